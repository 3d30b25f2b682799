"""Conversion of segments to bfloat16 precision.

Values are rounded in Arrow batches: a float is a bfloat16 value if the lower half of
its bits is zero, which SQL cannot see. ``functions.numeric.bf16`` is the same
rounding as an expression.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from wavequarry.operators.windowing import round_bf16
from wavequarry.session import arrow_batches


def _flat(column: pa.ListArray) -> tuple[pa.ListArray, np.ndarray]:
    """The channels of a nested column and all their values as float32 (null as NaN)."""
    channels = column.flatten()
    return channels, channels.flatten().to_numpy(zero_copy_only=False).astype(np.float32)


def _row_counts(column: pa.ListArray, flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row the number of values and the number of flagged values."""
    lengths = lambda a: np.nan_to_num(a.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    per_channel = lengths(column.flatten())
    row_of_channel = np.repeat(np.arange(len(column)), lengths(column))
    row = np.repeat(row_of_channel, per_channel)
    values = np.bincount(row, minlength=len(column))
    return values, np.bincount(row[flags], minlength=len(column))


def _rest(values: np.ndarray) -> np.ndarray:
    """Which values bfloat16 cannot hold."""
    return (np.ascontiguousarray(values).view(np.uint32) & 0xFFFF != 0) & ~np.isnan(values)


def _rounded(column: pa.ListArray) -> pa.ListArray:
    channels, values = _flat(column)
    lengths = channels.value_lengths()
    offsets = pa.array(np.concatenate([[0], np.cumsum(np.nan_to_num(lengths.to_numpy(zero_copy_only=False)))]).astype(np.int32))
    flat = pa.array(round_bf16(values), mask=channels.flatten().is_null().to_numpy(zero_copy_only=False))
    inner = pa.ListArray.from_arrays(offsets, flat, mask=channels.is_null() if channels.null_count else None)
    outer = np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False)).cumsum()
    starts = pa.array(np.concatenate([[0], outer]).astype(np.int32))
    return pa.ListArray.from_arrays(starts, inner, mask=column.is_null() if column.null_count else None)


def _convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns, left = dict(zip(batch.schema.names, batch.columns, strict=True)), np.zeros(batch.num_rows, dtype=np.int64)
        for name in ("x", "pos"):
            left += _row_counts(columns[name], _rest(_flat(columns[name])[1]))[1]
            columns[name] = _rounded(columns[name])
        columns["was_bf16"] = pa.array(left == 0)
        yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, left = np.zeros(batch.num_rows, dtype=np.int64), np.zeros(batch.num_rows, dtype=np.int64)
        missing = np.zeros(batch.num_rows, dtype=bool)
        for name in ("x", "pos"):
            column = batch.column(name)
            values, rest = _row_counts(column, _rest(_flat(column)[1]))
            n, left = n + values, left + rest
            missing |= column.is_null().to_numpy(zero_copy_only=False)
        state = np.where(missing, "failed", np.where(left == 0, "skipped", "converted"))
        after = np.where(state == "converted", 2 * n, 4 * n)
        yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(4 * n), pa.array(after), pa.array(state.tolist(), type=pa.string())], names=["path", "bytes_before", "bytes_after", "state"])


def convert_segments(segments: DataFrame) -> DataFrame:
    """``segments`` with x and pos (nested FLOAT) rounded to bfloat16 and ``was_bf16``; converting twice changes nothing.

    Missing parts stay missing and do not count against ``was_bf16``; a column of that name is replaced.
    """
    arrow_batches(segments.sparkSession)
    rows = segments.drop("was_bf16").withColumns({c: F.col(c).cast("array<array<float>>") for c in ("x", "pos")})
    return rows.mapInArrow(_convert, StructType([*rows.schema.fields, StructField("was_bf16", BooleanType())]))


def conversion_plan(segments: DataFrame) -> DataFrame:
    """Dry run: per row path, bytes now (four a value), bytes after (two a value; unchanged where already converted) and the state.

    A row without x or pos is failed.
    """
    arrow_batches(segments.sparkSession)
    rows = segments.select("path", *(F.col(c).cast("array<array<float>>").alias(c) for c in ("x", "pos")))
    return rows.mapInArrow(_plan, "path string, bytes_before bigint, bytes_after bigint, state string")
