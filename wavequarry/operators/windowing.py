"""Hopping windows, normalisation per sensor type and acceptance of segments.

Two forms of the same operators: a relational one over (rec, ch, type, t, v), which
SQL can check, and an array one over channels, where Spark cuts and places windows and
NumPy normalises each segment inside the task. Tests tie them together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wavequarry.functions.signals import matrix, nested
from wavequarry.session import arrow_batches

#: What is added to the spread of EEG, magnetometers and gradiometers.
EPSILON = (1e-5, 1e-13, 1e-13)
#: Defaults: window and stride in seconds, target rate.
WINDOW_S, STRIDE_S, RATE = 10, 5, 256
#: A rate this close to the target is not resampled.
RATE_TOLERANCE = 0.1


def check_window(window: int, stride: int) -> None:
    if window <= 0 or stride <= 0:
        raise ValueError("window and stride must be positive")


def window_count(n: Column, window: int, stride: int) -> Column:
    """How many whole windows fit into ``n`` samples."""
    check_window(window, stride)
    return F.when(n < window, F.lit(0)).otherwise(F.floor((n - window) / stride) + 1).cast("int")


def epsilon(kind: Column) -> Column:
    return F.when(kind == 0, F.lit(EPSILON[0])).otherwise(F.lit(EPSILON[1]))


def long_signals(channels: DataFrame, values: str = "samples") -> DataFrame:
    """(rec, ch, type, t, v) from one row per channel with an array of samples."""
    return channels.select("rec", "ch", "type", F.posexplode(values).alias("t", "v")).withColumn("v", F.col("v").cast("double"))


def average_reference(signals: DataFrame) -> DataFrame:
    """``signals`` with ``r``: v without the mean over the channels of its type at its time."""
    return signals.withColumn("r", F.col("v") - F.avg("v").over(Window.partitionBy("rec", "type", "t")))


def into_windows(signals: DataFrame, lengths: DataFrame, window: int, stride: int) -> DataFrame:
    """Each row once for every whole window that covers its time: ``win`` is the window's number.

    ``lengths`` has (rec, n); windows start at 0, stride, 2·stride and so on, and an
    incomplete last one is dropped.
    """
    count = window_count(F.col("n"), window, stride)
    first = F.greatest(F.lit(0), F.ceil((F.col("t") - window + 1) / stride)).cast("int")
    last = F.least(count - 1, F.floor(F.col("t") / stride)).cast("int")
    timed = signals.join(lengths, "rec").withColumn("first", first).withColumn("last", last).where("first <= last")
    return timed.withColumn("win", F.explode(F.sequence("first", "last"))).drop("first", "last", "n")


def segment_stats(windowed: DataFrame) -> DataFrame:
    """Per recording, window and type: channels, values, and mean, sample spread and maximum of the normalised signal.

    The normalised value is r over (population spread + epsilon), so its statistics
    follow from those of r in one aggregation.
    """
    scale = F.stddev_pop("r") + epsilon(F.col("type"))
    return windowed.groupBy("rec", "win", "type").agg(
        F.count_distinct("ch").alias("n_ch"),
        F.count("*").alias("n"),
        (F.avg("r") / scale).alias("x_mean"),
        (F.stddev_samp("r") / scale).alias("x_std"),
        (F.max("r") / scale).alias("x_max"),
    )


def accepted_windows(windowed: DataFrame, positions: DataFrame | None = None) -> DataFrame:
    """Windows without NaN, numbered densely: rec, win, seg_idx.

    With ``positions`` (rec, x, y, z) no window of a recording that has a NaN position is accepted.
    """
    clean = windowed.groupBy("rec", "win").agg(F.bool_or(F.isnan("v")).alias("bad")).where("NOT bad")
    if positions is not None:
        lost = positions.where(F.isnan("x") | F.isnan("y") | F.isnan("z")).select("rec").distinct()
        clean = clean.join(lost, "rec", "left_anti")
    return clean.select("rec", "win", (F.row_number().over(Window.partitionBy("rec").orderBy("win")) - 1).alias("seg_idx"))


def normalize(x: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """One segment (channels by samples): average reference and scale per sensor type, as float32."""
    out = np.array(x, dtype=np.float64)
    for kind, eps in enumerate(EPSILON):
        rows = kinds == kind
        if rows.any():
            part = out[rows] - out[rows].mean(axis=0, keepdims=True)
            out[rows] = part / (part.std() + eps)
    return out.astype(np.float32)


def round_bf16(x: np.ndarray) -> np.ndarray:
    """float32 values rounded to bfloat16, ties to even, NaN kept."""
    bits = np.ascontiguousarray(x, dtype=np.float32).view(np.uint32)
    rounded = ((bits.astype(np.uint64) + 0x7FFF + ((bits >> 16) & 1)) & 0xFFFF0000).astype(np.uint32)
    return np.where(np.isnan(x), np.float32(np.nan), rounded.view(np.float32))


def _normalized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kinds = batch.column("sensor_type")
        segments = [round_bf16(normalize(matrix(x), k.values.to_numpy(zero_copy_only=False))) for x, k in zip(batch.column("x"), kinds, strict=True)]
        columns = [batch.column(c) for c in ("rec", "win_idx", "seg_idx", "chs", "sensor_type")]
        yield pa.RecordBatch.from_arrays([*columns, nested(segments, pa.float32())], names=["rec", "win_idx", "seg_idx", "chs", "sensor_type", "x"])


def segment_channels(channels: DataFrame, window: int, stride: int) -> DataFrame:
    """Normalised, accepted, bfloat16-rounded segments: rec, win_idx, seg_idx, chs, sensor_type, x.

    ``channels`` has rec, ch, type and samples, one row per channel; a recording is as
    long as its shortest channel. No row ever holds more than a channel or a segment:
    windows are cut from the channels, and each segment is normalised where its
    channels meet. A NaN or infinite reading makes its whole sensor group NaN, so
    windows are rejected, and the others numbered densely, from the raw readings. A
    recording shorter than a window, or without a clean one, gives no row; channels
    without samples are ignored.
    """
    check_window(window, stride)
    arrow_batches(channels.sparkSession, rows=256)
    rows = channels.where("samples IS NOT NULL AND size(samples) > 0").select("rec", "ch", "type", "samples")
    wild = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    at = F.filter(F.transform("samples", lambda v, i: F.when(wild(v), i)), lambda i: i.isNotNull())
    first = lambda i: F.greatest(F.lit(0), F.ceil((i - window + 1) / stride)).cast("int")
    last = lambda i: F.floor(i / stride).cast("int")
    none = F.expr("cast(array() as array<int>)")  # a reading between two windows rejects neither
    hit = F.array_distinct(F.flatten(F.transform(at, lambda i: F.when(first(i) <= last(i), F.sequence(first(i), last(i))).otherwise(none))))
    lengths = rows.groupBy("rec").agg(F.min(F.size("samples")).alias("n"))
    bad = rows.select("rec", F.explode(hit).alias("win")).distinct().groupBy("rec").agg(F.collect_list("win").alias("bad"))
    covered = F.filter("bad", lambda w: w < F.col("count"))
    plan = lengths.join(bad, "rec", "left").withColumn("count", window_count(F.col("n"), window, stride)).where("count > 0")
    plan = plan.select("rec", "count", F.coalesce(covered, none).alias("bad"))
    wins = F.filter(F.sequence(F.lit(0), F.col("count") - 1), lambda w: ~F.array_contains("bad", w))
    cut_out = rows.join(plan, "rec").withColumn("win_idx", F.explode(wins))
    seg = F.col("win_idx") - F.size(F.filter("bad", lambda b: b < F.col("win_idx")))
    part = F.slice("samples", F.col("win_idx") * stride + 1, window)
    pieces = F.array_sort(F.collect_list(F.struct("ch", "type", "part")))
    whole = cut_out.select("rec", "win_idx", seg.alias("seg_idx"), "ch", "type", part.alias("part")).groupBy("rec", "win_idx", "seg_idx").agg(pieces.alias("p"))
    named = whole.select("rec", "win_idx", "seg_idx", F.col("p.ch").alias("chs"), F.col("p.type").cast("array<int>").alias("sensor_type"), F.col("p.part").alias("x"))
    rec, ch = (channels.schema[c].dataType.simpleString() for c in ("rec", "ch"))
    return named.mapInArrow(_normalized, f"rec {rec}, win_idx int, seg_idx int, chs array<{ch}>, sensor_type array<int>, x array<array<float>>")
