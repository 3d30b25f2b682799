"""Sinks: segments, manifests and run reports."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavequarry.session import write_text

#: Rows that a JSON array file may have; larger manifests are written as JSON lines by Spark.
ARRAY_ROWS = 1_000_000


def write_segments(segments: DataFrame, target: str, mode: str = "append") -> None:
    """Segments as Parquet, partitioned by dataset; Spark's commit makes them visible at once."""
    segments.write.mode(mode).partitionBy("dataset").parquet(target)


def write_manifest(split: DataFrame, target: str, mode: str = "overwrite") -> None:
    """The manifest as JSON lines, one folder per split, in shuffled order within it."""
    split.write.mode(mode).partitionBy("split").json(target)


def write_array(rows: DataFrame, file: str) -> None:
    """At most ``ARRAY_ROWS`` rows as one JSON array, for tools that expect one."""
    if rows.limit(ARRAY_ROWS + 1).count() > ARRAY_ROWS:
        raise ValueError(f"more than {ARRAY_ROWS} rows; use write_manifest")

    def lines() -> Iterator[str]:
        yield "["
        for k, r in enumerate(rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).toLocalIterator()):
            yield (",\n" if k else "\n") + r[0]
        yield "\n]\n"

    write_text(rows.sparkSession, file, lines())


def write_arrays(split: DataFrame, target: str) -> None:
    """Each split of the manifest as one JSON array, ``<split>.json``, in the order of ``split``."""
    for (name,) in split.select("split").distinct().collect():  # train, val and test
        write_array(split.where(F.col("split") == name).drop("split"), f"{target}/{name}.json")


def write_report(report: DataFrame, files: DataFrame, parameters: dict, target: str) -> None:
    """The run report: counts and parameters as ``summary.json``, the file results as JSON lines beside it."""
    files.write.mode("overwrite").json(f"{target}/files")
    stamp = report.select(F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")).first()[0]
    summary = report.first().asDict() | {"finished": stamp, "parameters": parameters}
    write_text(files.sparkSession, f"{target}/summary.json", [json.dumps(summary, indent=2, ensure_ascii=False, default=str)])
