"""Queries of the general data problems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wavequarry.operators.compaction import compact
from wavequarry.operators.records import RECORD_PATH_SQL, listed_paths, stored_rows
from wavequarry.operators.spikes import implausible_channels
from wavequarry.session import load, scratch_path


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channels with implausible readings, by dataset of the record's path."""
    signals = stored_rows(load(spark, sf_dir, "segments")).select("path", "source", "x")
    return implausible_channels(signals).select("path", "ch")


def compacted_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored train records, consolidated into even files in the shared folder."""
    listed = listed_paths(load(spark, sf_dir, "train"))
    rows = stored_rows(load(spark, sf_dir, "segments")).select("path", "x")
    return compact(rows, listed, scratch_path(spark, "train"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records that the consolidated files hold, read back from them."""
    return compacted_train(spark, sf_dir).select("path")


QUERIES = {"p1_found": p1_found, "p3_found": p3_found}

ORACLE = {
    "p3_found": f"""SELECT DISTINCT {RECORD_PATH_SQL} AS path FROM train WHERE {RECORD_PATH_SQL} IN (SELECT {RECORD_PATH_SQL} FROM segments WHERE x IS NOT NULL)""",
}
