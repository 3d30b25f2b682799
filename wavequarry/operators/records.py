"""Records: what the manifests list and what the segment table stores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavequarry.functions.paths import dataset_of, record_path
from wavequarry.session import load


#: The canonical path in DuckDB's SQL, for tests; it resolves one level of ``x/..``.
RECORD_PATH_SQL = (
    "CASE WHEN regexp_matches(path, '(^|/)curated/') THEN regexp_replace(regexp_replace(regexp_replace("
    "'/data/curated/' || regexp_extract(path, '(?:^|/)curated/+(.*)$', 1), '/(\\./)+', '/', 'g'), '/+', '/', 'g'), '/[^/]+/\\.\\./', '/', 'g') END"
)


def listed_paths(manifest: DataFrame) -> DataFrame:
    """Distinct canonical paths of a manifest; rows whose path is null or not a record's are left out."""
    return manifest.select(record_path(F.col("path")).alias("path")).where("path IS NOT NULL").distinct()


def stored_rows(segments: DataFrame) -> DataFrame:
    """Segment rows that hold a signal, under their canonical path, with the dataset of the path as ``source``."""
    path = record_path(F.col("path"))
    return segments.where("x IS NOT NULL").withColumn("path", path).where("path IS NOT NULL").withColumn("source", dataset_of(F.col("path")))


def splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (split, path) over the three manifests."""
    parts = [listed_paths(load(spark, sf_dir, s)).select(F.lit(s).alias("split"), "path") for s in ("train", "val", "test")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
