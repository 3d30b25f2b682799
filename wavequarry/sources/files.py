"""Discovery of recordings and file sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavequarry.functions.bids import is_preprocessed, parent_dir, record_key, stem

EXTENSIONS = ("fif", "vhdr")


def list_files(spark: SparkSession, root: str, extensions: tuple[str, ...]) -> DataFrame:
    """(path, size, modified) of the files below ``root`` with one of the extensions; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{" + ",".join(extensions) + "}").load(root)
    return files.select(F.regexp_replace("path", r"^file:", "").alias("path"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def discover_recordings(spark: SparkSession, root: str, extensions: tuple[str, ...] = EXTENSIONS, limit: int | None = None) -> DataFrame:
    """Preprocessed recordings below ``root`` in component order; ``limit`` 0 or None means all."""
    found = list_files(spark, root, extensions).where(is_preprocessed(F.col("path"))).orderBy(F.split("path", "/"))
    found = found.limit(limit) if limit else found
    return found.withColumn("rec", record_key(F.col("path"))).withColumn("stem", stem(F.col("path"))).withColumn("dir", parent_dir(F.col("path")))
