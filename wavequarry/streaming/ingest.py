"""Incremental ingestion of segment files as they land.

The file source keeps track of what it has read in its checkpoint, so every run takes
the files that are new since the last one, exactly once, and ends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wavequarry.functions.paths import dataset_of, record_path


def segment_stream(spark: SparkSession, source: str, schema: StructType) -> DataFrame:
    """The segment files below ``source`` as a stream, under canonical paths."""
    rows = spark.readStream.schema(schema).parquet(source)
    return rows.withColumn("path", record_path(F.col("path"))).where("path IS NOT NULL").withColumn("source", dataset_of(F.col("path")))


def first_landings(stream: DataFrame, lateness: str = "30 days") -> DataFrame:
    """One row per record within the watermark: a row that lands again for a known path is dropped."""
    return stream.withWatermark("landed_at", lateness).dropDuplicatesWithinWatermark(["path"])


def landing_counts(stream: DataFrame, window: str = "1 day", lateness: str = "30 days") -> DataFrame:
    """Rows and late rows per source and day of landing; late means more than an hour after writing."""
    late = F.col("landed_at") > F.col("written_at") + F.expr("INTERVAL 1 HOUR")
    timed = stream.withWatermark("landed_at", lateness)
    counts = timed.groupBy(F.window("landed_at", window).alias("w"), "source").agg(F.count("*").alias("rows"), F.count_if(late).alias("late"))
    return counts.select("source", F.col("w.start").alias("day"), "rows", "late")


def ingest(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Append what is new to the table at ``target`` and stop."""
    query = stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()


def ingest_batches(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Write what each batch changed in an aggregation to a folder of its own below ``target``, and stop.

    A batch that is repeated after a failure replaces only its own folder, and state
    ends with the watermark. :func:`latest` reads the result.
    """

    def replace(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    query = stream.writeStream.foreachBatch(replace).option("checkpointLocation", checkpoint).outputMode("update").trigger(availableNow=True).start()
    query.awaitTermination()


def latest(spark: SparkSession, target: str, keys: list[str]) -> DataFrame:
    """The rows of :func:`ingest_batches` as of the last batch that changed them."""
    rows = spark.read.parquet(target)
    values = F.struct(*(c for c in rows.columns if c not in (*keys, "batch")))
    return rows.groupBy(*keys).agg(F.max_by(values, "batch").alias("v")).select(*keys, "v.*")
