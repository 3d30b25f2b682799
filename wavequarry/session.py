"""Session helpers: shared folders, lineage cuts and bounded broadcasts."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is broadcast only if it has at most this many rows.
BROADCAST_ROWS = 100_000


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Where the setting is absent and Spark runs within one machine (tests, a laptop) a
    temporary folder is made and set as the checkpoint folder of the session; a
    cluster must name one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = "file://" + tempfile.mkdtemp(prefix="spark-wavequarry-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_folder(spark)}/wavequarry/{name}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path and the path as its object."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = file_system(spark, path)
    return fs.exists(at)


def write_text(spark: SparkSession, path: str, chunks: Iterable[str]) -> None:
    """A text file on whatever file system the path names, written piece by piece."""
    fs, at = file_system(spark, path)
    out = fs.create(at, True)
    try:
        for chunk in chunks:
            out.write(bytearray(chunk.encode()))
    finally:
        out.close()


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared checkpoint folder and read it back."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it is counted to be small, else unchanged.

    The count is an action over ``df``: use it on tables that are cheap or cut.
    """
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per Spark application.

    The zip lies in the shared folder where that is a mounted one, else Spark's file
    server hands out the driver's copy.
    """
    context = spark.sparkContext
    if getattr(context, "_wavequarry_shipped", False):
        return
    folder = re.sub("^file:/+", "/", shared_folder(spark))
    folder = tempfile.mkdtemp(prefix="spark-wavequarry-") if "://" in folder else folder
    os.makedirs(folder, exist_ok=True)
    file = f"{folder}/wavequarry-{uuid.uuid4().hex}.zip"
    package = Path(__file__).resolve().parent
    with zipfile.ZipFile(file, "w", zipfile.ZIP_DEFLATED) as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    context.addPyFile(file)
    context._wavequarry_shipped = True


def arrow_batches(spark: SparkSession, rows: int = 2000, size: str = "16m") -> None:
    """Bound the Arrow batches that go to Python workers (signals are wide rows), and see to it that these have the package."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One Parquet table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
