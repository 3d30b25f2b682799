"""Electrode tables beside the recordings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavequarry.functions.bids import entities, parent_dir
from wavequarry.operators.coords import KIND_EEG, KIND_MEG, first_candidate, last_electrode

SCHEMA = "name string, x double, y double, z double"


def read_electrodes(spark: SparkSession, root: str) -> DataFrame:
    """(file, dir, ord, name, x, y, z) of every ``*_electrodes.tsv`` below ``root``; ``n/a`` is null."""
    rows = (
        spark.read.schema(SCHEMA).option("sep", "\t").option("header", True).option("nullValue", "n/a").option("recursiveFileLookup", True).option("pathGlobFilter", "*_electrodes.tsv").csv(root)
    )
    file = F.regexp_replace(F.col("_metadata.file_path"), r"^file:/+", "/")
    rows = rows.select(file.alias("file"), "name", "x", "y", "z", F.monotonically_increasing_id().alias("ord"))
    return rows.withColumn("dir", parent_dir(F.col("file")))


def read_channel_kinds(spark: SparkSession, root: str) -> DataFrame:
    """(file, name, kind, coil) of every ``*_channels.tsv`` below ``root``: EEG, MEG (with its type as the coil) or neither.

    Name and type are the first two columns, whatever follows them.
    """
    rows = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*_channels.tsv").text(root)
    part = lambda i: F.trim(F.split_part("value", F.lit("\t"), F.lit(i)))
    rows = rows.withColumn("name", part(1)).withColumn("type", part(2)).where("name <> '' AND NOT (name = 'name' AND type = 'type')")
    file = F.regexp_replace(F.col("_metadata.file_path"), r"^file:/+", "/")
    coil = F.upper(F.trim("type"))
    kind = F.when(coil == "EEG", F.lit(KIND_EEG)).when(F.startswith(coil, F.lit("MEG")), F.lit(KIND_MEG)).otherwise(0)
    return rows.select(file.alias("file"), "name", kind.alias("kind"), coil.alias("coil"))


def kinds_of(recordings: DataFrame, kinds: DataFrame) -> DataFrame:
    """(rec, name, kind, coil) of the channel table that lies beside a recording (rec, stem, dir) under its name."""
    file = F.concat("dir", F.lit("/"), F.regexp_replace("stem", "_(eeg|meg)$", ""), F.lit("_channels.tsv"))
    found = recordings.select("rec", file.alias("file")).join(kinds, "file")
    return found.groupBy("rec", "name").agg(F.max(F.struct("kind", "coil")).alias("k")).select("rec", "name", "k.*")


def electrodes_of(recordings: DataFrame, electrodes: DataFrame) -> DataFrame:
    """(rec, name, x, y, z): the electrodes of the first table that a recording (rec, stem, dir) finds.

    In order: one with its session and task, with its task, with its session, or of its subject, in its
    own folder. Of repeated names in a table the last row counts.
    """
    e = entities(F.col("stem"))
    sub, ses, task = (F.concat(F.lit(f"{k}-"), e[k]) for k in ("sub", "ses", "task"))
    names = [F.concat_ws("_", *parts, F.lit("electrodes.tsv")) for parts in ((sub, ses, task), (sub, task), (sub, ses), (sub,))]
    tables = electrodes.select("file").distinct()
    wanted = recordings.select("rec", F.posexplode(F.array(*(F.concat(F.col("dir"), F.lit("/"), n) for n in names))).alias("priority", "file"))
    chosen = first_candidate(wanted.join(tables, "file"), "rec", "priority")
    rows = chosen.select("rec", "file").join(electrodes, "file").select(F.struct("rec", "name").alias("key"), "x", "y", "z", "ord")
    return last_electrode(rows, "key", "ord").select("key.rec", "key.name", "x", "y", "z")
