"""Manifests: fields of segments, sampled fields, stratified splits and their statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wavequarry.functions.bids import component_after, parent_dir
from wavequarry.operators.ranking import hex_part, running
from wavequarry.session import cut, small_side

#: Default shares of train, validation and test.
RATIOS = (0.97, 0.03, 0.0)
SEED = 42


def shuffle_key(path: Column, seed: int = SEED) -> Column:
    """A reproducible random order that does not depend on the order of the rows."""
    return F.md5(F.concat(F.lit(f"{seed}:"), path.cast("string")))


def manifest_fields(segments: DataFrame, root: str = "curated") -> DataFrame:
    """dataset, path, channels, is_eeg, is_meg of every readable segment, from all of its sensors.

    Both flags are false for a mixed segment and true for one without sensors.
    """
    kinds = F.col("sensor_type")
    readable = segments.where("path IS NOT NULL AND x IS NOT NULL AND sensor_type IS NOT NULL")
    return readable.select(
        component_after(F.col("path"), root).alias("dataset"),
        "path",
        F.size("x").alias("channels"),
        F.forall(kinds, lambda k: k == 0).alias("is_eeg"),
        F.forall(kinds, lambda k: k.isin(1, 2)).alias("is_meg"),
    ).distinct()


def manifest_failures(segments: DataFrame, root: str = "curated") -> DataFrame:
    """Per dataset: segment rows, those that :func:`manifest_fields` takes and those it drops as not readable."""
    readable = F.col("x").isNotNull() & F.col("sensor_type").isNotNull()
    rows = segments.where("path IS NOT NULL").select(component_after(F.col("path"), root).alias("dataset"), readable.alias("ok"))
    return rows.groupBy("dataset").agg(F.count("*").alias("total"), F.count_if("ok").alias("readable"), F.count_if(~F.col("ok")).alias("failed"))


def shuffled(rows: DataFrame, path: str = "path", seed: int = SEED) -> DataFrame:
    """``rows`` with their ``place`` from 1 in shuffled order, ranked in parts of it."""
    rows = cut(rows)
    key = shuffle_key(F.col(path), seed)
    return running(rows, [], hex_part(key, rows.count()), [key, path], {"place": F.lit(1)})


def sampled_manifest(segments: DataFrame, seed: int = SEED, root: str = "curated") -> DataFrame:
    """The manifest from one random segment per folder: its fields hold for all of the folder.

    In this form is_meg is the negation of is_eeg. A folder whose sample is not readable is dropped.
    """
    folder = parent_dir(F.col("path"))
    files = segments.where("path IS NOT NULL").withColumn("dir", folder)
    fields = F.struct(F.size("x").alias("channels"), F.forall("sensor_type", lambda k: k == 0).alias("is_eeg"), F.col("x").isNotNull().alias("ok"))
    sample = files.groupBy("dir").agg(F.min_by(fields, F.struct(shuffle_key(F.col("path"), seed), F.col("x").isNull())).alias("f"))
    sample = sample.where("f.ok AND f.is_eeg IS NOT NULL").select("dir", "f.channels", "f.is_eeg")
    paths = files.select("dir", "path").distinct()
    return paths.join(sample, "dir").select(component_after(F.col("path"), root).alias("dataset"), "path", "channels", "is_eeg", (~F.col("is_eeg")).alias("is_meg"))


def stratified_split(rows: DataFrame, strata: list[str], path: str = "path", ratios: tuple[float, float, float] = RATIOS, seed: int = SEED, remainder: str = "drop") -> DataFrame:
    """``rows`` with a ``split``: in every stratum, in hash order, whole parts of train, validation and test.

    With a test ratio of zero the rows that rounding down leaves over are dropped, or
    go to train with ``remainder='train'``; otherwise they are the test split. Strata of any
    size are ranked in parts of the hash order.
    """
    train, val, test = ratios
    if min(ratios) < 0 or sum(ratios) > 1 + 1e-9 or remainder not in ("drop", "train"):
        raise ValueError("ratios must not be negative or exceed one; remainder is 'drop' or 'train'")
    rows = cut(rows)  # counted, summed by part and ranked
    sizes = rows.groupBy(*strata).agg(F.count("*").alias("_n")).select(*(F.col(c).alias(f"_{c}") for c in strata), "_n")
    same = F.lit(True)
    for c in strata:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    key = shuffle_key(F.col(path), seed)
    ranked = running(rows, strata, hex_part(key, rows.count()), [key, path], {"_k": F.lit(1)})
    placed = ranked.join(small_side(cut(sizes)), same).drop(*(f"_{c}" for c in strata))
    n_train = F.floor(F.col("_n") * F.lit(float(train)))
    n_val = F.floor(F.col("_n") * F.lit(float(val)))
    rest = F.lit("test") if test > 0 else F.lit("train") if remainder == "train" else F.lit(None).cast("string")
    split = F.when(F.col("_k") <= n_train, "train").when(F.col("_k") <= n_train + n_val, "val").otherwise(rest)
    return placed.withColumn("split", split).where("split IS NOT NULL").drop("_n", "_k")


def dataset_stats(manifest: DataFrame) -> DataFrame:
    """Per dataset: rows and the sorted distinct channel counts."""
    return manifest.groupBy("dataset").agg(F.count("*").alias("n"), F.sort_array(F.collect_set("channels")).alias("channels"))


def split_sizes(split: DataFrame) -> DataFrame:
    """Per split: rows, datasets and the share of all rows in percent."""
    sizes = split.groupBy("split").agg(F.count("*").alias("n"), F.count_distinct("dataset").alias("datasets"))
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))  # one row per split
    return sizes.withColumn("percent", 100.0 * F.col("n") / total)
