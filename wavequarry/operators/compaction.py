"""Consolidation of tiny files into few even ones.

The files to merge are listed once into a frozen manifest (path, bytes, checksum).
Sizes are rounded up to ``SIGNIFICANT_BITS`` bits, so close sizes are one class and small
ones stay exact whatever the target; first-fit decreasing packs the classes: it fills one
bin after the other with the largest classes that still fit, and repeats a bin's pattern
while the classes last. The driver sees only the class counts, at most a few hundred for
every doubling of the size. Within a class the files go to its bins in hash order, so a bin
is a range of hashes per class and a row finds its bin by itself: signals move once, to
the task that writes their bin as one file of a staging folder. The row counts and
checksums of what was written are held against the manifest, and a rename makes the folder
visible (atomic where the file system's rename is).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wavequarry.operators.ranking import hash_order, hash_part, part_bounds, rank_in_class
from wavequarry.session import cut, small_side

#: Bytes of payload that one consolidated file should hold.
TARGET_BYTES = 32 << 20
#: Leading bits of a size that tell its class from others.
SIGNIFICANT_BITS = 9
#: Bins beyond this number share write tasks, each still with a file of its own.
WRITE_TASKS = 20_000


def pack(classes: list[tuple[int, int]], capacity: int) -> list[tuple[int, int, int, int]]:
    """First-fit decreasing over (size, count): runs (size, first rank, files per bin, first bin).

    A run's files fill bins one after the other until the size's next run begins.
    A size beyond the capacity gets a bin for each file.
    """
    left = {size: count for size, count in sorted(classes, reverse=True) if count > 0}
    used = dict.fromkeys(left, 0)
    runs, bins = [], 0
    while left:
        space, pattern, least = capacity, {}, next(reversed(left))
        for size in left:
            if pattern and space < least:
                break
            take = min(left[size], space // size)
            if not pattern and not take:
                pattern[size] = 1
                break
            if take:
                pattern[size] = take
                space -= take * size
        repeat = min(left[size] // take for size, take in pattern.items())
        for size, take in pattern.items():
            runs.append((size, used[size], take, bins))
            used[size] += take * repeat
            left[size] -= take * repeat
            if not left[size]:
                del left[size]
        bins += repeat
    return runs


def _bytes(payload: str = "x") -> Column:
    return F.aggregate(payload, F.lit(0).cast("bigint"), lambda n, c: n + F.coalesce(F.size(c), F.lit(0)).cast("bigint")) * 4


def freeze(rows: DataFrame, listed: DataFrame) -> DataFrame:
    """The frozen manifest: path, bytes and checksum of the listed paths that ``rows`` hold, one row per path.

    Of repeated rows of a path the one with the smallest checksum is kept, so the
    choice does not depend on the order of the rows.
    """
    per_row = rows.select("path", F.struct(F.xxhash64("path", "x").alias("checksum"), _bytes().alias("bytes")).alias("f"))
    per_path = per_row.groupBy("path").agg(F.min("f").alias("f")).join(listed.select("path").distinct(), "path", "left_semi")
    return cut(per_path.select("path", F.col("f.bytes").alias("bytes"), F.col("f.checksum").alias("checksum")))


class Bins:
    """First-fit decreasing bins over a frozen manifest."""

    def __init__(self, manifest: DataFrame, target_bytes: int = TARGET_BYTES) -> None:
        spark = manifest.sparkSession
        total, self.files, largest = manifest.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.count("*"), F.coalesce(F.max("bytes"), F.lit(0))).first()
        even = math.ceil(total / max(1, math.ceil(total / target_bytes)))
        ranked, counts = rank_in_class(manifest.withColumn("klass", _klass(F.col("bytes"))), "klass", "path", self.files)
        rounded = sum(k * n for k, n in counts) / max(1, total)
        # the slack of one file and of the rounding to classes keeps the last bin from being a remnant
        capacity = math.ceil((even + min(largest, target_bytes)) * max(1.0, rounded))
        rows, last = [], dict(counts)
        for klass, first, take, start in reversed(pack(counts, capacity)):
            rows.append((klass, first, last[klass], take, start))
            last[klass] = first
        self.count = max((start + math.ceil((end - first) / take) for _, first, end, take, start in rows), default=1)
        runs = spark.createDataFrame(rows, "klass bigint, first bigint, last bigint, take bigint, start bigint")
        placed = ranked.join(small_side(runs), "klass").where("rank >= first AND rank < last")
        bin_ = (F.col("start") + F.floor((F.col("rank") - F.col("first")) / F.col("take"))).cast("int")
        starts = placed.select("klass", "part", bin_.alias("bin"), "h").groupBy("klass", "part", "bin").agg(F.min("h").alias("low"))
        order = Window.partitionBy("klass", "part").orderBy("low")
        begin, end = part_bounds(F.col("part"), self.files)
        low = F.when(F.row_number().over(order) == 1, begin).otherwise(F.col("low"))
        ranges = cut(starts.select("klass", "part", "bin", low.alias("low"), F.coalesce(F.lead("low").over(order), end).alias("high")))
        # as many slots of the hash order as the class has ranges, so a row meets about two of them
        self.slots = cut(ranges.groupBy("klass").agg(F.count("*").alias("slots")))
        slot = lambda c: _slot(F.col(c), F.col("slots"))
        ranges = ranges.join(small_side(self.slots), "klass").withColumn("slot", F.explode(F.sequence(slot("low"), slot("high"))))
        self.ranges = cut(ranges.drop("slots"))

    def place(self, rows: DataFrame) -> DataFrame:
        """``rows`` (path, bytes and others) with the ``bin`` of their size and hash; rows that no bin was made for are dropped."""
        keyed = rows.withColumn("klass", _klass(F.col("bytes"))).withColumn("h", hash_order("path")).withColumn("part", hash_part(F.col("h"), self.files))
        keyed = keyed.join(small_side(self.slots), "klass").withColumn("slot", _slot(F.col("h"), F.col("slots")))
        found = keyed.join(small_side(self.ranges), ["klass", "part", "slot"]).where("h >= low AND h < high")
        return found.drop("klass", "part", "h", "slot", "slots", "low", "high")


def _klass(size: Column) -> Column:
    """``size`` rounded up to its ``SIGNIFICANT_BITS`` first bits."""
    unit = F.pow(F.lit(2.0), F.greatest(F.length(F.bin(size)) - SIGNIFICANT_BITS, F.lit(0)))
    return F.greatest(F.ceil(size / unit) * unit, F.lit(1)).cast("bigint")


def _slot(h: Column, slots: Column) -> Column:
    return F.floor(h / F.lit(float(1 << 63)) * slots).cast("int")


def _rename(spark: SparkSession, source: str, target: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.rename(path(source), path(target)):
        raise OSError(f"could not commit {source} as {target}")


def compact(rows: DataFrame, listed: DataFrame, target: str, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Rewrite the listed ``rows`` (path, x) as few even files under ``target``; return path, x, bin as read back.

    One row is kept for each path of ``listed`` that has a signal. Rows with null path
    or x are left out, other columns are not carried. No row at all gives an empty
    result and commits nothing. Raises, and commits nothing, if a bin's rows or checksums differ from the
    frozen manifest; ``target`` must not exist.
    """
    spark = rows.sparkSession
    rows = rows.where("path IS NOT NULL AND x IS NOT NULL").select("path", "x")
    manifest = freeze(rows, listed)
    if manifest.isEmpty():
        return manifest.join(rows, "path").select("path", "x", F.lit(0).alias("bin"))
    bins = Bins(manifest, target_bytes)
    frozen = cut(bins.place(manifest))
    staging = target + ".staging"
    signal = bins.place(rows.withColumn("bytes", _bytes())).select("bin", "path", F.xxhash64("path", "x").alias("checksum"), "x", F.lit(False).alias("frozen"))
    wanted = frozen.select("bin", "path", "checksum", F.lit(None).cast(rows.schema["x"].dataType).alias("x"), F.lit(True).alias("frozen"))
    tasks = min(bins.count, WRITE_TASKS)
    tagged = signal.unionByName(wanted).withColumn("task", F.col("bin") % tasks).repartitionById(tasks, F.col("task"))
    # within a task, sorted by bin, as the files are written: no second shuffle, no second sort
    same = Window.partitionBy("bin", "path", "checksum", "task").orderBy(F.desc("frozen"))
    # the manifest's row comes first; the signal row right behind it is the one that is kept
    chosen = tagged.withColumn("nth", F.row_number().over(same)).withColumn("known", F.first("frozen").over(same)).where("known AND nth = 2")
    chosen.select("path", "x", "bin").write.partitionBy("bin").parquet(staging)
    check = lambda df: df.groupBy("bin").agg(F.count("*").alias("n"), F.bit_xor("checksum").alias("checksum"))
    actual = check(spark.read.parquet(staging).select("bin", F.xxhash64("path", "x").alias("checksum")))
    wrong = check(frozen).join(actual.withColumnsRenamed({"n": "n2", "checksum": "c2"}), "bin", "full").where("NOT (n <=> n2) OR NOT (checksum <=> c2)")
    if bad := wrong.count():
        raise ValueError(f"{bad} of {bins.count} bins differ from the manifest; {staging} is not committed")
    _rename(spark, staging, target)
    return spark.read.parquet(target)


def file_report(compacted: DataFrame) -> DataFrame:
    """One row per consolidated file: bin, records and payload bytes."""
    return compacted.groupBy("bin").agg(F.count("*").alias("records"), F.sum(_bytes()).alias("bytes"))
