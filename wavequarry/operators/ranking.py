"""Dense ranks and running sums within classes of any size."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wavequarry.session import cut, small_side

#: Rows of one class that one task ranks, on average.
RANKED_ROWS = 200_000


def hash_order(key: str) -> Column:
    """The place of ``key`` in hash order, not negative."""
    return F.shiftrightunsigned(F.xxhash64(key), 1)


def hash_parts(total: int) -> int:
    return max(1, math.ceil(total / RANKED_ROWS))


def hash_part(order: Column, total: int) -> Column:
    """The part of the hash order that a row belongs to, as many parts as ``total`` rows need."""
    parts = hash_parts(total)
    return F.least(F.floor(order / F.lit(float(1 << 63)) * parts), F.lit(parts - 1)).cast("int")


def part_bounds(part: Column, total: int) -> tuple[Column, Column]:
    """Places in the hash order that enclose a part, with a margin for the rounding of doubles."""
    at = lambda p: (p.cast("double") / hash_parts(total) * F.lit(float(1 << 63))).cast("bigint")
    high = F.when(part >= hash_parts(total) - 1, F.lit((1 << 63) - 1)).otherwise(at(part + 1) + 4096)
    return F.greatest(at(part) - 4096, F.lit(0)), high


def hex_part(hexadecimal: Column, total: int) -> Column:
    """The part of the order of hexadecimal hashes that a row belongs to, as many parts as ``total`` rows need."""
    parts = hash_parts(total)
    return F.least(F.floor(F.conv(F.substring(hexadecimal, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32)) * parts), F.lit(parts - 1)).cast("int")


def running(rows: DataFrame, klass: list[str], part: Column, order: list[Column | str], sums: dict[str, Column]) -> DataFrame:
    """``rows`` with running sums within their class, the row itself included.

    ``part`` must not fall along ``order`` within a class: a class is summed in as many
    pieces as it has parts, and a part starts from the sums of those before it, so no task
    holds a whole hot class. Classes may be null.
    """
    keyed = rows.withColumn("_part", part).withColumns({f"_{name}": value for name, value in sums.items()})
    parts = cut(keyed.groupBy(*klass, "_part").agg(*(F.sum(f"_{name}").alias(f"_{name}") for name in sums)))
    before = Window.partitionBy(*klass).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    named = [F.col(k).alias(f"_{k}_") for k in klass]
    offsets = parts.select(*named, F.col("_part").alias("_part_"), *(F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_{n}_") for n in sums))
    within = Window.partitionBy(*klass, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = keyed.withColumns({name: F.sum(f"_{name}").over(within) for name in sums})
    same = F.col("_part").eqNullSafe(F.col("_part_"))
    for k in klass:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}_"))
    found = summed.join(small_side(offsets), same)
    return found.select(*(c for c in rows.columns if c not in sums), *((F.col(name) + F.col(f"_{name}_")).alias(name) for name in sums))


def rank_in_class(rows: DataFrame, klass: str, key: str, total: int) -> tuple[DataFrame, list[tuple]]:
    """``rows`` with ``h``, ``part`` and the ``rank`` from 0 in hash order within their class, and the (class, count) list.

    A class is ranked in as many parts of the hash order as ``total`` rows need; a
    part's ranks start where the parts before it end, so no task holds a whole hot
    class. The classes must be few: their counts go to the driver. ``key`` must be unique.
    """
    ordered = rows.withColumn("h", hash_order(key)).withColumn("part", hash_part(F.col("h"), total))
    parts = cut(ordered.groupBy(klass, "part").count())
    counts = [tuple(r) for r in parts.groupBy(klass).agg(F.sum("count")).collect()]
    before = Window.partitionBy(klass).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(klass, "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    ranked = ordered.withColumn("rank", F.row_number().over(Window.partitionBy(klass, "part").orderBy("h", key)) - 1)
    ranked = ranked.join(small_side(offsets), [klass, "part"])
    return ranked.withColumn("rank", F.col("rank") + F.col("offset")).drop("offset"), counts
