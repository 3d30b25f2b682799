"""Splits that keep related records together.

Records name the entities they belong to; entities that share a record are linked.
Parallel hooking and shortcutting over a parent table finds the connected
components: every round hooks each root to the smallest root it is linked to,
shortcuts the hooks by pointer jumping and contracts the links to the new roots, so
both tables shrink quickly. Components are then counted by size; a subset-sum bitset
over the sizes and their multiplicities chooses, for one split after the other, how
many components of each size bring its total closest to its share.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavequarry.functions.paths import dataset_of, subject_no
from wavequarry.operators.ranking import rank_in_class
from wavequarry.session import cut, small_side

#: Positions of the subset-sum bitset; totals are rounded to one part in as many.
RESOLUTION = 1 << 20


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b); the root is the smallest node of the component.

    Rows with a null end are ignored; a node without links is an edge from it to itself.
    """
    edges = edges.where("a IS NOT NULL AND b IS NOT NULL").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = cut(edges)
    parent = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("root", F.col("node"))
    links = edges.where("a <> b")
    while True:
        hooks = cut(links.groupBy(F.col("b").alias("root")).agg(F.min("a").alias("to")))
        if hooks.isEmpty():
            return parent
        while True:  # pointer jumping: hooks always lead to smaller roots, so this ends
            above = hooks.select(F.col("root").alias("to"), F.col("to").alias("next"))
            jumped = cut(hooks.join(above, "to", "left").select("root", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")))
            hooks = jumped.select("root", "to")
            if jumped.where("moved").isEmpty():
                break
        parent = cut(parent.join(hooks, "root", "left").select("node", F.coalesce("to", "root").alias("root")))
        ends = [hooks.select(F.col("root").alias(c), F.col("to").alias(f"{c}2")) for c in ("a", "b")]
        links = links.join(ends[0], "a", "left").join(ends[1], "b", "left").select(F.coalesce("a2", "a").alias("a"), F.coalesce("b2", "b").alias("b"))
        links = cut(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def record_entities(path: Column) -> Column:
    """The entities of a record: its subject's folder and its person; the record itself if it names no subject."""
    folder = F.regexp_extract(path, r"^(.*/sub-\d+)(?:/|$)", 1)
    person = F.concat_ws("|", dataset_of(path), subject_no(path).cast("string"))
    return F.when(subject_no(path).isNull(), F.array(path)).otherwise(F.array(folder, person))


def group_records(records: DataFrame, entities: Column) -> DataFrame:
    """``records`` with the ``component`` that their entities belong to.

    A record without entities is left out; a column ``component`` of the records
    themselves is replaced, all others are kept whatever their names.
    """
    rows = records.drop("component")
    keyed = rows.select(F.struct("*").alias("row"), entities.alias("entities")).where("size(entities) > 0")
    keyed = cut(keyed.withColumn("key", F.element_at("entities", 1)))  # read by the edges and by the join
    edges = keyed.select(F.col("key").alias("a"), F.explode("entities").alias("b"))
    found = components(edges).select(F.col("node").alias("key"), F.col("root").alias("component"))
    return keyed.join(found, "key").select("row.*", "component")


def closest_subset(sizes: list[tuple[int, float, int]], target: float, resolution: int = RESOLUTION) -> dict[int, int]:
    """How many components of each class (class, size, count) to take so that their sizes add up closest to ``target``.

    Multiplicities are split into powers of two; the bitset of reachable totals
    remembers the chunk that reached each total first, from which the choice is read back.
    """
    total = sum(size * count for _, size, count in sizes)
    unit = max(1.0, total / resolution)
    width = int(total / unit) + 2
    reach, first = np.zeros(width, dtype=bool), np.full(width, -1, dtype=np.int32)
    reach[0] = True
    chunks = []
    for klass, size, count in sorted(sizes, key=lambda s: (-s[1], s[0])):
        k = 1
        while count > 0:
            take = min(k, count)
            chunks.append((klass, take, int(round(size * take / unit))))
            count -= take
            k *= 2
    for i, (_, _, value) in enumerate(chunks):
        if 0 < value < width:
            moved = np.zeros(width, dtype=bool)
            moved[value:] = reach[: width - value]
            moved &= ~reach
            first[moved] = i
            reach |= moved
    at = int(np.flatnonzero(reach)[np.argmin(np.abs(np.flatnonzero(reach) - target / unit))])
    chosen: dict[int, int] = {}
    while at > 0:
        klass, take, value = chunks[first[at]]
        chosen[klass] = chosen.get(klass, 0) + take
        at -= value
    return chosen


def assign_splits(grouped: DataFrame, shares: dict[str, float]) -> DataFrame:
    """``grouped`` (with ``component``) with a ``new_split``: whole components, totals as close to the shares as they come.

    Shares are taken relative to their sum; splits are filled from the smallest to
    the largest, which takes the rest. An empty input gives an empty result. The driver sees
    the number of components of each size: of n records at most about the root of 2n sizes.
    """
    if not shares or min(shares.values()) < 0 or sum(shares.values()) <= 0:
        raise ValueError("shares must not be negative, and one must be positive")
    spark, grouped = grouped.sparkSession, grouped.drop("new_split")
    sized = grouped.groupBy("component").agg(F.count("*").alias("size"))
    sized = cut(sized.select("component", F.col("size").alias("klass")))
    ranked, counts = rank_in_class(sized, "klass", "component", sized.count())
    left = dict(counts)
    total = sum(k * n for k, n in counts)
    order = sorted(shares, key=lambda s: (shares[s], s))
    rows, used = [], dict.fromkeys(left, 0)
    for name in order:
        if name == order[-1]:
            chosen = dict(left)
        else:
            chosen = closest_subset([(k, float(k), n) for k, n in left.items() if n], total * shares[name] / sum(shares.values()))
        for k, n in chosen.items():
            if n:
                rows.append((k, used[k], used[k] + n, name))
                used[k] += n
                left[k] -= n
    ranges = spark.createDataFrame(rows, "klass bigint, first bigint, last bigint, new_split string")
    placed = ranked.join(small_side(ranges), "klass").where("rank >= first AND rank < last").select("component", "new_split")
    return grouped.join(placed, "component")


def leaking_components(grouped: DataFrame) -> DataFrame:
    """Components whose records are listed in more than one split: component, splits. ``grouped`` has ``split``."""
    per_split = grouped.groupBy("component", "split").agg(F.lit(1).alias("one"))
    return per_split.groupBy("component").agg(F.count("*").alias("splits")).where("splits > 1")
