from __future__ import annotations

import itertools
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wavequarry.functions.paths import dataset_of, subject_no
from wavequarry.llm import split_groups


def brute_components(edges):
    root = {v: v for e in edges for v in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(root[a], root[b])
            for v in (a, b):
                if root[v] != low:
                    root[v] = low
                    changed = True
    return root


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(f"{rng.randrange(120):03}", f"{rng.randrange(120):03}") for _ in range(100)]
    edges += [(f"c{k:03}", f"c{k + 1:03}") for k in range(40)]  # a chain
    edges += [("hub", f"leaf{k}") for k in range(30)] + [("alone", "alone")]
    got = {r["node"]: r["root"] for r in split_groups.components(spark.createDataFrame([*edges, edges[0], (None, "x")], "a string, b string")).collect()}
    assert got == brute_components(edges)


def test_components_of_nothing(spark):
    assert split_groups.components(spark.createDataFrame([], "a string, b string")).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 30), st.integers(1, 4)), min_size=1, max_size=4, unique_by=lambda s: s[0]), st.floats(0, 1))
def test_closest_subset(sizes, share):
    target = share * sum(s * n for s, n in sizes)
    chosen = split_groups.closest_subset([(s, float(s), n) for s, n in sizes], target)
    assert all(chosen.get(s, 0) <= n for s, n in sizes) and set(chosen) <= {s for s, _ in sizes}
    best = min(abs(sum(s * k for (s, _), k in zip(sizes, ks, strict=True)) - target) for ks in itertools.product(*(range(n + 1) for _, n in sizes)))
    assert abs(sum(s * k for s, k in chosen.items()) - target) <= best + 1e-6


def records(spark):
    rng = random.Random(9)
    rows = []
    for person in range(80):
        for k in range(1 + (person % 7) + 60 * (person == 0)):  # one person holds much of all
            release = rng.choice(["r1", "r2"])
            pad = "" if release == "r1" else "000"
            rows.append((f"/data/curated/D/{release}/sub-{pad}{person}/eeg/f/{k}_data.pt", rng.choice(["train", "train", "val"]), "kept", "kept"))
    rows += [("/data/curated/E/r1/sub-1/eeg/f/0_data.pt", "val", "kept", "kept"), ("/data/curated/D/loose/0_data.pt", "test", "kept", "kept")]
    return spark.createDataFrame([*rows, rows[0]], "path string, split string, key string, entities string").distinct()


def test_persons_stay_together(spark):
    rows = records(spark)
    grouped = split_groups.group_records(rows, split_groups.record_entities(F.col("path")))
    assert grouped.count() == rows.count()
    assert grouped.where("key <> 'kept' OR entities <> 'kept'").count() == 0
    person = F.concat_ws("|", dataset_of(F.col("path")), F.coalesce(subject_no(F.col("path")).cast("string"), F.lit("none")))
    assert grouped.groupBy(person).agg(F.count_distinct("component").alias("n")).where("n > 1").count() == 0
    assert grouped.select("component").distinct().count() == 82
    out = split_groups.assign_splits(grouped, {"train": 0.8, "val": 0.15, "test": 0.05})
    assert out.groupBy("component").agg(F.count_distinct("new_split").alias("n")).where("n > 1").count() == 0
    n = out.count()
    assert n == rows.count()
    shares = {r["new_split"]: r["count"] / n for r in out.groupBy("new_split").count().collect()}
    assert abs(shares["val"] - 0.15) < 0.01 and abs(shares["test"] - 0.05) < 0.01


def test_leaking_components(spark):
    rows = records(spark)
    grouped = split_groups.group_records(rows, split_groups.record_entities(F.col("path")))
    got = {r["component"] for r in split_groups.leaking_components(grouped).collect()}
    seen = {}
    for r in grouped.collect():
        seen.setdefault(r["component"], set()).add(r["split"])
    assert got == {c for c, s in seen.items() if len(s) > 1}


def test_nothing_to_split(spark):
    empty = spark.createDataFrame([], "path string, component string")
    assert split_groups.assign_splits(empty, {"train": 0.9, "val": 0.1}).count() == 0
    with pytest.raises(ValueError, match="shares"):
        split_groups.assign_splits(empty, {})
