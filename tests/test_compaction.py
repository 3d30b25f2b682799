from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wavequarry.operators.compaction import TARGET_BYTES, Bins, _klass, compact, file_report, freeze, pack
from wavequarry.operators.ranking import rank_in_class
from wavequarry.session import scratch_path

SCHEMA = "path string, x array<array<float>>, bin string"


def plain_first_fit_decreasing(sizes, capacity):
    bins = []
    for size in sorted(sizes, reverse=True):
        for b in bins:
            if sum(b) + size <= capacity:
                b.append(size)
                break
        else:
            bins.append([size])
    return Counter(tuple(sorted(b)) for b in bins)


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 12), max_size=7), st.integers(1, 60))
def test_pack_is_first_fit_decreasing(classes, capacity):
    runs = pack(list(classes.items()), capacity)
    bins, left = {}, {}
    for k, (size, first, take, start) in enumerate(runs):
        later = [r[1] for r in runs[k + 1 :] if r[0] == size]
        for rank in range(first, min(later, default=classes[size])):
            bins.setdefault(start + (rank - first) // take, []).append(size)
            left[size] = left.get(size, 0) + 1
    assert left == classes
    assert Counter(tuple(sorted(b)) for b in bins.values()) == plain_first_fit_decreasing([s for s, n in classes.items() for _ in range(n)], capacity)


def rows(spark, n, extra=()):
    data = [(f"/p/{k}", [[float(k)] * (4 + k % 5)] * 3, "clash") for k in range(n)]
    return spark.createDataFrame(data + list(extra), SCHEMA)


def test_holds_every_listed_record_once(spark):
    table = rows(spark, 200, [("/p/3", [[3.0] * 7] * 3, "again"), ("/p/3", [[3.0] * 7] * 3, "again"), ("/p/none", None, ""), (None, [[1.0]], ""), ("/p/unlisted", [[1.0]], "")])
    listed = spark.createDataFrame([(f"/p/{k}",) for k in range(0, 200, 2)] + [("/p/3",), ("/p/3",), ("/p/none",), ("/p/missing",), (None,)], "path string")
    out = compact(table, listed, scratch_path(spark, "t"), target_bytes=2000).collect()
    assert sorted(r["path"] for r in out) == sorted([f"/p/{k}" for k in range(0, 200, 2)] + ["/p/3"])
    assert all(r["x"] == [[float(r["path"][3:])] * len(r["x"][0])] * 3 for r in out)


def test_files_are_few_and_even(spark):
    table = rows(spark, 400)
    target = scratch_path(spark, "t")
    out = compact(table, table.select("path"), target, target_bytes=5000)
    report = file_report(out).collect()
    assert len(report) == len({r["bin"] for r in report}) == out.select(F.input_file_name()).distinct().count()
    sizes = [r["bytes"] for r in report]
    assert max(sizes) < 1.5 * min(sizes)


def test_wrong_bytes_are_not_committed(spark, monkeypatch):
    table = rows(spark, 20)
    target = scratch_path(spark, "t")
    honest = Bins.place
    monkeypatch.setattr(Bins, "place", lambda self, r: honest(self, r.where("path <> '/p/7'") if "x" in r.columns else r))
    with pytest.raises(ValueError, match="differ"):
        compact(table, table.select("path"), target)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(target)


def test_empty(spark):
    out = compact(rows(spark, 0), rows(spark, 5).select("path"), scratch_path(spark, "t"))
    assert out.count() == 0


def test_one_record_larger_than_the_target(spark):
    big = spark.createDataFrame([("/big", [[1.0] * 5000], ""), ("/a", [[1.0]], ""), ("/b", [[2.0]], "")], SCHEMA)
    assert compact(big, big.select("path"), scratch_path(spark, "t"), target_bytes=1000).count() == 3


def test_ranks_are_dense_in_every_part(spark, monkeypatch):
    monkeypatch.setattr("wavequarry.operators.ranking.RANKED_ROWS", 10)
    table = spark.range(300).select((F.col("id") % 2).alias("k"), F.col("id").cast("string").alias("path"))
    ranked, counts = rank_in_class(table, "k", "path", 300)
    got = ranked.orderBy("k", "rank").collect()
    assert sorted(counts) == [(0, 150), (1, 150)]
    assert [r["rank"] for r in got] == list(range(150)) * 2
    assert all(a["h"] <= b["h"] for a, b in zip(got[:150], got[1:150], strict=False))


def test_bins_of_many_parts_agree_with_the_manifest(spark, monkeypatch):
    monkeypatch.setattr("wavequarry.operators.ranking.RANKED_ROWS", 15)
    table = rows(spark, 200).drop("bin")
    manifest = freeze(table, table.select("path"))
    bins = Bins(manifest, 2000)
    placed = bins.place(manifest)
    assert placed.count() == 200
    assert placed.select("bin").distinct().count() == bins.count


def test_sizes_of_several_classes_share_bins_at_the_production_target(spark):
    sizes = [2560, 2816, 3072, 3584, 4096, 700_000, 5_000_000, 9_000_001, 30_000_000]
    counts = [900, 40, 70, 300, 200, 90, 25, 11, 3]
    manifest = spark.createDataFrame([(f"/s/{s}/{k}", s) for s, n in zip(sizes, counts, strict=True) for k in range(n)], "path string, bytes bigint")
    bins = Bins(manifest)
    placed = bins.place(manifest).groupBy("bin").agg(F.sum("bytes").alias("bytes"), F.count_distinct("bytes").alias("sizes"), F.count("*").alias("n")).collect()
    assert sum(r["n"] for r in placed) == sum(counts)
    total = sum(s * n for s, n in zip(sizes, counts, strict=True))
    assert len(placed) == bins.count <= -(-total // TARGET_BYTES)
    assert sum(r["sizes"] > 1 for r in placed) >= len(placed) / 2
    assert max(r["bytes"] for r in placed) <= 2 * TARGET_BYTES


def test_classes_round_sizes_up_and_keep_small_ones(spark):
    sizes = [1, 5, 511, 512, 513, 2560, 4096, 4097, (1 << 30) + 1, (1 << 50) + 3]
    rows = spark.createDataFrame([(s,) for s in sizes], "bytes bigint").select("bytes", _klass(F.col("bytes")).alias("k")).collect()
    for r in rows:
        assert r["bytes"] <= r["k"] <= r["bytes"] * (1 + 2.0**-8) + 1
    assert [r["k"] for r in rows[:7]] == [1, 5, 511, 512, 514, 2560, 4096]


def test_bins_share_write_tasks(spark, monkeypatch):
    monkeypatch.setattr("wavequarry.operators.compaction.WRITE_TASKS", 3)
    table = rows(spark, 200)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # a second shuffle would scatter a bin over files
    try:
        out = compact(table, table.select("path"), scratch_path(spark, "t"), target_bytes=1500)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert out.count() == 200
    assert out.select(F.input_file_name()).distinct().count() == out.select("bin").distinct().count() > 3
