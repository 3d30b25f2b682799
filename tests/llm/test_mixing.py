from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from wavequarry.llm import mixing

SCHEMA = "path string, label string, size int, rate double, cap string"


@pytest.fixture(scope="module")
def mixed(spark):
    rows = []
    for d, n, size in (("A", 600, 10), ("B", 150, 16), ("C", 40, 12), ("X", 30, 8)):
        for k in range(n):
            label = None if k % 9 == 4 else d
            rows.append((f"/data/curated/{d}/r{k % 2}/sub-{k}/eeg/sub-{k}_task-t{k % 3}_eeg/0_data.pt", label, size, None, "clash"))
    targets = [("A", 0.5, 1), ("B", 0.3, 3), ("C", 0.2, 2), ("D", 0.0, 1), ("E", 0.05, 4), (None, 0.1, 1)]
    mixture, report = mixing.mix(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(targets, "dataset string, target_share double, max_repeats int"))
    return rows, mixture.collect(), {r["dataset"]: r for r in report.collect()}


def test_domains_of_unlabelled_records(mixed):
    rows, mixture, report = mixed
    assert all(r["path"].split("/")[3] == r["domain"] for r in mixture)
    assert {d: report[d]["own"] for d in "ABCDE"} == {"A": 6000, "B": 2400, "C": 480, "D": 0, "E": 0}


def test_shares_and_limits(mixed):
    rows, mixture, report = mixed
    total = sum(r[2] for r in rows)
    for d in ("A", "B"):
        assert abs(report[d]["reached"] - report[d]["target"]) <= 16
    assert report["C"]["reached"] == 2 * 480  # as much as its limit allows
    assert {d: report[d]["short"] for d in report} == {"A": False, "B": False, "C": True, "D": False, "E": True}
    assert abs(report["A"]["target"] - 0.5 * total) < 1e-6
    limit = {"A": 1, "B": 3, "C": 2}
    assert all(0 < r["copies"] <= limit[r["domain"]] for r in mixture)
    assert abs(sum(r["share"] for r in report.values()) - 1) < 1e-9


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    targets = spark.createDataFrame([("A", 0.5, 1)], "dataset string, target_share double, max_repeats int")
    mixture, report = mixing.mix(empty, targets)
    assert mixture.count() == 0
    assert report.select("own", "reached", "short").first()[:] == (0, 0, False)
    mixture, report = mixing.mix(spark.createDataFrame([("/data/curated/A/r/sub-1/x", "A", 3, None, "")], SCHEMA), targets.limit(0))
    assert mixture.count() == 0 and report.count() == 0


def test_rates_minimise_the_gap(spark):
    groups = spark.createDataFrame([(1, 100.0), (2, 50.0), (3, 80.0)], "profile bigint, size double")
    membership = spark.createDataFrame([(1, "A", 1.0), (2, "A", 0.5), (2, "B", 0.5), (3, "B", 1.0)], "profile bigint, label string, posterior double")
    targets = spark.createDataFrame([("A", 90.0, 2), ("B", 60.0, 2)], "label string, target double, max_repeats int")
    rates = {r["profile"]: r["rate"] for r in mixing.fit_rates(groups, membership, targets).collect()}
    reached = (100 * rates[1] + 25 * rates[2], 25 * rates[2] + 80 * rates[3])
    assert abs(reached[0] - 90) < 0.1 and abs(reached[1] - 60) < 0.1
    assert all(0 <= r <= 2 for r in rates.values())


def test_classifier_held_out(spark):
    rows = spark.range(400).select((F.col("id") % 2).cast("string").alias("label"), F.array(F.concat(F.lit("t"), (F.col("id") % 2 * 5 + F.col("id") % 5).cast("string")), F.lit("same")).alias("features"), F.lit(1.0).alias("weight"), "id")
    model = mixing.fit_classifier(rows.where("id < 200"))
    test = rows.where("id >= 200").select(F.col("id").alias("profile"), "features", "label")
    best = mixing.posteriors(test, model).groupBy("profile").agg(F.max_by("label", "posterior").alias("guess"))
    right = test.join(best, "profile").select(F.avg((F.col("label") == F.col("guess")).cast("int"))).first()[0]
    assert right > 0.6


def test_rates_of_soft_members_meet_the_targets(spark):
    groups = spark.createDataFrame([(k, float(s)) for k, s in enumerate((100, 50, 80, 40, 30))], "profile bigint, size double")
    posterior = {0: {"A": 0.9, "B": 0.1}, 1: {"A": 0.5, "B": 0.5}, 2: {"B": 1.0}, 3: {"B": 0.3, "C": 0.7}, 4: {"C": 0.2, "X": 0.8}}
    membership = spark.createDataFrame([(k, d, p) for k, m in posterior.items() for d, p in m.items()], "profile bigint, label string, posterior double")
    targets = spark.createDataFrame([("A", 90.0, 2), ("B", 150.0, 2), ("C", 200.0, 3), ("D", 10.0, 1)], "label string, target double, max_repeats int")
    rates, standing = mixing.descend(groups, membership, targets)
    rate, size = {r["profile"]: r["rate"] for r in rates.collect()}, dict(groups.collect())
    for r in standing.collect():
        assert abs(r["fitted"] - sum(size[k] * rate[k] * m.get(r["label"], 0.0) for k, m in posterior.items())) < 1e-3
    fitted = {r["label"]: r["fitted"] for r in standing.collect()}
    cap = {0: 2, 1: 2, 2: 2, 3: 3, 4: 0}  # the limit of the likeliest domain
    assert all(-1e-9 <= rate[k] <= cap[k] + 1e-9 for k in rate)
    assert abs(fitted["A"] - 90) < 0.5 and abs(fitted["B"] - 150) < 0.5
    assert abs(fitted["C"] - (40 * 0.7 * cap[3])) < 0.5  # all that its limit allows
    assert fitted["D"] == 0


def test_traits_tell_domains_apart_that_paths_do_not(spark):
    rows = []
    for d, trait in (("A", "spread=-3"), ("B", "spread=2")):
        for k in range(100):
            rows.append((f"/data/curated/{'AB'[k % 2]}/r/sub-{k}/eeg/{d}{k}/0_data.pt", None if k % 5 == 0 else d, 10, [trait]))
    records = spark.createDataFrame(rows, "path string, label string, size int, traits array<string>")
    targets = spark.createDataFrame([("A", 0.5, 1), ("B", 0.7, 1)], "dataset string, target_share double, max_repeats int")
    mixture, report = mixing.mix(records, targets)
    assert all(r["path"].split("/")[7][0] == r["domain"] for r in mixture.collect())
    assert {r["dataset"]: r["short"] for r in report.collect()} == {"A": False, "B": True}
    _, report = mixing.mix(records.drop("traits"), targets)  # nothing tells them apart now: all without a label go to both in equal parts
    assert all(r["own"] != 1000 for r in report.collect())


def test_signal_traits(spark):
    rows = [("a", [[1.0, -1.0] * 8] * 3), ("a", [[1.0]]), ("b", [[4.0, None, float("nan"), -4.0] * 4, []]), ("c", []), (None, [[1.0]]), ("d", None)]
    found = {r["path"]: (r["size"], list(r["traits"])) for r in mixing.signal_traits(spark.createDataFrame(rows, "path string, x array<array<float>>")).collect()}
    assert found.keys() == {"a", "b", "c"}
    assert found["a"] == (3, ["spread=0", "peak=0"]) and found["b"][0] == 2
