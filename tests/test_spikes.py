from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from wavequarry.operators.spikes import fit_ellipsoids, implausible_channels, shape_counts, source_spreads
from wavequarry.session import arrow_batches

SCHEMA = "path string, source string, x array<array<float>>, ch string, radius string"


def smooth(rng, n=64):
    return np.convolve(rng.normal(size=n + 2), [0.25, 0.6, 0.25], "valid")


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(1)
    rows, want = [], set()
    for source, scale in (("a", 1.0), ("b", 0.2)):
        for k in range(120):
            x = np.array([smooth(rng) * scale for _ in range(4)])
            path = f"{source}/{k}"
            if k == 3:
                x[1, 30] = 12 * scale
                want.add((path, 1))
            if k == 5:
                x[2, 10:50] = x[2, 10] + rng.normal(size=40) * 1e-4 * scale
                want.add((path, 2))
            if k == 7:
                x[0, 4] = np.nan
                want.add((path, 0))
            if k == 9:
                x[3, 60] = -np.inf
                want.add((path, 3))
            rows.append((path, source, x.tolist(), "clash", "clash"))
    rows.append(rows[3])  # a repeated row
    rows += [("a/null", "a", None, "", ""), (None, "a", rows[0][2], "", ""), ("a/empty", "a", [], "", ""), ("a/short", "a", [[1.0], []], "", ""), ("a/hole", "a", [None, rows[1][2][0]], "", "")]
    return spark.createDataFrame(rows, SCHEMA), want


def test_finds_the_planted_faults_once(table):
    rows, want = table
    found = [(r["path"], r["ch"]) for r in implausible_channels(rows).collect()]
    assert len(found) == len(set(found))
    assert set(found) == want


def test_reasons(table):
    reasons = {r["path"]: list(r["reasons"]) for r in implausible_channels(table[0]).where("source = 'a'").collect()}
    assert reasons["a/3"] == ["spike"]
    assert reasons["a/5"] == ["stuck"]
    assert reasons["a/7"] == ["bound"]


def test_empty_table(spark):
    assert implausible_channels(spark.createDataFrame([], SCHEMA)).count() == 0


def test_ties_and_constant_source(spark):
    rows = [(f"c/{k}", "c", [[1.0] * 64], "", "") for k in range(5)]
    assert implausible_channels(spark.createDataFrame(rows, SCHEMA)).count() in (0, 5)  # no spread, no limit: nothing to compare with
    assert implausible_channels(spark.createDataFrame(rows, SCHEMA)).where(F.array_contains("reasons", "spike")).count() == 0


def test_many_faults_do_not_hide_each_other(spark):
    rng = np.random.default_rng(2)
    rows, want = [], {"spike": set(), "stuck": set()}
    for k in range(200):
        x = np.array([smooth(rng) for _ in range(8)])
        if k % 4 == 0:  # three channels of a hundred each
            x[1, 30] = rng.uniform(10, 25)
            want["spike"].add((f"m/{k}", 1))
            x[2, 10 : 10 + rng.integers(20, 50)] = x[2, 10]
            want["stuck"].add((f"m/{k}", 2))
        rows.append((f"m/{k}", "m", x.tolist(), "", ""))
    found = implausible_channels(spark.createDataFrame(rows, SCHEMA)).collect()
    for reason, channels in want.items():
        assert {(r["path"], r["ch"]) for r in found if reason in r["reasons"]} == channels


def test_sources_without_a_median_spread_are_checked(spark):
    rng = np.random.default_rng(3)
    rows, want = [], set()
    for k in range(120):
        coarse = np.array([np.where(rng.random(64) < 0.15, rng.choice([-1.0, 1.0, 2.0]), 0.0) for _ in range(4)])
        standing = np.array([np.full(64, 0.5) if c < 3 else smooth(rng) for c in range(4)])
        if k in (3, 70):
            coarse[1, 30] = standing[3, 30] = 40.0
            want |= {(f"coarse/{k}", 1), (f"standing/{k}", 3)}
        rows += [(f"coarse/{k}", "coarse", coarse.tolist(), "", ""), (f"standing/{k}", "standing", standing.tolist(), "", "")]
    # values in eighths that seldom keep still for long, and one that does
    for k in range(120):
        x = np.array([np.cumsum(np.arange(64) % 3 == 0) % 5 / 8 for _ in range(4)])
        if k == 9:
            x[2, 5:60] = x[2, 5]
            want.add((f"steps/{k}", 2))
        rows.append((f"steps/{k}", "steps", x.tolist(), "", ""))
    rows += [(f"still/{k}", "still", [[1.0] * 64], "", "") for k in range(5)]
    found = implausible_channels(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(r["path"], r["ch"]) for r in found} == want


def test_the_ellipsoid_decides_not_the_value(spark):
    rng = np.random.default_rng(4)
    rows = []
    for k in range(150):
        x = np.array([smooth(rng) for _ in range(4)])
        if k == 11:  # within the values of its source, but no signal of it turns like this
            x[1, 20:28] = 1.9 * (-1.0) ** np.arange(8)
        rows.append((f"z/{k}", "z", x.tolist(), "", ""))
    found = implausible_channels(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r["path"], r["ch"], list(r["reasons"])) for r in found] == [("z/11", 1, ["spike"])]
    assert max(abs(np.array(r[2])).max() for r in rows if r[0] != "z/11") > 1.9


def test_spreads_are_fitted_again_without_the_samples_outside(spark):
    rng = np.random.default_rng(5)
    clean, dirty = [], []
    for k in range(120):
        x = np.array([smooth(rng) for _ in range(4)])
        clean.append((f"r/{k}", "r", x.tolist(), "", ""))
        y = x.copy()
        y[0, 8:32] = rng.choice([-1.0, 1.0], 24) * rng.uniform(20, 30, 24)  # a quarter of the channels, not quite
        dirty.append((f"r/{k}", "r", (y if k % 20 else x).tolist(), "", ""))
    arrow_batches(spark)
    spread = lambda df: source_spreads(df).first()["a1"]
    true, first = (spread(shape_counts(spark.createDataFrame(r, SCHEMA))) for r in (clean, dirty))
    last = fit_ellipsoids(spark.createDataFrame(dirty, SCHEMA))[1].first()["a1"]
    assert first > 1.02 * true
    assert abs(last / true - 1) < abs(first / true - 1) / 2
