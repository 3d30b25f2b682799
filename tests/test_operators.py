from __future__ import annotations

import datetime
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wavequarry.functions.numeric import bf16, human_size, is_bf16_matrix, ratio
from wavequarry.operators import coords, manifest, precision, reports, resample, windowing

NAN = float("nan")


# --- numbers


def test_bf16_agrees_with_the_bits(spark):
    rng = np.random.default_rng(0)
    bits = rng.integers(0, 1 << 32, 20000, dtype=np.uint32)
    bits[:200] = rng.integers(0, 1 << 23, 200, dtype=np.uint32)  # subnormals
    bits[200:206] = [0, 1 << 31, 0x7F800000, 0xFF800000, 0x7F7FFFFF, 1]
    v = bits.view(np.float32)
    rows = spark.createDataFrame([(i, float(x)) for i, x in enumerate(v) if not np.isnan(x)] + [(-1, NAN), (-2, None)], "i int, v double")
    got = {r["i"]: r["b"] for r in rows.select("i", bf16(F.col("v")).alias("b")).collect()}
    assert math.isnan(got.pop(-1)) and got.pop(-2) is None
    want = windowing.round_bf16(v)
    for i, b in got.items():
        assert b == want[i] and math.copysign(1, b) == math.copysign(1, want[i])


def test_human_size_and_ratio(spark):
    rows = spark.createDataFrame([(0,), (1023,), (1024,), (1536 * 1024,), (1 << 60,), (None,)], "n bigint")
    assert [r[0] for r in rows.select(human_size(F.col("n"))).collect()] == ["0.00 B", "1023.00 B", "1.00 KB", "1.50 MB", "1024.00 PB", None]
    assert spark.range(1).select(ratio(F.lit(1), F.lit(0)), ratio(F.lit(None), F.lit(2)), ratio(F.lit(1), F.lit(2))).first()[:] == (0.0, 0.0, 0.5)


def test_converting_twice_changes_nothing(spark):
    rows = spark.createDataFrame([("a", [[0.1, 1.0]], [[0.3]]), ("b", [[0.5]], [[2.0]]), ("c", None, [[1.0]])], "path string, x array<array<float>>, pos array<array<float>>")
    once = precision.convert_segments(rows).drop("was_bf16")
    twice = precision.convert_segments(once)
    assert [r["was_bf16"] for r in twice.orderBy("path").collect()] == [True] * 3
    assert twice.drop("was_bf16").collect() == once.collect()
    plan = {r["path"]: (r["bytes_before"], r["bytes_after"], r["state"]) for r in precision.conversion_plan(rows).collect()}
    assert plan == {"a": (12, 6, "converted"), "b": (8, 8, "skipped"), "c": (4, 4, "failed")}
    assert rows.where("path = 'b'").select(is_bf16_matrix(F.col("x"))).first()[0]


# --- windows


@pytest.mark.parametrize(("n", "want"), [(15, 0), (16, 1), (23, 1), (24, 2), (0, 0)])
def test_window_count(spark, n, want):
    assert spark.range(1).select(windowing.window_count(F.lit(n), 16, 8)).first()[0] == want == len(range(0, n - 16 + 1, 8))


def test_window_arguments():
    for window, stride in ((0, 1), (1, 0), (-1, 1)):
        with pytest.raises(ValueError, match="positive"):
            windowing.check_window(window, stride)


@pytest.mark.parametrize(("window", "stride"), [(16, 8), (10, 3), (4, 6)])
def test_windows_cover_what_they_should(spark, window, stride):
    rows = spark.range(40).select(F.lit("r").alias("rec"), F.col("id").cast("int").alias("t"))
    out = windowing.into_windows(rows, spark.createDataFrame([("r", 40)], "rec string, n int"), window, stride)
    got = sorted((r["win"], r["t"]) for r in out.collect())
    assert got == sorted((k, t) for k, start in enumerate(range(0, 40 - window + 1, stride)) for t in range(start, start + window))


def signal_rows(rng, n=40):
    x = rng.normal(size=(6, n))
    return x, [0, 0, 1, 1, 2, 2]


def test_array_form_is_the_relational_form(spark):
    rng = np.random.default_rng(3)
    x, kinds = signal_rows(rng)
    rows = spark.createDataFrame([("r", c, kinds[c], x[c].tolist()) for c in range(6)], "rec string, ch int, type int, samples array<double>")
    long = windowing.average_reference(windowing.long_signals(rows))
    stats = windowing.segment_stats(windowing.into_windows(long, spark.createDataFrame([("r", 40)], "rec string, n int"), 16, 8))
    segments = {r["win_idx"]: np.array(r["x"]) for r in windowing.segment_channels(rows, 16, 8).collect()}
    assert len(segments) == 4
    for r in stats.collect():
        part = segments[r["win"]][[k == r["type"] for k in kinds]]
        assert abs(part.max() - r["x_max"]) < 2e-2
        assert abs(part.std(ddof=1) - r["x_std"]) < 2e-2


@pytest.mark.parametrize(("window", "stride"), [(16, 8), (10, 4), (5, 9)])
def test_segments_are_those_of_the_plain_loop(spark, window, stride):
    rng = np.random.default_rng(4)
    recordings = {}
    for k in range(6):
        x, kinds = signal_rows(rng, 30 + 7 * k)
        for _ in range(k):
            x[rng.integers(6), rng.integers(x.shape[1])] = rng.choice([NAN, np.inf])
        recordings[f"r{k}"] = (x, kinds)
    recordings["short"] = (np.ones((1, 4)), [0])
    recordings["flat"] = (np.ones((2, window)), [0, 1])
    rows = [(rec, c, kinds[c], x[c].tolist()) for rec, (x, kinds) in recordings.items() for c in range(len(x))]
    table = spark.createDataFrame([*rows, ("none", 0, 0, None), ("empty", 0, 0, [])], "rec string, ch int, type int, samples array<double>")
    got = {(r["rec"], r["win_idx"]): (r["seg_idx"], r["chs"], r["x"]) for r in windowing.segment_channels(table, window, stride).collect()}
    want = {}
    for rec, (x, kinds) in recordings.items():
        seg = 0
        for win, start in enumerate(range(0, x.shape[1] - window + 1, stride)):
            part = x[:, start : start + window]
            if np.isfinite(part).all():
                want[rec, win] = (seg, list(range(len(x))), windowing.round_bf16(windowing.normalize(part, np.array(kinds))).tolist())
                seg += 1
    assert got == want


# --- positions


def test_positions(spark):
    rows = spark.createDataFrame([("r", 0, float(i), float(i % 3), 1.0) for i in range(5)] + [("p", 0, 1.0, 2.0, 3.0)] * 3, "rec string, sensor_type int, x double, y double, z double")
    out = coords.normalize_positions(rows, ["rec"]).collect()
    r = np.array([[v["xn"], v["yn"], v["zn"]] for v in out if v["rec"] == "r"])
    assert np.allclose(r.mean(axis=0), 0) and abs(3 * (r**2).sum(axis=1).mean() - 1) < 1e-9
    assert all(v["xn"] == 0 and v["radius"] == 0 for v in out if v["rec"] == "p")


def test_coordinate_tolerance_and_guard(spark):
    rows = spark.createDataFrame([(1e-11, 0.0, 0.0), (1e-9, 0.0, 0.0), (NAN, 1.0, 1.0), (None, 1.0, 1.0)], "x double, y double, z double")
    assert [r[0] for r in rows.select(coords.invalid_coordinate(F.col("x"), F.col("y"), F.col("z"))).collect()] == [True, False, True, True]
    guard = spark.createDataFrame([("a", k >= 3) for k in range(12)] + [("b", k >= 2) for k in range(12)] + [("c", True)] * 8, "rec string, valid boolean")
    assert {r["rec"]: r["failed"] for r in coords.channel_guard(guard).collect()} == {"a": True, "b": False, "c": False}


def test_sensor_projection(spark):
    loc = [float(k) for k in range(12)]
    rows = spark.createDataFrame([(2, "x", loc), (1, "VV_MAG", loc), (1, "VV_PLANAR", loc), (5, "", loc)], "kind int, coil string, loc array<double>")
    got = rows.select(coords.sensor_type(F.col("kind"), F.col("coil")), coords.sensor_position(F.col("kind"), F.col("coil"), F.col("loc"))).collect()
    assert [tuple(r) for r in got] == [(0, [0, 1, 2, 0, 0, 0]), (1, [0, 1, 2, 9, 10, 11]), (2, [0, 1, 2, 3, 4, 5]), (0, [0, 1, 2, 0, 0, 0])]


def test_last_electrode_wins(spark):
    rows = spark.createDataFrame([("a", 1.0, 1), ("a", 2.0, 2), ("b", 3.0, 1)], "name string, x double, ord int")
    assert {r["name"]: r["x"] for r in coords.last_electrode(rows, "name", "ord").collect()} == {"a": 2.0, "b": 3.0}


# --- manifests


@pytest.mark.parametrize(("n", "want"), [(1, (0, 0, 1)), (33, (32, 0, 1)), (34, (32, 1, 1)), (99, (96, 2, 1)), (100, (97, 3, 0)), (101, (97, 3, 1))])
def test_split_sizes(spark, n, want):
    rows = spark.range(n).select(F.lit("d").alias("dataset"), F.lit(1).alias("channels"), F.col("id").cast("string").alias("path"))
    split = manifest.stratified_split(rows, ["dataset", "channels"])
    sizes = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
    assert (sizes.get("train", 0), sizes.get("val", 0), n - split.count()) == want
    assert manifest.stratified_split(rows, ["dataset", "channels"], remainder="train").count() == n
    again = manifest.stratified_split(rows.orderBy(F.desc("path")), ["dataset", "channels"])
    assert sorted(split.collect()) == sorted(again.collect())


def test_mixed_flags_differ_between_the_manifests(spark):
    schema = "path string, x array<array<float>>, sensor_type array<int>"
    rows = spark.createDataFrame([("/data/curated/D/s/0", [[1.0], [2.0]], [0, 1]), ("/data/curated/D/t/0", [[1.0]], [0]), ("/x/y", [], []), ("/data/curated/D/s/1", None, None)], schema)
    full = {r["path"]: (r["dataset"], r["channels"], r["is_eeg"], r["is_meg"]) for r in manifest.manifest_fields(rows).collect()}
    assert full == {"/data/curated/D/s/0": ("D", 2, False, False), "/data/curated/D/t/0": ("D", 1, True, False), "/x/y": ("unknown", 0, True, True)}
    fast = {r["path"]: r["is_meg"] for r in manifest.sampled_manifest(rows.where("x IS NOT NULL")).collect()}
    assert fast == {"/data/curated/D/s/0": True, "/data/curated/D/t/0": False, "/x/y": False}


# --- reports


def test_run_report_counts_ragged_rows(spark):
    rows = spark.createDataFrame([("a", True, 5, None), ("b", True, 3, True), ("c", False, 0, None), ("d", None, None, None)], "file string, success boolean, n_segments int, skipped boolean")
    assert reports.run_report(rows).first()[:] == (4, 2, 1, 1, 2, 8)


def test_validation_limits_are_strict(spark):
    def segment(mean, std, far=1.0):
        base = np.array([1.0, -1.0] * 500) * math.sqrt(999 / 1000)
        return [(base * std + mean).tolist()], [[far, 0.0, 0.0, 0.0, 0.0, 0.0]], [0]

    cases = {"ok": segment(0.0999, 1.499), "mean": segment(0.1002, 1), "std": segment(0, 1.51), "position range": segment(0, 1, 2.01)}
    rows = [(k, *v) for k, v in cases.items()] + [("nan", [[NAN, 1.0]], [[0.0] * 6], [0]), ("none", None, [[0.0] * 6], [0]), ("shape", [[1.0, 2.0]], [[0.0] * 5], [0, 1])]
    got = {r["path"]: r for r in reports.validation_records(spark.createDataFrame(rows, "path string, x array<array<double>>, pos array<array<double>>, sensor_type array<int>")).collect()}
    assert got["ok"]["warnings"] == [] and got["ok"]["valid"]
    for k in ("mean", "std", "position range"):
        assert got[k]["warnings"] == [k] and got[k]["valid"]
    assert got["nan"]["errors"] == ["NaN in x"] and not got["nan"]["valid"]
    assert got["none"]["errors"] == ["missing part"]
    assert got["shape"]["errors"] == ["pos shape", "sensor_type shape"]


def test_conversion_totals_of_nothing(spark):
    totals = reports.conversion_totals(spark.createDataFrame([], "success boolean, original_size bigint, new_size bigint")).first()
    assert totals["converted"] == 0 and totals["saved_percent"] == 0.0


# --- resampling


@settings(max_examples=20, deadline=None)
@given(st.integers(40, 200), st.integers(40, 300))
def test_resampling_keeps_band_limited_sines(n, m):
    t, u = np.arange(n) / n, np.arange(m) / m
    wave = lambda s: np.sin(2 * np.pi * 3 * s) + 0.5 * np.cos(2 * np.pi * 7 * s + 1)
    assert np.allclose(resample.fft_resample(wave(t), m), wave(u), atol=1e-9)


def test_rates_within_tolerance_stay(spark):
    rows = spark.createDataFrame([("r", 0, 256.05, [1.0, 2.0]), ("r", 1, 256.2, [1.0] * 1000), ("r", 2, 512.0, [1.0] * 100), ("r", 3, None, [1.0]), ("r", 4, 500.0, None)], "rec string, ch int, rate double, samples array<double>")
    got = {r["ch"]: (r["rate"], None if r["samples"] is None else len(r["samples"])) for r in resample.resample_channels(rows).collect()}
    assert got == {0: (256.05, 2), 1: (256.0, 999), 2: (256.0, 50), 3: (None, 1), 4: (500.0, None)}


def test_running_sums_and_splits_do_not_depend_on_the_parts(spark, monkeypatch):
    rows = [(("a", "b", None)[(k * 7) % 3], f"p{k}", k % 5, None if k % 11 == 0 else datetime.datetime(2024, 1, 1 + (k * k) % 20), "clash") for k in range(400)]
    table = spark.createDataFrame(rows, "d string, path string, size int, t timestamp, n string")
    split = lambda: sorted(manifest.stratified_split(table, ["d"], ratios=(0.7, 0.2, 0.1)).select("path", "split").collect())
    progress = lambda: sorted(reports.running_progress(table, ["d"], ["t", "path"], "size").select("path", "done", "bytes_so_far").collect())
    whole = split(), progress()
    monkeypatch.setattr("wavequarry.operators.ranking.RANKED_ROWS", 13)
    assert (split(), progress()) == whole
    want = []
    for d in ("a", "b", None):
        mine = sorted((r for r in rows if r[0] == d), key=lambda r: (r[3] is not None, r[3] or 0, r[1]))
        want += [(r[1], i + 1, sum(x[2] for x in mine[: i + 1])) for i, r in enumerate(mine)]
    assert [tuple(r) for r in whole[1]] == sorted(want)
    assert manifest.stratified_split(table.limit(0), ["d"]).count() == 0


def test_windows_of_a_recording_with_a_lost_position_are_rejected(spark):
    rows = [(r, w, float("nan") if (r, w) == ("a", 1) else 1.0) for r in "abc" for w in range(3)]
    windowed = spark.createDataFrame(rows, "rec string, win int, v double")
    positions = spark.createDataFrame([("a", 0.0, 0.1, 0.2), ("b", 0.0, NAN, 0.2), ("b", 0.0, 0.1, 0.2)], "rec string, x double, y double, z double")
    kept = lambda *p: sorted(tuple(r) for r in windowing.accepted_windows(windowed, *p).collect())
    assert kept() == [("a", 0, 0), ("a", 2, 1), *((r, w, w) for r in "bc" for w in range(3))]
    assert kept(positions) == [("a", 0, 0), ("a", 2, 1), *(("c", w, w) for w in range(3))]
