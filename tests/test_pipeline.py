from __future__ import annotations

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from wavequarry import cli, pipeline
from wavequarry.sources import brainvision, sinks

HEADER = """Brain Vision Data Exchange Header File Version 1.0
; a comment
[Common Infos]
DataFile={name}.eeg
DataFormat=BINARY
DataOrientation={orientation}
NumberOfChannels={n}
SamplingInterval={interval}
[Binary Infos]
BinaryFormat={kind}
[Channel Infos]
{channels}
"""


def write(folder, name, x, rate=256, kind="IEEE_FLOAT_32", orientation="MULTIPLEXED", names=None):
    folder.mkdir(parents=True, exist_ok=True)
    names = names or [f"E{k}" for k in range(len(x))]
    channels = "\n".join(f"Ch{k + 1}={c},,0.5,µV" for k, c in enumerate(names))
    (folder / f"{name}.vhdr").write_text(HEADER.format(name=name, orientation=orientation, n=len(x), interval=1e6 / rate, kind=kind, channels=channels), encoding="utf-8")
    raw = np.asarray(x) / 0.5e-6
    raw = raw.T if orientation == "MULTIPLEXED" else raw
    (folder / f"{name}.eeg").write_bytes(np.ascontiguousarray(raw).astype(brainvision.FORMATS[kind]).tobytes())


@pytest.mark.parametrize("orientation", ["MULTIPLEXED", "VECTORIZED"])
@pytest.mark.parametrize("kind", list(brainvision.FORMATS))
def test_round_trip(tmp_path, kind, orientation):
    x = np.random.default_rng(1).integers(-100, 100, (3, 50)) * 0.5e-6
    write(tmp_path, "a", x, kind=kind, orientation=orientation)
    names, rate, got = brainvision.decode((tmp_path / "a.vhdr").read_text(encoding="utf-8"), (tmp_path / "a.eeg").read_bytes())
    assert names == ["E0", "E1", "E2"] and rate == 256
    assert np.allclose(got, x, atol=1e-12)


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    root = tmp_path_factory.mktemp("in") / "study"
    rng = np.random.default_rng(2)
    at = lambda d, r, s: root / d / r / "bids" / "derivatives" / "preprocessing" / s / "eeg"
    write(at("D", "r1", "sub-1"), "sub-1_task-rest_eeg", rng.normal(size=(12, 256 * 3)) * 1e-5)
    write(at("D", "r2", "sub-1"), "sub-1_task-rest_eeg", rng.normal(size=(12, 512 * 3)) * 1e-5, rate=512)
    write(at("D", "r1", "sub-2"), "sub-2_task-rest_eeg", rng.normal(size=(12, 100)) * 1e-5)
    write(at("D", "r1", "sub-3"), "sub-3_task-rest_eeg", rng.normal(size=(12, 256 * 3)) * 1e-5)
    lines = ["name\tx\ty\tz"] + [f"E{k}\t{k}\t{k % 3}\t{0.1 * k + 0.1}" for k in range(5)] + [f"E{k}\tn/a\t0\t0" for k in range(5, 12)]
    (at("D", "r1", "sub-3") / "sub-3_task-rest_electrodes.tsv").write_text("\n".join(lines) + "\n")
    (at("D", "r1", "sub-4")).mkdir(parents=True)
    (at("D", "r1", "sub-4") / "sub-4_task-rest_eeg.fif").write_bytes(b"not read")
    return root


def test_segments_report_manifest_and_resumption(spark, tree, tmp_path):
    out = str(tmp_path / "out")
    results = {r["file"].split("/study/")[1].split("/bids")[0] + "/" + r["file"].rsplit("/", 1)[1][:5]: r for r in pipeline.segment_dataset(spark, str(tree), out, 1, 1).collect()}
    assert {k: (r["success"], r["n_segments"], r["error"]) for k, r in results.items()} == {
        "D/r1/sub-1": (True, 3, None),
        "D/r2/sub-1": (True, 3, None),
        "D/r1/sub-2": (False, 0, "no segment"),
        "D/r1/sub-3": (False, 0, "too few valid channels: 5"),
        "D/r1/sub-4": (False, 0, "unsupported format: fif"),
    }
    segments = spark.read.parquet(f"{out}/segments")
    assert segments.count() == 6
    first = segments.first()
    assert np.array(first["x"]).shape == (12, 256) and np.array(first["pos"]).shape == (12, 6)
    assert abs(np.array(first["x"]).mean()) < 0.1
    assert json.loads((tmp_path / "out" / "report" / "summary.json").read_text())["parameters"]["stride"] == 1
    again = pipeline.segment_dataset(spark, str(tree), out, 1, 1)
    assert again.where("skipped").count() == 2
    assert spark.read.parquet(f"{out}/segments").count() == 6
    split = pipeline.build_manifests(segments, str(tmp_path / "m"), ratios=(0.5, 0.5, 0.0), root="study")
    assert {r["split"]: r["count"] for r in split.groupBy("split").count().collect()} == {"train": 3, "val": 3}
    assert spark.read.json(str(tmp_path / "m")).count() == 6
    plan = pipeline.convert(spark, f"{out}/segments", str(tmp_path / "c"))
    assert plan.where("state = 'skipped'").count() == plan.count() == 6
    assert pipeline.validate(segments, 0).count() == 6
    assert cli.main(["validate", f"{out}/segments", "--limit", "2"]) == 0


def test_stride_must_be_positive():
    with pytest.raises(ValueError, match="positive"):
        cli.main(["segment", "-i", "x", "-o", "y", "--stride", "0"])


def test_stream_takes_each_file_once(spark, tmp_path):
    from wavequarry.streaming import ingest

    schema = "path string, x array<array<float>>, landed_at timestamp, written_at timestamp"
    rows = spark.createDataFrame([("/data/curated/A/1", [[1.0]]), ("/data/curated/A/1", [[1.0]]), ("/nowhere", [[1.0]])], "path string, x array<array<float>>")
    rows = rows.withColumn("landed_at", F.lit("2024-01-01").cast("timestamp")).withColumn("written_at", F.col("landed_at"))
    source, target, checkpoint = (str(tmp_path / k) for k in ("in", "out", "check"))
    for expected in (1, 1, 2):
        if expected == 2:
            rows = rows.withColumn("path", F.replace("path", F.lit("A/1"), F.lit("A/2")))
        if expected == 2 or not (tmp_path / "in").exists():
            rows.write.mode("append").parquet(source)
        stream = ingest.segment_stream(spark, source, rows.schema if expected else schema)
        ingest.ingest(ingest.first_landings(stream), target, checkpoint)
        assert spark.read.parquet(target).count() == expected


def test_a_read_error_is_not_taken_for_a_first_run(spark, tree, tmp_path):
    out = tmp_path / "out"
    pipeline.segment_dataset(spark, str(tree), str(out), 1, 1)
    before = spark.read.parquet(f"{out}/segments").count()
    for file in (out / "segments").rglob("*.parquet"):
        file.write_bytes(b"broken")
    for crc in (out / "segments").rglob("*.crc"):
        crc.unlink()
    files = sorted((out / "segments").rglob("*.parquet"))
    with pytest.raises(Exception, match="(?i)parquet|footer"):
        pipeline.segment_dataset(spark, str(tree), str(out), 1, 1).collect()
    assert before == 6 and sorted((out / "segments").rglob("*.parquet")) == files  # nothing was appended


def test_manifests_as_arrays(spark, tmp_path):
    split = spark.createDataFrame([(f"p{k}", "a", ("train", "val")[k % 3 == 0]) for k in range(10)], "path string, dataset string, split string")
    sinks.write_arrays(split.orderBy("path"), str(tmp_path / "m"))
    train, val = (json.loads((tmp_path / "m" / f"{s}.json").read_text()) for s in ("train", "val"))
    assert [r["path"] for r in val] == ["p0", "p3", "p6", "p9"] and len(train) == 6
    assert train[0] == {"path": "p1", "dataset": "a"}


def test_batches_replace_their_own_rows_only(spark, tmp_path):
    from wavequarry.streaming import ingest

    source, target, checkpoint = (str(tmp_path / k) for k in ("in", "out", "check"))
    for day in (1, 1, 2):
        row = spark.createDataFrame([("/data/curated/A/1", f"2024-01-0{day} 10:00:00")], "path string, t string")
        row = row.select("path", F.col("t").cast("timestamp").alias("landed_at"), F.col("t").cast("timestamp").alias("written_at"))
        row.write.mode("append").parquet(source)
        ingest.ingest_batches(ingest.landing_counts(ingest.segment_stream(spark, source, row.schema)), target, checkpoint)
    counts = {r["day"].day: r["rows"] for r in ingest.latest(spark, target, ["source", "day"]).collect()}
    assert counts == {1: 2, 2: 1}


def test_a_cluster_must_name_its_shared_folder():
    from types import SimpleNamespace

    from wavequarry.session import shared_folder

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=context)
    with pytest.raises(ValueError, match="checkpoint"):
        shared_folder(cluster)


def test_broken_recordings_are_rows_with_their_error(spark, tmp_path):
    x = np.random.default_rng(3).normal(size=(2, 40)) * 1e-5
    for name in ("good", "headless", "lost"):
        write(tmp_path, name, x)
    (tmp_path / "lost.eeg").unlink()
    (tmp_path / "headless.vhdr").write_text("nothing")
    (tmp_path / "good.vhdr").write_text((tmp_path / "good.vhdr").read_text(encoding="utf-8").replace("DataFile=good", "DataFile=$b"), encoding="utf-8")
    recordings = spark.createDataFrame([(n, str(tmp_path / f"{n}.vhdr")) for n in ("good", "headless", "lost", "absent")], "rec string, path string")
    rows = brainvision.read_recordings(recordings).collect()
    assert {r["rec"]: r["error"] for r in rows if r["error"]}.keys() == {"headless", "lost", "absent"}
    assert {r["rec"]: r["error"] for r in rows}["lost"] == "ValueError: data file is missing"
    good = sorted((r["ch"], r["samples"]) for r in rows if r["rec"] == "good")
    assert np.allclose([s for _, s in good], x, atol=1e-10)


def test_layout_and_channel_kinds(spark, tmp_path):
    root = tmp_path / "study"
    folder = root / "D" / "bids" / "derivatives" / "preprocessing" / "sub-1" / "eeg"
    names = ["Fp1", "Fp2", "F3", "Fz", "F4", "C3", "Cz", "C4", "P3", "Pz", "P4", "O1", "HEOG", "odd"]
    x = np.random.default_rng(4).normal(size=(14, 256 * 2)) * 1e-5
    write(folder, "sub-1_task-rest_eeg", x, names=names)
    types = ["EEG"] * 5 + ["MEGMAG"] + ["EEG"] * 6 + ["EOG", "EEG"]
    (folder / "sub-1_task-rest_channels.tsv").write_text("name\ttype\tunits\n" + "".join(f"{n}\t{t}\tuV\n" for n, t in zip(names, types, strict=True)))
    results = pipeline.segment_dataset(spark, str(root), str(tmp_path / "out"), 1, 1).collect()
    assert [(r["success"], r["error"]) for r in results] == [(True, None)]
    first = spark.read.parquet(str(tmp_path / "out" / "segments")).orderBy("seg_idx").first()
    assert list(first["sensor_type"]) == [0] * 5 + [1] + [0] * 6  # no EOG; a name without a place is dropped
    places = np.array(first["pos"])[:, :3]
    assert places[0][0] < places[3][0] < places[1][0] and places[3][1] > places[9][1]  # left, middle, right; front, back


def test_ten_twenty_layout():
    from wavequarry.operators.coords import HEAD_RADIUS, ten_twenty

    places = {n: np.array(p) / HEAD_RADIUS for n, p in ten_twenty().items()}
    assert all(abs(np.linalg.norm(p) - 1) < 1e-9 for p in places.values())
    assert np.allclose(places["Cz"], [0, 0, 1]) and np.allclose(places["T7"] * [-1, 1, 1], places["T8"])
    assert np.allclose(places["C3"], [-np.sin(np.radians(36)), 0, np.cos(np.radians(36))])
    assert np.allclose(places["T3"], places["T7"]) and len(places) == 9 + 4 + 7 * 8 + 4
    for name, place in places.items():
        if name[-1] in "13579":
            even = name[:-1] + str(int(name[-1]) + 1)
            assert np.allclose(places[even], place * [-1, 1, 1])
