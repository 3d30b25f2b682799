from __future__ import annotations

from pyspark.sql import functions as F

from wavequarry.functions import bids
from wavequarry.functions.paths import dataset_of, record_path, subject_no

CASES = {
    "/data/curated/A/r1/sub-01/eeg/s/0_data.pt": "/data/curated/A/r1/sub-01/eeg/s/0_data.pt",
    "file:///data/curated/A/r1/sub-01/x": "/data/curated/A/r1/sub-01/x",
    "/mnt/pool3/curated/A/x": "/data/curated/A/x",
    "curated/A/x": "/data/curated/A/x",
    "/data/curated//A/./tmp/../r1//x": "/data/curated/A/r1/x",
    "/data/curated/A/tmp/a/../../r1/x/": "/data/curated/A/r1/x",
    "/data/curated/../../A/x": "/data/curated/A/x",
    "\\data\\curated\\A\\x": "/data/curated/A/x",
    "/other/place": None,
    "": None,
    None: None,
}


def test_record_path(spark):
    rows = spark.createDataFrame([(k, v) for k, v in CASES.items()], "path string, want string")
    for r in rows.withColumn("got", record_path(F.col("path"))).collect():
        assert r["got"] == r["want"], r


def test_dataset_and_subject(spark):
    rows = spark.createDataFrame([("/data/curated/A/r1/sub-00012/eeg/x",), ("/data/curated/A/x",), ("/data/curated/B/r/sub-99999999999999999999/x",), (None,)], "path string")
    got = [tuple(r) for r in rows.select(dataset_of(F.col("path")), subject_no(F.col("path"))).collect()]
    assert got == [("A", 12), ("A", None), ("B", None), (None, None)]


def test_entities(spark):
    rows = spark.createDataFrame([("sub-1_ses-2_task-rest_run-3_eeg",), ("sub-1_sub-9_eeg",), ("plain",), (None,)], "name string")
    found = bids.entities(F.col("name"))
    got = [tuple(r) for r in rows.select(*(found[e] for e in bids.ENTITIES)).collect()]
    assert got == [("1", "2", "rest", "3"), ("9", None, None, None), (None,) * 4, (None,) * 4]


def test_equal_stems_of_two_releases_have_two_keys(spark):
    rows = spark.createDataFrame([("/d/A/r1/sub-1/f_eeg.vhdr",), ("/d/A/r2/sub-1/f_eeg.vhdr",)], "path string")
    assert rows.select(bids.record_key(F.col("path"))).distinct().count() == 2
