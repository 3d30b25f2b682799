"""Queries of the training-data problems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wavequarry.functions.paths import dataset_of, record_path, subject_no
from wavequarry.llm import leakage, mixing, overlap, split_groups, tokenizer, truncation
from wavequarry.operators.records import RECORD_PATH_SQL, splits, stored_rows
from wavequarry.session import cut, load, small_side


def _overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.cross_split_pairs(stored_rows(load(spark, sf_dir, "segments")).select("path", "x"), splits(spark, sf_dir))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a train and a val or test record whose signals come from the same measurement."""
    pairs = _overlaps(spark, sf_dir)
    return pairs.select(F.least("train_path", "eval_path").alias("path_a"), F.greatest("train_path", "eval_path").alias("path_b")).distinct()


def p2_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping pairs per split and dataset."""
    return overlap.overlap_report(_overlaps(spark, sf_dir), splits(spark, sf_dir), dataset_of)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Persons whose records are now listed in more than one split."""
    grouped = cut(split_groups.group_records(splits(spark, sf_dir), split_groups.record_entities(F.col("path"))))
    leaking = split_groups.leaking_components(grouped)
    persons = grouped.groupBy("component", dataset_of(F.col("path")).alias("dataset"), subject_no(F.col("path")).alias("subject_no")).agg(F.lit(1).alias("one"))
    return persons.join(leaking, "component").where("subject_no IS NOT NULL").select("dataset", "subject_no").distinct()


def p4_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every listed record with the split that its whole component goes to."""
    records = splits(spark, sf_dir).select("path").distinct()
    grouped = cut(split_groups.group_records(records, split_groups.record_entities(F.col("path"))))
    targets = load(spark, sf_dir, "split_targets").where("split_name IS NOT NULL AND share IS NOT NULL").select("split_name", "share").distinct()
    if targets.limit(SPLITS + 1).count() > SPLITS:
        raise ValueError(f"more than {SPLITS} splits")
    shares = {r["split_name"]: float(r["share"]) for r in targets.collect()}
    return split_groups.assign_splits(grouped, shares).select("path", "component", "new_split")


def p4_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records and share of each split after the assignment."""
    counts = p4_split(spark, sf_dir).groupBy("new_split").agg(F.count("*").alias("records"))
    total = F.sum("records").over(Window.partitionBy(F.lit(1)))  # one row per split
    return counts.withColumn("share", F.col("records") / total)


#: Most splits; their shares go to the driver.
SPLITS = 1000
#: A dataset whose limits come this close to its target, by the share of it, is settled by its exact size.
VERGE = 0.1


def _train_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """path, label, size and traits of the stored train records; the label is the manifest's dataset in its usual spelling, null if it has none."""
    key = F.translate(F.lower(F.trim("dataset")), "-", "_")
    train = load(spark, sf_dir, "train").select(record_path(F.col("path")).alias("path"), F.trim("dataset").alias("name"), F.nullif(key, F.lit("unknown")).alias("key"))
    train = train.where("path IS NOT NULL")
    targets = load(spark, sf_dir, "mix_targets").select(F.trim("dataset").alias("name"), key.alias("key"), F.lit(1 << 62).alias("n"))
    spelt = train.where("key <> ''").groupBy("name", "key").agg(F.count("*").alias("n")).unionByName(targets)
    usual = cut(spelt.groupBy("key").agg(F.max_by("name", F.struct("n", "name")).alias("label")))
    listed = train.groupBy("path").agg(F.max("key").alias("key")).join(small_side(usual), "key", "left").select("path", "label")
    rows = stored_rows(load(spark, sf_dir, "segments")).select("path", "x")
    return listed.join(mixing.signal_traits(rows), "path")


def _mixture(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return mixing.mix(_train_records(spark, sf_dir), load(spark, sf_dir, "mix_targets"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Datasets that cannot reach their target share within their repeat limit: the fitted total misses the target.

    Expected sizes carry the classifier's doubt, so datasets on the verge are settled by their exact sizes.
    """
    records = cut(_train_records(spark, sf_dir))
    report = cut(mixing.mix(records, load(spark, sf_dir, "mix_targets"))[1])
    own = records.groupBy(dataset_of(F.col("path")).alias("dataset")).agg(F.sum("size").alias("exact"))
    verge = F.abs(F.col("fitted") + F.col("headroom") - F.col("target")) <= VERGE * F.col("target")
    checked = report.join(own, "dataset", "left").withColumn("exact", F.coalesce("exact", F.lit(0)))
    return checked.where(F.when(verge, F.col("target") > F.col("max_repeats") * F.col("exact")).otherwise(F.col("short"))).select("dataset")


def p5_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of the mixture and how often each is used."""
    return _mixture(spark, sf_dir)[0]


def p5_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and reached size and share of each dataset."""
    return _mixture(spark, sf_dir)[1]


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document's text."""
    return tokenizer.encode_corpus(load(spark, sf_dir, "documents"), "doc_id", "text")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold at least half of an evaluation item, with the item."""
    return leakage.leaked_items(load(spark, sf_dir, "documents"), load(spark, sf_dir, "eval_items")).select("doc_id", "item_id")


def p7_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per evaluation suite: items that leaked, documents that hold them and the mean share held."""
    found = leakage.leaked_items(load(spark, sf_dir, "documents"), load(spark, sf_dir, "eval_items"))
    suites = load(spark, sf_dir, "eval_items").select("item_id", "suite")
    return found.join(suites, "item_id").groupBy("suite").agg(F.count_distinct("item_id").alias("items"), F.count_distinct("doc_id").alias("documents"), F.avg("share").alias("mean_share"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose text was cut."""
    return truncation.truncated(load(spark, sf_dir, "documents")).select("doc_id")


def p8_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each source cuts its texts."""
    return truncation.truncation_rates(load(spark, sf_dir, "documents"))


QUERIES = {
    "p2_found": p2_found,
    "p2_report": p2_report,
    "p4_found": p4_found,
    "p4_split": p4_split,
    "p4_shares": p4_shares,
    "p5_found": p5_found,
    "p5_mixture": p5_mixture,
    "p5_shares": p5_shares,
    "p6_ids": p6_ids,
    "p7_found": p7_found,
    "p7_report": p7_report,
    "p8_found": p8_found,
    "p8_rates": p8_rates,
}

ORACLE = {
    "p4_found": f"""WITH r AS (SELECT 'train' AS split, {RECORD_PATH_SQL} AS path FROM train UNION ALL SELECT 'val', {RECORD_PATH_SQL} FROM val UNION ALL SELECT 'test', {RECORD_PATH_SQL} FROM test)
SELECT split_part(path, '/', 4) AS dataset, CAST(regexp_extract(path, '/sub-([0-9]+)/', 1) AS BIGINT) AS subject_no FROM r WHERE path IS NOT NULL GROUP BY ALL HAVING count(DISTINCT split) > 1""",
    # totals as close to the shares as whole records allow: components are small enough for every total to be reached
    "p4_shares": f"""WITH r AS (SELECT {RECORD_PATH_SQL} AS path FROM train UNION SELECT {RECORD_PATH_SQL} FROM val UNION SELECT {RECORD_PATH_SQL} FROM test),
  n AS (SELECT count(path) AS n FROM r), t AS (SELECT split_name, share / sum(share) OVER () AS share, row_number() OVER (ORDER BY share DESC, split_name DESC) AS k FROM split_targets),
  s AS (SELECT split_name, k, n, CAST(ceil(n * share - 0.5) AS BIGINT) AS records FROM t, n)
SELECT split_name AS new_split, CASE WHEN k > 1 THEN records ELSE n - sum(records) FILTER (k > 1) OVER () END AS records,
  CASE WHEN k > 1 THEN records ELSE n - sum(records) FILTER (k > 1) OVER () END / n AS share FROM s""",
    "p5_found": f"""WITH l AS (SELECT DISTINCT {RECORD_PATH_SQL} AS path FROM train), s AS (SELECT {RECORD_PATH_SQL} AS path, max(len(x)) AS n FROM segments WHERE x IS NOT NULL GROUP BY 1),
  r AS (SELECT split_part(path, '/', 4) AS dataset, n FROM s JOIN l USING (path)), own AS (SELECT dataset, sum(n) AS n FROM r GROUP BY dataset)
SELECT t.dataset FROM mix_targets t LEFT JOIN own USING (dataset) WHERE t.target_share * (SELECT sum(n) FROM r) > t.max_repeats * coalesce(own.n, 0)""",
    "p8_found": truncation.TRUNCATED_SQL,
    "p8_rates": f"""SELECT coalesce(source, '') AS source, count(*) AS texts, count(c.doc_id) AS cut, count(c.doc_id) / count(*) AS share
FROM documents d LEFT JOIN ({truncation.TRUNCATED_SQL}) c ON d.doc_id = c.doc_id WHERE text IS NOT NULL GROUP BY 1""",
}
