"""Records of one split that come back, exactly or almost, in another.

Every signal becomes a sparse vector of weighted terms. A term names, for one channel,
where around an anchor (the largest or smallest reading of a stretch) the most extreme
readings lie, counted from the anchor: noise, rescaling, a change of channel order and a
shift of a few samples leave it alone, and a changed stretch or channel costs only its own
terms. Weights are inverse document frequencies over all listed records, vectors have
length one, and pairs between the splits whose cosine reaches the threshold are joined
over inverted lists. Of each evaluation vector the commonest terms, as long as their
residual norm, or their dot product with the largest weights of the other side, stays
below half of the threshold, are left out of the index; candidates that these bounds keep
get their exact dot product, in which only terms count whose anchors lie at about the same
place: windows that overlap through the stride have equal terms, but far apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wavequarry.functions.signals import channel_groups
from wavequarry.session import arrow_batches, cut, small_side

#: Extremes of either sign that name the surroundings of an anchor, and samples of these to each side.
EXTREMES, AROUND = 5, 14
#: The stretches that have an anchor, as shares of a channel's samples: its largest (1) or smallest (-1) reading.
ANCHORS = ((1, 0.0, 0.5), (-1, 0.25, 0.75), (1, 0.5, 1.0))
#: Samples by which a copy may be shifted.
SHIFT = 8
#: Least cosine of a pair. Copies with noise, a rescaled amplitude, a changed stretch, a shift or
#: a sixth of the channels replaced reach 0.39; records that only resemble stay below 0.06.
THRESHOLD = 0.15
#: Train postings of a term that one task joins; a longer list is cut into slices.
SLICE = 20_000


def _codes(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(channel, term, place) of the anchors of equally long channels; channels that stand still have none."""
    n = values.shape[1]
    at, terms, places = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.int64)]
    alive = np.flatnonzero(values.max(axis=1) > values.min(axis=1))
    values = values[alive]
    for k, (sign, start, end) in enumerate(ANCHORS):
        low, high = int(start * n), int(end * n)
        if high - low < 2 * EXTREMES or not len(values):
            continue
        place = low + (sign * values[:, low:high]).argmax(axis=1)
        window = np.arange(len(values))[:, None], place[:, None] + np.arange(2 * AROUND + 1)
        code = np.full(len(values), k + 1, dtype=np.uint64)
        for direction in (1.0, -1.0):
            around = np.pad(direction * values, ((0, 0), (AROUND, AROUND)), constant_values=-np.inf)[window]
            for c in np.sort(np.argsort(-around, axis=1, kind="stable")[:, :EXTREMES], axis=1).T.astype(np.uint64):
                code = (code ^ (code >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + c
        at.append(alive)
        terms.append(code ^ (code >> np.uint64(32)))
        places.append(place)
    return np.concatenate(at), np.concatenate(terms), np.concatenate(places)


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches (path, fp, x) to (path, fp, terms, places); a term that comes back in a record has its first place."""
    for batch in batches:
        rows, terms, places = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        for row, _, raw in channel_groups(batch.column("x")):
            with np.errstate(invalid="ignore"):
                at, code, place = _codes(np.where(np.isfinite(raw), raw, 0.0))
            rows.append(row[at])
            terms.append(code.view(np.int64))
            places.append(place)
        row, term, place = np.concatenate(rows), np.concatenate(terms), np.concatenate(places)
        order = np.lexsort((place, term, row))
        row, term, place = row[order], term[order], place[order]
        first = np.ones(len(row), dtype=bool)
        first[1:] = (row[1:] != row[:-1]) | (term[1:] != term[:-1])
        row, term, place = row[first], term[first], place[first]
        offsets = pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(a)) for a in (term, place.astype(np.int32))]
        yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("fp"), *lists], names=["path", "fp", "terms", "places"])


def listed_signals(signals: DataFrame, splits: DataFrame) -> DataFrame:
    """One row per listed record: path, fp (equal for equal signals), in_train, in_eval, terms, places.

    Of repeated rows of a path that differ the one with the smallest fp counts.
    """
    arrow_batches(signals.sparkSession)
    rows = signals.where("path IS NOT NULL AND x IS NOT NULL").select("path", F.xxhash64("x").alias("fp"), "x")
    terms = rows.mapInArrow(_terms, "path string, fp bigint, terms array<bigint>, places array<int>")
    train = F.col("split") == "train"
    sides = splits.groupBy("path").agg(F.max(train).alias("in_train"), F.max(~train).alias("in_eval"))
    kept = terms.groupBy("path").agg(F.min_by(F.struct("fp", "terms", "places"), "fp").alias("s"))
    return kept.join(sides, "path").select("path", "s.*", "in_train", "in_eval")


def _vectors(classes: DataFrame, n: int) -> DataFrame:
    """fp, in_train, in_eval and the terms (term, w, at) that both sides share; w is the weight over the norm of the whole vector."""
    placed = F.arrays_zip("terms", "places") if "places" in classes.columns else F.transform(F.array_distinct("terms"), lambda t: F.struct(t.alias("terms"), F.lit(0).alias("places")))
    postings = classes.select("fp", "in_train", "in_eval", F.explode(placed).alias("p")).select("fp", "in_train", "in_eval", F.col("p.terms").alias("term"), F.col("p.places").alias("at"))
    seen = postings.groupBy("term").agg(F.count("*").alias("df"), F.max("in_train").alias("t"), F.max("in_eval").alias("e"))
    common = seen.where("df > 1").withColumn("idf", F.log1p(F.lit(float(n)) / F.col("df")))
    single = float(np.log1p(n))  # the weight of a term that only one vector has
    weighted = postings.join(common.select("term", "idf", (F.col("t") & F.col("e")).alias("both")), "term", "left")
    return (
        weighted.groupBy("fp")
        .agg(
            F.first("in_train").alias("in_train"),
            F.first("in_eval").alias("in_eval"),
            F.sqrt(F.sum(F.coalesce("idf", F.lit(single)) ** 2)).alias("norm"),
            F.collect_list(F.when(F.col("both"), F.struct("term", "idf", "at"))).alias("terms"),
        )
        .where(F.size("terms") > 0)
        .select("fp", "in_train", "in_eval", F.transform("terms", lambda t: F.struct(t["term"].alias("term"), (t["idf"] / F.col("norm")).alias("w"), t["at"].alias("at"))).alias("terms"))
    )


def cosine_join(classes: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs (eval_fp, train_fp, cosine) of different vectors between the sides whose cosine reaches the threshold.

    ``classes`` has one row per vector: fp, in_train, in_eval, its terms and, if their
    places count, those beside them; then a term adds to the cosine only if its places in
    both vectors are at most ``SHIFT`` apart. Long posting lists are joined in slices.
    """
    vectors = cut(_vectors(classes, classes.count()))
    posts = vectors.select("fp", "in_train", "in_eval", F.explode("terms").alias("p")).select("fp", "in_train", "in_eval", "p.*")
    train = posts.where("in_train").select("term", F.col("fp").alias("train_fp"), F.col("w").alias("train_w"))
    largest = cut(train.groupBy("term").agg(F.max("train_w").alias("top"), F.ceil(F.count("*") / SLICE).cast("int").alias("slices")))
    hot = small_side(largest.where("slices > 1").select("term", "slices"))
    train = train.join(hot, "term", "left").withColumn("slice", F.pmod(F.xxhash64("train_fp"), F.coalesce("slices", F.lit(1))).cast("int"))
    upward = Window.partitionBy("fp").orderBy("w", "term").rowsBetween(Window.unboundedPreceding, 0)
    evals = (
        posts.where("in_eval")
        .join(largest, "term")
        .withColumn("residual", F.least(F.sqrt(F.sum(F.col("w") ** 2).over(upward)), F.sum(F.col("w") * F.col("top")).over(upward)))
        .withColumn("kept", F.col("residual") > threshold / 2)
    )
    bound = evals.where("NOT kept").groupBy("fp").agg(F.max("residual").alias("bound"))
    index = evals.where("kept").select("term", F.col("fp").alias("eval_fp"), "w", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
    candidates = (
        index.join(train.select("term", "slice", "train_fp", "train_w"), ["term", "slice"])
        .where("eval_fp <> train_fp")
        .groupBy("eval_fp", "train_fp")
        .agg(F.sum(F.col("w") * F.col("train_w")).alias("partial"))
        .join(bound.withColumnRenamed("fp", "eval_fp"), "eval_fp", "left")
        .where(F.col("partial") + F.coalesce("bound", F.lit(0.0)) >= threshold)
    )
    left = vectors.select(F.col("fp").alias("eval_fp"), F.col("terms").alias("eval_terms"))
    entries = F.transform("terms", lambda t: F.struct(t["term"], F.struct(t["w"].alias("w"), t["at"].alias("at"))))
    right = vectors.select(F.col("fp").alias("train_fp"), F.map_from_entries(entries).alias("train_terms"))
    other = lambda t: F.try_element_at("train_terms", t["term"])
    dot = F.aggregate("eval_terms", F.lit(0.0), lambda s, t: s + F.when(F.abs(other(t)["at"] - t["at"]) <= SHIFT, t["w"] * other(t)["w"]).otherwise(0.0))
    return (
        candidates.select("eval_fp", "train_fp")
        .join(left, "eval_fp")
        .join(right, "train_fp")
        .select("eval_fp", "train_fp", dot.alias("cosine"))
        .where(F.col("cosine") >= threshold)
    )


def cross_split_pairs(signals: DataFrame, splits: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Every overlap of a train record with a val or test record: train_path, eval_path, cosine.

    ``signals`` has path and x, ``splits`` has split (train, val, test) and path; other
    columns are ignored. Only records in both tables count; rows with a null path or x
    are left out, repeated rows count once. Equal signals are one vector: the join runs
    between representatives and its pairs are spread over their members. Records
    whose channels all stand still or are too short overlap only if they are equal.
    """
    members = cut(listed_signals(signals, splits))
    sides = [F.max(c).alias(c) for c in ("in_train", "in_eval")]
    classes = members.groupBy("fp").agg(*sides, F.min_by(F.struct("terms", "places"), "path").alias("s"))
    classes = classes.select("fp", "in_train", "in_eval", "s.*")
    near = cosine_join(classes, threshold)
    same = classes.where("in_train AND in_eval").select(F.col("fp").alias("eval_fp"), F.col("fp").alias("train_fp"), F.lit(1.0).alias("cosine"))
    pairs = small_side(cut(near.unionByName(same)))
    train = members.where("in_train").select(F.col("fp").alias("train_fp"), F.col("path").alias("train_path"))
    evals = members.where("in_eval").select(F.col("fp").alias("eval_fp"), F.col("path").alias("eval_path"))
    return train.join(pairs, "train_fp").join(evals, "eval_fp").select("train_path", "eval_path", "cosine")


def overlap_report(pairs: DataFrame, splits: DataFrame, dataset) -> DataFrame:
    """Pairs per evaluation split and dataset of its record: split, dataset, pairs, records."""
    listed = splits.where("split <> 'train'").withColumnRenamed("path", "eval_path")
    return (
        pairs.join(listed, "eval_path")
        .groupBy("split", dataset(F.col("eval_path")).alias("dataset"))
        .agg(F.count("*").alias("pairs"), F.count_distinct("eval_path").alias("records"))
    )
