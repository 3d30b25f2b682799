"""Mixing sources to target weights.

A classifier learned from the labelled rows of the table predicts the domain posteriors
of the records whose label is missing, from how and of what they were recorded; labelled
records belong to their label. Every record has a rate, the number of times it should
enter the mixture; projected gradient descent on the squared gaps between the expected
sizes of the domains and their targets fits the rates between zero and the repeat limit
of the likeliest domain. Records with the same features have the same posteriors and so the same
gradient: the descent runs over Spark groups of them, and only the totals of the target
domains reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavequarry.functions.signals import channel_groups
from wavequarry.operators.ranking import hash_order, hash_part, running
from wavequarry.session import arrow_batches, cut, small_side

#: Additive smoothing of the classifier's counts.
SMOOTHING = 0.5
#: Posteriors below this are taken as zero.
LEAST_POSTERIOR = 1e-6
#: Descent ends when no domain's total moved by this share of the whole; its steps never overshoot, so it does.
TOLERANCE = 1e-6
#: Steps between two lineage cuts.
STEPS_PER_CUT = 5
#: Most target domains; their totals go to the driver.
DOMAINS = 10_000
#: A domain is short if its fitted total misses the target by more than this share.
SHORT = 1e-3
#: Steps per octave of a signal's spread and of its peak over its spread.
SPREAD_STEPS, PEAK_STEPS = 3, 1


def path_features(path: Column, size: Column) -> Column:
    """Tokens that describe a record without naming its source: release, kind of recording, task and number of channels."""
    parts = F.split(path, "/")
    return F.array(
        F.concat(F.lit("release="), F.coalesce(F.try_element_at(parts, F.lit(5)), F.lit(""))),
        F.concat(F.lit("kind="), F.regexp_extract(path, r"/(eeg|meg)/", 1)),
        F.concat(F.lit("task="), F.regexp_extract(path, r"_task-([^_/]*)", 1)),
        F.concat(F.lit("size="), size.cast("string")),
    )


def _traits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        total, count, top = np.zeros(batch.num_rows), np.zeros(batch.num_rows), np.zeros(batch.num_rows)
        for row, _, raw in channel_groups(batch.column("x")):
            size = np.abs(np.where(np.isfinite(raw), raw, 0.0))
            np.add.at(total, row, size.sum(axis=1))
            np.add.at(count, row, raw.shape[1])
            np.maximum.at(top, row, np.median(size, axis=1))
        with np.errstate(divide="ignore", invalid="ignore"):
            mean = total / count
            spread, peak = np.floor(np.log2(top) * SPREAD_STEPS), np.floor(np.log2(top / mean) * PEAK_STEPS)
        tokens = [[f"spread={s:.0f}", f"peak={p:.0f}"] for s, p in zip(spread, peak, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("size"), pa.array(tokens, type=pa.list_(pa.string()))], names=["path", "size", "traits"])


def signal_traits(signals: DataFrame) -> DataFrame:
    """(path, size, traits) of signals (path, x), one row per path: the number of channels and tokens for the spread of the readings.

    Of repeated rows of a path the one with most channels counts. Null readings count as zero.
    """
    arrow_batches(signals.sparkSession)
    rows = signals.where("path IS NOT NULL AND x IS NOT NULL").select("path", F.size("x").alias("size"), "x")
    found = rows.mapInArrow(_traits, "path string, size int, traits array<string>")
    return found.groupBy("path").agg(F.max(F.struct("size", "traits")).alias("t")).select("path", "t.size", "t.traits")


def fit_classifier(labelled: DataFrame) -> DataFrame:
    """(token, label, gain, base, prior) of a naive Bayes classifier over ``labelled`` (label, features, weight).

    Only pairs that occur have a row: ``base`` is the log-likelihood of a token the
    label never had, ``gain`` what the token's own count adds to it.
    """
    tokens = labelled.select("label", "weight", F.explode("features").alias("token"))
    counts = tokens.groupBy("label", "token").agg(F.sum("weight").alias("n"))
    priors = labelled.groupBy("label").agg(F.sum("weight").alias("total"))
    base = F.log(F.lit(SMOOTHING) / F.col("total"))
    seen = F.log((F.col("n") + SMOOTHING) / F.col("total"))
    return counts.join(priors, "label").select("token", "label", (seen - base).alias("gain"), base.alias("base"), F.log("total").alias("prior"))


def posteriors(groups: DataFrame, model: DataFrame) -> DataFrame:
    """(profile, label, posterior) of ``groups`` (profile, features); tokens that no label had say nothing.

    A profile none of whose tokens is known gets no row, a label that shares no token
    with it posterior zero.
    """
    known = groups.select("profile", F.explode("features").alias("token")).join(small_side(cut(model)), "token")
    tokens = known.groupBy("profile").agg(F.count_distinct("token").alias("tokens"))
    score = F.sum("gain") + F.max("tokens") * F.max("base") + F.max("prior")
    scored = cut(known.join(tokens, "profile").groupBy("profile", "label").agg(score.alias("score")))
    best = scored.groupBy("profile").agg(F.max("score").alias("best"))
    raw = scored.join(best, "profile").withColumn("p", F.exp(F.col("score") - F.col("best")))
    total = raw.groupBy("profile").agg(F.sum("p").alias("total"))
    sure = raw.join(total, "profile").select("profile", "label", (F.col("p") / F.col("total")).alias("posterior"))
    return sure.where(F.col("posterior") >= LEAST_POSTERIOR)


def descend(groups: DataFrame, membership: DataFrame, targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rates (profile, rate) by projected gradient over groups (profile, size), membership and targets, and how the domains stand.

    ``targets`` has label, target (a size) and max_repeats, one row per domain. The limit of a
    group is that of its likeliest domain, 0 if that is no target. The second table has label, fitted (the expected total
    under the rates) and headroom (what the limits still allow). A step moves every rate by the mean of
    its domains' gaps, each over the size of the domain, and clips it to its limits:
    in the metric of the group sizes that is projected gradient descent, whose step of one
    is at most the inverse of the largest curvature.
    """
    wanted = {r["label"]: float(r["target"]) for r in targets.select("label", "target").limit(DOMAINS + 1).collect()}
    if len(wanted) > DOMAINS:
        raise ValueError(f"more than {DOMAINS} target domains")
    member = membership.join(small_side(targets), "label", "left").join(groups, "profile")
    limit = F.max_by(F.coalesce("max_repeats", F.lit(0)), F.struct("posterior", "label")).cast("double")
    mine = F.collect_list(F.when(F.col("target").isNotNull(), F.struct("label", "posterior")))
    state = member.groupBy("profile").agg(F.first("size").alias("size"), limit.alias("cap"), mine.alias("m"))
    state = cut(state.withColumn("rate", F.least(F.lit(1.0), F.col("cap"))))
    everything = max(1.0, sum(wanted.values()))

    def totals(of: Column) -> dict[str, float]:
        mass = state.select(F.explode("m").alias("e"), of.alias("v")).groupBy("e.label").agg(F.sum(F.col("e.posterior") * F.col("v")).alias("now"))
        return {r["label"]: float(r["now"]) for r in mass.collect()}  # one row per target domain

    whole, before, steps = totals(F.col("size")), None, 0
    while True:
        now = totals(F.col("size") * F.col("rate"))
        if before is not None and max((abs(now[k] - before[k]) for k in now), default=0.0) <= TOLERANCE * everything:
            break
        before, steps = now, steps + 1
        pulls = F.create_map(*(F.lit(v) for k in now for v in (k, (wanted[k] - now[k]) / max(whole[k], 1e-12)))) if now else F.create_map()
        pull = F.aggregate("m", F.lit(0.0), lambda s, e: s + e["posterior"] * F.element_at(pulls, e["label"]))  # noqa: B023
        state = state.withColumn("rate", F.least("cap", F.greatest(F.lit(0.0), F.col("rate") + pull)))
        state = cut(state) if steps % STEPS_PER_CUT == 0 else state
    state = cut(state)
    most = totals(F.col("size") * F.col("cap"))
    rows = [(k, now.get(k, 0.0), most.get(k, 0.0) - now.get(k, 0.0)) for k in wanted]
    return state.select("profile", "rate"), groups.sparkSession.createDataFrame(rows, "label string, fitted double, headroom double")


def fit_rates(groups: DataFrame, membership: DataFrame, targets: DataFrame) -> DataFrame:
    """(profile, rate) by :func:`descend`."""
    return descend(groups, membership, targets)[0]


def mix(records: DataFrame, targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The mixture (path, domain, size, copies) and the report per target dataset.

    ``records`` has path, label (null where it is missing), size and perhaps traits (more
    tokens that describe it), one row per record; ``targets`` has dataset, target_share
    and max_repeats; null shares count as 0, null limits as 1. A record's domain is its
    label, else the label with the largest posterior. The records of a domain take copies
    in hash order as their running rate passes whole numbers, so the domain's total comes
    out as fitted and no record exceeds the limit of its domain. The report has target
    size, own size, the limit, the reached size and share, the fitted expected size, the
    headroom that the limits leave above it, and ``short``: the fitted size misses the target.
    """
    traits = F.coalesce("traits", F.array().cast("array<string>")) if "traits" in records.columns else F.array().cast("array<string>")
    featured = records.withColumn("features", F.concat(path_features(F.col("path"), F.col("size")), traits))
    featured = featured.withColumn("profile", F.xxhash64("features", "label"))
    featured = cut(featured.select("path", "label", "size", "features", "profile"))
    groups = cut(featured.groupBy("profile").agg(F.first("features").alias("features"), F.first("label").alias("label"), F.sum("size").cast("double").alias("size")))
    labelled = featured.where("label IS NOT NULL").groupBy("label", "features").agg(F.count("*").cast("double").alias("weight"))
    known = groups.where("label IS NOT NULL").select("profile", "label", F.lit(1.0).alias("posterior"))
    membership = cut(known.unionByName(posteriors(groups.where("label IS NULL"), fit_classifier(labelled))))
    total = F.lit(float(groups.agg(F.coalesce(F.sum("size"), F.lit(0.0))).first()[0]))
    wanted = cut(
        targets.where("dataset IS NOT NULL")
        .groupBy(F.col("dataset").alias("label"))
        .agg((F.coalesce(F.max("target_share"), F.lit(0.0)) * total).alias("target"), F.coalesce(F.max("max_repeats"), F.lit(1)).alias("max_repeats"))
    )
    rates, standing = descend(groups.select("profile", "size"), membership, wanted)
    domain = membership.groupBy("profile").agg(F.max_by("label", F.struct("posterior", "label")).alias("domain"))
    placed = domain.join(rates, "profile", "left")
    limits = wanted.select(F.col("label").alias("domain"), "max_repeats")
    placed = featured.select("path", "size", "profile").join(small_side(cut(placed)), "profile", "left").join(small_side(limits), "domain", "left")
    placed = cut(placed.select("path", "size", F.coalesce("domain", F.lit("")).alias("domain"), F.coalesce("rate", F.lit(0.0)).alias("rate"), F.coalesce("max_repeats", F.lit(0)).alias("cap")))
    rows = placed.withColumn("h", hash_order("path"))
    ranked = running(rows, ["domain"], hash_part(F.col("h"), placed.count()), ["h", "path"], {"upto": F.col("rate")})
    copies = F.floor(F.col("upto") + 1e-6) - F.floor(F.col("upto") - F.col("rate") + 1e-6)
    mixture = cut(ranked.select("path", F.nullif("domain", F.lit("")).alias("domain"), "size", F.least(copies, F.col("cap")).cast("int").alias("copies")))
    reached = mixture.groupBy(F.col("domain").alias("label")).agg(F.sum("size").alias("own"), F.sum(F.col("size") * F.col("copies")).alias("reached"))
    whole = F.lit(max(1, mixture.agg(F.coalesce(F.sum(F.col("size") * F.col("copies")), F.lit(0))).first()[0]))
    report = (
        wanted.join(reached, "label", "left")
        .join(small_side(standing), "label", "left")
        .select(
            F.col("label").alias("dataset"),
            "target",
            F.coalesce("own", F.lit(0)).alias("own"),
            "max_repeats",
            F.coalesce("reached", F.lit(0)).alias("reached"),
            (F.coalesce("reached", F.lit(0)) / whole).alias("share"),
            "fitted",
            "headroom",
        )
        .withColumn("short", F.col("fitted") < F.col("target") * (1 - SHORT))
    )
    return mixture.where("copies > 0"), report
