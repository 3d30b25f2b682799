"""Implausible readings in multichannel signals, relative to their source.

Phase-space thresholding: every sample is a point (value, first difference, second
difference); the second difference is rotated onto the value axis and each axis is scaled
by the source's robust spread, so that a sample's radius says how many times it lies
outside the unit ellipsoid. A source's ellipsoid has the radius that its own tail allows:
a limit starts at the median and the upper quartile of the channels' radii and is set
again from the tail of what it keeps until it settles. Samples outside are flagged, the
spreads are fitted again without them, and all of it is repeated until the spreads stay
the same. A spike is a channel with a sample outside the last ellipsoid. Runs of
differences close to zero find values that stand still, and bounds find readings that
cannot occur at all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavequarry.functions.signals import channel_groups
from wavequarry.session import arrow_batches, cut, small_side

#: The ellipsoid's radius is so many times the tail quantile of its source's radii ...
MARGIN, TAIL = 1.18, 0.99
#: ... and wider where the source's tail is heavy: by this power of the tail quantile over the median.
HEAVINESS = 0.75
#: The rounds start so many times the distance from median to upper quartile above the median, so faults are not in the first tail.
START = 4.0
#: A difference is "zero" below this share of the source's robust spread of differences.
STILL_SHARE = 0.1
#: A zero-difference run is a stuck value beyond this multiple of the source's tail run ...
STILL_FACTOR = 3.0
#: ... and if at least this many differences are zero in a row.
STILL_LEAST = 10
#: No normalised signal reaches this absolute value.
HARD_LIMIT = 1.0e3
#: The measures of one channel of a record.
CHANNELS = "array<struct<ch:int,radius:double,run:int,wild:boolean>>"
#: Mean absolute deviation of a normal distribution, in standard deviations.
MEAN_SHARE = 0.7979
#: Width of a bin of the radii and spreads, in natural-log units, and of the slopes; and the bin of a spread that is zero.
LOG_BIN, SLOPE_BIN, ZERO_BIN = 0.01, 0.01, -1_000_000
#: The measures of a channel that make up the spreads of its source: medians and means of the three axes and of its steps, and the slope of the rotation.
SHAPES = ("m0", "m1", "m2", "m3", "slope", "e0", "e1", "e2", "e3")


def _finite(v: np.ndarray) -> np.ndarray:
    """Readings that can occur; the others become NaN."""
    with np.errstate(invalid="ignore"):
        return np.where(np.abs(v) < HARD_LIMIT, v, np.nan)


def _median(a: np.ndarray) -> np.ndarray:
    """Median by row without NaN; NaN for rows that have no value."""
    a = np.sort(a, axis=1)
    n = np.count_nonzero(~np.isnan(a), axis=1)
    at = np.maximum(n - 1, 0)
    return np.where(n > 0, a[np.arange(len(a)), at // 2], np.nan)


def _mean(a: np.ndarray) -> np.ndarray:
    """Mean by row without NaN; NaN for rows that have no value."""
    known = ~np.isnan(a)
    with np.errstate(invalid="ignore"):
        return np.where(known, a, 0.0).sum(axis=1) / known.sum(axis=1)


def _phases(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centred values with their central first and their second differences; the ends are continued by themselves."""
    v = v - _median(v)[:, None]
    step = np.diff(np.concatenate([v[:, :1], v, v[:, -1:]], axis=1), axis=1)
    return v, (step[:, 1:] + step[:, :-1]) / 2, np.diff(step, axis=1)


def _radii(v: np.ndarray, scale: list[np.ndarray]) -> np.ndarray:
    """Each sample's radius in its source's phase space; 0 where a neighbour is missing or the source has no spread."""
    a0, a1, slope, a2 = scale
    value, d1, d2 = _phases(v)
    with np.errstate(invalid="ignore", divide="ignore"):
        square = (value / a0) ** 2
        square += np.nan_to_num((d1 / a1) ** 2)
        square += np.nan_to_num(((d2 - slope * value) / a2) ** 2)
    return np.sqrt(np.nan_to_num(square))


def _scales(batch: pa.RecordBatch, row: np.ndarray, names: tuple[str, ...]) -> list[np.ndarray]:
    return [batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64)[row][:, None] for c in names]


def _bins(a: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.where(a > 0, np.floor(np.log(np.where(a > 0, a, 1.0)) / LOG_BIN), ZERO_BIN)


def _shape_bins(v: np.ndarray) -> list[np.ndarray]:
    """The bin of each of ``SHAPES`` for every channel; NaN where it does not count (a channel that does not move, a mean of zero)."""
    value, d1, d2 = _phases(v)
    with np.errstate(invalid="ignore", divide="ignore"):
        both = np.where(np.isnan(d2), np.nan, value)
        slope = np.nansum(both * d2, axis=1) / np.nansum(both * both, axis=1)
        sizes = [np.abs(a) for a in (value, d1, d2 - slope[:, None] * value, np.diff(value, axis=1))]
    medians, means = [_median(a) for a in sizes], [_bins(_mean(a)) for a in sizes]
    known = ~np.isnan(slope) & ~np.isnan(medians[0])
    found = [*(_bins(m) for m in medians), np.floor(slope / SLOPE_BIN), *(np.where(e == ZERO_BIN, np.nan, e) for e in means)]
    return [np.where(known, a, np.nan) for a in found]


def _shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches (source, x) to counts (source, what, bin, count) of channel shapes.

    With an ellipsoid (a0, a1, slope, a2, radius_limit) the counts are what changes in them if samples outside
    are left out: channels that have such samples count once less as they are, and once more without them.
    """
    for batch in batches:
        code = batch.column("source").dictionary_encode()
        names, keys, parts = code.dictionary, code.indices.to_numpy(zero_copy_only=False), []
        for row, _, raw in channel_groups(batch.column("x")):
            if raw.shape[1] < 3:
                continue
            v = _finite(raw)
            forms = [(v, row, 1)]
            if "radius_limit" in batch.schema.names:
                *scale, limit = _scales(batch, row, ("a0", "a1", "slope", "a2", "radius_limit"))
                with np.errstate(invalid="ignore"):
                    outside = _radii(v, scale) > limit
                hit = np.flatnonzero(outside.any(axis=1))
                forms = [(v[hit], row[hit], -1), (np.where(outside[hit], np.nan, v[hit]), row[hit], 1)]
            for values, rows, weight in forms:
                for what, bins in enumerate(_shape_bins(values) if len(rows) else []):
                    kept = ~np.isnan(bins)
                    parts.append(np.stack([keys[rows][kept], np.full(kept.sum(), what), bins[kept], np.full(kept.sum(), weight)], axis=1).astype(np.int64))
        if parts:
            bars, n = np.unique(np.concatenate(parts), axis=0, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [names.take(pa.array(bars[:, 0])), pa.array(np.array(SHAPES)[bars[:, 1]]), pa.array(bars[:, 2].astype(np.float64)), pa.array(n * bars[:, 3])],
                names=["source", "what", "bin", "count"],
            )


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches (path, source, x, spreads of the source) to one row of channel measures per record."""
    kinds = {"ch": pa.int32(), "radius": pa.float64(), "run": pa.int32(), "wild": pa.bool_()}
    for batch in batches:
        parts = []
        for row, ch, raw in channel_groups(batch.column("x")):
            v = _finite(raw)
            wild = np.isnan(v).any(axis=1)
            radius, run = np.full(len(row), np.nan), np.zeros(len(row), dtype=np.int32)
            if raw.shape[1] >= 3:
                scale = _scales(batch, row, ("a0", "a1", "slope", "a2"))
                radius = _radii(v, scale).max(axis=1)
                with np.errstate(invalid="ignore"):
                    still = np.abs(np.diff(raw, axis=1)) <= STILL_SHARE * np.nan_to_num(_scales(batch, row, ("a3",))[0])
                current = np.zeros(len(row), dtype=np.int32)
                for t in range(still.shape[1]):
                    current = (current + 1) * still[:, t]
                    np.maximum(run, current, out=run)
            parts.append((row, ch, radius, run, wild))
        if parts:
            row, *cols = (np.concatenate(c) for c in zip(*parts, strict=True))
            order = np.lexsort((cols[0], row))
            row, cols = row[order], [c[order] for c in cols]
        else:
            row, cols = np.zeros(0, dtype=np.int64), [np.zeros(0)] * len(kinds)
        offsets = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
        struct = pa.StructArray.from_arrays([pa.array(c, from_pandas=True).cast(k) for c, k in zip(cols, kinds.values(), strict=True)], names=list(kinds))
        yield pa.RecordBatch.from_arrays(
            [batch.column("path"), batch.column("source"), pa.ListArray.from_arrays(pa.array(offsets), struct)], names=["path", "source", "channels"]
        )


def _quantile(bins: np.ndarray, counts: np.ndarray, q: float) -> float:
    """Interpolated quantile of ascending ``bins`` that hold ``counts``."""
    place, upto = (counts.sum() - 1) * q, np.cumsum(counts)
    low, high = (bins[np.searchsorted(upto, i, side="right")] for i in (np.floor(place), np.ceil(place)))
    return float(low + (high - low) * (place - np.floor(place)))


def _from_bars(estimate):
    """(source, what, bars) histograms, one a row, to (source, what, value) by ``estimate(bins, counts, what)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for what, bars in zip(batch.column("what").to_pylist(), batch.column("bars").to_pylist(), strict=True):
                bins, counts = np.array(sorted((b["bin"], b["count"]) for b in bars)).T
                found.append(estimate(bins, counts, what))
            yield pa.RecordBatch.from_arrays([batch.column("source"), batch.column("what"), pa.array(found, type=pa.float64())], names=["source", "what", "value"])

    return run


def _per_source(counts: DataFrame, estimate) -> DataFrame:
    """(source, what, value) from counts (source, what, bin, count), whose bins are bounded in number whatever the number of channels."""
    summed = counts.groupBy("source", "what", "bin").agg(F.sum("count").alias("count")).where("count > 0")
    bars = summed.groupBy("source", "what").agg(F.collect_list(F.struct("bin", "count")).alias("bars"))
    return bars.mapInArrow(_from_bars(estimate), "source string, what string, value double")


def _middle(bins: np.ndarray, counts: np.ndarray, what: str) -> float:
    middle = np.floor(_quantile(bins, counts, 0.5))
    return (middle + 0.5) * SLOPE_BIN if what == "slope" else 0.0 if middle == ZERO_BIN else float(np.exp((middle + 0.5) * LOG_BIN))


def shape_counts(signals: DataFrame) -> DataFrame:
    """Histograms (source, what, bin, count) of the moving channels' ``SHAPES``.

    If ``signals`` carry an ellipsoid (a0, a1, slope, a2, radius_limit), what changes in them without the samples outside.
    """
    columns = [c for c in ("source", "x", "a0", "a1", "slope", "a2", "radius_limit") if c in signals.columns]
    counts = signals.select(*columns).mapInArrow(_shapes, "source string, what string, bin double, count bigint")
    return counts.groupBy("source", "what", "bin").agg(F.sum("count").alias("count"))


def source_spreads(counts: DataFrame) -> DataFrame:
    """Robust spread of value, first and rotated second difference per source, the slope of the rotation and the spread of steps.

    The median over moving channels of each channel's median deviation; where that is zero
    (coarse steps) of the mean deviation. A source without a moving channel has no row.
    """
    middles = _per_source(counts, _middle)
    of = lambda what: F.max(F.when(F.col("what") == what, F.col("value")))
    spread = lambda k: F.coalesce(F.nullif(of(f"m{k}"), F.lit(0.0)) / F.lit(0.6745), of(f"e{k}") / F.lit(MEAN_SHARE))
    return middles.groupBy("source").agg(*(spread(k).alias(f"a{k}") for k in range(4)), F.coalesce(of("slope"), F.lit(0.0)).alias("slope"))


def channel_measures(signals: DataFrame, spreads: DataFrame) -> DataFrame:
    """One row per record: path, source and per channel its phase-space radius, longest still run and bound flag."""
    joined = signals.select("path", "source", "x").join(small_side(spreads), "source", "left")
    return joined.mapInArrow(_measure, f"path string, source string, channels {CHANNELS}")


def tail_limit(bins: np.ndarray, counts: np.ndarray, what: str) -> float:
    """The limit of one source's histogram, set from the tail of what lies below the limit, from a robust start until it settles."""
    if what == "run":
        beyond = lambda middle, tail: max(tail * STILL_FACTOR, float(STILL_LEAST))
    else:
        beyond = lambda middle, tail: tail + 1 + np.log(MARGIN) / LOG_BIN + HEAVINESS * (tail - middle)
    middle, upper = (_quantile(bins, counts, q) for q in (0.5, 0.75))
    limit = max(middle + START * (upper - middle), beyond(middle, middle))
    seen = set()
    while limit not in seen:  # the bins kept mostly only grow or only shrink; a limit that comes back has settled
        seen.add(limit)
        kept = bins < limit if what == "run" else bins <= limit
        limit = beyond(*(_quantile(bins[kept], counts[kept], q) for q in (0.5, TAIL)))
    return limit


def source_limits(measures: DataFrame) -> DataFrame:
    """Per source the radius of its ellipsoid and the longest still run that counts as normal.

    The limits come from histograms, and start from the median and the upper quartile, so
    up to a quarter of a source's channels may be faulty.
    """
    flat = measures.select("source", F.explode("channels").alias("c")).select("source", "c.*")
    radius = F.when(F.col("radius") > 0, F.floor(F.log("radius") / LOG_BIN)).cast("double")
    named = flat.select("source", F.explode(F.create_map(F.lit("radius"), radius, F.lit("run"), F.col("run").cast("double"))).alias("what", "bin"))
    counts = named.where("bin IS NOT NULL").groupBy("source", "what", "bin").agg(F.count("*").alias("count"))
    limits = _per_source(counts, tail_limit)
    of = lambda what, value: F.max(F.when(F.col("what") == what, value)).alias(f"{what}_limit")
    return limits.groupBy("source").agg(of("radius", F.exp(F.col("value") * LOG_BIN)), of("run", F.col("value")))


def fit_ellipsoids(signals: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The channels' measures under the last ellipsoids, and those ellipsoids (spreads, slope, radius_limit, run_limit) per source.

    A round measures the channels, sets the limits, and fits the spreads again without the
    samples outside. Only histograms are shuffled. Spreads are middles of bins, so they
    come to a stand: the rounds end when all of them are as in a round before.
    """
    whole = cut(shape_counts(signals))
    spreads, seen = cut(source_spreads(whole)), set()
    while True:
        seen.add(frozenset(map(tuple, spreads.collect())))  # one row per source
        measures = cut(channel_measures(signals, spreads))
        ellipsoids = cut(spreads.join(source_limits(measures), "source", "full"))
        changes = shape_counts(signals.select("source", "x").join(small_side(ellipsoids), "source", "left"))
        spreads = cut(source_spreads(whole.unionByName(changes)))
        if frozenset(map(tuple, spreads.collect())) in seen:
            return measures, ellipsoids


def _reasons(ch: Column) -> Column:
    return F.array_compact(
        F.array(
            F.when(ch["wild"], F.lit("bound")),
            F.when(ch["radius"] > F.col("radius_limit"), F.lit("spike")),
            F.when(ch["run"] >= F.col("run_limit"), F.lit("stuck")),
        )
    )


def implausible_channels(signals: DataFrame) -> DataFrame:
    """Channels with readings their source does not normally show: path, ch, source, reasons, radius, run.

    ``signals`` has path, source and ``x ARRAY<ARRAY<FLOAT>>``; other columns are
    ignored. Rows with null ``x`` or ``path`` give nothing; a null source is a
    source of its own. Null readings count as missing (they end a still run),
    NaN, infinite and out-of-bounds readings are faults. Channels of fewer than
    three samples have no radius and no run. Where no channel of a source moves, nothing is
    an outburst and standing still is usual. Repeated rows of a path give each
    channel once, with its largest measures.
    """
    signals = signals.where("path IS NOT NULL AND x IS NOT NULL").select("path", F.coalesce("source", F.lit("")).alias("source"), "x")
    arrow_batches(signals.sparkSession)
    measures, ellipsoids = fit_ellipsoids(signals)
    limits = small_side(ellipsoids)
    flagged = (
        measures.join(limits, "source", "left")
        .select("path", "source", F.explode("channels").alias("c"), "radius_limit", "run_limit")
        .withColumn("reasons", _reasons(F.col("c")))
        .where(F.size("reasons") > 0)
    )
    return flagged.groupBy("path", F.col("c.ch").alias("ch")).agg(
        F.first("source").alias("source"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("reasons")))).alias("reasons"),
        F.max("c.radius").alias("radius"),
        F.max("c.run").alias("run"),
    )
