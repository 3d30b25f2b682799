"""Queries of the segmenting and curation operators, each with its DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wavequarry.functions import bids
from wavequarry.functions.numeric import bf16, human_size
from wavequarry.operators import coords, manifest, precision, reports, resample, windowing
from wavequarry.session import load, scratch_path
from wavequarry.streaming import ingest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
WINDOW, STRIDE = 16, 8


def query(sql: str | None = None):
    def register(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[function.__name__] = function
        if sql:
            ORACLE[function.__name__] = sql
        return function

    return register


def rounded(c: Column | str, digits: int = 6) -> Column:
    return F.round(c, digits) + F.lit(0.0)


# --- signals ---------------------------------------------------------------


def _channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "embeddings")
    return e.select(
        F.floor(F.col("vec_id") / 10).cast("bigint").alias("rec"), F.col("vec_id").alias("ch"), (F.col("label") % 3).alias("type"), F.col("embedding").alias("samples")
    )


def _windowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    channels = _channels(spark, sf_dir).repartition("rec")  # one shuffle serves the windows and aggregations below
    lengths = channels.groupBy("rec").agg(F.max(F.size("samples")).alias("n"))
    return windowing.into_windows(windowing.average_reference(windowing.long_signals(channels)), lengths, WINDOW, STRIDE)


_SIGNALS = """s AS (SELECT vec_id // 10 AS rec, vec_id AS ch, label % 3 AS type, CAST(t - 1 AS INTEGER) AS t, CAST(v AS DOUBLE) AS v
    FROM (SELECT vec_id, label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS t FROM embeddings)),
  r AS (SELECT *, v - avg(v) OVER (PARTITION BY rec, type, t) AS r FROM s),
  w AS (SELECT r.*, CAST(k AS INTEGER) AS win FROM r JOIN (SELECT unnest(range(0, 7)) AS k) ON t >= k * 8 AND t < k * 8 + 16)"""
_EPS = "CASE WHEN type = 0 THEN 1e-5 ELSE 1e-13 END"
_BF16 = "CASE WHEN {v} = 0 OR isinf({v}) OR isnan({v}) THEN {v} ELSE round_even({v} / pow(2.0, greatest(floor(log2(abs({v}))), -126) - 7), 0) * pow(2.0, greatest(floor(log2(abs({v}))), -126) - 7) END"


@query(
    f"""WITH {_SIGNALS}
SELECT rec, win, type, count(DISTINCT ch) AS n_ch, count(*) AS n, round(avg(r) / (stddev_pop(r) + {_EPS}), 6) + 0.0 AS x_mean,
  round(stddev_samp(r) / (stddev_pop(r) + {_EPS}), 6) + 0.0 AS x_std, round(max(r) / (stddev_pop(r) + {_EPS}), 6) + 0.0 AS x_max
FROM w GROUP BY rec, win, type"""
)
def segment_zscore_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of the normalised signal per recording, window and sensor type."""
    stats = windowing.segment_stats(_windowed(spark, sf_dir))
    return stats.select("rec", "win", "type", "n_ch", "n", *(rounded(c).alias(c) for c in ("x_mean", "x_std", "x_max")))


@query(f"WITH {_SIGNALS} SELECT rec, type, t, count(*) AS n_ch, round(max(abs(r)), 6) + 0.0 AS r_max FROM r GROUP BY rec, type, t")
def average_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Largest deviation from the channels' mean at each time."""
    r = windowing.average_reference(windowing.long_signals(_channels(spark, sf_dir)))
    return r.groupBy("rec", "type", "t").agg(F.count("*").alias("n_ch"), rounded(F.max(F.abs("r"))).alias("r_max"))


@query(f"WITH {_SIGNALS} SELECT rec, win, type, round(stddev_pop(r) + {_EPS}, 8) + 0.0 AS scale FROM w GROUP BY rec, win, type")
def group_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each group of a window is divided by."""
    scale = F.stddev_pop("r") + windowing.epsilon(F.col("type"))
    return _windowed(spark, sf_dir).groupBy("rec", "win", "type").agg(rounded(scale, 8).alias("scale"))


@query(
    f"""WITH {_SIGNALS}, bad AS (SELECT rec, win, bool_or(ch % 7 = 0 AND t = 20) AS bad FROM w GROUP BY rec, win)
SELECT rec, win, CAST(row_number() OVER (PARTITION BY rec ORDER BY win) - 1 AS INTEGER) AS seg_idx FROM bad WHERE NOT bad"""
)
def accept_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows that stay after every window with a NaN was rejected, numbered densely."""
    broken = F.when((F.col("ch") % 7 == 0) & (F.col("t") == 20), F.lit(float("nan"))).otherwise(F.col("v"))
    return windowing.accepted_windows(_windowed(spark, sf_dir).withColumn("v", broken))


@query(
    """WITH o AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS t, count(*) OVER (PARTITION BY user_id) AS n FROM events),
  w AS (SELECT o.*, k FROM (SELECT *, unnest(range(0, CASE WHEN n < 20 THEN 0 ELSE (n - 20) // 10 + 1 END)) AS k FROM o) o WHERE t >= k * 10 AND t < k * 10 + 20)
SELECT user_id, CAST(k AS INTEGER) AS win, count(*) AS n, min(event_id) AS first_event, max(event_id) AS last_event, round(sum(value), 4) + 0.0 AS total FROM w GROUP BY user_id, k"""
)
def hop_windows_by_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hopping windows over each user's ordered events, by position."""
    events = load(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")
    order = windowing.Window.partitionBy("user_id").orderBy("ts", "event_id")
    rows = events.select(F.col("user_id").alias("rec"), "event_id", "value", (F.row_number().over(order) - 1).alias("t"))
    lengths = events.groupBy(F.col("user_id").alias("rec")).agg(F.count("*").alias("n"))
    win = windowing.into_windows(rows, lengths, 20, 10)
    return (
        win.groupBy("rec", "win")
        .agg(F.count("*").alias("n"), F.min("event_id").alias("first_event"), F.max("event_id").alias("last_event"), rounded(F.sum("value"), 4).alias("total"))
        .withColumnRenamed("rec", "user_id")
    )


@query(
    """SELECT user_id, count(*) AS n, CAST(CASE WHEN count(*) < 20 THEN 0 ELSE (count(*) - 20) // 10 + 1 END AS INTEGER) AS windows, count(*) < 20 AS too_short
FROM events GROUP BY user_id"""
)
def window_count_formula(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many whole windows each user's events give."""
    counts = load(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("n"))
    return counts.withColumn("windows", windowing.window_count(F.col("n"), 20, 10)).withColumn("too_short", F.col("n") < 20)


@query(
    """WITH d AS (SELECT DISTINCT path, coalesce(sfreq, 256.0) AS rate, n_samples FROM recordings),
  p AS (SELECT path, abs(rate - 256) > 0.1 AS resample, CASE WHEN abs(rate - 256) > 0.1 THEN CAST(floor(n_samples * 256 / rate + 0.5) AS INTEGER) ELSE n_samples END AS n FROM d)
SELECT path, resample, n, CAST(CASE WHEN n < 2560 THEN 0 ELSE (n - 2560) // 1280 + 1 END AS INTEGER) AS windows, n < 2560 AS failed, round(n / 256.0, 6) AS seconds FROM p"""
)
def recording_window_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per recording: whether it is resampled, its length and duration then, its windows and whether it fails for want of one."""
    rows = load(spark, sf_dir, "recordings").select("path", F.coalesce("sfreq", F.lit(256.0)).alias("rate"), "n_samples").distinct()
    again = resample.needs_resampling(F.col("rate"))
    n = F.when(again, F.floor(F.col("n_samples") * 256 / F.col("rate") + 0.5)).otherwise(F.col("n_samples")).cast("int")
    window, stride = windowing.WINDOW_S * windowing.RATE, windowing.STRIDE_S * windowing.RATE
    planned = rows.select("path", again.alias("resample"), n.alias("n"))
    return planned.select(
        "path", "resample", "n", windowing.window_count(F.col("n"), window, stride).alias("windows"), (F.col("n") < window).alias("failed"), F.round(F.col("n") / 256.0, 6).alias("seconds")
    )


@query()
def segment_recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The array form: normalised, accepted and rounded segments of every recording."""
    return windowing.segment_channels(_channels(spark, sf_dir), WINDOW, STRIDE)


@query(
    f"""WITH {_SIGNALS},
  z AS (SELECT rec, win, ch, CAST(r / (stddev_pop(r) OVER (PARTITION BY rec, win, type) + {_EPS}) AS FLOAT) :: DOUBLE AS v FROM w),
  b AS (SELECT rec, win, ch, {_BF16.format(v="v")} AS v FROM z)
SELECT rec, win AS win_idx, win AS seg_idx, count(DISTINCT ch) AS n_ch, count(*) AS n_values, round(avg(abs(v)), 6) AS x_abs, max(v) AS x_max FROM b GROUP BY rec, win"""
)
def segment_recordings_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The array form's segments by their size, mean magnitude and maximum."""
    s = segment_recordings(spark, sf_dir)
    v = F.transform(F.flatten("x"), lambda a: a.cast("double"))
    mean = F.aggregate(v, F.lit(0.0), lambda t, a: t + F.abs(a)) / F.size(v)
    sizes = [F.size("x").cast("bigint").alias("n_ch"), F.size(v).cast("bigint").alias("n_values")]
    return s.select("rec", "win_idx", "seg_idx", *sizes, F.round(mean, 6).alias("x_abs"), F.array_max(v).alias("x_max"))


@query(
    """WITH s AS (SELECT vec_id // 10 AS rec, vec_id AS ch, CAST(j - 1 AS INTEGER) AS j, CAST(v AS DOUBLE) AS v FROM (SELECT vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS j FROM embeddings)),
  k AS (SELECT t, j, (1 + 2 * sum(CASE WHEN f < 32 THEN cos(2 * pi() * f * (t / 164.0 - j / 64.0)) END) + max(cos(2 * pi() * 32 * t / 164.0)) * (CASE WHEN j % 2 = 0 THEN 1 ELSE -1 END)) / 64 AS w
    FROM (SELECT CAST(unnest(range(0, 164)) AS INTEGER) AS t), (SELECT CAST(unnest(range(0, 64)) AS INTEGER) AS j), (SELECT unnest(range(1, 33)) AS f) GROUP BY t, j)
SELECT rec, ch, t, round(sum(v * w), 6) + 0.0 AS v FROM s JOIN k USING (j) GROUP BY rec, ch, t"""
)
def resample_fft_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The resampled channels sample by sample."""
    return resample_fft(spark, sf_dir).select("rec", "ch", F.posexplode("samples").alias("t", "v")).withColumn("v", rounded("v"))


@query()
def resample_fft(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every channel resampled from 100 Hz to the target rate."""
    return resample.resample_channels(_channels(spark, sf_dir).withColumn("rate", F.lit(100.0)))


# --- positions -------------------------------------------------------------


@query(
    """WITH c AS (SELECT path, ch, sensor_type[ch] = 0 AS eeg, CAST(pos[ch][1] AS DOUBLE) AS x, CAST(pos[ch][2] AS DOUBLE) AS y, CAST(pos[ch][3] AS DOUBLE) AS z
    FROM (SELECT path, pos, sensor_type, unnest(range(1, len(pos) + 1)) AS ch FROM (SELECT DISTINCT path, pos, sensor_type FROM segments WHERE path IS NOT NULL AND pos IS NOT NULL))),
  m AS (SELECT *, x - avg(x) OVER g AS xn, y - avg(y) OVER g AS yn, z - avg(z) OVER g AS zn FROM c WINDOW g AS (PARTITION BY path, eeg)),
  s AS (SELECT *, sqrt(3 * avg(xn * xn + yn * yn + zn * zn) OVER (PARTITION BY path, eeg)) AS radius FROM m)
SELECT path, CAST(ch - 1 AS INTEGER) AS ch, round(CASE WHEN radius > 1e-10 THEN xn / radius ELSE xn END, 5) + 0.0 AS xn,
  round(CASE WHEN radius > 1e-10 THEN yn / radius ELSE yn END, 5) + 0.0 AS yn, round(CASE WHEN radius > 1e-10 THEN zn / radius ELSE zn END, 5) + 0.0 AS zn FROM s"""
)
def position_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions of every segment, centred and scaled per group of sensors."""
    rows = load(spark, sf_dir, "segments").where("path IS NOT NULL AND pos IS NOT NULL").select("path", "pos", "sensor_type")
    rows = rows.repartition("path").distinct()  # one shuffle serves the distinct rows and the groups
    channels = rows.select("path", "sensor_type", F.posexplode("pos").alias("ch", "p")).select(
        "path", "ch", F.get("sensor_type", F.col("ch")).alias("sensor_type"), *(F.get("p", i).cast("double").alias(c) for i, c in enumerate("xyz"))
    )
    return coords.normalize_positions(channels, ["path"]).select("path", "ch", *(rounded(f"{c}n", 5).alias(f"{c}n") for c in "xyz"))


@query(
    """WITH e AS (SELECT vec_id AS ch, first_value(embedding) OVER (PARTITION BY vec_id // 10 ORDER BY vec_id) AS p FROM embeddings)
SELECT ch, round(CAST(p[1] AS DOUBLE), 6) + 0.0 AS cx, round(CAST(p[2] AS DOUBLE), 6) + 0.0 AS cy, round(CAST(p[3] AS DOUBLE), 6) + 0.0 AS cz, 0.0 :: DOUBLE AS xn, 0.0 :: DOUBLE AS yn, 0.0 :: DOUBLE AS zn, true AS tiny FROM e"""
)
def position_degenerate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Electrodes that all lie in one point, that of their recording's first channel, are centred on it and not scaled."""
    first = F.first("samples").over(windowing.Window.partitionBy("rec").orderBy("ch"))
    rows = _channels(spark, sf_dir).select("rec", "ch", F.lit(0).alias("sensor_type"), *(first[i].cast("double").alias(c) for i, c in enumerate("xyz")))
    out = coords.normalize_positions(rows, ["rec"])
    centre = (rounded(F.col(c) - F.col(f"{c}n")).alias(f"c{c}") for c in "xyz")
    return out.select("ch", *centre, *(rounded(f"{c}n", 9).alias(f"{c}n") for c in "xyz"), (F.col("radius") <= coords.TINY).alias("tiny"))


@query(
    """WITH c AS (SELECT vec_id // 10 AS rec, CASE WHEN vec_id % 13 = 0 THEN NULL WHEN vec_id % 5 = 0 THEN 0.0 WHEN vec_id % 11 = 0 THEN 'nan' :: DOUBLE ELSE CAST(embedding[1] AS DOUBLE) END AS x,
    CASE WHEN vec_id % 5 = 0 THEN 1e-11 ELSE CAST(embedding[2] AS DOUBLE) END AS y, CASE WHEN vec_id % 5 = 0 THEN 0.0 ELSE CAST(embedding[3] AS DOUBLE) END AS z FROM embeddings),
  v AS (SELECT rec, NOT (x IS NULL OR isnan(x) OR (abs(x) <= 1e-10 AND abs(y) <= 1e-10 AND abs(z) <= 1e-10)) AS valid FROM c)
SELECT rec, count(*) FILTER (valid) AS n_valid, count(*) FILTER (NOT valid) AS n_invalid,
  count(*) FILTER (NOT valid) > 0 AND count(*) FILTER (valid) < 10 AS failed FROM v GROUP BY rec"""
)
def invalid_channel_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channels without a usable coordinate, and recordings that keep too few."""
    e = load(spark, sf_dir, "embeddings")
    k = F.col("vec_id")
    part = [F.col("embedding")[i].cast("double") for i in range(3)]
    x = F.when(k % 13 == 0, F.lit(None).cast("double")).when(k % 5 == 0, 0.0).when(k % 11 == 0, F.lit(float("nan"))).otherwise(part[0])
    y, z = F.when(k % 5 == 0, 1e-11).otherwise(part[1]), F.when(k % 5 == 0, 0.0).otherwise(part[2])
    rows = e.select(F.floor(k / 10).cast("bigint").alias("rec"), (~coords.invalid_coordinate(x, y, z)).alias("valid"))
    return coords.channel_guard(rows)


@query(
    """WITH c AS (SELECT p_partkey, p_size % 3 AS kind, CASE WHEN contains(p_type, 'STEEL') THEN 'VV_MAG_T1' WHEN contains(p_type, 'TIN') THEN 'VV_PLANAR_T1' ELSE 'AXIAL_5CM' END AS coil, CAST(p_size AS DOUBLE) AS s FROM part)
SELECT p_partkey, CAST(CASE WHEN kind = 1 THEN CASE WHEN contains(coil, 'MAG') THEN 1 ELSE 2 END ELSE 0 END AS INTEGER) AS sensor_type,
  s + 0.5 :: DOUBLE AS x, s + 1.0 :: DOUBLE AS y, s + 1.5 :: DOUBLE AS z, CAST(CASE WHEN kind <> 1 THEN 0 WHEN contains(coil, 'PLANAR') THEN s + 2.0 ELSE s + 5.0 END AS DOUBLE) AS dx,
  CAST(CASE WHEN kind <> 1 THEN 0 WHEN contains(coil, 'PLANAR') THEN s + 3.0 ELSE s + 6.0 END AS DOUBLE) AS dz FROM c"""
)
def sensor_type_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensor type and position of channels from their kind, coil and location."""
    p = load(spark, sf_dir, "part")
    coil = F.when(F.contains("p_type", F.lit("STEEL")), "VV_MAG_T1").when(F.contains("p_type", F.lit("TIN")), "VV_PLANAR_T1").otherwise("AXIAL_5CM")
    loc = F.transform(F.sequence(F.lit(1), F.lit(12)), lambda i: F.col("p_size") + i * F.lit(0.5).cast("double"))
    rows = p.select("p_partkey", (F.col("p_size") % 3).alias("kind"), coil.alias("coil"), loc.alias("loc"))
    pos = coords.sensor_position(F.col("kind"), F.col("coil"), F.col("loc"))
    out = rows.select("p_partkey", coords.sensor_type(F.col("kind"), F.col("coil")).alias("sensor_type"), pos.alias("pos"))
    return out.select("p_partkey", "sensor_type", *(F.col("pos")[i].cast("double").alias(c) for i, c in ((0, "x"), (1, "y"), (2, "z"), (3, "dx"), (5, "dz"))))


@query(
    """WITH e AS (SELECT c_nationkey AS name, max_by(c_acctbal, c_custkey) AS x, max(c_custkey) AS ord FROM customer GROUP BY c_nationkey)
SELECT n_name AS channel, x, ord FROM nation JOIN e ON n_nationkey = name"""
)
def electrode_join_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions looked up by name; of repeated names the last row counts."""
    c = load(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("name"), F.col("c_acctbal").alias("x"), F.col("c_custkey").alias("ord"))
    electrodes = coords.last_electrode(c, "name", "ord")
    return load(spark, sf_dir, "nation").join(electrodes, F.col("n_nationkey") == F.col("name")).select(F.col("n_name").alias("channel"), "x", "ord")


@query(
    """WITH c AS (SELECT s_nationkey AS rec, CASE WHEN s_suppkey % 9 = 0 THEN 'E' || s_suppkey ELSE s_name END AS name FROM supplier)
SELECT rec, CASE WHEN bool_or(regexp_full_match(lower(name), 'e[0-9]+')) THEN 'geodesic' ELSE 'standard_1020' END AS montage FROM c GROUP BY rec"""
)
def montage_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The standard layout of each recording by its channel names."""
    name = F.when(F.col("s_suppkey") % 9 == 0, F.concat(F.lit("E"), F.col("s_suppkey").cast("string"))).otherwise(F.col("s_name"))
    return coords.montage_choice(load(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("rec"), name.alias("name")), "rec")


@query(
    """WITH c AS (SELECT s_nationkey AS rec, s_suppkey AS ch, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 0.5 AS place, count(*) OVER (PARTITION BY s_nationkey) AS n FROM supplier),
  a AS (SELECT *, acos(1 - 2 * CAST(place AS DOUBLE) / n) AS phi, pi() * (1 + sqrt(5.0)) * CAST(place AS DOUBLE) AS theta FROM c)
SELECT rec, ch, round(0.1 * cos(theta) * sin(phi), 9) + 0.0 AS x, round(0.1 * sin(theta) * sin(phi), 9) + 0.0 AS y, round(0.1 * cos(phi), 9) + 0.0 AS z FROM a"""
)
def golden_sphere(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in positions on a sphere for channels without a layout."""
    per = windowing.Window.partitionBy("rec")
    s = load(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("rec"), F.col("s_suppkey").alias("ch"))
    s = s.withColumn("i", F.row_number().over(per.orderBy("ch")) - 1).withColumn("n", F.count("*").over(per))
    x, y, z = coords.golden_sphere(F.col("i"), F.col("n"))
    return s.select("rec", "ch", rounded(x, 9).alias("x"), rounded(y, 9).alias("y"), rounded(z, 9).alias("z"))


# --- precision -------------------------------------------------------------



@query(
    f"""WITH v AS (SELECT vec_id, CAST(i AS INTEGER) - 1 AS dim, CAST(e AS DOUBLE) AS v FROM (SELECT vec_id, unnest(embedding) AS e, generate_subscripts(embedding, 1) AS i FROM embeddings))
SELECT vec_id, dim, {_BF16.format(v="v")} AS rounded, {_BF16.format(v="v")} = v AS exact FROM v"""
)
def bf16_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value rounded to bfloat16, and whether it already was one."""
    v = load(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("dim", "v"))
    return v.select("vec_id", "dim", bf16(F.col("v")).cast("double").alias("rounded"), (bf16(F.col("v")) == F.col("v")).alias("exact"))


@query(
    f"""WITH d AS (SELECT row_number() OVER () AS k, path, x, pos FROM segments),
  v AS (SELECT k, CAST(unnest(list_concat(flatten(x), flatten(pos))) AS DOUBLE) AS v FROM d WHERE x IS NOT NULL AND pos IS NOT NULL),
  b AS (SELECT k, count(*) AS n, bool_and(isnan(v) OR {_BF16.format(v="v")} = v) AS ready FROM v GROUP BY k),
  s AS (SELECT path, coalesce(n, coalesce(list_sum(list_transform(x, lambda c: len(c))), 0) + coalesce(list_sum(list_transform(pos, lambda c: len(c))), 0)) AS n,
    CASE WHEN x IS NULL OR pos IS NULL THEN 'failed' WHEN coalesce(ready, true) THEN 'skipped' ELSE 'converted' END AS state FROM d LEFT JOIN b USING (k))
SELECT split_part(path, '/', 4) AS dataset, state, count(*) AS files, CAST(sum(n * 4) AS BIGINT) AS bytes_before, CAST(sum(CASE WHEN state = 'converted' THEN n * 2 ELSE n * 4 END) AS BIGINT) AS bytes_after
FROM s GROUP BY 1, 2"""
)
def conversion_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dry run of the precision conversion over all segments."""
    plan = precision.conversion_plan(load(spark, sf_dir, "segments").select("path", "x", "pos"))
    dataset = F.split_part("path", F.lit("/"), F.lit(4))
    return plan.groupBy(dataset.alias("dataset"), "state").agg(F.count("*").alias("files"), F.sum("bytes_before").alias("bytes_before"), F.sum("bytes_after").alias("bytes_after"))


@query(
    """WITH c AS (SELECT coalesce(success, false) AS ok, original_size AS o, new_size AS n FROM (SELECT DISTINCT * FROM conversions)),
  t AS (SELECT count(*) FILTER (ok AND NOT coalesce(o = n, false)) AS converted, count(*) FILTER (ok AND o = n) AS skipped, count(*) FILTER (NOT ok) AS failed,
    CAST(sum(CASE WHEN ok THEN coalesce(o, 0) ELSE 0 END) AS BIGINT) AS original_bytes, CAST(sum(CASE WHEN ok THEN coalesce(n, 0) ELSE 0 END) AS BIGINT) AS new_bytes FROM c),
  u AS (SELECT *, original_bytes - new_bytes AS saved_bytes FROM t)
SELECT *, round(100.0 * saved_bytes / original_bytes, 6) AS saved_percent,
  CASE WHEN saved_bytes < 1024 THEN format('{:.2f} B', saved_bytes * 1.0) WHEN saved_bytes < 1048576 THEN format('{:.2f} KB', saved_bytes / 1024.0)
    WHEN saved_bytes < 1073741824 THEN format('{:.2f} MB', saved_bytes / 1048576.0) ELSE format('{:.2f} GB', saved_bytes / 1073741824.0) END AS saved FROM u"""
)
def conversion_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the precision conversion did and saved."""
    totals = reports.conversion_totals(load(spark, sf_dir, "conversions").distinct())
    return totals.withColumn("saved_percent", F.round("saved_percent", 6)).withColumn("saved", human_size(F.col("saved_bytes")))


@query(
    """SELECT dataset, path, count(*) OVER w AS done, CAST(sum(coalesce(new_size, 0)) OVER w AS BIGINT) AS bytes_so_far
FROM (SELECT DISTINCT split_part(path, '/', 4) AS dataset, path, new_size, converted_at FROM conversions WHERE success AND path IS NOT NULL)
WINDOW w AS (PARTITION BY dataset ORDER BY converted_at, path ROWS UNBOUNDED PRECEDING)"""
)
def running_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversions of each dataset in order, with the count and bytes so far."""
    rows = load(spark, sf_dir, "conversions").where("success AND path IS NOT NULL")
    rows = rows.select(F.split_part("path", F.lit("/"), F.lit(4)).alias("dataset"), "path", "new_size", "converted_at").distinct()
    return reports.running_progress(rows, ["dataset"], ["converted_at", "path"], "new_size").select("dataset", "path", "done", "bytes_so_far")


# --- manifests -------------------------------------------------------------

_MANIFEST = """m AS (SELECT DISTINCT CASE WHEN list_position(string_split(path, '/'), 'curated') > 0 THEN coalesce(string_split(path, '/')[list_position(string_split(path, '/'), 'curated') + 1], 'unknown') ELSE 'unknown' END AS dataset,
    path, CAST(len(x) AS INTEGER) AS channels, len(list_filter(sensor_type, lambda k: k <> 0)) = 0 AS is_eeg, len(list_filter(sensor_type, lambda k: k NOT IN (1, 2))) = 0 AS is_meg
    FROM segments WHERE path IS NOT NULL AND x IS NOT NULL AND sensor_type IS NOT NULL)"""


def _split_sql(train: float, val: float, test: bool) -> str:
    rest = "'test'" if test else "NULL"
    return f"""{_MANIFEST},
  k AS (SELECT *, count(*) OVER (PARTITION BY dataset, channels) AS n, row_number() OVER (PARTITION BY dataset, channels ORDER BY md5('42:' || path), path) AS k FROM m),
  s AS (SELECT dataset, path, channels, is_eeg, is_meg, CASE WHEN k <= floor(n * {train} :: DOUBLE) THEN 'train' WHEN k <= floor(n * {train} :: DOUBLE) + floor(n * {val} :: DOUBLE) THEN 'val' ELSE {rest} END AS split FROM k)"""


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest_fields(load(spark, sf_dir, "segments").select("path", "x", "sensor_type"))


@query(f"WITH {_MANIFEST} SELECT * FROM m")
def manifest_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest from a full scan of the segments."""
    return _manifest(spark, sf_dir)


@query(
    """WITH f AS (SELECT regexp_replace(path, '/[^/]*$', '') AS dir, path, len(x) AS channels, len(list_filter(sensor_type, lambda k: k <> 0)) = 0 AS is_eeg, x IS NOT NULL AS ok FROM segments WHERE path IS NOT NULL),
  o AS (SELECT dir, channels, is_eeg, ok, row_number() OVER (PARTITION BY dir ORDER BY md5('42:' || path), NOT ok) AS k FROM f),
  p AS (SELECT DISTINCT dir, path FROM f)
SELECT CASE WHEN list_position(string_split(path, '/'), 'curated') > 0 THEN coalesce(string_split(path, '/')[list_position(string_split(path, '/'), 'curated') + 1], 'unknown') ELSE 'unknown' END AS dataset,
  path, CAST(channels AS INTEGER) AS channels, is_eeg, NOT is_eeg AS is_meg FROM p JOIN o USING (dir) WHERE k = 1 AND ok AND is_eeg IS NOT NULL"""
)
def manifest_sampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest from one sampled segment per folder."""
    return manifest.sampled_manifest(load(spark, sf_dir, "segments").select("path", "x", "sensor_type"))


@query(f"WITH {_split_sql(0.97, 0.03, False)} SELECT * FROM s WHERE split IS NOT NULL")
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest split 97 to 3 within datasets and channel counts; what rounding leaves over is dropped."""
    return manifest.stratified_split(_manifest(spark, sf_dir), ["dataset", "channels"])


@query(f"WITH {_split_sql(0.8, 0.1, True)} SELECT * FROM s WHERE split IS NOT NULL")
def stratified_split_80_10_10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest split into three within datasets and channel counts."""
    return manifest.stratified_split(_manifest(spark, sf_dir), ["dataset", "channels"], ratios=(0.8, 0.1, 0.1))


@query(
    f"""WITH {_split_sql(0.8, 0.1, True)}
SELECT split, count(*) AS n, count(DISTINCT dataset) AS datasets, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS percent FROM s GROUP BY split"""
)
def split_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, datasets and percentage of each split."""
    return manifest.split_sizes(stratified_split_80_10_10(spark, sf_dir)).withColumn("percent", F.round("percent", 6))


@query(
    f"""WITH {_MANIFEST} SELECT dataset, count(*) AS n, array_to_string(list_sort(list_distinct(list(channels))), ',') AS channels FROM m GROUP BY dataset"""
)
def dataset_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and distinct channel counts of each dataset."""
    stats = manifest.dataset_stats(_manifest(spark, sf_dir))
    return stats.withColumn("channels", F.array_join(F.col("channels").cast("array<string>"), ","))


@query("SELECT regexp_replace(path, '/[^/]*$', '') AS dir, count(*) AS files FROM (SELECT DISTINCT path FROM segments WHERE path IS NOT NULL) GROUP BY 1")
def directory_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segment files in each folder."""
    return load(spark, sf_dir, "segments").where("path IS NOT NULL").select("path").distinct().groupBy(bids.parent_dir(F.col("path")).alias("dir")).agg(F.count("*").alias("files"))


@query(
    f"""WITH {_MANIFEST}, o AS (SELECT path FROM m ORDER BY md5('42:' || path), path LIMIT 100)
SELECT path, row_number() OVER (ORDER BY md5('42:' || path), path) AS place FROM o"""
)
def shuffled_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first hundred rows of the manifest in shuffled order: the limit that a smoke run takes."""
    key = manifest.shuffle_key(F.col("path"))
    head = _manifest(spark, sf_dir).select("path").orderBy(key, "path").limit(100)
    return head.withColumn("place", F.row_number().over(windowing.Window.partitionBy(F.lit(1)).orderBy(key, "path")).cast("bigint"))


@query(
    f"""WITH {_MANIFEST} SELECT path, row_number() OVER (ORDER BY md5('42:' || path), path) AS place FROM (SELECT DISTINCT path FROM m)"""
)
def shuffled_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every path of the manifest in shuffled order."""
    return manifest.shuffled(_manifest(spark, sf_dir).select("path").distinct()).select("path", "place")


@query(
    """SELECT CASE WHEN list_position(string_split(path, '/'), 'curated') > 0 THEN coalesce(string_split(path, '/')[list_position(string_split(path, '/'), 'curated') + 1], 'unknown') ELSE 'unknown' END AS dataset,
  count(*) AS total, count(*) FILTER (x IS NOT NULL AND sensor_type IS NOT NULL) AS readable, count(*) FILTER (x IS NULL OR sensor_type IS NULL) AS failed FROM segments WHERE path IS NOT NULL GROUP BY 1"""
)
def manifest_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segment rows that the manifest takes and those it drops because they cannot be read, by dataset."""
    return manifest.manifest_failures(load(spark, sf_dir, "segments").select("path", "x", "sensor_type"))


# --- runs and validation ---------------------------------------------------


@query(
    """SELECT count(*) AS total, count(*) FILTER (ok) AS successful, count(*) FILTER (ok AND NOT sk) AS processed, count(*) FILTER (ok AND sk) AS skipped, count(*) FILTER (NOT ok) AS failed,
  CAST(sum(CASE WHEN ok THEN coalesce(n_segments, 0) ELSE 0 END) AS BIGINT) AS total_segments
FROM (SELECT *, coalesce(success, false) AS ok, coalesce(skipped, false) AS sk FROM (SELECT DISTINCT * FROM results))"""
)
def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts over all file results."""
    return reports.run_report(load(spark, sf_dir, "results").distinct())


@query(
    """WITH f AS (SELECT DISTINCT file, error FROM results WHERE NOT coalesce(success, false))
SELECT file, error, (SELECT count(*) FROM f) AS failures FROM f ORDER BY file, error NULLS FIRST LIMIT 10"""
)
def run_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first ten failed files and the number of all."""
    return reports.first_failures(load(spark, sf_dir, "results"))


@query(
    """WITH r AS (SELECT DISTINCT path FROM recordings), d AS (SELECT file AS path, count(*) AS existing FROM (SELECT DISTINCT file, output_dir, finished_at FROM results WHERE success) GROUP BY file)
SELECT path, coalesce(existing, 0) AS existing, coalesce(existing, 0) > 0 AS skipped FROM r LEFT JOIN d USING (path)"""
)
def resume_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recordings with what earlier runs already wrote for them."""
    done = load(spark, sf_dir, "results").where("success").select(F.col("file").alias("path"), "output_dir", "finished_at").distinct()
    return reports.resume_state(load(spark, sf_dir, "recordings").select("path").distinct(), done, "path")


@query(
    """WITH h AS (SELECT (min(epoch_us(finished_at)) + max(epoch_us(finished_at))) // 2 AS half FROM results)
SELECT path FROM (SELECT path FROM recordings UNION SELECT file FROM results) WHERE path IS NOT NULL
  AND path NOT IN (SELECT file FROM results, h WHERE success AND file IS NOT NULL AND epoch_us(finished_at) <= half)"""
)
def resume_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files, listed as recordings or known from results, that no run had finished halfway through the time of the results."""
    results = load(spark, sf_dir, "results").select(F.col("file").alias("path"), "success", F.unix_micros("finished_at").alias("at"))
    half = results.agg(F.floor((F.min("at") + F.max("at")) / 2)).first()[0]
    results = results.withColumn("success", F.col("success") & (F.col("at") <= F.lit(half)))
    known = load(spark, sf_dir, "recordings").select("path").unionByName(results.select("path"))
    return reports.work_list(known.where("path IS NOT NULL").distinct(), results.where("success").select("path"), "path")


@query(
    """SELECT dataset, count(*) AS total, count(*) FILTER (ok) AS successful, count(*) FILTER (NOT ok) AS failed, bool_or(NOT ok) AS any_failed
FROM (SELECT string_split(file, '/')[4] AS dataset, coalesce(success, false) AS ok FROM (SELECT DISTINCT * FROM results)) GROUP BY dataset"""
)
def batch_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Successes and failures of each dataset's batch."""
    runs = load(spark, sf_dir, "results").distinct().withColumn("dataset", bids.component_after(F.col("file"), "raw"))
    return reports.batch_tally(runs, "dataset", "success")


_VALID = """d AS (SELECT row_number() OVER () AS k, * FROM (SELECT DISTINCT path, x, pos, sensor_type FROM segments)),
  v AS (SELECT k, CAST(unnest(flatten(x)) AS DOUBLE) AS v FROM d),
  a AS (SELECT k, count(*) AS n_values, bool_or(isnan(v)) AS nan_x, CASE WHEN bool_or(isnan(v) OR isinf(v) OR abs(v) > 1e6) THEN NULL ELSE avg(CASE WHEN abs(v) <= 1e6 THEN v END) END AS m,
    CASE WHEN bool_or(isnan(v) OR isinf(v) OR abs(v) > 1e6) THEN NULL ELSE stddev_samp(CASE WHEN abs(v) <= 1e6 THEN v END) END AS s, bool_or(NOT isnan(v) AND abs(v) > 1e6) AS wild FROM v GROUP BY k),
  p AS (SELECT k, max(CAST(q AS DOUBLE)) AS hi, min(CAST(q AS DOUBLE)) AS lo FROM (SELECT k, unnest(flatten(list_transform(pos, lambda r: r[1:3]))) AS q FROM d) GROUP BY k),
  r AS (SELECT path, x IS NULL OR pos IS NULL OR sensor_type IS NULL AS missing, coalesce(len(pos) <> len(x), false) OR coalesce(len(list_filter(pos, lambda q: len(q) <> 6)) > 0, false) AS bad_pos,
    coalesce(len(sensor_type) <> len(x), false) AS bad_type, coalesce(nan_x, false) AS nan_x, CAST(len(x) AS INTEGER) AS n_channels, n_values, m, s, wild, hi, lo FROM d LEFT JOIN a USING (k) LEFT JOIN p USING (k)),
  e AS (SELECT path, missing, n_channels, m, s, wild, CASE WHEN missing THEN 'missing part' ELSE concat_ws(',', CASE WHEN bad_pos THEN 'pos shape' END, CASE WHEN bad_type THEN 'sensor_type shape' END, CASE WHEN nan_x THEN 'NaN in x' END) END AS errors,
    CASE WHEN missing THEN '' ELSE concat_ws(',', CASE WHEN abs(m) > 0.1 THEN 'mean' END, CASE WHEN abs(s - 1) > 0.5 THEN 'std' END, CASE WHEN wild THEN 'value range' END, CASE WHEN lo < -2 OR hi > 2 THEN 'position range' END) END AS warnings FROM r)"""


def _validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.validation_records(load(spark, sf_dir, "segments").select("path", "x", "pos", "sensor_type").distinct())


@query(
    f"""WITH {_VALID}
SELECT path, errors = '' AS valid, errors, n_channels, round(m, 5) + 0.0 AS x_mean, round(s, 5) + 0.0 AS x_std, warnings FROM e"""
)
def validation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors, warnings and statistics of every segment."""
    r = _validated(spark, sf_dir)
    number = lambda c: rounded(F.when(~F.isnan(c), F.col(c)), 5).alias(c)
    return r.select("path", "valid", F.array_join("errors", ",").alias("errors"), "n_channels", number("x_mean"), number("x_std"), F.array_join("warnings", ",").alias("warnings"))


@query(f"WITH {_VALID} SELECT count(*) AS total, count(*) FILTER (errors = '') AS valid, count(*) FILTER (warnings <> '') AS warned, count(*) FILTER (errors <> '') AS invalid FROM e")
def validation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many segments are valid, and how many are warned about."""
    return reports.validation_summary(_validated(spark, sf_dir))


# --- paths -----------------------------------------------------------------


@query(
    """WITH d AS (SELECT DISTINCT path, string_split(path, '/') AS p FROM recordings), n AS (SELECT path, p, regexp_replace(p[-1], '\\.[^.]*$', '') AS stem, regexp_replace(path, '/[^/]*$', '') AS dir FROM d),
  q AS (SELECT *, string_split(replace(stem, '_eeg', ''), '_') AS w FROM n)
SELECT path, dir || '/' || stem AS record, p[4] AS dataset,
  list_filter(w, lambda t: starts_with(t, 'sub-'))[-1][5:] AS sub, list_filter(w, lambda t: starts_with(t, 'ses-'))[-1][5:] AS ses,
  list_filter(w, lambda t: starts_with(t, 'task-'))[-1][6:] AS task, list_filter(w, lambda t: starts_with(t, 'run-'))[-1][5:] AS run FROM q"""
)
def bids_entity_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key, dataset and entities of every recording's path."""
    path = F.col("path")
    rows = load(spark, sf_dir, "recordings").select("path").distinct()
    found = bids.entities(bids.stem(path))
    return rows.select("path", bids.record_key(path).alias("record"), bids.component_after(path, "raw").alias("dataset"), *(c.alias(e) for e, c in found.items()))


@query(
    """SELECT path FROM (SELECT DISTINCT path, string_split(path, '/') AS parts FROM recordings
  WHERE contains(path, 'derivatives') AND contains(path, 'preprocessing') AND regexp_matches(path, '\\.(fif|vhdr)$') ORDER BY parts LIMIT 50)"""
)
def path_filter_sort_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first fifty recordings in component order: the limit that a smoke run takes."""
    paths = load(spark, sf_dir, "recordings").select("path").distinct().where(bids.is_preprocessed(F.col("path")) & F.col("path").rlike(r"\.(fif|vhdr)$"))
    return paths.orderBy(F.split("path", "/")).limit(50)


@query(
    """SELECT ext, count(*) AS n FROM (SELECT string_split(path, '.')[-1] AS ext FROM recordings WHERE path LIKE '%.fif' UNION ALL SELECT string_split(path, '.')[-1] FROM recordings WHERE path LIKE '%.vhdr'
UNION ALL SELECT string_split(file, '.')[-1] FROM results) GROUP BY ext"""
)
def union_extensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bag union of the files of each extension, with those of the results."""
    paths = load(spark, sf_dir, "recordings").select("path")
    parts = [paths.where(F.endswith("path", F.lit(e))) for e in (".fif", ".vhdr")] + [load(spark, sf_dir, "results").select(F.col("file").alias("path"))]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return whole.groupBy(F.element_at(F.split("path", r"\."), -1).alias("ext")).agg(F.count("*").alias("n"))


# --- streaming -------------------------------------------------------------


@query(
    """SELECT split_part(path, '/', 4) AS source, count(*) AS rows, count(*) FILTER (landed_at > written_at + INTERVAL 1 HOUR) AS late
FROM segments WHERE path IS NOT NULL GROUP BY 1"""
)
def landing_counts_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and late rows per source, counted by a stream over the segment files."""
    stream = ingest.segment_stream(spark, f"{sf_dir}/segments.parquet*", load(spark, sf_dir, "segments").schema)
    target = scratch_path(spark, "landings")
    ingest.ingest_batches(ingest.landing_counts(stream.select("source", "landed_at", "written_at")), target, scratch_path(spark, "landings-checkpoint"))
    counts = ingest.latest(spark, target, ["source", "day"])
    return counts.groupBy("source").agg(F.sum("rows").alias("rows"), F.sum("late").alias("late"))
