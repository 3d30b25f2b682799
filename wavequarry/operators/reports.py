"""Reports over runs: results, resumption, conversions, validation and progress."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavequarry.functions.numeric import ratio
from wavequarry.operators.ranking import hash_parts, running
from wavequarry.session import cut

#: Warning limits of a segment's mean, spread and coordinates.
MEAN_LIMIT, STD_LIMIT, POSITION_LIMIT = 0.1, 0.5, 2.0
#: Beyond this absolute value a segment's sums say nothing, and depend on the order of its values.
VALUE_LIMIT = 1e6


def run_report(results: DataFrame) -> DataFrame:
    """One row: files in total, successful, processed afresh, skipped and failed, and all segments of the successful ones."""
    ok, skipped = F.coalesce("success", F.lit(False)), F.coalesce("skipped", F.lit(False))
    return results.agg(
        F.count("*").alias("total"),
        F.count_if(ok).alias("successful"),
        F.count_if(ok & ~skipped).alias("processed"),
        F.count_if(ok & skipped).alias("skipped"),
        F.count_if(~ok).alias("failed"),
        F.sum(F.when(ok, F.coalesce("n_segments", F.lit(0))).otherwise(0)).alias("total_segments"),
    )


def first_failures(results: DataFrame, limit: int = 10) -> DataFrame:
    """The first failed files by name, with the number of all failures beside them."""
    failed = results.where(~F.coalesce("success", F.lit(False))).select("file", "error").distinct()
    return failed.orderBy("file", "error").limit(limit).withColumn("failures", F.lit(failed.count()).cast("bigint"))


def resume_state(inputs: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Every input with ``skipped`` and the number of outputs it already has. ``done`` has one row per output."""
    counts = done.groupBy(key).agg(F.count("*").alias("existing"))
    return inputs.join(counts, key, "left").withColumn("existing", F.coalesce("existing", F.lit(0))).withColumn("skipped", F.col("existing") > 0)


def work_list(inputs: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """The inputs that have no output yet."""
    return inputs.join(done, key, "left_anti")


def conversion_totals(conversions: DataFrame) -> DataFrame:
    """One row: converted, skipped (equal sizes) and failed files, bytes before and after, saved bytes and percent."""
    ok = F.coalesce("success", F.lit(False))
    same = ok & (F.col("original_size") == F.col("new_size"))
    size = lambda c: F.sum(F.when(ok, F.coalesce(c, F.lit(0))).otherwise(0))
    totals = conversions.agg(
        F.count_if(ok & ~F.coalesce(same, F.lit(False))).alias("converted"),
        F.count_if(same).alias("skipped"),
        F.count_if(~ok).alias("failed"),
        size("original_size").alias("original_bytes"),
        size("new_size").alias("new_bytes"),
    )
    saved = F.col("original_bytes") - F.col("new_bytes")
    return totals.withColumn("saved_bytes", saved).withColumn("saved_percent", 100.0 * ratio(saved, F.col("original_bytes")))


def _values(x: str) -> Column:
    return F.flatten(x)


def validation_records(segments: DataFrame) -> DataFrame:
    """Per segment row: valid, errors, warnings and statistics.

    Errors: a missing part, positions that are not channels by six, sensor types that
    are not one per channel, NaN in signal or positions. Warnings: mean, spread or
    coordinates beyond the limits, or a value beyond ``VALUE_LIMIT`` (finite or not), in which case mean
    and spread are null. Statistics are over all values; the spread is that of a sample.
    """
    c = F.size("x")
    v = F.transform(_values("x"), lambda a: a.cast("double"))
    n = F.size(v)
    mean = F.aggregate(v, F.lit(0.0), lambda s, a: s + a) / n
    wild = F.coalesce(F.exists(v, lambda a: ~F.isnan(a) & (F.abs(a) > VALUE_LIMIT)), F.lit(False))
    counted = segments.withColumn("n_channels", c).withColumn("n_values", n).withColumn("wild_value", wild)
    with_mean = counted.withColumn("x_mean", F.when((n > 0) & ~F.col("wild_value"), mean))
    m = F.col("x_mean")
    spread = F.when(n > 1, F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, a: s + (a - m) * (a - m)) / (n - 1)))
    xyz = F.flatten(F.transform("pos", lambda p: F.slice(p, 1, 3)))
    stats = with_mean.withColumn("x_std", spread).withColumn("pos_min", F.array_min(xyz).cast("double")).withColumn("pos_max", F.array_max(xyz).cast("double"))
    missing = F.col("x").isNull() | F.col("pos").isNull() | F.col("sensor_type").isNull()
    errors = F.array_compact(
        F.array(
            F.when((F.size("pos") != c) | F.exists("pos", lambda p: F.size(p) != 6), F.lit("pos shape")),
            F.when(F.size("sensor_type") != c, F.lit("sensor_type shape")),
            F.when(F.exists(v, lambda a: F.isnan(a)), F.lit("NaN in x")),
            F.when(F.exists(F.flatten("pos"), lambda a: F.isnan(a)), F.lit("NaN in pos")),
        )
    )
    warnings = F.array_compact(
        F.array(
            F.when(~F.isnan("x_mean") & (F.abs("x_mean") > MEAN_LIMIT), F.lit("mean")),  # NaN is above every number in Spark
            F.when(~F.isnan("x_std") & (F.abs(F.col("x_std") - 1) > STD_LIMIT), F.lit("std")),
            F.when(F.col("wild_value"), F.lit("value range")),
            F.when((F.col("pos_min") < -POSITION_LIMIT) | (F.col("pos_max") > POSITION_LIMIT), F.lit("position range")),
        )
    )
    none = F.expr("cast(array() as array<string>)")
    return stats.select(
        *(k for k in segments.columns if k not in ("x", "pos", "sensor_type", "wild_value")),
        F.when(missing, F.array(F.lit("missing part"))).otherwise(errors).alias("errors"),
        F.when(missing, none).otherwise(warnings).alias("warnings"),
        "n_channels", "n_values", "x_mean", "x_std", "pos_min", "pos_max",
    ).withColumn("valid", F.size("errors") == 0)


def validation_summary(records: DataFrame) -> DataFrame:
    """One row: rows, valid rows, rows with warnings, rows with errors; a row can be valid and warned about."""
    return records.agg(
        F.count("*").alias("total"), F.count_if("valid").alias("valid"), F.count_if(F.size("warnings") > 0).alias("warned"), F.count_if(~F.col("valid")).alias("invalid")
    )


def batch_tally(runs: DataFrame, batch: str, ok: str) -> DataFrame:
    """Per batch: runs, successes and failures, and whether any failed."""
    good = F.coalesce(ok, F.lit(False))
    return runs.groupBy(batch).agg(F.count("*").alias("total"), F.count_if(good).alias("successful"), F.count_if(~good).alias("failed"), F.bool_or(~good).alias("any_failed"))


def running_progress(rows: DataFrame, part: list[str], order: list[str], size: str) -> DataFrame:
    """Running count and sum within each part, in order; a null size counts as 0.

    ``order`` starts with a timestamp, whose range is cut into equal spans, so a part of any
    size is summed in many tasks; only rows of one span meet in one.
    """
    rows = cut(rows)
    at = F.unix_micros(F.col(order[0]).cast("timestamp"))
    first, last, n = rows.agg(F.coalesce(F.min(at), F.lit(0)), F.coalesce(F.max(at), F.lit(0)), F.count("*")).first()
    width = max(1.0, (last - first + 1) / hash_parts(n))
    span = F.coalesce(F.floor((at - F.lit(first)) / width), F.lit(-1)).cast("int")  # null times come first
    return running(rows, part, span, order, {"done": F.lit(1), "bytes_so_far": F.coalesce(size, F.lit(0))})
