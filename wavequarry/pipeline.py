"""The programs: segment recordings, build manifests, convert, validate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavequarry.functions.bids import component_after
from wavequarry.operators import coords, manifest, precision, reports, resample, windowing
from wavequarry.session import cut, exists
from wavequarry.sources import brainvision, electrodes, files, sinks


def _positions(channels: DataFrame, places: DataFrame, kinds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The valid EEG and MEG channels with normalised position and sensor type, and per recording whether it keeps enough of them.

    Channels without a kind are EEG. Positions are those of the electrode table, else of the standard
    layout, else stand-ins on a sphere.
    """
    known = channels.select("rec", "ch", "name").join(kinds, ["rec", "name"], "left").withColumn("kind", F.coalesce("kind", F.lit(coords.KIND_EEG)))
    picked = cut(coords.pick_channels(known))
    tables = places.select("rec").distinct()
    places = places.unionByName(coords.montage_positions(picked.select("rec", "name").join(tables, "rec", "left_anti")))
    tables = places.select("rec").distinct().withColumn("placed", F.lit(True))
    found = picked.join(places, ["rec", "name"], "left").join(tables, "rec", "left")
    per = windowing.Window.partitionBy("rec")  # as many rows as a recording has channels
    # a recording without any position gets stand-ins
    stand_in = coords.golden_sphere(F.row_number().over(per.orderBy("ch")) - 1, F.count("*").over(per))
    for c, s in zip("xyz", stand_in, strict=True):
        found = found.withColumn(c, F.when(F.col("placed"), F.col(c)).otherwise(s))
    known = found.withColumn("valid", ~coords.invalid_coordinate(F.col("x"), F.col("y"), F.col("z"))).withColumn("sensor_type", coords.sensor_type(F.col("kind"), F.coalesce("coil", F.lit(""))))
    kept = coords.normalize_positions(known.where("valid"), ["rec"])
    six = F.transform(F.array("xn", "yn", "zn", F.lit(0.0), F.lit(0.0), F.lit(0.0)), lambda v: v.cast("float"))
    return kept.select("rec", "ch", six.alias("pos"), "sensor_type"), coords.channel_guard(known)


def segment_dataset(
    spark: SparkSession, input_dir: str, output_dir: str, window_s: int = windowing.WINDOW_S, stride_s: int = windowing.STRIDE_S, rate: int = windowing.RATE,
    limit: int | None = None, dataset: str | None = None,
) -> DataFrame:
    """Segment every recording below ``input_dir`` that has no segments yet; write segments and report, return the file results.

    A recording that cannot be decoded, keeps too few channels or gives no window is a failed result.
    """
    root = f"{input_dir}/{dataset}" if dataset else input_dir
    found = cut(files.discover_recordings(spark, root, limit=limit))
    target = f"{output_dir}/segments"
    # only the first run has no output yet; an output that cannot be read is an error
    done = spark.read.parquet(target).select("rec") if exists(spark, target) else spark.createDataFrame([], "rec string")
    state = cut(reports.resume_state(found, done, "rec"))
    decoded = cut(brainvision.read_recordings(state.where("NOT skipped").select("rec", "path")))
    places = electrodes.electrodes_of(state.select("rec", "stem", "dir"), electrodes.read_electrodes(spark, root))
    channels = decoded.where("error IS NULL")
    kinds = electrodes.kinds_of(state.select("rec", "stem", "dir"), electrodes.read_channel_kinds(spark, root))
    sensors, guard = _positions(channels, cut(places), kinds)
    guard = cut(guard.select("rec", "failed", "n_valid"))
    sensors = cut(sensors.join(guard.where("NOT failed").select("rec"), "rec", "left_semi"))
    even = resample.resample_channels(channels.select("rec", "ch", "rate", "samples"), rate)
    typed = even.join(sensors.select("rec", "ch", F.col("sensor_type").alias("type")), ["rec", "ch"])
    segments = windowing.segment_channels(typed.select("rec", "ch", "type", "samples"), window_s * rate, stride_s * rate)
    layout = sensors.groupBy("rec").agg(F.array_sort(F.collect_list(F.struct("ch", "pos"))).alias("c")).select("rec", F.col("c.pos").alias("pos"))
    name = F.col("rec") if dataset is None else F.lit(dataset)
    label = component_after(F.col("rec"), input_dir.rstrip("/").rsplit("/", 1)[-1]) if dataset is None else name
    out = segments.drop("chs").join(layout, "rec").withColumn("dataset", label)
    out = out.withColumn("path", F.concat("rec", F.lit("/"), F.col("seg_idx").cast("string"), F.lit("_data")))
    sinks.write_segments(precision.convert_segments(out).drop("was_bf16"), target)
    counts = spark.read.parquet(target).groupBy("rec").agg(F.count("*").alias("n"), F.max(F.size("x")).alias("n_channels"))
    length = F.max(F.size("samples") / F.col("rate")).alias("duration_sec")
    results = (
        state.join(decoded.groupBy("rec").agg(F.max("error").alias("error"), length), "rec", "left")
        .join(guard, "rec", "left")
        .join(counts, "rec", "left")
    )
    few = F.format_string("too few valid channels: %d", F.col("n_valid"))
    problem = F.coalesce("error", F.when(F.col("failed"), few), F.when(F.col("n").isNull(), F.lit("no segment")))
    results = cut(
        results.select(
            F.col("path").alias("file"), problem.isNull().alias("success"), F.coalesce("n", F.lit(0)).alias("n_segments"), problem.alias("error"),
            F.when(problem.isNull(), F.col("rec")).alias("output_dir"), "skipped", "n_channels", "duration_sec",
        )
    )
    parameters = {"time_window": window_s, "stride": stride_s, "sfreq": rate, "limit": limit, "dataset": dataset}
    sinks.write_report(reports.run_report(results), results, parameters, f"{output_dir}/report")
    return results


def build_manifests(segments: DataFrame, target: str, ratios: tuple[float, float, float] = manifest.RATIOS, seed: int = manifest.SEED, sampled: bool = False, root: str = "curated", arrays: bool = False) -> DataFrame:
    """Split and write the manifest of a segment table, as JSON lines or one JSON array for each split; return it with its splits."""
    fields = manifest.sampled_manifest(segments, seed, root) if sampled else manifest.manifest_fields(segments, root)
    split = manifest.stratified_split(fields, ["dataset", "channels"], ratios=ratios, seed=seed)
    ordered = split.orderBy(manifest.shuffle_key(F.col("path"), seed), "path")
    (sinks.write_arrays if arrays else sinks.write_manifest)(ordered, target)
    return split


def convert(spark: SparkSession, source: str, target: str, dry_run: bool = False) -> DataFrame:
    """Write a segment table in bfloat16 precision to a new place; return the plan of what changes."""
    segments = spark.read.parquet(source)
    plan = precision.conversion_plan(segments)
    if not dry_run:
        precision.convert_segments(segments).drop("was_bf16").write.mode("errorifexists").parquet(target)
    return plan


def validate(segments: DataFrame, limit: int | None = 10) -> DataFrame:
    """Validation records of the first ``limit`` segments by path; all with 0 or None."""
    rows = segments.select("path", "x", "pos", "sensor_type").orderBy("path")
    return reports.validation_records(rows.limit(limit) if limit else rows)
