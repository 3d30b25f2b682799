"""Command line: ``python -m wavequarry.cli PROGRAM ...``."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from wavequarry import pipeline
from wavequarry.operators import manifest, reports, windowing


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="wavequarry")
    programs = out.add_subparsers(dest="program", required=True)
    p = programs.add_parser("segment", help="cut recordings into normalised segments")
    p.add_argument("--input_dir", "-i", required=True)
    p.add_argument("--output_dir", "-o", required=True)
    p.add_argument("--time_window", "-t", type=int, default=windowing.WINDOW_S)
    p.add_argument("--stride", "-s", type=int, default=windowing.STRIDE_S)
    p.add_argument("--sfreq", type=int, default=windowing.RATE)
    p.add_argument("--limit", "-l", type=int)
    p.add_argument("--dataset")
    p.add_argument("--no_generate_metadata", action="store_true")
    for name, sampled in (("manifest", False), ("manifest-fast", True)):
        p = programs.add_parser(name, help="split the segments into manifests" + ", from one segment per folder" * sampled)
        p.add_argument("segments")
        p.add_argument("target")
        for ratio, value in zip(("train", "val", "test"), manifest.RATIOS, strict=True):
            p.add_argument(f"--{ratio}_ratio", type=float, default=value)
        p.add_argument("--seed", type=int, default=manifest.SEED)
        p.add_argument("--root", default="curated")
        p.add_argument("--array", action="store_true", help="one JSON array for each split instead of JSON lines")
    p = programs.add_parser("convert", help="write segments in bfloat16 precision to a new place")
    p.add_argument("source")
    p.add_argument("target")
    p.add_argument("--dry-run", action="store_true")
    p = programs.add_parser("validate", help="check segments")
    p.add_argument("segments")
    p.add_argument("--limit", type=int, default=10)
    p.add_argument("--verbose", action="store_true")
    return out


def main(arguments: list[str] | None = None) -> int:
    a = parser().parse_args(arguments)
    spark = SparkSession.builder.appName(f"wavequarry {a.program}").getOrCreate()
    if a.program == "segment":
        windowing.check_window(a.time_window, a.stride)
        results = pipeline.segment_dataset(spark, a.input_dir, a.output_dir, a.time_window, a.stride, a.sfreq, a.limit, a.dataset)
        report = reports.run_report(results)
        report.show(truncate=False)
        reports.first_failures(results).show(truncate=False)
        if not a.no_generate_metadata:
            pipeline.build_manifests(spark.read.parquet(f"{a.output_dir}/segments"), f"{a.output_dir}/metadata", root=a.input_dir.rstrip("/").rsplit("/", 1)[-1])
        return int(report.first()["failed"] > 0)
    if a.program.startswith("manifest"):
        ratios = (a.train_ratio, a.val_ratio, a.test_ratio)
        split = pipeline.build_manifests(spark.read.parquet(a.segments), a.target, ratios, a.seed, a.program == "manifest-fast", a.root, a.array)
        manifest.manifest_failures(spark.read.parquet(a.segments), a.root).show(truncate=False)
        manifest.split_sizes(split).show()
        manifest.dataset_stats(split).show(truncate=False)
        return 0
    if a.program == "convert":
        plan = pipeline.convert(spark, a.source, a.target, a.dry_run)
        plan.groupBy("state").agg({"bytes_before": "sum", "bytes_after": "sum", "path": "count"}).show()
        return 0
    records = pipeline.validate(spark.read.parquet(a.segments), a.limit)
    if a.verbose:
        for r in records.toLocalIterator():
            print(r.asDict())
    summary = reports.validation_summary(records)
    summary.show()
    return int(summary.first()["invalid"] > 0)


if __name__ == "__main__":
    sys.exit(main())
