"""Resampling of whole recordings to a target rate."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavequarry.operators.windowing import RATE, RATE_TOLERANCE
from wavequarry.session import arrow_batches


def needs_resampling(rate: Column, target: float = RATE) -> Column:
    return F.abs(rate - target) > RATE_TOLERANCE


def fft_resample(x: np.ndarray, n_out: int) -> np.ndarray:
    """Band-limited resampling of the last axis to ``n_out`` samples; the spectrum is cut or padded with zeros."""
    n = x.shape[-1]
    if n == 0 or n_out == 0:
        return np.zeros((*x.shape[:-1], n_out))
    spectrum = np.fft.rfft(x)
    kept = min(n, n_out)
    out = np.zeros((*x.shape[:-1], n_out // 2 + 1), dtype=complex)
    out[..., : kept // 2 + 1] = spectrum[..., : kept // 2 + 1]
    if kept % 2 == 0 and n != n_out:  # the middle frequency stands for both of its signs
        out[..., kept // 2] *= 0.5 if n_out > n else 2.0
        if n_out < n:
            out[..., kept // 2] = spectrum[..., kept // 2].real
    return np.fft.irfft(out, n_out) * (n_out / n)


def resample_channels(channels: DataFrame, target: float = RATE) -> DataFrame:
    """(rec, ch, rate, samples) with every channel at the target rate; one within the tolerance, or without a rate, stays as it is.

    Channels are resampled whole, one row each, so Spark spreads them by row.
    """
    arrow_batches(channels.sparkSession, rows=256)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rates, out = [], []
            for rate, samples in zip(batch.column("rate").to_pylist(), batch.column("samples"), strict=True):
                x = None if samples.values is None else samples.values.to_numpy(zero_copy_only=False)
                if x is not None and len(x) and rate and abs(rate - target) > RATE_TOLERANCE:
                    x, rate = fft_resample(x.astype(np.float64), int(round(len(x) * target / rate))), float(target)
                rates.append(rate)
                out.append(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rec"), batch.column("ch"), pa.array(rates, type=pa.float64()), pa.array(out, type=pa.list_(pa.float64()))],
                names=["rec", "ch", "rate", "samples"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in channels.schema}
    return channels.select("rec", "ch", F.col("rate").cast("double").alias("rate"), F.col("samples").cast("array<double>").alias("samples")).mapInArrow(
        run, f"rec {kinds['rec']}, ch {kinds['ch']}, rate double, samples array<double>"
    )
