"""Sensor positions: projection, lookup, validity, normalisation and stand-in layouts."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Sensor types of the data model and kinds of channels in recordings.
EEG, MAG, GRAD = 0, 1, 2
KIND_MEG, KIND_EEG = 1, 2
#: A coordinate whose parts are all this close to zero is missing; a radius up to this is not scaled.
TINY = 1e-10
#: Channels that must stay valid once any was removed.
MIN_CHANNELS = 10


def sensor_type(kind: Column, coil: Column) -> Column:
    """0 for EEG and unknown kinds, 1 for magnetometers, 2 for other MEG coils."""
    return F.when(kind == KIND_MEG, F.when(F.contains(coil, F.lit("MAG")), MAG).otherwise(GRAD)).otherwise(EEG).cast("int")


def sensor_position(kind: Column, coil: Column, loc: Column) -> Column:
    """Six floats: xyz, then the direction (zero but for MEG, where planar coils use their own axis)."""
    zero = F.array_repeat(F.lit(0.0), 3)
    direction = F.when(kind == KIND_MEG, F.when(F.contains(coil, F.lit("PLANAR")), F.slice(loc, 4, 3)).otherwise(F.slice(loc, 10, 3)))
    return F.transform(F.concat(F.slice(loc, 1, 3), F.coalesce(direction, zero)), lambda v: v.cast("float"))


def pick_channels(channels: DataFrame) -> DataFrame:
    """EEG and MEG channels, bad ones included."""
    return channels.where(F.col("kind").isin(KIND_EEG, KIND_MEG))


def invalid_coordinate(x: Column, y: Column, z: Column) -> Column:
    """Missing, NaN in any part, or zero within tolerance."""
    parts = (x, y, z)
    missing = x.isNull() | y.isNull() | z.isNull()
    nan = F.isnan(x) | F.isnan(y) | F.isnan(z)
    zero = F.lit(True)
    for p in parts:
        zero = zero & (F.abs(p) <= TINY)
    return F.coalesce(missing | nan | zero, F.lit(True))


def channel_guard(channels: DataFrame, key: str = "rec") -> DataFrame:
    """Per recording: valid and invalid channels and whether it fails, which takes a removed channel and too few left."""
    counts = channels.groupBy(key).agg(F.count_if("valid").alias("n_valid"), F.count_if(~F.col("valid")).alias("n_invalid"))
    return counts.withColumn("failed", (F.col("n_invalid") > 0) & (F.col("n_valid") < MIN_CHANNELS))


def last_electrode(electrodes: DataFrame, name: str, order: str) -> DataFrame:
    """One row per electrode name: of repeated names the last row wins."""
    fields = [c for c in electrodes.columns if c != name]
    return electrodes.groupBy(name).agg(F.max_by(F.struct(*fields), order).alias("e")).select(name, "e.*")


def first_candidate(candidates: DataFrame, key: str, priority: str) -> DataFrame:
    """Of several candidate rows per key the one with the lowest priority number."""
    rows = Window.partitionBy(key).orderBy(priority)
    return candidates.withColumn("nth", F.row_number().over(rows)).where("nth = 1").drop("nth")


def normalize_positions(channels: DataFrame, key: list[str]) -> DataFrame:
    """Centre and scale x, y, z per recording and group of sensors (EEG, and both kinds of MEG together).

    The radius is the root of three times the mean squared distance from the centre; a
    group whose radius is tiny is only centred. Directions stay as they are.
    """
    group = F.col("sensor_type") == EEG
    per = Window.partitionBy(*key, "is_eeg_group")
    out = channels.withColumn("is_eeg_group", group)
    for c in "xyz":
        out = out.withColumn(f"{c}n", F.col(c) - F.avg(c).over(per))
    square = F.col("xn") ** 2 + F.col("yn") ** 2 + F.col("zn") ** 2
    out = out.withColumn("radius", F.sqrt(3.0 * F.avg(square).over(per)))
    for c in "xyz":
        out = out.withColumn(f"{c}n", F.when(F.col("radius") > TINY, F.col(f"{c}n") / F.col("radius")).otherwise(F.col(f"{c}n")))
    return out


def golden_sphere(i: Column, n: Column, radius: float = 0.1) -> tuple[Column, Column, Column]:
    """Point ``i`` of ``n`` evenly spread over a sphere along the golden angle."""
    at = i + 0.5
    phi = F.acos(1 - 2 * at / n)
    theta = math.pi * (1 + math.sqrt(5.0)) * at
    return radius * F.cos(theta) * F.sin(phi), radius * F.sin(theta) * F.sin(phi), radius * F.cos(phi)


#: Radius of the standard layout's sphere in metres.
HEAD_RADIUS = 0.095
#: The rows of the 10-10 system from front to back, and the older names of four of its electrodes.
ROWS = ("Fp", "AF", "F", "FC", "C", "CP", "P", "PO", "O")
OLDER_NAMES = {"T3": "T7", "T4": "T8", "T5": "P7", "T6": "P8"}


def ten_twenty() -> dict[str, tuple[float, float, float]]:
    """The 10-10 electrodes on a sphere (x to the right, y to the front, z up), by the system's own rule.

    The midline runs from 72 degrees in front of the vertex to 72 behind it in even steps,
    the outer ring 72 degrees around the vertex from 18 degrees beside the front to 18
    beside the back, and each row divides the arc from its outer to its middle electrode
    evenly. The outer electrodes of the middle rows begin with T.
    """
    out: dict[str, np.ndarray] = {}
    ring = math.radians(72)
    for k, row in enumerate(ROWS):
        tilt = math.radians(72 - 18 * k)
        middle = np.array([0.0, math.sin(tilt), math.cos(tilt)])
        out[f"{row}z"] = middle
        turn = math.radians(18 + 18 * k)
        for side, odd in ((-1, 1), (1, 0)):
            outer = np.array([side * math.sin(turn) * math.sin(ring), math.cos(turn) * math.sin(ring), math.cos(ring)])
            if row in ("Fp", "O"):
                out[f"{row}{1 if odd else 2}"] = outer
                continue
            angle = math.acos(float(np.clip(outer @ middle, -1, 1)))
            for step in range(1, 5):  # electrodes 1, 3, 5, 7 or 2, 4, 6, 8
                part = (math.sin((1 - step / 4) * angle) * middle + math.sin(step / 4 * angle) * outer) / math.sin(angle)
                name = {"FC": "FT", "C": "T", "CP": "TP"}.get(row, row) if step == 4 else row
                out[f"{name}{2 * step - odd}"] = part
    out |= {old: out[new] for old, new in OLDER_NAMES.items()}
    return {name: tuple(float(v) * HEAD_RADIUS for v in place) for name, place in out.items()}


def montage_positions(channels: DataFrame) -> DataFrame:
    """(rec, name, x, y, z) of the channels (rec, name) of recordings whose layout is 10-20 and that have at least one of its names.

    A recording with geodesic names has no table here, nor one none of whose names is known; the
    caller places their channels otherwise. Other names of a known recording have no row.
    """
    table = channels.sparkSession.createDataFrame([(n.lower(), *p) for n, p in ten_twenty().items()], "key string, x double, y double, z double")
    layouts = montage_choice(channels, "rec").where("montage = 'standard_1020'")
    standard = channels.join(layouts, "rec", "left_semi").select("rec", "name", F.lower("name").alias("key"))
    return standard.join(F.broadcast(table), "key").select("rec", "name", "x", "y", "z")  # under a hundred rows


def montage_choice(channels: DataFrame, key: str, name: str = "name") -> DataFrame:
    """Per recording the standard layout: the geodesic net if any channel is named e and digits, else 10-20."""
    net = F.bool_or(F.lower(name).rlike("^e[0-9]+$"))
    return channels.groupBy(key).agg(F.when(net, "geodesic").otherwise("standard_1020").alias("montage"))
