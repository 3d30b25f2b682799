"""Numeric column functions: bfloat16 rounding, byte sizes, guarded ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bf16(value: Column) -> Column:
    """``value`` rounded to bfloat16 (eight significant bits, ties to even), as FLOAT.

    Subnormals use the smallest exponent, zeros keep their sign, values past the
    range become infinite, NaN stays NaN and null stays null.
    """
    v = value.cast("double")
    exponent = F.greatest(F.floor(F.log2(F.abs(v))).cast("double"), F.lit(-126.0))
    quantum = F.pow(F.lit(2.0), exponent - 7)
    plain = (v == 0) | F.isnan(v) | (F.abs(v) == F.lit(float("inf")))
    return F.when(plain, v).otherwise(F.rint(v / quantum) * quantum).cast("float")


def bf16_matrix(x: Column) -> Column:
    """Every value of a nested signal rounded to bfloat16."""
    return F.transform(x, lambda ch: F.transform(ch, bf16))


def is_bf16_matrix(x: Column) -> Column:
    """Whether every value of a nested signal already is a bfloat16 value (true for an empty one)."""
    return F.forall(x, lambda ch: F.forall(ch, lambda v: v.isNull() | F.isnan(v) | (bf16(v) == v)))


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole``, 0 where the whole is 0 or null."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def human_size(size: Column) -> Column:
    """A byte count as text: two decimals and the first unit below 1024, up to PB."""
    units = ["B", "KB", "MB", "GB", "TB"]
    value = size.cast("double")
    out = F.format_string("%.2f PB", value / 1024.0**5)
    for power, unit in reversed(list(enumerate(units))):
        out = F.when(value < 1024.0 ** (power + 1), F.format_string(f"%.2f {unit}", value / 1024.0**power)).otherwise(out)
    return F.when(size.isNotNull(), out)


def to_samples(seconds: Column, rate: Column) -> Column:
    """Seconds as a number of samples, truncated."""
    return F.floor(seconds * rate).cast("int")
