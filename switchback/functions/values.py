"""Rounding, trimming and missing values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed(c: Column, pattern: str) -> Column:
    """Decimal text by pattern, rounded half to even from the exact binary value."""
    return F.call_function("format_number", c, F.lit(pattern))


def py_round(c: Column, digits: int) -> Column:
    """Round the exact binary value, ties to even (``round`` of the double would scale it first)."""
    pattern = "0." + "0" * digits if digits else "0"
    return fixed(c, pattern).cast("double")


def quick_round(c: Column, digits: int) -> Column:
    """As :func:`py_round`, which is needed for values beside a tie and very large ones only; ``c`` is evaluated several times."""
    scaled = c * F.lit(float(10**digits))
    sure = (F.abs(scaled) < F.lit(1e8)) & (F.abs(F.abs(scaled - F.rint(scaled)) - F.lit(0.5)) > F.lit(1e-6))
    return F.when(sure, np_round(c, digits)).otherwise(py_round(c, digits))


def np_round(c: Column, digits: int) -> Column:
    """Scale, round half to even, scale back."""
    return F.rint(c * F.lit(float(10**digits))) / F.lit(float(10**digits))


def strip(c: Column) -> Column:
    """Remove white space of any kind, line breaks and no-break spaces included, at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def finite(c: Column) -> Column:
    """NaN and the infinities become NULL."""
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), None).otherwise(c)


def parse_float(c: Column) -> Column:
    """Number in a text field; empty or garbled text is NULL."""
    return strip(c).try_cast("double")


def parse_int(c: Column) -> Column:
    """As ``parse_float``, then truncated toward zero."""
    return finite(parse_float(c)).try_cast("int")


def falsy(c: Column, zero) -> Column:
    """NULL or the empty value of the type."""
    return c.isNull() | (c == F.lit(zero))
