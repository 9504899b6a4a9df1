"""Numeric guards. ANSI mode raises on bad casts and zero division, so all are total."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def finite(c: Column) -> Column:
    """Null for NaN and both infinities."""
    return F.when(~(F.isnan(c) | (F.abs(c) == F.lit(float("inf")))), c)


def non_negative(c: Column) -> Column:
    """Null for values below zero; text that is no number is left as it is."""
    return F.when(F.coalesce(c.try_cast("double") < 0, F.lit(False)), None).otherwise(c)


def within(c: Column, low, high) -> Column:
    return F.when(c.between(low, high), c)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Null where the denominator is zero or missing."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def decade(year: Column) -> Column:
    """Year truncated towards zero to its decade."""
    return (year - year % 10).cast("int")
