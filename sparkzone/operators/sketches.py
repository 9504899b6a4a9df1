"""Distinct counts from stored sketches that merge across days."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

# Registers of a sketch, as a power of two.
PRECISION = 14


def distinct_sketches(df: DataFrame, by: Sequence[str], value: str, precision: int = PRECISION) -> DataFrame:
    """One sketch of the values per group, of bounded size whatever the rows; nulls don't count."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(value, precision).alias("sketch"))


def distinct_estimates(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct values per coarser group, from the union of its sketches; the rows they are from are not read."""
    return sketches.groupBy(*by).agg(F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch")), F.lit(0)).alias("estimate"))


def relative_error(precision: int = PRECISION, deviations: float = 3.0) -> float:
    """The share by which an estimate may be off, at so many standard deviations."""
    return deviations * 1.04 / math.sqrt(2.0**precision)
