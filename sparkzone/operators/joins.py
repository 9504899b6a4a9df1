"""Joins. No hint is given: AQE broadcasts a side once its measured size allows it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F


def star_join(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Inner join of a fact with each dimension on its key column."""
    return reduce(lambda left, item: left.join(item[1], item[0], "inner"), dims.items(), fact)


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join in which a null key matches a null key."""
    renamed = right.select(*[F.col(c).alias(f"__r_{c}") if c in on else F.col(c) for c in right.columns])
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"__r_{c}")) for c in on])
    return left.join(renamed, same, how).drop(*[f"__r_{c}" for c in on])


def not_yet_done(work: DataFrame, done: DataFrame | None, on: str) -> DataFrame:
    """Work whose key is not among the finished ones; nothing finished leaves all of it."""
    if done is None:
        return work
    return work.join(done.select(on).distinct(), on, "left_anti")
