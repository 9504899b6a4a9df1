"""Proof that two tables hold the same rows, copies included."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..functions.keys import fingerprint


def row_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """How often each row occurs, by fingerprint."""
    return df.select(fingerprint(*(cols or df.columns)).alias("row_hash")).groupBy("row_hash").agg(F.count("*").alias("n"))


def diff_tables(left: DataFrame, right: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Fingerprints whose number of copies differs, one row per side that has it.

    One aggregation over both tables: copies collapse before the exchange and
    nothing is joined.
    """
    cols = list(cols or left.columns)
    mark = lambda df, l, r: df.select(fingerprint(*cols).alias("row_hash"), F.lit(l).alias("l"), F.lit(r).alias("r"))
    counts = mark(left, 1, 0).unionAll(mark(right, 0, 1)).groupBy("row_hash").agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    sides = F.array(
        F.struct(F.lit("left").alias("side"), F.col("l").alias("n")), F.struct(F.lit("right").alias("side"), F.col("r").alias("n"))
    )
    return (
        counts.filter("l <> r").select("row_hash", F.explode(sides).alias("s")).filter("s.n > 0").select("s.side", "row_hash", "s.n")
    )


@dataclass(frozen=True)
class Match:
    same_columns: bool
    left_rows: int
    right_rows: int
    differences: int

    def __bool__(self) -> bool:
        return self.same_columns and self.left_rows == self.right_rows and self.differences == 0


def compare(left: DataFrame, right: DataFrame) -> Match:
    """Columns, row counts and row multisets of two tables."""
    if left.columns != right.columns:
        return Match(False, -1, -1, -1)
    left_rows, right_rows = left.count(), right.count()
    if left_rows != right_rows:
        return Match(True, left_rows, right_rows, -1)
    return Match(True, left_rows, right_rows, diff_tables(left, right).count())


def table_signature(df: DataFrame) -> DataFrame:
    """Row count and an order-free xor of row hashes."""
    return df.agg(F.count("*").alias("row_count"), F.bit_xor(F.xxhash64(*df.columns)).alias("signature"))
