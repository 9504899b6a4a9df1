"""Physical layouts that later reads profit from.

* Ranges: files that each hold one range of a key, so that a filter on it skips files and row
  groups by their least and greatest values.
* Pairs: a fact and its dimension bucketed alike, so that their join needs no exchange. A key
  with more rows than a bucket should hold is dealt over numbered pieces when the tables are
  written; the dimension's row of such a key is there once per piece.

Both write the rows once more than a plain write, as a row's place within its first file is what
splits equal keys, and equal rows, the same way on every retry.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.gates import GateError
from ..sharedfs import cut_lineage, new_folder

ROWS_PER_FILE = 1 << 20
ROWS_PER_BUCKET = 1 << 22


def _unused(columns: Sequence[str], wanted: str) -> str:
    taken = {c.lower() for c in columns}
    while wanted in taken:
        wanted += "_"
    return wanted


def _numbered(frame: DataFrame, name: str) -> DataFrame:
    """The rows, written, with a number that stays theirs."""
    return cut_lineage(frame.withColumn(name, F.monotonically_increasing_id()), "numbered")


def write_ranges(frame: DataFrame, path: str, keys: Sequence[str], rows_per_file: int = ROWS_PER_FILE) -> None:
    """Files of about ``rows_per_file`` rows, each sorted and of one range of ``keys``.

    Rows of one key may span files; nulls come first. A table without rows is written as such.
    """
    place = _unused(frame.columns, "__place")
    rows = _numbered(frame, place)
    files = max(1, math.ceil(rows.count() / rows_per_file))
    dealt = rows.repartitionByRange(files, *keys, place).sortWithinPartitions(*keys).drop(place)
    dealt.write.mode("overwrite").parquet(path)


def file_ranges(table: DataFrame, key: str) -> DataFrame:
    """file, rows, nulls, least and greatest value of a key, per file of a scanned table."""
    k = F.col(f"`{key}`")
    per_file = table.groupBy(F.col("_metadata.file_path").alias("file"))
    return per_file.agg(F.count("*").alias("rows"), F.count_if(k.isNull()).alias("nulls"), F.min(k).alias("least"), F.max(k).alias("greatest"))


def files_within(ranges: DataFrame, low: Column, high: Column) -> DataFrame:
    """One row: files, those that hold values from ``low`` up to but without ``high``, and those only partly within."""
    met = (F.col("greatest") >= low) & (F.col("least") < high)
    whole = (F.col("least") >= low) & (F.col("greatest") < high)
    return ranges.agg(F.count("*").alias("files"), F.count_if(met).alias("met"), F.count_if(met & ~whole).alias("partly"))


@dataclass(frozen=True)
class Pair:
    """Two catalogue tables bucketed by ``keys`` and ``piece``."""

    fact: str
    dimension: str
    keys: tuple[str, ...]
    piece: str
    buckets: int

    def join(self, spark: SparkSession, how: str = "inner") -> DataFrame:
        """``inner``, ``left``, ``left_semi`` or ``left_anti``: each row of the fact is there once, those of the dimension may not be."""
        if how not in ("inner", "left", "left_semi", "left_anti"):
            raise ValueError(f"a pair can't be joined by {how}")
        return spark.table(self.fact).join(spark.table(self.dimension), [*self.keys, self.piece], how).drop(self.piece)


def store_pair(fact: DataFrame, dimension: DataFrame, keys: Sequence[str], name: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> Pair:
    """Write both as tables ``<name>_fact`` and ``<name>_dimension`` of the catalogue, in the shared folder.

    Keys have the same names and types in both. Rows of the fact that lack a key match nothing
    and are spread over all buckets. Repeated keys of the dimension stay repeated.
    """
    spark, keys = fact.sparkSession, list(keys)
    kinds = [[f.schema[k].dataType for k in keys] for f in (fact, dimension)]
    if kinds[0] != kinds[1]:
        raise GateError(f"{name}: keys differ in type: {kinds[0]} and {kinds[1]}")
    columns = [*fact.columns, *dimension.columns]
    place, piece, pieces = (_unused(columns, c) for c in ("__place", "__piece", "__pieces"))
    rows = _numbered(fact, place)
    # A power of two: tables of different sizes can still be read as if they had the same buckets.
    buckets = 1 << max(0, math.ceil(math.log2(max(1, rows.count() / rows_per_bucket))))
    # At most one row per ``rows_per_bucket`` of the fact.
    counted = rows.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias(pieces)).where(F.col(pieces) > rows_per_bucket)
    hot = cut_lineage(counted.withColumn(pieces, F.ceil(F.col(pieces) / rows_per_bucket).cast("long")), "hot-keys")
    lacking = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    of = F.when(lacking, F.lit(buckets)).otherwise(F.coalesce(pieces, F.lit(1)))
    dealt = rows.join(hot, keys, "left").withColumn(piece, F.pmod(F.xxhash64(place), of).cast("int")).select(*fact.columns, piece)
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(pieces, F.lit(1)).cast("int") - 1))
    spread = dimension.join(hot, keys, "left").withColumn(piece, copies).select(*dimension.columns, piece)
    made = Pair(f"{name}_fact", f"{name}_dimension", tuple(keys), piece, buckets)
    for frame, table in ((dealt, made.fact), (spread, made.dimension)):
        # Dealt as buckets are, so that a bucket is one file.
        by_bucket = frame.repartition(buckets, *keys, piece)
        writer = by_bucket.write.mode("overwrite").option("path", new_folder(spark, table)).bucketBy(buckets, *keys, piece)
        writer.sortBy(*keys, piece).saveAsTable(table)
    return made
