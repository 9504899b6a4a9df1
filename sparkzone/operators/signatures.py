"""Signatures of row multisets that add up, kept per file so that a change reads only what changed.

A row's fingerprint gives two numbers of 60 bits; a signature is the count of rows and the sums
of both numbers over all of them. Sums, unlike xor, count copies: {a, a} and {b, b} differ. The
signature of a union is the sum of its parts', whatever their order, so a table's follows from
those of its files or partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.keys import fingerprint
from ..sources import versions

SUMS = ("rows", "sum_high", "sum_low")
FILE = ("file_path", "file_size", "changed")


def _number(digest: Column, at: int) -> Column:
    """15 hex digits of the digest as a number."""
    return F.conv(F.substring(digest, at, 15), 16, 10).cast("decimal(38,0)")


def signature(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """rows, sum_high and sum_low of the given columns; per group if ``by`` is given."""
    hashed = df.select(*by, fingerprint(*cols).alias("__digest"))
    zero = F.lit(0).cast("decimal(38,0)")
    total = lambda at: F.coalesce(F.sum(_number(F.col("__digest"), at)), zero).cast("decimal(38,0)")
    return hashed.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), total(1).alias("sum_high"), total(17).alias("sum_low"))


def merged(parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Signatures of parts that have no row in common, added up."""
    zero = F.lit(0)
    add = lambda c: F.coalesce(F.sum(c), zero).cast("bigint" if c == "rows" else "decimal(38,0)").alias(c)
    return parts.groupBy(*by).agg(*map(add, SUMS))


def listed(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """file_path, file_size and changed of the files below a folder, as a scan of them names them; none is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    meta = F.col("_metadata")
    return files.select(meta["file_path"].alias("file_path"), meta["file_size"].alias("file_size"), meta["file_modification_time"].alias("changed"))


def of_files(table: DataFrame, files: DataFrame) -> DataFrame:
    """The rows of a file-backed table that are in some of its files, with ``file_path``.

    Files older than all of these are pruned by their time before they are opened; which of the
    others count is decided by a join, so no list of paths reaches the driver.
    """
    oldest = files.agg(F.min("changed")).first()[0]
    pruned = table.where(F.col("_metadata.file_modification_time") >= F.lit(oldest)) if oldest is not None else table.limit(0)
    rows = pruned.select("*", F.col("_metadata.file_path").alias("file_path")) if oldest is not None else pruned.withColumn("file_path", F.lit(None).cast("string"))
    return rows.join(files.select("file_path"), "file_path", "left_semi")


def refresh(spark: SparkSession, path: str, state: str, cols: Sequence[str]) -> DataFrame:
    """Bring the stored signatures of a Parquet table's files up to date, reading only new and changed files.

    One row per file: ``FILE``, ``SUMS`` and ``read`` (whether this call read it). Kept in
    versions, so a call that fails changes nothing.
    """
    files = listed(spark, path)
    if versions.latest(spark, state) < 0:
        known = files.limit(0).select(*FILE, F.lit(0).cast("bigint").alias("rows"), *[F.lit(0).cast("decimal(38,0)").alias(c) for c in SUMS[1:]])
    else:
        known = versions.read(spark, state).select(*FILE, *SUMS)
    kept = known.join(files, list(FILE), "left_semi").withColumn("read", F.lit(False))
    fresh = files.join(known, list(FILE), "left_anti")
    signed = signature(of_files(spark.read.parquet(path), fresh), cols, by=["file_path"])
    # A file without rows has a signature too, else it would be new for ever.
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint" if c == "rows" else "decimal(38,0)").alias(c)
    added = fresh.join(signed, "file_path", "left").select(*FILE, *map(zero, SUMS), F.lit(True).alias("read"))
    versions.publish(kept.unionByName(added), state)
    return versions.read(spark, state)
