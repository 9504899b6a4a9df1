"""Routing of arriving objects and proof-carrying CSV landing."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import logicaldate, sharedfs
from ..operators.gates import GateError, require_shape
from ..operators.integrity import Match, compare
from ..sources.tables import overwrite, read_raw_csv, read_table

JSON_TYPES = ("application/json", "application/x-ndjson")


def category(content_type: Column) -> Column:
    return (
        F.when(F.startswith(F.coalesce(content_type, F.lit("")), F.lit("image/")), "image")
        .when(content_type.isin(*JSON_TYPES), "semistructured")
        .otherwise("structured")
    )


def _stem(path: Column) -> Column:
    """File name without its last extension; a name that only starts with a dot keeps it."""
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"(?<=[^.])\.[^.]*$", "")


def route(manifest: DataFrame, date, destination: str = "") -> DataFrame:
    """Where each arriving object goes. ``manifest`` has path, content_type and landing_name.

    Folder placeholders drop out.
    """
    suffix, day = logicaldate.epoch_millis(date), logicaldate.compact_day(date)
    path = F.col("path")
    extension = F.regexp_extract(F.element_at(F.split(path, r"\."), -1), r"^([^?]*)", 1)
    routed = manifest.filter(~(F.endswith(path, F.lit("/")) & (F.coalesce("length", F.lit(0)) == 0))).withColumn(
        "category", category(F.col("content_type"))
    )
    name = F.when(F.col("category") == "structured", _stem(F.coalesce("landing_name", path))).otherwise(_stem(path))
    folder = (
        F.when(F.col("category") == "structured", "structured/raw/")
        .when(F.col("category") == "image", "unstructured/image/")
        .otherwise(f"semistructured/{day}/")
    )
    target = F.concat(F.lit(destination), folder, name, F.lit(f"_{suffix}."), extension)
    return routed.withColumn("destination", target).withColumn("logical_date", F.lit(logicaldate.iso(date)))


@dataclass(frozen=True)
class LandResult:
    table: str
    path: str
    written: bool
    match: Match


def land_csv(
    spark: SparkSession,
    csv_path: str,
    target: str,
    table: str,
    expected_rows: int | None = None,
    expected_columns: int | None = None,
    encoding: str | None = None,
    retire=None,
) -> LandResult:
    """CSV to table. The raw file is retired only once the table is proven equal to it.

    A table that already equals the CSV is left alone, so a rerun only retires.
    """
    raw = read_raw_csv(spark, csv_path, encoding)
    if sharedfs.exists(spark, target):
        before = compare(raw, read_table(spark, target))
        if before:
            if retire:
                retire(csv_path)
            return LandResult(table, target, False, before)
    require_shape(raw, table, expected_rows, expected_columns)
    overwrite(raw, target)
    proof = compare(raw, read_table(spark, target))
    if not proof:
        raise GateError(f"{table}: the written table differs from {csv_path}: {proof}")
    if retire:
        retire(csv_path)
    return LandResult(table, target, True, proof)
