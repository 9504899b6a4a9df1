"""Run-time gates. Each raises ``GateError`` or returns what it measured."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType

from .. import sharedfs
from ..functions.labels import POLICY_FIELDS
from ..functions.text import has_unclean_chars
from .rows import duplicate_keys


class GateError(ValueError):
    """A data gate did not hold."""


def require_paths(spark: SparkSession, paths: Sequence[str]) -> None:
    """Sources exist, hold data and are no raw CSV folders."""
    if not paths:
        raise GateError("no source paths")
    for path in paths:
        parts = path.rstrip("/").split("/")
        if parts[-1] == "raw" or "/structured/raw/" in f"{path.rstrip('/')}/":
            raise GateError(f"raw CSV folder given as a structured source: {path}")
    missing = [p for p in paths if not sharedfs.holds_data(spark, p)]
    if missing:
        raise GateError(f"no data under {missing}")


def require_columns(df: DataFrame, required: Sequence[str], table: str) -> None:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise GateError(f"{table} lacks required columns {missing}")


def require_rows(df: DataFrame, table: str, expected: int | None = None) -> int:
    observed = df.count()
    if expected is not None and observed != expected:
        raise GateError(f"{table}: expected {expected} rows, observed {observed}")
    return observed


def require_shape(df: DataFrame, table: str, rows: int | None, columns: int | None) -> None:
    if columns is not None and len(df.columns) != columns:
        raise GateError(f"{table}: expected {columns} columns, observed {len(df.columns)}")
    if rows is not None:
        require_rows(df, table, rows)


def require_unique(df: DataFrame, table: str, keys: Sequence[str]) -> None:
    if keys:
        found = duplicate_keys(df, keys).limit(5).collect()
        if found:
            raise GateError(f"{table}: duplicate {list(keys)}, such as {[r.asDict() for r in found]}")


def require_not_empty(df: DataFrame, table: str) -> None:
    if df.isEmpty():
        raise GateError(f"{table} produced no records")


def unclean_condition(df: DataFrame) -> Column:
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return reduce(or_, [has_unclean_chars(F.col(c)) for c in texts], F.lit(False))


def require_clean_text(df: DataFrame, table: str) -> None:
    bad = df.filter(unclean_condition(df)).limit(5).collect()
    if bad:
        raise GateError(f"{table}: control characters left in {len(bad)} sampled rows")


def damaged_units(df: DataFrame, column: str = "unit") -> DataFrame:
    """Report of unit texts that still hold marks of a wrong decoding."""
    broken = F.contains(F.col(column), F.lit("Â")) | F.contains(F.col(column), F.lit("â"))
    return df.filter(broken).groupBy(column).agg(F.count("*").alias("n"))


# Columns no trusted image row may lack.
IMAGE_CRITICAL = (
    "id",
    "trusted_path",
    "raw_source_path",
    "source_file_path",
    "source_system",
    "ingestion_time",
    "validation_status",
    "schema_version",
    *POLICY_FIELDS,
)


def image_gate_counts(catalogue: DataFrame, trusted_root: str, size: int = 512) -> DataFrame:
    """One row with the four gate counts of a trusted image catalogue, in one pass."""
    missing = reduce(or_, [F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == "" for c in IMAGE_CRITICAL])
    wrong = (
        (F.col("current_width") != size)
        | (F.col("current_height") != size)
        | (F.col("current_image_mode") != "RGB")
        | (F.col("current_format") != "PNG")
        | ~F.startswith(F.col("trusted_path"), F.lit(trusted_root))
        | (F.col("validation_status") != "valid")
    )
    return catalogue.agg(
        F.count("*").alias("catalogue_rows"),
        F.count_if(missing).alias("missing_critical_fields"),
        F.count_if(wrong).alias("invalid_standardisation_rows"),
        F.count_if(F.col("file_size_bytes").isNull() | F.col("md5").isNull()).alias("missing_lineage_metrics"),
    )


def require_image_catalogue(catalogue: DataFrame, expected: int, trusted_root: str) -> dict[str, int]:
    counts = image_gate_counts(catalogue, trusted_root).first().asDict()
    problems = {k: v for k, v in counts.items() if k != "catalogue_rows" and v}
    if counts["catalogue_rows"] != expected or problems:
        raise GateError(f"image catalogue: expected {expected} clean rows, observed {counts}")
    return counts


def missing_objects(catalogue: DataFrame, files: DataFrame, column: str) -> DataFrame:
    """Catalogue rows whose object is not among the listed, non-empty files (``path``, ``length``)."""
    there = files.filter("length > 0").select(F.col("path").alias("__there")).distinct()
    return catalogue.join(there, F.col(column) == F.col("__there"), "left_anti")


def sampled_paths(catalogue: DataFrame, column: str, n: int = 20) -> list[str]:
    """``n`` paths at most, the same ones on every run: those with the least digests."""
    chosen = catalogue.filter(F.col(column).isNotNull()).select(column, F.md5(column).alias("__d")).distinct().orderBy("__d").limit(n)
    return [r[column] for r in chosen.collect()]


def require_objects(spark: SparkSession, paths: Sequence[str]) -> None:
    missing = [p for p in paths if not sharedfs.exists(spark, p)]
    if missing:
        raise GateError(f"objects do not exist: {missing}")
