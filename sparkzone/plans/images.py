"""Cleaning, standardising and cataloguing of image files."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .. import logicaldate
from ..functions.labels import governance_columns, policy_columns
from ..functions.text import allowed_image
from ..operators.rows import keep_first, later_copies
from ..sharedfs import cut_lineage

METADATA = (
    "label STRING, url STRING, file_size_bytes BIGINT, content_type STRING, width INT, height INT, "
    "aspect_ratio DOUBLE, image_mode STRING, is_corrupted BOOLEAN, md5 STRING"
)
DONE = ("DIRECT_COPY", "TRANSFORMED")
REJECTED_VERSION = "unstructured_image_v1"


@dataclass(frozen=True)
class Images:
    """Together the three outputs hold every image row of the catalogue."""

    valid: DataFrame
    rejected: DataFrame
    duplicates: DataFrame


def rejection_reason() -> Column:
    """Why a catalogue row is no valid image, the first reason that applies; null for a valid one."""
    size, corrupted = F.col("meta.file_size_bytes"), F.col("meta.is_corrupted")
    return (
        F.when(F.col("file_id").isNull(), "missing_file_id")
        .when(F.col("file_path").isNull(), "missing_file_path")
        .when(size.isNull() | (size <= 0), "empty_or_missing_source_file")
        .when(corrupted, "corrupted_image")
        .when(F.col("meta.md5").isNull(), "missing_md5")
        .when(~allowed_image(F.col("file_path")), "unsupported_extension")
        .when(corrupted.isNull(), "unknown_corruption_state")
    )


def clean_images(catalogue: DataFrame, date) -> Images:
    """Valid images, one per content digest; rejected rows; and the other copies of a digest."""
    parsed = (
        catalogue.filter("file_type = 'Image'")
        .withColumn("meta", F.from_json("metadata_blob", METADATA))
        .withColumn("md5", F.col("meta.md5"))
        .withColumn("reason", rejection_reason())
    )
    good = parsed.filter("reason is null").drop("reason")
    order = ["file_path", "file_id"]
    return Images(
        valid=keep_first(good, ["md5"], order),
        rejected=rejected_rows(parsed.filter("reason is not null"), date),
        duplicates=later_copies(good.select("file_id", "file_path", "md5"), ["md5"], order),
    )


def rejected_rows(rows: DataFrame, date, id_column: str = "file_id", path_column: str = "file_path") -> DataFrame:
    stamp = logicaldate.iso(date)
    governed = governance_columns("landing-zone", stamp, "landing image catalogue", "rejected", REJECTED_VERSION)
    return rows.select(
        F.col(id_column).alias("id"),
        F.col(path_column).alias("source_file_path"),
        "reason",
        F.lit("trusted").alias("zone"),
        F.lit("unstructured_file").alias("asset_type"),
        F.lit("image").alias("dataset_name"),
        F.lit(stamp).alias("rejected_at"),
        *[c.alias(n) for n, c in governed.items() if n != "source_file_path"],
    )


def work_list(valid: DataFrame) -> DataFrame:
    return valid.select(
        F.col("file_id").alias("id"), "file_path", "meta.image_mode", "meta.width", "meta.height", "meta.file_size_bytes"
    )


def trusted_path(path: Column, trusted_root: str) -> Column:
    stem = F.regexp_replace(F.regexp_replace(path, r"\.[^./]*$", ".png"), "persistent-landing/", "")
    return F.concat(F.lit(trusted_root.rstrip("/") + "/"), F.regexp_replace(stem, r"^([a-z0-9]+:/+[^/]*)?/*", ""))


# (source path, target path) copied or transformed; raising marks the row as failed.
Codec = Callable[[str, str], None]

RESULT = "id STRING, trusted_path STRING, status STRING"


def standardize_images(work: DataFrame, trusted_root: str, copy: Codec, transform: Codec, size: int = 512) -> DataFrame:
    """Copy images already in standard form and transform the others, on the executors.

    Which of the two applies is decided by column expressions; Python only moves
    bytes. A failing image fails its row, not its batch. The outcome is written once, so that
    whatever is derived from it sees the same one and no image is handled again.
    """
    extension = F.lower(F.regexp_extract("file_path", r"\.([^./]*)$", 1))
    standard = (F.col("width") == size) & (F.col("height") == size) & (F.col("image_mode") == "RGB") & (extension == "png")
    routed = work.select(
        "id",
        "file_path",
        trusted_path(F.col("file_path"), trusted_root).alias("trusted_path"),
        F.coalesce(standard, F.lit(False)).alias("standard"),
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                try:
                    (copy if row.standard else transform)(row.file_path, row.trusted_path)
                    rows.append((row.id, row.trusted_path, DONE[0] if row.standard else DONE[1]))
                except Exception as error:  # noqa: BLE001 - one bad image must not stop the job
                    rows.append((row.id, None, f"FAILED: {error}"))
            yield pd.DataFrame(rows, columns=["id", "trusted_path", "status"])

    return cut_lineage(routed.mapInPandas(run, RESULT), "images")


def split_results(results: DataFrame, valid: DataFrame, date) -> tuple[DataFrame, DataFrame]:
    """(trusted catalogue, rejected rows) from the outcome per image."""
    stamp = logicaldate.iso(date)
    sources = valid.select(
        F.col("file_id").alias("id"),
        F.col("file_path").alias("raw_source_path"),
        F.col("meta.label").alias("label"),
        F.col("meta.url").alias("source_url"),
        F.col("meta.file_size_bytes").alias("file_size_bytes"),
        F.col("meta.md5").alias("md5"),
    )
    succeeded = F.col("status").isin(*DONE)
    trusted = results.filter(succeeded).join(sources, "id").withColumns(
        {
            "current_width": F.lit(512),
            "current_height": F.lit(512),
            "current_image_mode": F.lit("RGB"),
            "current_format": F.lit("PNG"),
            "processed_at": F.lit(stamp),
            **governance_columns("landing-zone", stamp, F.col("raw_source_path")),
            **policy_columns(F.lit("image"), F.lit("unstructured"), F.lit("valid")),
        }
    )
    failed = results.filter(~succeeded).join(sources.select("id", "raw_source_path"), "id", "left")
    return trusted, rejected_rows(failed.withColumn("reason", F.col("status")), date, "id", "raw_source_path")


def status_counts(results: DataFrame) -> DataFrame:
    """Outcomes per task, for the processing report."""
    return results.groupBy(F.spark_partition_id().alias("batch_id"), "status").agg(F.count("*").alias("n")).orderBy("batch_id", "status")
