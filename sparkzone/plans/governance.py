"""Catalogue, quality and lineage tables over published assets."""

from __future__ import annotations

import json
import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import logicaldate
from ..functions.labels import (
    ASSET_FIELDS,
    ASSET_VERSION,
    asset_columns,
    governance_columns,
    policy_columns,
)
from ..sources.tables import overwrite
from .purposes import DOCUMENTS, STRUCTURED, kind_of


@dataclass(frozen=True)
class Asset:
    """A published frame and what the catalogue says about it."""

    name: str
    df: DataFrame
    source_assets: str
    location: str = ""
    key: str | None = None
    structured: bool = True
    storage: str = "parquet"

    # Said here, or else looked up among the declared assets.
    own_domain: str | None = None
    own_usage: str | None = None

    @property
    def family(self):
        return STRUCTURED if self.structured else DOCUMENTS

    @property
    def domain(self) -> str:
        return self.own_domain or self.family.domain_of(self.name)

    @property
    def usage(self) -> str:
        return self.own_usage or self.family.use_of(self.name)


def with_metadata(df: DataFrame, name: str, source_assets: str, date) -> DataFrame:
    return df.withColumns(asset_columns(kind_of(name), source_assets, logicaldate.iso(date)))


def publish(spark: SparkSession, assets: Sequence[Asset], root: str, date, sort_keys: Mapping[str, Sequence[str]] = {}) -> list[Asset]:
    """Write every asset with its metadata columns and hand back assets that read the written tables.

    Reading back keeps the governance tables from recomputing whole marts.
    """
    published = []
    for asset in assets:
        path = f"{root.rstrip('/')}/{asset.name}"
        full = with_metadata(asset.df, asset.name, asset.source_assets, date)
        overwrite(full, path, sort_keys.get(asset.name, ()))
        published.append(
            replace(asset, df=spark.read.schema(full.schema).parquet(path), location=path)
        )
    return published


def _measures(asset: Asset) -> DataFrame:
    """Everything the quality checks need, in one aggregation per asset."""
    incomplete = reduce(or_, [F.coalesce(F.col(c).cast("string"), F.lit("")) == "" for c in ASSET_FIELDS])
    distinct = F.count_distinct(asset.key) if asset.key else F.lit(None).cast("long")
    return asset.df.agg(
        F.lit(asset.name).alias("asset_name"),
        F.count("*").alias("row_count"),
        F.count_if(incomplete).alias("incomplete_rows"),
        distinct.alias("distinct_keys"),
    )


def measure(assets: Sequence[Asset]) -> DataFrame:
    return reduce(DataFrame.unionAll, [_measures(a) for a in assets])


def _check(name: str, passed, observed, expected: str):
    return F.struct(
        F.lit(name).alias("check_name"),
        F.when(passed, "PASS").otherwise("FAIL").alias("status"),
        observed.cast("string").alias("observed_value"),
        F.lit(expected).alias("expected_value"),
    )


def quality(assets: Sequence[Asset], date, measures: DataFrame | None = None) -> DataFrame:
    """Non-fatal checks per asset: rows present, metadata complete, key unique."""
    measured = measure(assets) if measures is None else measures
    keys = F.col("distinct_keys")
    structured = assets[0].structured
    noun, key_check = ("rows", "dimension_key_unique") if structured else ("documents", "business_key_unique")
    checks = F.array(
        _check("non_empty", F.col("row_count") > 0, F.col("row_count"), "> 0"),
        _check("metadata_complete", F.col("incomplete_rows") == 0, F.col("incomplete_rows"), f"0 missing {noun}"),
        F.when(
            keys.isNotNull(),
            _check(key_check, keys == F.col("row_count"), F.concat_ws("/", keys.cast("string"), F.col("row_count").cast("string")), "distinct=count"),
        ),
    )
    return (
        measured.select("asset_name", F.explode(F.filter(checks, lambda c: c.isNotNull())).alias("c"))
        .select("asset_name", "c.*")
        .withColumns({"created_at": F.lit(logicaldate.iso(date)), "schema_version": F.lit(ASSET_VERSION)})
    )


def worst_status(checks: DataFrame) -> DataFrame:
    """PASS per asset unless a check says otherwise."""
    return checks.groupBy("asset_name").agg(
        F.coalesce(F.max(F.when(F.col("status") != "PASS", F.col("status"))), F.lit("PASS")).alias("quality_status")
    )


def _registry(assets: Sequence[Asset]) -> DataFrame:
    """One row per asset name; driver-side metadata, never data."""
    spark = assets[0].df.sparkSession
    rows = [(a.name, a.domain, kind_of(a.name), a.storage, a.location, a.source_assets, a.usage, a.structured) for a in assets]
    schema = (
        "asset_name STRING, domain STRING, asset_type STRING, storage_system STRING, location STRING, "
        "source_assets STRING, downstream_usage STRING, structured BOOLEAN"
    )
    return spark.createDataFrame(rows, schema)


def catalogue(assets: Sequence[Asset], date, measures: DataFrame | None = None) -> DataFrame:
    measured = measure(assets) if measures is None else measures
    status = worst_status(quality(assets, date, measured))
    joined = _registry(assets).join(measured.select("asset_name", "row_count"), "asset_name").join(status, "asset_name", "left")
    return joined.select(
        "asset_name",
        "domain",
        "asset_type",
        "storage_system",
        "location",
        F.lit("trusted-zone").alias("source_system"),
        "source_assets",
        "downstream_usage",
        F.lit("analytics").alias("owner"),
        F.coalesce("quality_status", F.lit("PASS")).alias("quality_status"),
        F.col("row_count").alias("record_count"),
        F.lit(logicaldate.iso(date)).alias("created_at"),
        F.lit(ASSET_VERSION).alias("schema_version"),
    )


def lineage(assets: Sequence[Asset], date) -> DataFrame:
    prefix = F.when(F.col("structured"), "structured_exploitation.").otherwise("semistructured_exploitation.")
    return _registry(assets).select(
        "asset_name",
        F.lit("trusted-zone").alias("upstream_zone"),
        F.col("source_assets").alias("upstream_assets"),
        F.concat(prefix, "asset_name").alias("transformation_name"),
        "downstream_usage",
        F.lit(logicaldate.iso(date)).alias("created_at"),
        F.lit(ASSET_VERSION).alias("schema_version"),
    )


def output_counts(assets: Sequence[Asset]) -> DataFrame:
    return measure(assets).select("asset_name", "row_count")


# --- trusted summary -------------------------------------------------------

SUMMARY_KINDS = {
    # kind: (asset type, source type, downstream usage)
    "table": ("structured_table", "structured", "exploitation_zone_structured_marts"),
    "collection": ("semi_structured_collection", "semi_structured", "exploitation_zone_semistructured_marts"),
    "images": ("unstructured_catalogue", "unstructured", "exploitation_zone_image_vectorization"),
}


def trusted_summary(datasets: Mapping[str, tuple[str, DataFrame]], date) -> DataFrame:
    """One row per trusted dataset: counts, schema, lineage, policy.

    ``datasets`` maps a name to (kind, frame). A dataset that cannot be analysed keeps its
    row, with the status ``unreadable`` and no counts, so that it hides neither itself nor the others.
    """
    rows = []
    for name, (kind, df) in sorted(datasets.items()):
        try:
            rows.append(_summary_row(name, kind, df, date))
        except Exception as error:  # noqa: BLE001
            warnings.warn(f"{name} can't be read: {error}", stacklevel=2)
            nothing = SparkSession.active().createDataFrame([("unreadable",)], "validation_status STRING")
            row = _summary_row(name, kind, nothing, date)
            unknown = {c: F.lit(None).cast(row.schema[c].dataType) for c in ("record_count", "column_or_key_count", "schema_json")}
            rows.append(row.withColumns(unknown))
    return reduce(DataFrame.unionAll, rows)


def _summary_row(name: str, kind: str, df: DataFrame, date) -> DataFrame:
    asset, source, usage = SUMMARY_KINDS[kind]
    stamp = logicaldate.iso(date)
    pick = lambda column, agg, default: F.coalesce(agg(column), F.lit(default)) if column in df.columns else F.lit(default)
    # Nothing about the run is written into the schema text but names and types.
    schema_json = json.dumps({f.name: f.dataType.simpleString() for f in df.schema.fields}, sort_keys=True)
    default_version = f"{name}_v1" if kind == "collection" else "trusted_v1"
    status = F.lit("rejected") if name.endswith("_rejected") else pick("validation_status", F.max, "valid")
    row = df.agg(
        F.count("*").alias("record_count"),
        pick("source_file_path", F.max, "").alias("source_path"),
        pick("schema_version", F.max, default_version).alias("schema_version"),
        status.alias("validation_status"),
        pick("ingestion_time", F.max, None).cast("string").alias("updated_at"),
    )
    full = row.select(
        F.lit("trusted").alias("zone"),
        F.lit(asset).alias("asset_type"),
        F.lit(source).alias("source_type"),
        F.lit(name).alias("dataset_name"),
        "record_count",
        F.lit(len(df.columns)).alias("column_or_key_count"),
        F.lit(schema_json).alias("schema_json"),
        "source_path",
        "schema_version",
        "validation_status",
        F.col("updated_at").alias("created_at"),
        "updated_at",
        F.lit("persistent_landing").alias("upstream_zone"),
        F.when(F.col("validation_status") == "rejected", "quality_review").otherwise(usage).alias("downstream_usage"),
        F.lit(stamp).alias("logical_date"),
    )
    governed = governance_columns("trusted-zone", stamp, F.col("source_path"))
    missing = {n: c for n, c in governed.items() if n not in full.columns}
    return full.withColumns({**missing, **policy_columns(F.col("dataset_name"), F.col("source_type"), F.col("validation_status"))})
