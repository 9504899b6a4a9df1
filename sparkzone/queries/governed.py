"""Catalogue, quality, lineage and summary tables over published assets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import sharedfs
from ..functions import labels
from ..plans import governance as gov, star
from ..sources.tables import rows_per_partition, storage_metrics
from .documents import weather_documents
from .registry import DATE, query, table
from .structured import CLIMATE_SQL, TEMPERATURES_SQL, climate, temperatures
from .texts import tweets


def assets(spark: SparkSession, folder: str) -> list[gov.Asset]:
    """Dimensions and a fact of the climate domain, written with their metadata and read back."""
    years, areas = climate(spark, folder), temperatures(spark, folder)
    plain = [
        gov.Asset("dim_country", star.dim_country(years), "global_warming_dataset", key="country_key"),
        gov.Asset("dim_area", star.dim_area(areas), "temperature_change", key="area_key"),
        # Keyed by name here, which is not unique, so that one check fails.
        gov.Asset("dim_time_period", star.dim_time_period(areas), "temperature_change", key="period_type"),
        gov.Asset("fact_climate_country_year", star.fact_climate_country_year(years), "global_warming_dataset"),
    ]
    return gov.publish(spark, plain, sharedfs.new_folder(spark, "assets"), DATE)


ASSETS_SQL = f"""
with {CLIMATE_SQL}, {TEMPERATURES_SQL}, periods as (select distinct months_code, months, case when contains(months, '-') then 'season' when contains(months, 'year') then 'annual' else 'month' end as kind from temps),
m as (
  select 'dim_country' as asset_name, count(*) as n, count(*) as d, 'global_warming_dataset' as src from (select distinct country from climate)
  union all select 'dim_area', count(*), count(*), 'temperature_change' from (select distinct area from temps)
  union all select 'dim_time_period', count(*), count(distinct kind), 'temperature_change' from periods
  union all select 'fact_climate_country_year', count(*), null, 'global_warming_dataset' from climate)
"""


@query(
    "asset_quality",
    ASSETS_SQL
    + """select asset_name, 'non_empty' as check_name, case when n > 0 then 'PASS' else 'FAIL' end as status, n::varchar as observed_value, '> 0' as expected_value, '2026-05-24T10:00:00+00:00' as created_at, 'exploitation_v1' as schema_version from m
    union all select asset_name, 'metadata_complete', 'PASS', '0', '0 missing rows', '2026-05-24T10:00:00+00:00', 'exploitation_v1' from m
    union all select asset_name, 'dimension_key_unique', case when n = d then 'PASS' else 'FAIL' end, d || '/' || n, 'distinct=count', '2026-05-24T10:00:00+00:00', 'exploitation_v1' from m where d is not null""",
)
def asset_quality(spark, folder):
    return gov.quality(assets(spark, folder), DATE)


@query(
    "asset_catalogue",
    ASSETS_SQL
    + """select asset_name, 'climate_environment' as domain, case when asset_name like 'dim%' then 'dimension' else 'fact' end as asset_type, 'parquet' as storage_system, 'trusted-zone' as source_system, src as source_assets,
    case when asset_name like 'dim%' then 'analytical modelling support' else 'analyst SQL' end as downstream_usage, 'analytics' as owner, case when n = d or d is null then 'PASS' else 'FAIL' end as quality_status,
    n as record_count, '2026-05-24T10:00:00+00:00' as created_at, 'exploitation_v1' as schema_version from m""",
)
def asset_catalogue(spark, folder):
    return gov.catalogue(assets(spark, folder), DATE).drop("location")


@query(
    "asset_lineage",
    ASSETS_SQL
    + """select asset_name, 'trusted-zone' as upstream_zone, src as upstream_assets, 'structured_exploitation.' || asset_name as transformation_name,
    case when asset_name like 'dim%' then 'analytical modelling support' else 'analyst SQL' end as downstream_usage, '2026-05-24T10:00:00+00:00' as created_at, 'exploitation_v1' as schema_version from m""",
)
def asset_lineage(spark, folder):
    return gov.lineage(assets(spark, folder), DATE)


@query("asset_counts", ASSETS_SQL + "select asset_name, n as row_count from m")
def asset_counts(spark, folder):
    return gov.output_counts(assets(spark, folder))


@query(
    "trusted_summary",
    """select 'natural_disaster_tweets' as dataset_name, 'structured_table' as asset_type, 'structured' as source_type, count(*) as record_count, 'natural_disaster_tweets_v1' as schema_version, 'valid' as validation_status,
      'public_text_analytics' as data_classification, 'possible_user_mentions' as pii_flag, 'exploitation_zone_structured_marts' as downstream_usage, cast(10 as int) as column_or_key_count, 'documents' as source_path from documents
    union all select 'weather_barcelona', 'semi_structured_collection', 'semi_structured', count(*), 'trusted_v1', 'valid', 'public_environmental_observation', 'no_direct_pii', 'exploitation_zone_semistructured_marts', 8,
      max('events/' || event_id) from events where value < 200
    union all select 'weather_barcelona_rejected', 'semi_structured_collection', 'semi_structured', count(*), 'weather_barcelona_v1', 'rejected', 'quality_review', 'review_required', 'quality_review', 13,
      max('events/' || event_id) from events where value >= 200""",
)
def trusted_summary(spark, folder):
    docs = weather_documents(spark, folder)
    datasets = {
        "natural_disaster_tweets": ("table", tweets(spark, folder)),
        "weather_barcelona": ("collection", docs.valid),
        "weather_barcelona_rejected": ("collection", docs.rejected),
    }
    return gov.trusted_summary(datasets, DATE).select(
        "dataset_name", "asset_type", "source_type", "record_count", "schema_version", "validation_status", "data_classification", "pii_flag",
        "downstream_usage", "column_or_key_count", "source_path",
    )


@query(
    "policy_labels",
    """select doc_id, case when quality = 0 then 'quality_review' when toxic = 1 then 'public_text_analytics' when doc_id < 100 then 'public_environmental_observation' when doc_id < 500 then 'public_image_metadata' else 'public_environmental_analytics' end as data_classification,
    case when quality = 0 then 'review_required' when toxic = 1 then 'possible_user_mentions' else 'no_direct_pii' end as pii_flag, 'data_engineering_team' as owner from labels""",
)
def policy_labels(spark, folder):
    kind = F.when(F.col("doc_id") < 100, "semi_structured").when(F.col("doc_id") < 500, "unstructured").otherwise("structured")
    rows = table(spark, folder, "labels").select(
        "doc_id",
        F.when(F.col("quality") == 0, "Rejected").otherwise("valid").alias("status"),
        F.when(F.col("toxic") == 1, "Tweets").otherwise("other").alias("name"),
        kind.alias("kind"),
    )
    return rows.withColumns(labels.policy_columns(F.col("name"), F.col("kind"), F.col("status"))).select("doc_id", "data_classification", "pii_flag", "owner")


@query("partition_rows", "select count(*) as total from lineitem")
def partition_rows(spark, folder):
    # Rows per task depend on how files are split; their sum does not.
    return rows_per_partition(table(spark, folder, "lineitem")).agg(F.sum("n").alias("total"))


@query("storage_metrics", "select cast(1 as bigint) as files, count(*) as rows from orders")
def storage(spark, folder):
    return storage_metrics(table(spark, folder, "orders")).select("files", "rows")


def with_metadata_sample(spark: SparkSession, folder: str) -> DataFrame:
    return gov.with_metadata(table(spark, folder, "labels"), "mart_labels", "labels", DATE)


@query(
    "asset_metadata",
    """select *, 'trusted-zone' as source_system, 'labels' as source_assets, '2026-05-24T10:00:00+00:00' as created_at, 'exploitation_v1' as schema_version, 'mart' as exploitation_asset_type from labels""",
)
def asset_metadata(spark, folder):
    return with_metadata_sample(spark, folder)
