"""Cleaning rules as data: one value per table, interpreted by ``plans.structured``."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from ..functions.labels import TRUSTED_VERSION


@dataclass(frozen=True)
class TableRules:
    table: str
    schema_version: str = TRUSTED_VERSION
    required: tuple[str, ...] = ()
    business_keys: tuple[str, ...] = ()
    unique_keys: tuple[str, ...] = ()
    expected: tuple[str, ...] = ()
    integers: tuple[str, ...] = ()
    non_negative: tuple[str, ...] = ()
    year_range: tuple[int, int] | None = None
    arrays: tuple[str, ...] = ("hashtags", "emojis")
    text_ids: tuple[str, ...] = ()
    unit_columns: tuple[str, ...] = ()
    month_columns: tuple[str, ...] = ()
    sort_keys: tuple[str, ...] = field(default=())
    # Known business tables drop only whole-row copies; others keep one row per sort key.
    whole_row_duplicates: bool = True

    def sort_keys_for(self, columns: Sequence[str]) -> list[str]:
        present = [k for k in self.sort_keys if k in columns]
        return present or (["id"] if "id" in columns else list(columns[:1]))

    def missing_expected(self, columns: Sequence[str]) -> list[str]:
        return [c for c in self.expected if c not in columns]


# The rules of the known tables.
VEHICLES = TableRules(
    table="co2_emission_by_vehicles",
    schema_version="co2_emission_by_vehicles_v1",
    required=("make", "model", "vehicle_class"),
    business_keys=("make", "model", "vehicle_class", "transmission", "fuel_type"),
    expected=(
        "make",
        "model",
        "vehicle_class",
        "engine_sizel",
        "cylinders",
        "transmission",
        "fuel_type",
        "fuel_consumption_city_l_100_km",
        "fuel_consumption_hwy_l_100_km",
        "fuel_consumption_comb_l_100_km",
        "fuel_consumption_comb_mpg",
        "co2_emissionsg_km",
    ),
    integers=("cylinders", "fuel_consumption_comb_mpg", "co2_emissionsg_km"),
    non_negative=(
        "engine_sizel",
        "cylinders",
        "fuel_consumption_city_l_100_km",
        "fuel_consumption_hwy_l_100_km",
        "fuel_consumption_comb_l_100_km",
        "fuel_consumption_comb_mpg",
        "co2_emissionsg_km",
    ),
    sort_keys=("make", "model", "vehicle_class"),
)
CLIMATE = TableRules(
    table="global_warming_dataset",
    schema_version="global_warming_dataset_v1",
    required=("country", "year"),
    business_keys=("country", "year"),
    expected=("country", "year", "temperature_anomaly", "co2_emissions", "population"),
    integers=("year", "extreme_weather_events"),
    non_negative=("co2_emissions", "population", "forest_area", "gdp", "methane_emissions"),
    year_range=(1900, 2100),
    sort_keys=("country", "year"),
)
TWEETS = TableRules(
    table="natural_disaster_tweets",
    schema_version="natural_disaster_tweets_v1",
    required=("id",),
    business_keys=("id",),
    unique_keys=("id",),
    expected=("id", "text", "label", "hashtags", "emojis"),
    text_ids=("id",),
    sort_keys=("id",),
)
TEMPERATURES = TableRules(
    table="temperature_change",
    schema_version="temperature_change_v1",
    required=("area", "months", "year"),
    business_keys=("area", "months", "year"),
    expected=(
        "domain_code",
        "domain",
        "area_code_m49",
        "area",
        "element_code",
        "element",
        "months_code",
        "months",
        "year_code",
        "year",
        "unit",
        "value",
        "flag",
        "flag_description",
    ),
    integers=("year", "year_code"),
    year_range=(1961, 2100),
    unit_columns=("unit",),
    month_columns=("months",),
    sort_keys=("area", "months", "year"),
)
KNOWN_TABLES = (VEHICLES, CLIMATE, TWEETS, TEMPERATURES)


def rules_for(table: str) -> TableRules:
    """The rules whose table name occurs in ``table``; plain ones for an unknown table."""
    known = next((r for r in KNOWN_TABLES if r.table in table), None)
    return known or TableRules(table=table, whole_row_duplicates=False)
