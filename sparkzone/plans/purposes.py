"""What the catalogue says about each published asset: its domain, kind and use."""

from __future__ import annotations

from dataclasses import dataclass

KINDS = {"dim": "dimension", "bridge": "bridge", "fact": "fact", "mart": "mart"}


@dataclass(frozen=True)
class Family:
    """Assets built from one sort of source: names by domain, and the use of each kind."""

    domains: dict[str, str]
    uses: dict[str, str]
    other_use: str
    other_domain: str
    own_uses: tuple[tuple[str, str], ...] = ()

    def domain_of(self, asset: str) -> str:
        return next((d for d, names in self.domains.items() if asset in names.split()), self.other_domain)

    def use_of(self, asset: str) -> str:
        return dict(self.own_uses).get(asset) or self.uses.get(kind_of(asset), self.other_use)


# Names, domains and uses as published.
STRUCTURED = Family(
    domains={
        "climate_environment": "dim_year dim_country dim_area dim_time_period fact_climate_country_year "
        "fact_temperature_area_period mart_climate_country_year mart_temperature_trends",
        "vehicle_emissions": "dim_vehicle fact_vehicle_emission mart_vehicle_emission_summary",
        "disaster_response": "dim_disaster_type fact_tweet_features bridge_tweet_hashtag bridge_tweet_emoji "
        "mart_disaster_tweet_features mart_disaster_type_profile",
    },
    uses={
        "dimension": "analytical modelling support",
        "bridge": "analytical modelling support",
        "fact": "analyst SQL",
        "mart": "BI dashboard and analyst SQL",
    },
    other_use="analyst SQL",
    other_domain="shared_analytics",
    own_uses=(("fact_tweet_features", "natural disaster classifier"),),
)
DOCUMENTS = Family(
    domains={
        "barcelona_air_quality": "dim_station dim_sensor bridge_station_sensor bridge_station_instrument "
        "bridge_station_license fact_station_availability mart_station_sensor_catalog",
        "barcelona_weather": "dim_weather_code fact_weather_observation mart_weather_timeseries mart_weather_summary",
        "barcelona_environment": "dim_country dim_provider dim_owner dim_instrument dim_license mart_environment_overview",
    },
    uses={
        "dimension": "semi-structured analytical modelling support",
        "bridge": "semi-structured analytical modelling support",
        "fact": "semi-structured analyst queries",
        "mart": "environment dashboard and document queries",
    },
    other_use="semi-structured analyst queries",
    other_domain="barcelona_environment",
)


def kind_of(asset: str) -> str:
    """The kind that the first part of a name stands for; assets outside the star are metrics or embeddings."""
    words = asset.split("_")
    if words[0] in KINDS:
        return KINDS[words[0]]
    return "embedding" if {"embedding", "embeddings", "vector", "vectors"} & set(words) else "metric"
