"""Dimensions, facts, bridges and marts of the structured domain."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import features, numbers, text
from ..functions.keys import surrogate_key
from ..functions.names import pick_column
from ..operators.joins import star_join
from ..operators.ordered import partition_average, rank_in_group, rolling_average
from ..operators.rows import explode_bridge


# Given a lookup from logical name to column, the expression of one output column.
FieldRule = Callable[[Callable[[str], Column]], Column]


@dataclass(frozen=True)
class DimSource:
    """One source of a dimension: logical names, where they are found, and what to select.

    ``fields`` maps an output column to a function of the logical columns.
    """

    df: DataFrame
    fields: Mapping[str, FieldRule]
    columns: Mapping[str, Sequence[str]] = field(default_factory=dict)
    not_blank: str | None = None

    def column(self, logical: str) -> Column:
        return F.col(pick_column(self.df.columns, self.columns.get(logical, (logical,))))

    def select(self) -> DataFrame:
        df = self.df.filter(self.column(self.not_blank) != "") if self.not_blank else self.df
        return df.select(*[rule(self.column).alias(out) for out, rule in self.fields.items()])


def build_dimension(sources: Sequence[DimSource]) -> DataFrame:
    """Distinct union of all sources; copies collapse before the exchange."""
    return reduce(DataFrame.unionByName, [s.select() for s in sources]).distinct()


# Column names that differ between producers.
VEHICLE_COLUMNS = {
    "engine_size_l": ("engine_size_l", "engine_sizel"),
    "co2_emissions_g_km": ("co2_emissions_g_km", "co2_emissionsg_km"),
}
VEHICLE_KEY = ("make", "model", "vehicle_class", "transmission", "fuel_type", "engine_size_l", "cylinders")


def _same(name: str):
    return lambda col: col(name)


def dim_year(*tables: DataFrame) -> DataFrame:
    year = lambda col: col("year").try_cast("int")
    rules = {"year_key": year, "year": year, "decade": lambda col: numbers.decade(year(col))}
    return build_dimension([DimSource(t, rules) for t in tables])


def keyed_dimension(df: DataFrame, key: str, name: str, source: str, extra: Sequence[str] = ()) -> DataFrame:
    """Dimension of one named entity, keyed by its name; blank names do not enter."""
    rules = {key: lambda col: surrogate_key(col(name)), **{e: _same(e) for e in extra}, name: _same(name)}
    return build_dimension([DimSource(df, rules, {name: (source,)}, not_blank=name)])


def dim_country(climate: DataFrame) -> DataFrame:
    return keyed_dimension(climate, "country_key", "country_name", "country")


def dim_area(temperatures: DataFrame) -> DataFrame:
    return keyed_dimension(temperatures, "area_key", "area_name", "area", ["area_code_m49"])


def dim_disaster_type(tweets: DataFrame) -> DataFrame:
    return keyed_dimension(tweets, "disaster_type_key", "disaster_type", "disaster_type")


def dim_time_period(temperatures: DataFrame) -> DataFrame:
    rules = {
        "period_key": _same("period_key"),
        "period_name": _same("period_name"),
        "period_type": lambda col: text.period_type(col("period_name")),
    }
    columns = {"period_key": ("months_code",), "period_name": ("months",)}
    return build_dimension([DimSource(temperatures, rules, columns, not_blank="period_name")])


def dim_vehicle(vehicles: DataFrame) -> DataFrame:
    rules = {"vehicle_key": lambda col: surrogate_key(*[col(c) for c in VEHICLE_KEY]), **{c: _same(c) for c in VEHICLE_KEY}}
    return build_dimension([DimSource(vehicles, rules, VEHICLE_COLUMNS)])


# Measures of the climate fact, in its column order.
CLIMATE_MEASURES = (
    "temperature_anomaly",
    "average_temperature",
    "co2_emissions",
    "population",
    "forest_area",
    "gdp",
    "renewable_energy_usage",
    "methane_emissions",
    "sea_level_rise",
    "arctic_ice_extent",
    "urbanization",
    "deforestation_rate",
    "extreme_weather_events",
    "average_rainfall",
    "solar_energy_potential",
    "waste_management",
    "per_capita_emissions",
    "industrial_activity",
    "air_pollution_index",
    "biodiversity_index",
    "ocean_acidification",
    "fossil_fuel_usage",
    "energy_consumption_per_capita",
    "policy_score",
)
TEMPERATURE_COLUMNS = ("domain_code", "domain", "element_code", "element", "year_code", "unit", "value", "flag", "flag_description")
VEHICLE_MEASURES = (
    "fuel_consumption_city_l_100_km",
    "fuel_consumption_hwy_l_100_km",
    "fuel_consumption_comb_l_100_km",
    "fuel_consumption_comb_mpg",
    "co2_emissions_g_km",
)


def fact_climate_country_year(climate: DataFrame) -> DataFrame:
    renamed = {"per_capita_emissions": "source_per_capita_emissions"}
    return climate.select(
        surrogate_key("country").alias("country_key"),
        F.col("year").try_cast("int").alias("year_key"),
        *[F.col(m).alias(renamed.get(m, m)) for m in CLIMATE_MEASURES],
    )


def fact_temperature_area_period(temperatures: DataFrame) -> DataFrame:
    renamed = {"value": "temperature_change_value"}
    return temperatures.select(
        surrogate_key("area").alias("area_key"),
        F.col("year").try_cast("int").alias("year_key"),
        F.col("months_code").alias("period_key"),
        *[F.col(c).alias(renamed.get(c, c)) for c in TEMPERATURE_COLUMNS],
    )


def fact_vehicle_emission(vehicles: DataFrame) -> DataFrame:
    source = DimSource(vehicles, {}, VEHICLE_COLUMNS)
    return vehicles.select(
        surrogate_key(*[source.column(c) for c in VEHICLE_KEY]).alias("vehicle_key"),
        *[source.column(m).alias(m) for m in VEHICLE_MEASURES],
    )


def text_features(df: DataFrame, key: str, body: str, label: str, tags: str | None = None, emojis: str | None = None) -> DataFrame:
    """Sixteen features per text, all inside one generated stage."""
    count_of = lambda c: features.array_count(F.col(c)) if c else F.lit(0)
    base = df.select(
        F.col(key).alias("tweet_id"),
        surrogate_key(label).alias("disaster_type_key"),
        F.col(label).alias("disaster_type"),
        count_of(emojis).alias("emoji_count"),
        F.coalesce(F.col(body), F.lit("")).alias("tweet_text"),
        count_of(tags).alias("hashtag_count"),
    ).withColumn("__low", F.lower("tweet_text"))
    words, low = F.col("tweet_text"), F.col("__low")
    scored = base.select(
        "*",
        F.char_length(words).alias("text_length"),
        features.word_count(words).alias("word_count"),
        features.occurrences(words, features.MENTION).alias("mention_count"),
        features.occurrences(words, features.LINK).alias("url_count"),
        features.occurrences(words, "!").alias("exclamation_count"),
        features.occurrences(words, r"\?").alias("question_count"),
        F.contains(low, F.lit("youtube")).cast("int").alias("contains_youtube"),
        features.alert_flag(low).alias("contains_alert_keyword"),
        features.sentiment_score(low).alias("simple_sentiment_score"),
    )
    return scored.select(*TEXT_FEATURES[:-1], features.sentiment_label(F.col("simple_sentiment_score")).alias(TEXT_FEATURES[-1]))


# Columns of the text fact, in order.
TEXT_FEATURES = (
    "tweet_id",
    "disaster_type_key",
    "disaster_type",
    "emoji_count",
    "tweet_text",
    "text_length",
    "word_count",
    "hashtag_count",
    "mention_count",
    "url_count",
    "exclamation_count",
    "question_count",
    "contains_youtube",
    "contains_alert_keyword",
    "simple_sentiment_score",
    "simple_sentiment_label",
)


def bridge_hashtag(tweets: DataFrame, key: str = "id", tags: str = "hashtags") -> DataFrame:
    return explode_bridge(tweets, key, tags, "hashtag", text.strip_hash).withColumnRenamed(key, "tweet_id")


def bridge_emoji(tweets: DataFrame, key: str = "id", emojis: str = "emojis") -> DataFrame:
    return explode_bridge(tweets, key, emojis, "emoji").withColumnRenamed(key, "tweet_id")


def mart_climate_country_year(fact: DataFrame, countries: DataFrame, years: DataFrame) -> DataFrame:
    joined = star_join(fact, {"country_key": countries, "year_key": years})
    return joined.select(
        F.col("country_name").alias("country"),
        "year",
        "decade",
        "temperature_anomaly",
        "average_temperature",
        "co2_emissions",
        "population",
        numbers.ratio(F.col("co2_emissions"), F.col("population")).alias("co2_per_capita"),
        "gdp",
        numbers.ratio(F.col("gdp"), F.col("population")).alias("gdp_per_capita"),
        numbers.ratio(F.col("co2_emissions"), F.col("gdp")).alias("emission_intensity"),
        "renewable_energy_usage",
        "forest_area",
        "deforestation_rate",
        "extreme_weather_events",
        "policy_score",
        "air_pollution_index",
        "biodiversity_index",
        "fossil_fuel_usage",
    )


def mart_temperature_trends(
    fact: DataFrame, areas: DataFrame, years: DataFrame, periods: DataFrame, tie: Column | None = None, ranges: int | None = None
) -> DataFrame:
    joined = star_join(fact, {"area_key": areas, "year_key": years, "period_key": periods})
    extra = [] if tie is None else [tie.alias("__order")]
    trends = joined.select(
        F.col("area_name").alias("area"), "year", F.col("period_name").alias("period"), "period_type", "temperature_change_value", *extra
    )
    annual = partition_average(trends, ["area", "year"], "temperature_change_value", "annual_avg_temperature_change")
    rolled = rolling_average(
        annual,
        ["area", "period"],
        "year",
        "temperature_change_value",
        "rolling_5y_period_avg",
        rows=5,
        tie=F.col("__order") if extra else None,
        ranges=ranges,
    )
    return rolled.drop("__order")


def mart_vehicle_emission_summary(fact: DataFrame, vehicles: DataFrame) -> DataFrame:
    """Averages per kind of vehicle, ranked within its class.

    Facts are summed per vehicle key before the join, so one row per vehicle meets its dimension.
    """
    measures = ("co2_emissions_g_km", "fuel_consumption_comb_l_100_km", "fuel_consumption_comb_mpg")
    sums = fact.groupBy("vehicle_key").agg(
        F.count("*").alias("n"),
        *[F.sum(m).alias(f"sum_{m}") for m in measures],
        *[F.count(m).alias(f"count_{m}") for m in measures],
    )
    joined = star_join(sums, {"vehicle_key": vehicles})
    summary = joined.groupBy("make", "model", "vehicle_class", "fuel_type").agg(
        F.sum("n").alias("vehicle_record_count"),
        *[F.try_divide(F.sum(f"sum_{m}"), F.sum(f"count_{m}")).alias(f"avg_{m}") for m in measures],
    )
    return rank_in_group(summary, ["vehicle_class"], "avg_co2_emissions_g_km", "emission_rank_in_class")


def mart_disaster_tweet_features(fact: DataFrame) -> DataFrame:
    return fact.drop("disaster_type_key", "tweet_text")


def mart_disaster_type_profile(fact: DataFrame) -> DataFrame:
    averages = {
        "avg_text_length": "text_length",
        "avg_word_count": "word_count",
        "avg_hashtag_count": "hashtag_count",
        "avg_mention_count": "mention_count",
        "avg_url_count": "url_count",
        "avg_emoji_count": "emoji_count",
        "alert_keyword_share": "contains_alert_keyword",
        "avg_simple_sentiment_score": "simple_sentiment_score",
    }
    return fact.groupBy("disaster_type").agg(
        F.count("*").alias("tweet_count"),
        *[F.avg(c).alias(out) for out, c in averages.items()],
        *[
            F.count_if(F.col("simple_sentiment_label") == label).alias(f"{label}_tweets")
            for label in ("positive", "negative", "neutral")
        ],
    )
