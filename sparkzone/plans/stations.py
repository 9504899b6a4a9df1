"""Dimensions, facts and marts of station snapshots and weather observations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.features import array_count
from ..functions.keys import stable_key
from ..functions.labels import weather_label
from ..functions.times import elapsed_days, event_time
from ..operators.joins import null_safe_join
from ..operators.rows import computed_once, keep_first, latest
from .documents import field

NAMED = "id BIGINT, name STRING"
COUNTRY = "id BIGINT, code STRING, name STRING"
POINT = "latitude DOUBLE, longitude DOUBLE"
MOMENT = "utc STRING, local STRING"
SENSOR = f"array<struct<id: BIGINT, name: STRING, parameter: struct<id: BIGINT, name: STRING, units: STRING, displayName: STRING>>>"
ITEMS = "array<struct<id: BIGINT, name: STRING>>"


def first_field(*candidates: str) -> Column:
    """The first present spelling of a document field."""
    return F.coalesce(*[field("doc", c) for c in candidates])


def json_field(schema: str, *candidates: str) -> Column:
    """A nested field; blank or malformed JSON is null."""
    return F.from_json(first_field(*candidates), schema)


def station_frame(docs: DataFrame) -> DataFrame:
    """Every snapshot with its nested fields parsed once; the parts below select from it."""
    return docs.select(
        F.coalesce(first_field("id"), first_field("station_id")).try_cast("bigint").alias("station_id"),
        first_field("name", "station_name").alias("station_name"),
        first_field("locality").alias("locality"),
        first_field("timezone").alias("timezone"),
        json_field(COUNTRY, "country").alias("country"),
        json_field(NAMED, "provider").alias("provider"),
        json_field(NAMED, "owner").alias("owner"),
        first_field("country_id").try_cast("bigint").alias("flat_country_id"),
        first_field("provider_id").try_cast("bigint").alias("flat_provider_id"),
        first_field("owner_id").try_cast("bigint").alias("flat_owner_id"),
        first_field("isMobile", "ismobile", "is_mobile").try_cast("boolean").alias("is_mobile"),
        first_field("isMonitor", "ismonitor", "is_monitor").try_cast("boolean").alias("is_monitor"),
        json_field(POINT, "coordinates").alias("point"),
        first_field("latitude").try_cast("double").alias("flat_latitude"),
        first_field("longitude").try_cast("double").alias("flat_longitude"),
        first_field("bounds").alias("bounds"),
        first_field("distance").try_cast("double").alias("distance"),
        json_field(SENSOR, "sensors").alias("sensors"),
        json_field(ITEMS, "instruments").alias("instruments"),
        json_field(ITEMS, "licenses").alias("licenses"),
        json_field(MOMENT, "datetimeFirst", "datetimefirst", "datetime_first").alias("first_seen"),
        json_field(MOMENT, "datetimeLast", "datetimelast", "datetime_last").alias("last_seen"),
    )


def dim_station(stations: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    rows = stations.select(
        "station_id",
        "station_name",
        "locality",
        "timezone",
        F.coalesce("country.id", "flat_country_id").alias("country_id"),
        F.coalesce("provider.id", "flat_provider_id").alias("provider_id"),
        F.coalesce("owner.id", "flat_owner_id").alias("owner_id"),
        "is_mobile",
        "is_monitor",
        F.coalesce("point.latitude", "flat_latitude").alias("latitude"),
        F.coalesce("point.longitude", "flat_longitude").alias("longitude"),
        "bounds",
        "distance",
        array_count(F.col("sensors")).alias("sensor_count"),
        array_count(F.col("instruments")).alias("instrument_count"),
        array_count(F.col("licenses")).alias("license_count"),
        F.col("first_seen.utc").alias("datetime_first_utc"),
        F.col("first_seen.local").alias("datetime_first_local"),
        F.col("last_seen.utc").alias("datetime_last_utc"),
        F.col("last_seen.local").alias("datetime_last_local"),
    )
    return keep_first(rows, ["station_id"], order)


def dim_country(stations: DataFrame) -> DataFrame:
    rows = stations.filter("country is not null").select(
        F.col("country.id").alias("country_id"), F.col("country.code").alias("country_code"), F.col("country.name").alias("country_name")
    )
    return keep_first(rows, ["country_id"])


def dim_named(stations: DataFrame, part: str) -> DataFrame:
    rows = stations.filter(f"{part} is not null").select(
        F.col(f"{part}.id").alias(f"{part}_id"), F.col(f"{part}.name").alias(f"{part}_name")
    )
    return keep_first(rows, [f"{part}_id"])


def _items(stations: DataFrame, array: str, *keys: str) -> DataFrame:
    """One row ``s`` per element of a nested list, which is parsed once: an exploded column is also filtered, by parsing it again."""
    read = stations.select(*keys, F.col(array).alias("__read"))
    return computed_once(read, "__items", F.col("__read")).select(*keys, F.explode("__items").alias("s"))


def dim_sensor(stations: DataFrame) -> DataFrame:
    items = _items(stations, "sensors")
    rows = items.select(
        F.col("s.id").alias("sensor_id"),
        F.col("s.name").alias("sensor_name"),
        F.col("s.parameter.id").alias("parameter_id"),
        F.col("s.parameter.name").alias("parameter_name"),
        F.col("s.parameter.units").alias("parameter_units"),
        # Trusted cleaning may have lower-cased this key.
        F.col("s.parameter.displayName").alias("parameter_display_name"),
    )
    return keep_first(rows, ["sensor_id"])


def dim_item(stations: DataFrame, array: str, name: str) -> DataFrame:
    items = _items(stations, array)
    return keep_first(items.select(F.col("s.id").alias(f"{name}_id"), F.col("s.name").alias(f"{name}_name")), [f"{name}_id"])


def bridge_station(stations: DataFrame, array: str, name: str) -> DataFrame:
    """Distinct (station, item) pairs found in the snapshots."""
    return _items(stations, array, "station_id").select("station_id", F.col("s.id").alias(f"{name}_id")).distinct()


def fact_station_availability(stations: DataFrame) -> DataFrame:
    days = elapsed_days(event_time(F.col("datetime_first_utc")), event_time(F.col("datetime_last_utc")))
    return stations.select(
        "station_id",
        "datetime_first_utc",
        "datetime_last_utc",
        days.alias("active_days"),
        "is_mobile",
        "is_monitor",
        "sensor_count",
        "instrument_count",
        "license_count",
    )


def mart_station_sensor_catalog(
    bridge: DataFrame, stations: DataFrame, sensors: DataFrame, countries: DataFrame, providers: DataFrame, owners: DataFrame
) -> DataFrame:
    """Five left joins in which missing keys match missing keys."""
    joined = bridge
    for dim, key in ((stations, "station_id"), (sensors, "sensor_id"), (countries, "country_id"), (providers, "provider_id"), (owners, "owner_id")):
        joined = null_safe_join(joined, dim, [key])
    return joined.select(
        "station_id",
        "station_name",
        "locality",
        "timezone",
        "country_code",
        "country_name",
        "provider_name",
        "owner_name",
        "is_mobile",
        "is_monitor",
        "latitude",
        "longitude",
        "bounds",
        "distance",
        "sensor_id",
        "sensor_name",
        "parameter_name",
        "parameter_units",
        "parameter_display_name",
        "datetime_first_utc",
        "datetime_last_utc",
    )


def station_assets(docs: DataFrame) -> dict[str, DataFrame]:
    return station_marts(station_frame(docs))


def station_marts(stations: DataFrame) -> dict[str, DataFrame]:
    """All assets of one station frame; a stored one is parsed once for all of them."""
    assets = {
        "dim_station": dim_station(stations),
        "dim_country": dim_country(stations),
        "dim_provider": dim_named(stations, "provider"),
        "dim_owner": dim_named(stations, "owner"),
        "dim_sensor": dim_sensor(stations),
        "bridge_station_sensor": bridge_station(stations, "sensors", "sensor"),
        "dim_instrument": dim_item(stations, "instruments", "instrument"),
        "bridge_station_instrument": bridge_station(stations, "instruments", "instrument"),
        "dim_license": dim_item(stations, "licenses", "license"),
        "bridge_station_license": bridge_station(stations, "licenses", "license"),
    }
    assets["fact_station_availability"] = fact_station_availability(assets["dim_station"])
    assets["mart_station_sensor_catalog"] = mart_station_sensor_catalog(
        *[assets[n] for n in ("bridge_station_sensor", "dim_station", "dim_sensor", "dim_country", "dim_provider", "dim_owner")]
    )
    return assets


# Columns of a weather event and their types.
WEATHER_FIELDS = {
    "time": "string",
    "interval": "int",
    "is_day": "int",
    "temperature": "double",
    "weathercode": "int",
    "winddirection": "int",
    "windspeed": "double",
}


def weather_frame(docs: DataFrame) -> DataFrame:
    """Typed weather columns of trusted documents; text that does not fit its type is null."""
    typed = {n: field("doc", n).try_cast(t) if t != "string" else field("doc", n) for n, t in WEATHER_FIELDS.items()}
    return docs.select(*[c.alias(n) for n, c in typed.items()], "source_file_path").distinct()


def dim_weather_code(weather: DataFrame) -> DataFrame:
    codes = weather.filter("weathercode is not null").select("weathercode").distinct()
    return codes.select("weathercode", weather_label(F.col("weathercode")).alias("weather_description"))


def fact_weather_observation(weather: DataFrame) -> DataFrame:
    seen = weather.withColumn("observation_time", event_time(F.col("time")))
    return seen.select(
        stable_key("time", "temperature", "windspeed", "weathercode").alias("observation_id"),
        "observation_time",
        F.to_date("observation_time").alias("observation_date"),
        F.hour("observation_time").alias("observation_hour"),
        "interval",
        "is_day",
        "temperature",
        "weathercode",
        "winddirection",
        "windspeed",
    )


def mart_weather_timeseries(fact: DataFrame, codes: DataFrame) -> DataFrame:
    return null_safe_join(fact, codes, ["weathercode"])


def mart_weather_summary(timeseries: DataFrame) -> DataFrame:
    """Per date and hour; observations without a time form their own group."""
    return timeseries.groupBy("observation_date", "observation_hour").agg(
        F.avg("temperature").alias("avg_temperature"),
        F.min("temperature").alias("min_temperature"),
        F.max("temperature").alias("max_temperature"),
        F.avg("windspeed").alias("avg_windspeed"),
        F.max("windspeed").alias("max_windspeed"),
        F.count("observation_id").alias("observation_count"),
        F.count_if(F.col("is_day") == 1).alias("day_observation_count"),
        F.count_if(F.col("is_day") == 0).alias("night_observation_count"),
    )


def mart_environment_overview(
    stations: DataFrame, sensors: DataFrame, providers: DataFrame, owners: DataFrame, timeseries: DataFrame, locality: str
) -> DataFrame:
    """One row; every other input enters as a scalar subquery, so nothing is joined."""
    distinct = lambda df, key: df.agg(F.count_distinct(key)).scalar()
    seen = F.struct("observation_time", "temperature", "weathercode", "weather_description")
    overview = timeseries.agg(F.avg("temperature").alias("avg_temperature"), F.avg("windspeed").alias("avg_windspeed")).select(
        F.lit(locality).alias("locality"),
        distinct(stations, "station_id").alias("station_count"),
        distinct(sensors, "sensor_id").alias("sensor_count"),
        distinct(providers, "provider_id").alias("provider_count"),
        distinct(owners, "owner_id").alias("owner_count"),
        "avg_temperature",
        "avg_windspeed",
        latest(timeseries, "observation_time").select(seen).scalar().alias("newest"),
    )
    return overview.select(
        *[c for c in overview.columns if c != "newest"],
        F.col("newest.observation_time").alias("latest_weather_time"),
        F.col("newest.temperature").alias("latest_temperature"),
        F.col("newest.weathercode").alias("latest_weathercode"),
        F.col("newest.weather_description").alias("latest_weather_description"),
    )


def weather_assets(docs: DataFrame) -> dict[str, DataFrame]:
    return weather_marts(weather_frame(docs))


def weather_marts(weather: DataFrame) -> dict[str, DataFrame]:
    """All assets of one weather frame; a stored one is parsed once for all of them."""
    codes, fact = dim_weather_code(weather), fact_weather_observation(weather)
    series = mart_weather_timeseries(fact, codes)
    return {
        "dim_weather_code": codes,
        "fact_weather_observation": fact,
        "mart_weather_timeseries": series,
        "mart_weather_summary": mart_weather_summary(series),
    }
