"""Typed weather and station streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Declared schemas of the two topics.
WEATHER_SCHEMA = (
    "interval INT, is_day INT, temperature DOUBLE, time TIMESTAMP, weathercode INT, winddirection INT, windspeed DOUBLE"
)
STATION_SCHEMA = (
    "array<struct<id: INT, name: STRING, locality: STRING, timezone: STRING, "
    "country: struct<id: INT, code: STRING, name: STRING>, "
    "owner: struct<id: INT, name: STRING>, provider: struct<id: INT, name: STRING>, "
    "isMobile: BOOLEAN, isMonitor: BOOLEAN, "
    "coordinates: struct<latitude: DOUBLE, longitude: DOUBLE>, "
    "instruments: array<STRING>, sensors: array<STRING>, licenses: array<STRING>, bounds: array<DOUBLE>, "
    "datetimeFirst: struct<utc: STRING, local: STRING>, datetimeLast: struct<utc: STRING, local: STRING>>>"
)
WEATHER_TOPIC = "weather-barcelona"
STATION_TOPIC = "airquality-barcelona"


def kafka_source(spark: SparkSession, servers: str, topics: str = f"{WEATHER_TOPIC},{STATION_TOPIC}", starting: str = "earliest") -> DataFrame:
    """Kafka topics as a stream; needs the Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topics)
        .option("startingOffsets", starting)
        .option("failOnDataLoss", "false")
        .load()
    )


def of_topic(raw: DataFrame, topic: str) -> DataFrame:
    return raw.filter(F.col("topic") == topic)


def weather_stream(raw: DataFrame, topic: str = WEATHER_TOPIC) -> DataFrame:
    parsed = of_topic(raw, topic).select(F.from_json(F.col("value").cast("string"), WEATHER_SCHEMA).alias("data"))
    return parsed.select("data.*")


def station_stream(raw: DataFrame, topic: str = STATION_TOPIC) -> DataFrame:
    """One row per station of each snapshot."""
    parsed = of_topic(raw, topic).select(F.explode(F.from_json(F.col("value").cast("string"), STATION_SCHEMA)).alias("station"))
    return parsed.select(
        F.col("station.id").alias("station_id"),
        F.col("station.name").alias("station_name"),
        "station.locality",
        "station.timezone",
        "station.isMobile",
        "station.isMonitor",
        "station.coordinates.latitude",
        "station.coordinates.longitude",
        F.col("station.country.name").alias("country"),
        F.col("station.provider.name").alias("provider"),
        F.col("station.owner.name").alias("owner"),
        F.col("station.datetimeFirst.local").alias("datetimeFirst"),
        F.col("station.datetimeLast.local").alias("datetimeLast"),
        "station.sensors",
    )


def plausible_weather() -> Column:
    """Sanity limits of a weather event; a missing value fails them."""
    inside = (
        F.col("temperature").between(-50, 60)
        & F.col("windspeed").between(0, 150)
        & F.col("winddirection").between(0, 360)
        & (F.col("interval") > 0)
        & F.col("time").isNotNull()
    )
    return F.coalesce(inside, F.lit(False))


def near(locality: Column, place: str) -> Column:
    return F.contains(F.lower(locality), F.lit(place.lower()))


def hourly_stream(stream: DataFrame, late: str = "2 hours") -> DataFrame:
    """Weather per hour of event time; an hour is final once the watermark has passed it."""
    return (
        stream.withWatermark("time", late)
        .groupBy(F.window("time", "1 hour"))
        .agg(
            F.avg("temperature").alias("avg_temperature"),
            F.min("temperature").alias("min_temperature"),
            F.max("temperature").alias("max_temperature"),
            F.avg("windspeed").alias("avg_windspeed"),
            F.max("windspeed").alias("max_windspeed"),
            F.count("*").alias("observation_count"),
            F.count_if(F.col("is_day") == 1).alias("day_observation_count"),
            F.count_if(F.col("is_day") == 0).alias("night_observation_count"),
        )
        .select(F.col("window.start").alias("hour_start"), "*")
        .drop("window")
    )
