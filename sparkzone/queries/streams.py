"""Streams over the events table, read as a file stream shaped like Kafka messages."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import sharedfs
from ..streaming import events as ev, listener, sinks
from .documents import STATIONS_SQL, station_payloads
from .registry import DATE, query, table


def messages(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of (topic, partition, offset, value) with one weather message per event."""
    schema = table(spark, folder, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    record = F.struct(
        F.lit(900).alias("interval"),
        F.hour("ts").between(6, 17).cast("int").alias("is_day"),
        (F.col("value") - 60).alias("temperature"),
        F.when(F.col("event_type") != "error", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).alias("time"),
        F.get_json_object("props", "$.k").cast("int").alias("weathercode"),
        (F.col("user_id") * 5).cast("int").alias("winddirection"),
        (F.col("user_id") / 2).alias("windspeed"),
    )
    return stream.select(
        F.when(F.col("event_type") != "signup", ev.WEATHER_TOPIC).otherwise("other").alias("topic"),
        F.when(F.col("event_type") == "click", 1).otherwise(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.to_json(record).cast("binary").alias("value"),
    )


MESSAGES_SQL = """
msg as (
  select cast(900 as int) as "interval", cast(hour(ts) between 6 and 17 as int) as is_day, value - 60 as temperature, case when event_type <> 'error' then date_trunc('second', ts) end as time,
    cast(props->>'k' as int) as weathercode, cast(user_id * 5 as int) as winddirection, user_id / 2.0::double as windspeed from events where event_type <> 'signup'),
good as (select * from msg where temperature between -50 and 60 and windspeed between 0 and 150 and winddirection between 0 and 360 and time is not null)
"""


@query("stream_weather", f"with {MESSAGES_SQL} select \"interval\", is_day, round(temperature, 6) as temperature, time, weathercode, winddirection, windspeed from good")
def stream_weather(spark, folder):
    root = sharedfs.new_folder(spark, "stream")
    stream = ev.weather_stream(messages(spark, folder))
    started = sinks.write_batches(stream, f"{root}/checkpoint", sinks.parquet_writer(f"{root}/out"), ev.plausible_weather(), available_now=True)
    started.awaitTermination()
    kept = spark.read.parquet(f"{root}/out").drop("batch_id")
    return kept.withColumns({"temperature": F.round("temperature", 6), "time": F.col("time").cast("timestamp_ntz")})


@query("stream_counts", f"with {MESSAGES_SQL} select (select count(*) from msg) as received, (select count(*) from good) as kept")
def stream_counts(spark, folder):
    root = sharedfs.new_folder(spark, "stream")
    seen: list[tuple[int, int, int]] = []
    stream = ev.weather_stream(messages(spark, folder))
    started = sinks.write_batches(
        stream, f"{root}/checkpoint", sinks.parquet_writer(f"{root}/out"), ev.plausible_weather(), on_counts=lambda *c: seen.append(c), available_now=True
    )
    started.awaitTermination()
    return spark.createDataFrame(seen, "batch BIGINT, received BIGINT, kept BIGINT").agg(F.sum("received").alias("received"), F.sum("kept").alias("kept"))


@query(
    "stream_hourly",
    f"""with {MESSAGES_SQL}, h as (select date_trunc('hour', time) as hour_start, round(avg(temperature), 6) as avg_temperature, round(max(windspeed), 6) as max_windspeed, count(*) as observation_count,
    count(*) filter (is_day = 1) as day_observation_count from good group by 1)
    select * from h where hour_start + interval 1 hour <= (select max(time) - interval 2 hour from good)""",
)
def stream_hourly(spark, folder):
    """Hours the watermark has passed; later ones are not final yet."""
    root = sharedfs.new_folder(spark, "stream")
    hourly = ev.hourly_stream(ev.weather_stream(messages(spark, folder)).filter(ev.plausible_weather()))
    sinks.append_files(hourly, f"{root}/out", f"{root}/checkpoint", available_now=True).awaitTermination()
    out = spark.read.schema(hourly.schema).parquet(f"{root}/out")
    return out.select(
        F.col("hour_start").cast("timestamp_ntz").alias("hour_start"), F.round("avg_temperature", 6).alias("avg_temperature"),
        F.round("max_windspeed", 6).alias("max_windspeed"), "observation_count", "day_observation_count",
    )


@query(
    "stream_landing",
    """select partition, min(event_id) as "start", max(event_id) as "end" from (select event_id, cast(case when event_type = 'click' then 1 else 0 end as int) as partition from events) group by 1""",
)
def stream_landing(spark, folder):
    """Raw landing: the audit rows name the offset range of every partition."""
    root = sharedfs.new_folder(spark, "landing")
    sinks.land_kafka(messages(spark, folder), root, "weather", DATE, f"{root}/checkpoint", available_now=True).awaitTermination()
    audit = spark.read.option("recursiveFileLookup", True).parquet(f"{root}/_audit")
    ranges = audit.select(F.explode(F.from_json("ranges", "array<struct<partition: INT, start: BIGINT, end: BIGINT>>")).alias("r")).select("r.*")
    return ranges.groupBy("partition").agg(F.min("start").alias("start"), F.max("end").alias("end"))


@query("stream_landed_rows", "select count(*) as n, count(distinct event_id) as events from events")
def stream_landed_rows(spark, folder):
    from ..sources.documents import parse_documents

    root = sharedfs.new_folder(spark, "landing")
    raw = messages(spark, folder).withColumn("value", F.to_json(F.struct("offset")).cast("binary"))
    sinks.land_kafka(raw, root, "weather", DATE, f"{root}/checkpoint", available_now=True).awaitTermination()
    docs = parse_documents(spark, f"{root}/weather").docs.select(F.get_json_object("record", "$.offset").alias("o"))
    return docs.agg(F.count("*").alias("n"), F.count_distinct("o").alias("events"))


@query(
    "stream_explode",
    f"""with {STATIONS_SQL.replace("where s_acctbal >= 0", "")} select cast(station_id as int) as station_id, initcap_name as station_name, country, provider, owner, ismobile as "isMobile", cast(n as bigint) as n from (
      select s.s_suppkey as station_id, s.s_name as initcap_name, case when r_name <> 'AFRICA' then n_name end as country, 'P' || cast(floor(s_acctbal / 1000) as bigint) as provider, r_name as owner, s_acctbal < 1000 as ismobile, count(*) as n
      from lineitem join supplier s on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey where l_returnflag = 'N' group by all)""",
)
def stream_explode(spark, folder):
    """Station arrays exploded from a stream of snapshots; here the snapshots are first landed as files."""
    root = sharedfs.new_folder(spark, "stream")
    station_payloads(spark, folder).filter(F.startswith("payload", F.lit("[{"))).select("payload").write.parquet(f"{root}/in")
    raw = spark.readStream.schema("payload STRING").parquet(f"{root}/in")
    stream = ev.station_stream(raw.select(F.lit(ev.STATION_TOPIC).alias("topic"), F.col("payload").alias("value")))
    sinks.append_files(stream, f"{root}/out", f"{root}/checkpoint", available_now=True).awaitTermination()
    rows = spark.read.schema(stream.schema).parquet(f"{root}/out")
    return rows.groupBy("station_id", "station_name", "country", "provider", "owner", "isMobile").agg(F.count("*").alias("n"))


@query("locality_filter", "select c_custkey, n_name from customer join nation on c_nationkey = n_nationkey where contains(lower(n_name), 'nation_1')")
def locality_filter(spark, folder):
    """Customers near a place, by the name of theirs."""
    places = table(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return table(spark, folder, "customer").join(places, "c_nationkey").filter(ev.near(F.col("n_name"), "Nation_1")).select("c_custkey", "n_name")


WAVES = 3


@query(
    "stream_progress",
    f"""with w as (select event_id, value, event_id % {WAVES} as wave from events)
    select cast(wave as bigint) as batch_id, count(*) as input_rows, count(*) as received, count(*) filter (value >= 50) as kept,
      cast(case when wave = 1 then 2 else 1 end as bigint) as runs, cast(case when wave = 1 then 1 else 0 end as bigint) as failures from w group by wave""",
)
def stream_progress(spark, folder):
    """Stored progress of a stream that gets a third of the events at a time, is stopped after each, and fails once.

    The failed batch is run again after a restart, and is told once.
    """
    root = sharedfs.new_folder(spark, "progress")
    events = table(spark, folder, "events").select("event_id", "value")
    keep = F.col("value") >= 50
    write = sinks.parquet_writer(f"{root}/out")

    def fails(batch: DataFrame, batch_id: int) -> None:
        raise RuntimeError(f"batch {batch_id} has no luck")

    tried = []
    with listener.ProgressLog(spark, f"{root}/log") as log:
        for wave in range(WAVES):
            events.where(F.col("event_id") % WAVES == wave).write.mode("append").parquet(f"{root}/in")
            for writer in (fails, write) if wave == 1 else (write,):
                stream = spark.readStream.schema(events.schema).parquet(f"{root}/in")
                counted = stream.observe("rows", F.count(F.lit(1)).alias("received"), F.count_if(keep).alias("kept"))
                started = sinks.write_batches(counted, f"{root}/checkpoint", writer, keep, name="told", available_now=True)
                try:
                    started.awaitTermination()
                except StreamingQueryException:
                    pass
                log.wait(started)
                tried.append((wave, str(started.runId)))
    told = listener.progress(spark, f"{root}/log")
    runs = listener.runs(spark, f"{root}/log").where("name = 'told' and not active").select("run_id", F.col("error").isNotNull().alias("failed"))
    by_wave = spark.createDataFrame(tried, "batch_id BIGINT, run_id STRING").join(runs, "run_id").groupBy("batch_id").agg(
        F.count("*").alias("runs"), F.count_if("failed").alias("failures")
    )
    metric = lambda name: F.col("observed")["rows"][name].cast("bigint").alias(name)
    return told.select("batch_id", "input_rows", metric("received"), metric("kept")).join(by_wave, "batch_id")
