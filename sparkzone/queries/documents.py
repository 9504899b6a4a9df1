"""JSON documents, station snapshots and weather observations derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import sharedfs
from ..functions.features import array_count
from ..functions.labels import weather_label
from ..functions.times import elapsed_days, file_epoch
from ..operators.joins import null_safe_join
from ..plans import stations as st
from ..plans.documents import clean_documents
from ..sources.documents import flatten_snapshots, parse_documents, parse_payloads
from ..sources.files import json_shape, profile_json_files
from ..sources.tables import spread
from .registry import DATE, query, table

# --- weather: one event, one observation --------------------------------------------


def weather_payloads(spark: SparkSession, folder: str) -> DataFrame:
    e = spread(table(spark, folder, "events"))
    k = F.get_json_object("props", "$.k").cast("int")
    code = F.when(k < 30, 0).when(k < 50, 45).when(k < 70, 61).when(k < 90, 95).otherwise(7)
    lost = (F.col("event_type") == "error") & (F.col("value") < 20)
    record = F.struct(
        F.when(~lost, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).alias("time"),
        F.lit(900).alias("interval"),
        F.hour("ts").between(6, 17).cast("int").alias("is_day"),
        F.when(F.col("value") < 200, F.col("value")).alias("temperature"),
        code.alias("weatherCode"),
        (F.col("user_id") * 3).alias("windDirection"),
        (F.col("user_id") / 2).alias("windSpeed"),
    )
    path = F.concat(F.lit("events/"), F.col("event_id").cast("string"))
    return e.select(path.alias("source_file_path"), F.to_json(record).alias("payload"))


def weather_documents(spark: SparkSession, folder: str, required=("temperature",)):
    return clean_documents(parse_payloads(weather_payloads(spark, folder)).docs, "weather-barcelona", DATE, required)


WEATHER_SQL = """
w as (
  select event_id, case when event_type = 'error' and value < 20 then null else date_trunc('second', ts) end as t, cast(900 as int) as "interval",
    cast(hour(ts) between 6 and 17 as int) as is_day, value as temperature, cast(props->>'k' as int) as k, cast(user_id * 3 as int) as winddirection, user_id / 2.0::double as windspeed
  from events where value < 200),
codes as (select *, cast(case when k < 30 then 0 when k < 50 then 45 when k < 70 then 61 when k < 90 then 95 else 7 end as int) as weathercode from w),
fact as (
  select sha1(coalesce(replace(cast(t as varchar), ' ', 't'), '') || '|' || cast(temperature as varchar) || '|' || cast(windspeed as varchar) || '|' || cast(weathercode as varchar)) as observation_id,
    t as observation_time, cast(t as date) as observation_date, cast(hour(t) as int) as observation_hour, "interval", is_day, temperature, weathercode, winddirection, windspeed from codes),
series as (select *, case weathercode when 0 then 'Clear sky' when 45 then 'Fog' when 61 then 'Slight rain' when 95 then 'Thunderstorm' else 'Unknown' end as weather_description from fact)
"""


def _wall(df: DataFrame, column: str) -> DataFrame:
    """UTC wall time, as the SQL side has it."""
    return df.withColumn(column, F.col(column).cast("timestamp_ntz"))


@query("fact_weather_observation", f"with {WEATHER_SQL} select * from fact")
def fact_weather_observation(spark, folder):
    weather = st.weather_frame(weather_documents(spark, folder).valid)
    return _wall(st.fact_weather_observation(weather), "observation_time")


@query("weather_timeseries", f"with {WEATHER_SQL} select * from series")
def weather_timeseries(spark, folder):
    return _wall(st.weather_assets(weather_documents(spark, folder).valid)["mart_weather_timeseries"], "observation_time")


@query("dim_weather_code", f"with {WEATHER_SQL} select distinct weathercode, weather_description from series")
def dim_weather_code(spark, folder):
    return st.dim_weather_code(st.weather_frame(weather_documents(spark, folder).valid))


@query(
    "weather_summary",
    f"""with {WEATHER_SQL} select observation_date, observation_hour, round(avg(temperature), 6) as avg_temperature, min(temperature) as min_temperature, max(temperature) as max_temperature,
    round(avg(windspeed), 6) as avg_windspeed, max(windspeed) as max_windspeed, count(observation_id) as observation_count,
    count(*) filter (is_day = 1) as day_observation_count, count(*) filter (is_day = 0) as night_observation_count from series group by all""",
)
def weather_summary(spark, folder):
    mart = st.weather_assets(weather_documents(spark, folder).valid)["mart_weather_summary"]
    return mart.withColumns({"avg_temperature": F.round("avg_temperature", 6), "avg_windspeed": F.round("avg_windspeed", 6)})


@query(
    "weather_rejects",
    """select 'events/' || event_id as source_file_path, 'weather_barcelona' as dataset_name, 'missing_required_fields' as reason,
    case when event_type = 'error' and value < 20 then 'interval,is_day,temperature,weathercode,winddirection,windspeed'
         else 'interval,is_day,time,weathercode,winddirection,windspeed' end as record_keys, 'rejected' as validation_status, 'weather_barcelona_v1' as schema_version
    from events where value >= 200 or (event_type = 'error' and value < 20)""",
)
def weather_rejects(spark, folder):
    bad = weather_documents(spark, folder, None).rejected
    return bad.select(
        "source_file_path", "dataset_name", "reason", F.concat_ws(",", "record_keys").alias("record_keys"), "validation_status", "schema_version"
    )


@query(
    "code_labels",
    """with c as (select event_id, cast(props->>'k' as int) as k from events) select event_id, case k when 0 then 'Clear sky' when 1 then 'Mainly clear' when 2 then 'Partly cloudy'
    when 3 then 'Overcast' when 45 then 'Fog' when 48 then 'Depositing rime fog' when 51 then 'Light drizzle' when 53 then 'Moderate drizzle' when 55 then 'Dense drizzle' when 61 then 'Slight rain'
    when 63 then 'Moderate rain' when 65 then 'Heavy rain' when 71 then 'Slight snow fall' when 73 then 'Moderate snow fall' when 75 then 'Heavy snow fall' when 80 then 'Slight rain showers'
    when 81 then 'Moderate rain showers' when 82 then 'Violent rain showers' when 95 then 'Thunderstorm' else 'Unknown' end as label from c""",
)
def code_labels(spark, folder):
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, folder, "events").select("event_id", weather_label(k).alias("label"))


@query(
    "station_availability",
    """select user_id, cast(floor((epoch_us(max(ts)) - epoch_us(min(ts))) / 86400000000.0::double) as bigint) as active_days from events group by 1""",
)
def station_availability(spark, folder):
    spans = table(spark, folder, "events").groupBy("user_id").agg(F.min("ts").alias("first"), F.max("ts").alias("last"))
    return spans.select("user_id", elapsed_days(F.col("first"), F.col("last")).alias("active_days"))


@query(
    "file_event_time",
    """select event_id, case when event_type = 'error' then timestamp '2026-05-24 10:00:00' else date_trunc('second', ts) end as event_time from events""",
)
def file_event_time(spark, folder):
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    name = F.when(F.col("event_type") == "error", "x_abc.jpg").when(
        F.col("event_type") == "click", F.concat(F.lit("x_"), (seconds * 1000).cast("string"), F.lit(".jpg"))
    ).otherwise(F.concat(F.lit("x_"), seconds.cast("string"), F.lit(".jpg")))
    return _wall(table(spark, folder, "events").select("event_id", file_epoch(name, DATE).alias("event_time")), "event_time")


# --- documents of any shape -----------------------------------------------------------


@query("doc_parse", "select 'props/' || event_id as source_file_path, cast(props->>'k' as int) as k from events")
def doc_parse(spark, folder):
    payloads = table(spark, folder, "events").select(
        F.concat(F.lit("props/"), F.col("event_id").cast("string")).alias("source_file_path"), F.col("props").alias("payload")
    )
    docs = parse_payloads(payloads).docs
    return docs.select("source_file_path", F.get_json_object("record", "$.k").cast("int").alias("k"))


@query(
    "doc_shapes",
    """select conv_id, turn, case role when 'user' then 2 else 1 end as copies, role from conversations where role <> 'system'
    union all select conv_id, turn, 1, role from conversations where role = 'system'""",
)
def doc_shapes(spark, folder):
    """Objects, lists of lists and line-separated values, brought to one row per station-like record."""
    c = table(spark, folder, "conversations")
    record = F.to_json(F.struct("conv_id", "turn", "role", "text"))
    shaped = F.when(F.col("role") == "user", F.concat(F.lit("[["), record, F.lit("], ["), record, F.lit("]]"))).otherwise(record)
    docs = parse_payloads(c.select(F.lit("conversations").alias("source_file_path"), shaped.alias("payload"))).docs
    # A list of lists parses to one record per inner list; each of those holds one object.
    flat = flatten_snapshots(docs).select(F.from_json("record", "conv_id BIGINT, turn BIGINT, role STRING").alias("r")).select("r.*")
    return flat.groupBy("conv_id", "turn", "role").agg(F.count("*").cast("int").alias("copies"))


@query(
    "doc_malformed",
    "select 'c/' || conv_id || '/' || turn as source_file_path, 'invalid_json_payload' as reason from conversations where role = 'user' or contains(text, chr(10))",
)
def doc_malformed(spark, folder):
    """Plain text, truncated objects and scalars are no documents."""
    c = table(spark, folder, "conversations")
    whole = F.to_json(F.struct("conv_id", "text"))
    payload = F.when((F.col("role") == "user") | F.contains("text", F.lit("\n")), F.substring(whole, 1, 25)).otherwise(whole)
    path = F.concat_ws("/", F.lit("c"), F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    return parse_payloads(c.select(path.alias("source_file_path"), payload.alias("payload"))).malformed


@query("doc_files", "select role, count(*) as n, count(distinct conv_id) as conversations, cast(sum(length(text)) as bigint) as chars from conversations group by role")
def doc_files(spark, folder):
    """Through files: records written as line-separated JSON come back complete."""
    path = sharedfs.new_folder(spark, "documents") + "/conversations.ndjson"
    table(spark, folder, "conversations").select(F.to_json(F.struct("*"))).write.text(path)
    docs = parse_documents(spark, path).docs.select(F.from_json("record", "conv_id BIGINT, turn BIGINT, role STRING, text STRING").alias("r"))
    return docs.groupBy("r.role").agg(
        F.count("*").alias("n"), F.count_distinct("r.conv_id").alias("conversations"), F.sum(F.char_length("r.text")).alias("chars")
    )


# Records of a whole-text file of the shapes below; how many files there are follows the table.
PER_FILE = 2000


def _shape_files(spark: SparkSession, folder: str) -> str:
    """Conversations as JSON files of every shape, a folder of files each; line ends within values and broken ones among them."""
    root = sharedfs.new_folder(spark, "shapes")
    c = table(spark, folder, "conversations")
    user = c.where("role = 'user'")
    files = 1 + user.count() // PER_FILE
    # By turn, as a single conversation can be large.
    group = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(files)).alias("group")
    record = F.to_json(F.struct("conv_id", "turn", "role"), {"pretty": "true"})
    listed = user.groupBy(group).agg(F.array_sort(F.collect_list(record)).alias("records"))
    body = F.array_join("records", ",\n")
    whole = {
        "list": F.concat(F.lit("[\n"), body, F.lit("\n]\n")),
        "nested": F.concat(F.lit("[["), body, F.lit("],\n["), body, F.lit("]]")),
        "broken": F.concat(F.lit("[\n"), body, F.lit(",\n")),
    }
    for name, text in whole.items():
        listed.select(text).write.option("maxRecordsPerFile", 1).text(f"{root}/{name}.json", lineSep=" ")
    c.orderBy("conv_id", "turn").limit(1).select(record).write.text(f"{root}/object.json")
    lines = c.select(F.to_json(F.struct("conv_id", "turn", "role")).alias("line"), group)
    lines.select("line").write.text(f"{root}/lines.ndjson")
    # Every file gets the broken line of its groups.
    half = lines.unionAll(spark.range(files).select(F.lit('{"conv_id": 1').alias("line"), F.col("id").alias("group")))
    half.repartition("group").select("line").write.text(f"{root}/half.ndjson")
    return root


@query(
    "doc_multiline_files",
    """with u as (select conv_id, turn from conversations where role = 'user'), f as (select conv_id, turn from conversations order by conv_id, turn limit 1)
    select kind, file, count(*) as n, cast(sum(conv_id) as bigint) as conv_ids, cast(sum(turn) as bigint) as turns from (
      select 'record' as kind, 'list.json' as file, * from u union all select 'record', 'nested.json', * from u union all select 'record', 'nested.json', * from u
      union all select 'record', 'object.json', * from f union all select 'record', 'lines.ndjson', conv_id, turn from conversations) group by 1, 2
    union all select 'malformed', file, 1, null, null from (values ('broken.json'), ('half.ndjson')) v(file)
    where (select count(*) from conversations) > 0""",
)
def doc_multiline_files(spark, folder):
    """Pretty-printed lists, lists of lists, objects, lines, and files broken at their end."""
    parsed = parse_documents(spark, _shape_files(spark, folder))
    file = F.regexp_extract("source_file_path", r"([^/]+)/part-[^/]*$", 1).alias("file")
    flat = flatten_snapshots(parsed.docs).select(file, F.from_json("record", "conv_id BIGINT, turn BIGINT").alias("r"))
    good = flat.groupBy(F.lit("record").alias("kind"), "file").agg(
        F.count("*").alias("n"), F.sum("r.conv_id").alias("conv_ids"), F.sum("r.turn").alias("turns")
    )
    none = F.lit(None).cast("long")
    bad = parsed.malformed.select(F.lit("malformed").alias("kind"), file, F.lit(1).cast("long").alias("n"), none.alias("conv_ids"), none.alias("turns"))
    # A broken file that were read would show among the records.
    return good.unionAll(bad.distinct())


@query(
    "json_file_catalogue",
    """with u as (select count(*) filter (role = 'user') as n, count(*) as lines from conversations)
    select 'list.json' as file, 1 as nesting_level, n as record_count from u union all select 'nested.json', 2, 2 * n from u
    union all select 'object.json', 0, 1 from u union all select 'lines.ndjson', 0, lines from u""",
)
def json_file_catalogue(spark, folder):
    """Catalogue rows of readable files, whatever their lines, summed by kind of file and level."""
    rows = profile_json_files(spark, _shape_files(spark, folder), "conversations", DATE)
    file = F.regexp_extract("file_path", r"([^/]+)/part-[^/]*$", 1).alias("file")
    level = F.get_json_object("metadata_blob", "$.nesting_level").cast("int").alias("nesting_level")
    return rows.groupBy(file, level).agg(F.sum("record_count").alias("record_count"))


@query(
    "json_profile",
    """select 'c/' || conv_id || '/' || turn as source_file_path, cast(case role when 'user' then 2 when 'assistant' then 1 else 0 end as int) as nesting_level, 'conv_id,role' as schema_keys,
    cast(case role when 'user' then 3 when 'assistant' then 2 else 1 end as bigint) as record_count from conversations""",
)
def json_profile(spark, folder):
    c = table(spark, folder, "conversations")
    r = F.to_json(F.struct("conv_id", "role"))
    payload = (
        F.when(F.col("role") == "user", F.concat(F.lit("[["), r, F.lit(","), r, F.lit("], ["), r, F.lit("]]")))
        .when(F.col("role") == "assistant", F.concat(F.lit("[ "), r, F.lit(","), r, F.lit("]")))
        .otherwise(r)
    )
    path = F.concat_ws("/", F.lit("c"), F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    shape = json_shape(c.select(path.alias("source_file_path"), payload.alias("payload")))
    return shape.select("source_file_path", "nesting_level", F.concat_ws(",", "schema_keys").alias("schema_keys"), "record_count")


# --- stations: every line item is one snapshot of its supplier ---------------------------


def station_payloads(spark: SparkSession, folder: str) -> DataFrame:
    l, s, p, n, r = (table(spark, folder, x) for x in ("lineitem", "supplier", "part", "nation", "region"))
    l = spread(l.select("l_orderkey", "l_suppkey", "l_partkey", "l_linenumber", "l_returnflag", "l_shipdate", "l_quantity"))
    joined = (
        l.join(s, l.l_suppkey == s.s_suppkey)
        .join(p, l.l_partkey == p.p_partkey)
        .join(n, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    number = F.col("l_linenumber").cast("string")
    moment = lambda shift: F.date_format(F.col("l_shipdate") + F.make_dt_interval(shift, F.lit(0), F.lit(30)), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    first, last = moment(F.lit(0)), moment(F.col("l_quantity").cast("int"))
    provider = F.floor(F.col("s_acctbal") / 1000).cast("int")
    record = F.to_json(
        F.struct(
            F.col("s_suppkey").alias("id"),
            F.col("s_name").alias("name"),
            F.concat(F.lit(" "), "n_name").alias("locality"),
            F.lit("UTC").alias("timezone"),
            F.when(
                F.col("r_name") != "AFRICA",
                F.struct(F.col("n_nationkey").alias("id"), F.substring("n_name", 1, 3).alias("code"), F.col("n_name").alias("name")),
            ).alias("country"),
            F.struct(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name")).alias("owner"),
            F.struct(provider.alias("id"), F.concat(F.lit("P"), provider.cast("string")).alias("name")).alias("provider"),
            (F.col("s_acctbal") < 1000).alias("isMobile"),
            (F.col("s_acctbal") > 5000).alias("isMonitor"),
            F.when(
                F.col("s_acctbal") >= 0, F.struct((F.col("s_acctbal") / 100).alias("latitude"), F.col("n_nationkey").cast("double").alias("longitude"))
            ).alias("coordinates"),
            F.array(
                F.struct(
                    F.col("p_partkey").alias("id"),
                    F.col("p_name").alias("name"),
                    F.struct(
                        F.col("p_size").alias("id"),
                        F.col("p_type").alias("name"),
                        F.col("p_brand").alias("units"),
                        F.lower("p_type").alias("displayName"),
                    ).alias("parameter"),
                )
            ).alias("sensors"),
            F.array(F.struct(F.col("l_linenumber").alias("id"), F.concat(F.lit("I"), number).alias("name"))).alias("instruments"),
            F.when(
                F.col("l_returnflag") != "N", F.array(F.struct(F.ascii("l_returnflag").alias("id"), F.col("l_returnflag").alias("name")))
            ).otherwise(F.array()).alias("licenses"),
            F.struct(first.alias("utc"), first.alias("local")).alias("datetimeFirst"),
            F.struct(last.alias("utc"), last.alias("local")).alias("datetimeLast"),
        )
    )
    shaped = (
        F.when(F.col("l_returnflag") == "A", record)
        .when(F.col("l_returnflag") == "N", F.concat(F.lit("["), record, F.lit("]")))
        .otherwise(F.concat(F.lit("[["), record, F.lit("]]")))
    )
    return joined.select(F.concat(F.lit("snapshots/"), F.col("l_orderkey").cast("string")).alias("source_file_path"), shaped.alias("payload"))


def station_documents(spark: SparkSession, folder: str):
    return clean_documents(parse_payloads(station_payloads(spark, folder)).docs, "airquality-barcelona", DATE)


def stations(spark: SparkSession, folder: str) -> DataFrame:
    return st.station_frame(station_documents(spark, folder).valid)


STATIONS_SQL = """
snap as (
  select s_suppkey as station_id, lower(s_name) as station_name, lower(n_name) as locality, 'utc' as timezone, case when r_name <> 'AFRICA' then cast(n_nationkey as bigint) end as country_id,
    substr(n_name, 1, 3) as country_code, n_name as country_name, cast(floor(s_acctbal / 1000) as bigint) as provider_id, 'P' || cast(floor(s_acctbal / 1000) as bigint) as provider_name,
    cast(r_regionkey as bigint) as owner_id, r_name as owner_name, s_acctbal < 1000 as is_mobile, s_acctbal > 5000 as is_monitor, s_acctbal / 100 as latitude, cast(n_nationkey as double) as longitude,
    p_partkey as sensor_id, p_name as sensor_name, cast(p_size as bigint) as parameter_id, p_type as parameter_name, p_brand as parameter_units, lower(p_type) as parameter_display_name,
    cast(l_linenumber as bigint) as instrument_id, 'I' || l_linenumber as instrument_name, case when l_returnflag <> 'N' then cast(ascii(l_returnflag) as bigint) end as license_id, l_returnflag as license_name,
    strftime(l_shipdate + interval 30 minute, '%Y-%m-%dT%H:%M:%SZ') as first_utc, strftime(l_shipdate + to_days(cast(l_quantity as int)) + interval 30 minute, '%Y-%m-%dT%H:%M:%SZ') as last_utc
  from lineitem join supplier on l_suppkey = s_suppkey join part on l_partkey = p_partkey join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey where s_acctbal >= 0),
station as (
  select station_id, station_name, locality, timezone, country_id, provider_id, owner_id, is_mobile, is_monitor, latitude, longitude, cast(null as varchar) as bounds, cast(null as double) as distance,
    cast(1 as int) as sensor_count, cast(1 as int) as instrument_count, license_count, first_utc as datetime_first_utc, first_utc as datetime_first_local, last_utc as datetime_last_utc, last_utc as datetime_last_local
  from (select *, cast(license_id is not null as int) as license_count, row_number() over (partition by station_id order by license_id is not null, first_utc, last_utc) as n from snap) where n = 1)
"""


@query("dim_station", f"with {STATIONS_SQL} select * from station")
def dim_station(spark, folder):
    return st.dim_station(stations(spark, folder))


@query("dim_station_country", f"with {STATIONS_SQL} select distinct country_id, country_code, country_name from snap where country_id is not null")
def dim_station_country(spark, folder):
    return st.dim_country(stations(spark, folder))


@query("dim_provider", f"with {STATIONS_SQL} select distinct provider_id, provider_name from snap")
def dim_provider(spark, folder):
    return st.dim_named(stations(spark, folder), "provider")


@query("dim_owner", f"with {STATIONS_SQL} select distinct owner_id, owner_name from snap")
def dim_owner(spark, folder):
    return st.dim_named(stations(spark, folder), "owner")


@query(
    "dim_sensor",
    f"with {STATIONS_SQL} select distinct sensor_id, sensor_name, parameter_id, parameter_name, parameter_units, parameter_display_name from snap",
)
def dim_sensor(spark, folder):
    return st.dim_sensor(stations(spark, folder))


@query("dim_instrument", f"with {STATIONS_SQL} select distinct instrument_id, instrument_name from snap")
def dim_instrument(spark, folder):
    return st.dim_item(stations(spark, folder), "instruments", "instrument")


@query("dim_license", f"with {STATIONS_SQL} select distinct license_id, license_name from snap where license_id is not null")
def dim_license(spark, folder):
    return st.dim_item(stations(spark, folder), "licenses", "license")


@query("bridge_station_sensor", f"with {STATIONS_SQL} select distinct station_id, sensor_id from snap")
def bridge_station_sensor(spark, folder):
    return st.bridge_station(stations(spark, folder), "sensors", "sensor")


@query("bridge_station_instrument", f"with {STATIONS_SQL} select distinct station_id, instrument_id from snap")
def bridge_station_instrument(spark, folder):
    return st.bridge_station(stations(spark, folder), "instruments", "instrument")


@query("bridge_station_license", f"with {STATIONS_SQL} select distinct station_id, license_id from snap where license_id is not null")
def bridge_station_license(spark, folder):
    return st.bridge_station(stations(spark, folder), "licenses", "license")


@query(
    "fact_station_availability",
    f"""with {STATIONS_SQL} select station_id, datetime_first_utc, datetime_last_utc, date_diff('day', cast(substr(datetime_first_utc, 1, 10) as date), cast(substr(datetime_last_utc, 1, 10) as date)) as active_days,
    is_mobile, is_monitor, sensor_count, instrument_count, license_count from station""",
)
def fact_station_availability(spark, folder):
    return st.fact_station_availability(st.dim_station(stations(spark, folder)))


@query(
    "station_sensor_catalog",
    f"""with {STATIONS_SQL}, bridge as (select distinct station_id, sensor_id, sensor_name, parameter_name, parameter_units, parameter_display_name, country_code, country_name, provider_name, owner_name from snap)
    select s.station_id, station_name, locality, timezone, case when country_id is not null then country_code end as country_code, case when country_id is not null then country_name end as country_name,
    provider_name, owner_name, is_mobile, is_monitor, latitude, longitude, bounds, distance, sensor_id, sensor_name, parameter_name, parameter_units, parameter_display_name, datetime_first_utc, datetime_last_utc
    from bridge join station s using (station_id)""",
)
def station_sensor_catalog(spark, folder):
    # Six assets read the frame, so it is stored with its nested fields parsed.
    trusted = sharedfs.cut_lineage(stations(spark, folder), "stations")
    return st.station_marts(trusted)["mart_station_sensor_catalog"]


@query(
    "environment_overview",
    f"""with {STATIONS_SQL}, {WEATHER_SQL},
    newest as (select * from series where observation_time is not null order by observation_time desc limit 1)
    select 'Barcelona' as locality, (select count(distinct station_id) from station) as station_count, (select count(distinct sensor_id) from snap) as sensor_count,
    (select count(distinct provider_id) from snap) as provider_count, (select count(distinct owner_id) from snap) as owner_count, round((select avg(temperature) from series), 6) as avg_temperature,
    round((select avg(windspeed) from series), 6) as avg_windspeed, observation_time as latest_weather_time, temperature as latest_temperature, weathercode as latest_weathercode,
    weather_description as latest_weather_description from newest""",
)
def environment_overview(spark, folder):
    frame = sharedfs.cut_lineage(stations(spark, folder), "stations")
    # The series is read for its means and its newest row, and each reads the weather for facts and codes.
    weather = sharedfs.cut_lineage(st.weather_frame(weather_documents(spark, folder).valid), "weather")
    series = st.weather_marts(weather)["mart_weather_timeseries"]
    mart = st.mart_environment_overview(
        st.dim_station(frame), st.dim_sensor(frame), st.dim_named(frame, "provider"), st.dim_named(frame, "owner"), series, "Barcelona"
    )
    rounded = mart.withColumns({"avg_temperature": F.round("avg_temperature", 6), "avg_windspeed": F.round("avg_windspeed", 6)})
    return _wall(rounded, "latest_weather_time")


@query(
    "doc_rejects",
    """select 'snapshots/' || l_orderkey as source_file_path, 'airquality_barcelona' as dataset_name, s_suppkey as station_id, (case when r_name <> 'AFRICA' then 'country,country_code,country_id,country_name,' else '' end) ||
    'datetimefirst,datetimelast,id,instruments,ismobile,ismonitor,licenses,locality,name,owner,owner_id,owner_name,provider,provider_id,provider_name,sensors,timezone' as record_keys
    from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey where s_acctbal < 0""",
)
def doc_rejects(spark, folder):
    bad = station_documents(spark, folder).rejected
    return bad.select(
        "source_file_path",
        "dataset_name",
        F.get_json_object("raw_record", "$.id").cast("bigint").alias("station_id"),
        F.concat_ws(",", "record_keys").alias("record_keys"),
    )


@query(
    "doc_provenance",
    """select '20260524' as trusted_partition_date, 'airquality-barcelona' as trusted_source_topic, 'kafka' as source_system, '2026-05-24T10:00:00+00:00' as ingestion_time, 'valid' as validation_status,
    'trusted_v1' as schema_version, count(*) as n, count(distinct l_orderkey) as files from lineitem join supplier on l_suppkey = s_suppkey where s_acctbal >= 0""",
)
def doc_provenance(spark, folder):
    valid = station_documents(spark, folder).valid
    by = ["trusted_partition_date", "trusted_source_topic", "source_system", "ingestion_time", "validation_status", "schema_version"]
    return valid.groupBy(*by).agg(F.count("*").alias("n"), F.count_distinct("source_file_path").alias("files"))


@query(
    "null_safe_lookup",
    """with o as (select o_orderkey, case when o_orderstatus = 'F' then null else o_orderpriority end as p from orders), d as (select o_orderpriority as p, count(*) as orders from orders where o_orderpriority <> '5-LOW' group by 1 union all select null, 0)
    select o_orderkey, o.p as priority, d.orders from o left join d on o.p is not distinct from d.p""",
)
def null_safe_lookup(spark, folder):
    o = table(spark, folder, "orders")
    keyed = o.select("o_orderkey", F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority")).alias("priority"))
    low = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))
    dim = o.groupBy(low.alias("priority")).agg(F.count(low).alias("orders"))
    return null_safe_join(keyed, dim, ["priority"])


@query("nested_counts", "select event_id, cast(case event_type when 'click' then 1 when 'view' then 0 else 0 end as int) as items from events")
def nested_counts(spark, folder):
    """Lengths of nested arrays; what is no list counts as empty."""
    raw = F.when(F.col("event_type") == "click", F.concat(F.lit("["), "props", F.lit("]"))).when(F.col("event_type") == "view", "[]").otherwise(F.col("props"))
    parsed = F.from_json(F.when(F.startswith(raw, F.lit("[")), raw), "array<struct<k: INT>>")
    return table(spark, folder, "events").select("event_id", array_count(parsed).alias("items"))
