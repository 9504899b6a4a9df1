"""Structured cleaning, dimensions, facts and marts over the order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import numbers, text
from ..functions.keys import fingerprint
from ..operators import ordered, rows
from ..plans import star
from ..plans.rules import CLIMATE, TEMPERATURES, VEHICLES, TableRules
from ..plans.structured import clean_structured
from ..sharedfs import cut_lineage
from ..sources.tables import spread
from .registry import DATE, clean, fp, query, table, tidy

# --- vehicles: parts as models, line items as measurements ---------------------


def vehicles_raw(spark: SparkSession, folder: str) -> DataFrame:
    needed = ("l_partkey", "l_linenumber", "l_linestatus", "l_returnflag", "l_quantity", "l_tax", "l_extendedprice")
    lines, parts = spread(table(spark, folder, "lineitem").select(*needed)), table(spark, folder, "part")
    return lines.join(parts, lines.l_partkey == parts.p_partkey).select(
        F.upper("p_brand").alias("Make"),
        F.concat(F.lit(" "), "p_name").alias("Model"),
        F.col("p_type").alias("Vehicle Class"),
        (F.col("p_size") / 10).alias("Engine Size(L)"),
        F.col("l_linenumber").cast("string").alias("Cylinders"),
        F.col("l_linestatus").alias("Transmission"),
        F.col("l_returnflag").alias("Fuel Type"),
        F.col("l_quantity").alias("Fuel Consumption City (L/100 km)"),
        (F.col("l_tax") * 100).alias("Fuel Consumption Hwy (L/100 km)"),
        (F.col("l_quantity") - 2).alias("Fuel Consumption Comb (L/100 km)"),
        F.col("l_quantity").cast("int").alias("Fuel Consumption Comb (mpg)"),
        F.floor("l_extendedprice").cast("int").alias("CO2 Emissions(g/km)"),
    )


def vehicles(spark: SparkSession, folder: str) -> DataFrame:
    return clean_structured(vehicles_raw(spark, folder), VEHICLES, DATE, "lineitem").valid


VEHICLES_SQL = f"""
vehicles as (
  select distinct {clean("upper(p_brand)")} as make, {clean("' ' || p_name")} as model, {clean("p_type")} as vehicle_class,
    p_size / 10.0::double as engine_sizel, l_linenumber::int as cylinders, {clean("l_linestatus")} as transmission, {clean("l_returnflag")} as fuel_type,
    l_quantity as city, l_tax * 100 as hwy, case when l_quantity - 2 < 0 then null else l_quantity - 2 end as comb,
    l_quantity::int as mpg, floor(l_extendedprice)::int as co2
  from lineitem join part on l_partkey = p_partkey)
"""
VEHICLE_KEY_SQL = fp("make", "model", "vehicle_class", "transmission", "fuel_type", "engine_sizel", "cylinders")


@query(
    "vehicle_emission_summary",
    f"""with {VEHICLES_SQL}, summary as (
      select make, model, vehicle_class, fuel_type, count(*) as vehicle_record_count, avg(co2) as co2, avg(comb) as comb, avg(mpg) as mpg
      from vehicles group by all)
    select make, model, vehicle_class, fuel_type, vehicle_record_count, round(co2, 6) as avg_co2_emissions_g_km,
      round(comb, 6) as avg_fuel_consumption_comb_l_100_km, round(mpg, 6) as avg_fuel_consumption_comb_mpg,
      cast(rank() over (partition by vehicle_class order by co2 desc) as int) as emission_rank_in_class from summary""",
)
def vehicle_emission_summary(spark, folder):
    clean_rows = cut_lineage(vehicles(spark, folder), "vehicles")
    mart = star.mart_vehicle_emission_summary(star.fact_vehicle_emission(clean_rows), star.dim_vehicle(clean_rows))
    return _rounded(mart, "avg_co2_emissions_g_km", "avg_fuel_consumption_comb_l_100_km", "avg_fuel_consumption_comb_mpg")


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query(
    "dim_vehicle",
    f"""with {VEHICLES_SQL} select distinct {VEHICLE_KEY_SQL} as vehicle_key, make, model, vehicle_class, transmission, fuel_type,
    engine_sizel as engine_size_l, cylinders from vehicles""",
)
def dim_vehicle(spark, folder):
    return star.dim_vehicle(vehicles(spark, folder))


@query(
    "fact_vehicle_emission",
    f"""with {VEHICLES_SQL} select {VEHICLE_KEY_SQL} as vehicle_key, city as fuel_consumption_city_l_100_km, round(hwy, 6) as fuel_consumption_hwy_l_100_km,
    comb as fuel_consumption_comb_l_100_km, mpg as fuel_consumption_comb_mpg, co2 as co2_emissions_g_km from vehicles""",
)
def fact_vehicle_emission(spark, folder):
    return _rounded(star.fact_vehicle_emission(vehicles(spark, folder)), "fuel_consumption_hwy_l_100_km")


# --- temperature: orders by nation, period and year ----------------------------


def temperatures_raw(spark: SparkSession, folder: str) -> DataFrame:
    orders, customers, nations = (table(spark, folder, n) for n in ("orders", "customer", "nation"))
    orders = spread(orders)
    joined = orders.join(customers, orders.o_custkey == customers.c_custkey).join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    urgent, high = F.col("o_orderpriority") == "1-URGENT", F.col("o_orderpriority") == "2-HIGH"
    quarter, month = F.quarter("o_orderdate").cast("string"), F.month("o_orderdate").cast("string")
    return joined.select(
        F.lit("ET").alias("Domain Code"),
        F.lit("Temperature  change").alias("Domain"),
        F.col("n_nationkey").cast("string").alias("Area Code (M49)"),
        F.col("n_name").alias("Area"),
        F.lit("7271").alias("Element Code"),
        F.col("o_orderstatus").alias("Element"),
        F.when(urgent, "7020").when(high, F.concat(F.lit("Q"), quarter)).otherwise(F.concat(F.lit("M"), month)).alias("Months Code"),
        F.when(urgent, "Meteorological year")
        .when(high, F.concat(F.lit("Q"), quarter, F.lit(" - start")))
        .otherwise(F.concat(F.lit("Month "), month))
        .alias("Months"),
        F.year("o_orderdate").alias("Year Code"),
        F.year("o_orderdate").cast("string").alias("Year"),
        F.lit("Â°c").alias("Unit"),
        F.col("o_totalprice").alias("Value"),
        F.lit("E").alias("Flag"),
        F.col("o_orderkey").cast("string").alias("Flag Description"),
    )


def temperatures(spark: SparkSession, folder: str) -> DataFrame:
    return clean_structured(temperatures_raw(spark, folder), TEMPERATURES, DATE, "orders").valid


TEMPERATURES_SQL = """
temps as (
  select distinct 'et' as domain_code, 'temperature change' as domain, cast(n_nationkey as varchar) as area_code_m49, lower(n_name) as area,
    '7271' as element_code, lower(o_orderstatus) as element,
    case o_orderpriority when '1-URGENT' then '7020' when '2-HIGH' then 'q' || quarter(o_orderdate) else 'm' || month(o_orderdate) end as months_code,
    case o_orderpriority when '1-URGENT' then 'meteorological year' when '2-HIGH' then 'q' || quarter(o_orderdate) || '-start' else 'month ' || month(o_orderdate) end as months,
    cast(year(o_orderdate) as int) as year_code, cast(year(o_orderdate) as int) as year, '°C' as unit, o_totalprice as value, 'e' as flag,
    cast(o_orderkey as varchar) as flag_description
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey)
"""
PERIOD_SQL = "case when contains(months, '-') then 'season' when contains(months, 'year') then 'annual' else 'month' end"


@query(
    "temperature_trends",
    f"""with {TEMPERATURES_SQL}
    select area, year, months as period, {PERIOD_SQL} as period_type, value as temperature_change_value,
      round(avg(value) over (partition by area, year), 6) as annual_avg_temperature_change,
      round(avg(value) over (partition by area, months order by year, {fp("flag_description")} rows between 4 preceding and current row), 6) as rolling_5y_period_avg
    from temps""",
)
def temperature_trends(spark, folder, ranges=None):
    rows_ = cut_lineage(temperatures(spark, folder), "temperatures")
    mart = star.mart_temperature_trends(
        star.fact_temperature_area_period(rows_),
        star.dim_area(rows_),
        star.dim_year(rows_),
        star.dim_time_period(rows_),
        fingerprint("flag_description"),
        ranges,
    )
    return _rounded(mart, "annual_avg_temperature_change", "rolling_5y_period_avg")


# The same mart with its groups cut many times.
query(
    "temperature_trends_chunked",
    f"""with {TEMPERATURES_SQL}
    select area, year, months as period, {PERIOD_SQL} as period_type, value as temperature_change_value,
      round(avg(value) over (partition by area, year), 6) as annual_avg_temperature_change,
      round(avg(value) over (partition by area, months order by year, {fp("flag_description")} rows between 4 preceding and current row), 6) as rolling_5y_period_avg
    from temps""",
)(lambda spark, folder: temperature_trends(spark, folder, ranges=60))


@query("dim_area", f"with {TEMPERATURES_SQL} select distinct {fp('area')} as area_key, area_code_m49, area as area_name from temps")
def dim_area(spark, folder):
    return star.dim_area(temperatures(spark, folder))


@query(
    "dim_time_period",
    f"with {TEMPERATURES_SQL} select distinct months_code as period_key, months as period_name, {PERIOD_SQL} as period_type from temps",
)
def dim_time_period(spark, folder):
    return star.dim_time_period(temperatures(spark, folder))


@query(
    "fact_temperature_area_period",
    f"""with {TEMPERATURES_SQL} select {fp('area')} as area_key, year as year_key, months_code as period_key, domain_code, domain, element_code, element,
    year_code, unit, value as temperature_change_value, flag, flag_description from temps""",
)
def fact_temperature_area_period(spark, folder):
    return star.fact_temperature_area_period(temperatures(spark, folder))


# --- climate: yearly totals per nation -------------------------------------------


def climate_raw(spark: SparkSession, folder: str) -> DataFrame:
    orders, customers, nations = (table(spark, folder, n) for n in ("orders", "customer", "nation"))
    joined = orders.join(customers, orders.o_custkey == customers.c_custkey).join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    totals = joined.groupBy(F.col("n_name").alias("Country"), F.year("o_orderdate").alias("Year")).agg(
        F.sum("o_totalprice").alias("CO2 Emissions"),
        # One nation has no population, for the zero denominator.
        F.sum(F.when(F.col("n_name") == "NATION_3", 0.0).otherwise(0.97)).alias("Population"),
        (F.sum("c_acctbal") - 300000).alias("GDP"),
        F.count_if(F.col("o_orderstatus") == "F").alias("Extreme Weather Events"),
        (F.avg("o_totalprice") / 7).alias("Average Temperature"),
    )
    filled = {m for m in ("co2_emissions", "population", "gdp", "extreme_weather_events", "average_temperature")}
    return totals.select("*", *[F.lit(0.5).alias(m) for m in star.CLIMATE_MEASURES if m not in filled])


def climate(spark: SparkSession, folder: str) -> DataFrame:
    return clean_structured(climate_raw(spark, folder), CLIMATE, DATE, "orders").valid


CLIMATE_SQL = """
climate as (
  select lower(n_name) as country, cast(year(o_orderdate) as int) as year, sum(o_totalprice) as co2,
    sum(case when n_name = 'NATION_3' then 0.0::double else 0.97::double end) as population,
    case when sum(c_acctbal) - 300000 < 0 then null else sum(c_acctbal) - 300000 end as gdp,
    cast(count(*) filter (o_orderstatus = 'F') as int) as events, avg(o_totalprice) / 7 as temperature
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by all)
"""


@query(
    "climate_country_year",
    f"""with {CLIMATE_SQL} select country, year, cast(year - year % 10 as int) as decade, 0.5::double as temperature_anomaly, round(temperature, 4) as average_temperature,
      round(co2, 4) as co2_emissions, round(population, 4) as population, case when population = 0 then null else round(co2 / population, 4) end as co2_per_capita,
      round(gdp, 4) as gdp, case when population = 0 then null else round(gdp / population, 4) end as gdp_per_capita,
      case when gdp = 0 then null else round(co2 / gdp, 4) end as emission_intensity, 0.5::double as renewable_energy_usage, 0.5::double as forest_area,
      0.5::double as deforestation_rate, events as extreme_weather_events, 0.5::double as policy_score, 0.5::double as air_pollution_index,
      0.5::double as biodiversity_index, 0.5::double as fossil_fuel_usage from climate""",
)
def climate_country_year(spark, folder):
    rows_ = climate(spark, folder)
    mart = star.mart_climate_country_year(star.fact_climate_country_year(rows_), star.dim_country(rows_), star.dim_year(rows_))
    measured = ("average_temperature", "co2_emissions", "population", "co2_per_capita", "gdp", "gdp_per_capita", "emission_intensity")
    return _rounded(mart, *measured, digits=4)


@query("dim_country", f"with {CLIMATE_SQL} select distinct {fp('country')} as country_key, country as country_name from climate")
def dim_country(spark, folder):
    return star.dim_country(climate(spark, folder))


@query(
    "fact_climate_country_year",
    f"""with {CLIMATE_SQL} select {fp('country')} as country_key, year as year_key, round(co2, 4) as co2_emissions, round(population, 4) as population, round(gdp, 4) as gdp,
    events as extreme_weather_events, round(temperature, 4) as average_temperature, 0.5::double as source_per_capita_emissions from climate""",
)
def fact_climate_country_year(spark, folder):
    fact = star.fact_climate_country_year(climate(spark, folder)).select(
        "country_key", "year_key", "co2_emissions", "population", "gdp", "extreme_weather_events", "average_temperature", "source_per_capita_emissions"
    )
    return _rounded(fact, "co2_emissions", "population", "gdp", "average_temperature", digits=4)


@query(
    "dim_year_union",
    """with years as (select cast(year(o_orderdate) as int) as y from orders union select cast(year(l_shipdate) as int) from lineitem)
    select y as year_key, y as year, cast(y - y % 10 as int) as decade from years""",
)
def dim_year_union(spark, folder):
    return star.dim_year(
        table(spark, folder, "orders").select(F.year("o_orderdate").alias("year")),
        table(spark, folder, "lineitem").select(F.year("l_shipdate").alias("year")),
    )


# --- ordered operators, each also with its groups cut many times ----------------------

RANK_SQL = """select o_orderkey, o_orderpriority, o_totalprice, cast(rank() over (partition by o_orderpriority order by o_totalprice desc) as int) as price_rank from orders"""


def _rank(spark, folder, ranges=None):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return ordered.rank_in_group(orders, ["o_orderpriority"], "o_totalprice", "price_rank", ranges)


query("rank_in_group", RANK_SQL)(_rank)
query("rank_in_group_chunked", RANK_SQL)(lambda spark, folder: _rank(spark, folder, 50))



@query(
    "rank_text_in_group",
    """select event_id, kind, word, cast(rank() over (partition by kind order by word desc nulls last) as int) as word_rank
    from (select event_id, event_type as kind, case when event_type = 'view' then null else props end as word from events)""",
)
def rank_text_in_group(spark, folder):
    """By text, with a group in which every value is missing."""
    events = table(spark, folder, "events").select(
        "event_id", F.col("event_type").alias("kind"), F.when(F.col("event_type") != "view", F.col("props")).alias("word")
    )
    return ordered.rank_in_group(events, ["kind"], "word", "word_rank", ranges=20)


ROLLING_SQL = f"""select l_orderkey, l_linenumber, l_suppkey, l_shipdate, l_quantity, round(avg(l_quantity) over (partition by l_suppkey order by l_shipdate,
  {fp("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")} rows between 4 preceding and current row), 6) as rolling_quantity from lineitem"""


def _rolling(spark, folder, ranges=None):
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_shipdate").cast("timestamp").alias("l_shipdate"), "l_quantity"
    )
    tie = fingerprint("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    rolled = ordered.rolling_average(lines, ["l_suppkey"], "l_shipdate", "l_quantity", "rolling_quantity", 5, tie, ranges)
    return _rounded(rolled.drop("l_partkey").withColumn("l_shipdate", F.to_timestamp_ntz(F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"))), "rolling_quantity")


query("rolling_average", ROLLING_SQL)(_rolling)
query("rolling_average_chunked", ROLLING_SQL)(lambda spark, folder: _rolling(spark, folder, 50))


@query(
    "partition_average",
    "select event_id, event_type, value, round(avg(value) over (partition by event_type), 6) as type_average from events",
)
def partition_average(spark, folder):
    events = table(spark, folder, "events").select("event_id", "event_type", "value")
    return _rounded(ordered.partition_average(events, ["event_type"], "value", "type_average"), "type_average")


# --- cleaning steps ---------------------------------------------------------------

SENSOR_RULES = TableRules(
    table="event_readings",
    schema_version="event_readings_v1",
    required=("event_type", "reading"),
    unique_keys=("event_id",),
    integers=("user",),
    non_negative=("reading",),
    sort_keys=("event_type", "event_id"),
)


def readings(spark: SparkSession, folder: str) -> DataFrame:
    """Events with the defects cleaning must deal with: null tokens, infinities, negatives, bad numbers, blank rows."""
    e = spread(table(spark, folder, "events"))
    blank = F.col("event_type") == "signup"
    keep = lambda c: F.when(~blank | (F.col("value") < 100), c)
    reading = (
        F.when(F.col("value") < 1, F.lit(float("nan")))
        .when(F.col("value") < 2, F.lit(float("inf")))
        .when(F.col("value") < 3, -F.col("value"))
        .otherwise(F.col("value"))
    )
    return e.select(
        keep(F.col("event_id")).alias("Event ID"),
        keep(F.when(F.col("event_type") == "error", " N/A ").otherwise(F.concat(F.lit("\t"), "event_type"))).alias("Event Type"),
        keep(reading).alias("Reading"),
        keep(F.when(F.col("value") > 200, "abc").otherwise(F.col("user_id").cast("string"))).alias("User"),
    )


READINGS_SQL = f"""
raw as (select *, event_type = 'signup' and value >= 100 as is_blank from events),
cleaned as (
  select event_id, {clean("case when event_type = 'error' then ' N/A ' else chr(9) || event_type end")} as event_type,
    case when value < 3 then null else value end as reading, case when value > 200 then null else cast(user_id as int) end as "user"
  from raw where not is_blank)
"""


def cleaned_readings(spark, folder):
    return clean_structured(readings(spark, folder), SENSOR_RULES, DATE, "events")


@query(
    "quarantine_split_valid",
    f"""with {READINGS_SQL} select distinct event_id, event_type, reading, "user", 'landing-zone' as source_system, '2026-05-24T10:00:00+00:00' as ingestion_time,
    'events' as source_file_path, 'valid' as validation_status, 'event_readings_v1' as schema_version
    from cleaned where event_type is not null and reading is not null""",
)
def quarantine_split_valid(spark, folder):
    return cleaned_readings(spark, folder).valid


@query(
    "quarantine_split_rejected",
    f"""with {READINGS_SQL} select *, 'missing_required_values' as reason from cleaned where event_type is null or reading is null""",
)
def quarantine_split_rejected(spark, folder):
    return cleaned_readings(spark, folder).rejected


@query(
    "quarantine_event",
    f"""with {READINGS_SQL}, bad as (select count(*) as n from cleaned where event_type is null or reading is null)
    select 'event_readings' as dataset_name, 'structured' as domain, '2026-05-24T10:00:00+00:00' as logical_date, 'missing_required_values' as reason, n as rejected_record_count,
    'event_type,reading' as required_columns, cast(least(n, 5) as int) as samples, 'events' as source_file_path, 'rejected' as validation_status, 'trusted' as zone, 16 as event_id_length from bad where n > 0""",
)
def quarantine_event(spark, folder):
    return cleaned_readings(spark, folder).event().select(
        "dataset_name",
        "domain",
        "logical_date",
        "reason",
        "rejected_record_count",
        F.concat_ws(",", "required_columns").alias("required_columns"),
        F.size("sample_records").alias("samples"),
        "source_file_path",
        "validation_status",
        "zone",
        F.char_length("event_id").alias("event_id_length"),
    )


@query(
    "cleaning_audit",
    f"""with {READINGS_SQL}, n as (
      select (select count(*) from raw) as loaded, (select count(*) from cleaned) as not_empty,
        (select count(*) from cleaned where event_type is not null and reading is not null) as complete,
        (select count(*) from (select distinct * from cleaned where event_type is not null and reading is not null)) as kept)
    select 'event_readings' as "table", 1 as step_no, 'drop_empty_rows' as step, loaded as before_rows, not_empty as after_rows from n
    union all select 'event_readings', 2, 'quarantine_invalid_required_rows', not_empty, complete from n
    union all select 'event_readings', 3, 'deduplicate', complete, kept from n""",
)
def cleaning_audit(spark, folder):
    return cleaned_readings(spark, folder).audit()


DIRTY_SQL = "' ' || text || chr(9) || 'Decâ' || chr(128) || chr(147) || 'Jan 5 Â° c'"


@query("clean_strings", f"select doc_id, {clean(DIRTY_SQL)} as text, {clean('lang')} as lang from documents")
def clean_strings(spark, folder):
    dirty = F.concat(F.lit(" "), "text", F.lit("\tDecâ\u0080\u0093Jan 5 Â° c"))
    docs = table(spark, folder, "documents").select("doc_id", dirty.alias("text"), "lang")
    return docs.select("doc_id", text.tidy(F.col("text")).alias("text"), text.tidy(F.col("lang")).alias("lang")).select(
        "doc_id", text.null_tokens(F.col("text")).alias("text"), text.null_tokens(F.col("lang")).alias("lang")
    )


@query(
    "null_tokens",
    f"""with t as (select event_id, case event_type when 'error' then ' N/A' when 'click' then 'None ' when 'view' then '--' when 'signup' then 'C' else 'degrees  c' end as u from events)
    select event_id, {clean('u')} as token, case when lower({tidy('u')}) in ('', '-', '--', 'n/a', 'na', 'nan', 'none', 'null') then null
    when lower({tidy('u')}) in ('c', 'celsius', 'degree c', 'degrees c') then '°C' else {tidy('u')} end as unit from t""",
)
def null_tokens(spark, folder):
    kind = F.col("event_type")
    raw = F.when(kind == "error", " N/A").when(kind == "click", "None ").when(kind == "view", "--").when(kind == "signup", "C").otherwise("degrees  c")
    e = table(spark, folder, "events").select("event_id", text.tidy(raw).alias("u"))
    u = F.col("u")
    return e.select("event_id", text.null_tokens(u).alias("token"), text.null_tokens(u, text.celsius_unit(u)).alias("unit"))


@query(
    "mask_numeric",
    """with t as (select event_id, case when value < 1 then 'nan'::double when value < 2 then 'inf'::double when value < 3 then '-inf'::double else value - 5 end as v from events)
    select event_id, case when isnan(v) or isinf(v) then null else v end as finite_value, case when v < 0 then null else case when isnan(v) or isinf(v) then null else v end end as non_negative_value from t""",
)
def mask_numeric(spark, folder):
    v = F.col("value")
    bad = F.when(v < 1, float("nan")).when(v < 2, float("inf")).when(v < 3, float("-inf")).otherwise(v - 5)
    e = table(spark, folder, "events").select("event_id", numbers.finite(bad).alias("finite_value"))
    return e.select("*", numbers.non_negative(F.col("finite_value")).alias("non_negative_value"))


@query(
    "year_range",
    """with t as (select o_orderkey, case o_orderstatus when 'F' then year(o_orderdate) - 200 when 'P' then year(o_orderdate) + 200 else year(o_orderdate) end as y from orders)
    select o_orderkey, cast(case when y between 1900 and 2100 then y end as int) as year, try_cast(case when y > 2100 then 'later' else y::varchar end as int) as parsed from t""",
)
def year_range(spark, folder):
    status, y = F.col("o_orderstatus"), F.year("o_orderdate")
    shifted = F.when(status == "F", y - 200).when(status == "P", y + 200).otherwise(y)
    o = table(spark, folder, "orders").select("o_orderkey", shifted.alias("y"))
    text_year = F.when(F.col("y") > 2100, "later").otherwise(F.col("y").cast("string"))
    return o.select("o_orderkey", numbers.within(F.col("y"), 1900, 2100).alias("year"), text_year.try_cast("int").alias("parsed"))


@query(
    "fill_sort_keys",
    """select coalesce(case when o_orderpriority = '5-LOW' then null else o_orderpriority end, 'unknown') as priority,
    coalesce(case when o_orderstatus = 'P' then null else o_custkey end, 0) as custkey, coalesce(case when o_orderstatus = 'F' then null else o_totalprice end, 0) as price, o_orderkey from orders""",
)
def fill_sort_keys(spark, folder):
    o = table(spark, folder, "orders").select(
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("priority"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("custkey"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice")).alias("price"),
        "o_orderkey",
    )
    return rows.fill_keys(o, ["priority", "custkey", "price"])


@query("ratio_guard", "select l_orderkey, l_linenumber, l_partkey, case when l_discount = 0 then null else round(l_tax / l_discount, 6) end as tax_per_discount from lineitem")
def ratio_guard(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.round(numbers.ratio(F.col("l_tax"), F.col("l_discount")), 6).alias("tax_per_discount")
    )


@query("dedup_full", "select distinct * from (select * from documents union all select * from documents where doc_id % 3 = 0)")
def dedup_full(spark, folder):
    """Whole rows, a third of them stored twice."""
    d = table(spark, folder, "documents")
    return d.unionAll(d.filter("doc_id % 3 = 0")).dropDuplicates()


@query(
    "dedup_keyed",
    """select l_orderkey, l_linenumber, l_partkey, l_quantity from (select *, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity) as n from lineitem) where n = 1""",
)
def dedup_keyed(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return rows.keep_first(lines, ["l_orderkey"]).drop("l_suppkey")


@query("duplicate_keys", "select l_orderkey, l_linenumber, count(*) as n from lineitem group by all having count(*) > 1")
def duplicate_keys(spark, folder):
    return rows.duplicate_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("latest_row", f"select event_id, event_type, value from events order by ts desc, {fp('event_id', 'event_type', 'value')} limit 1")
def latest_row(spark, folder):
    return rows.latest(table(spark, folder, "events").select("event_id", "event_type", "value", "ts"), "ts").drop("ts")


@query("status_histogram", "select o_orderpriority, o_orderstatus, count(*) as n from orders group by all order by 1, 2")
def status_histogram(spark, folder):
    return rows.histogram(table(spark, folder, "orders"), "o_orderpriority", "o_orderstatus").orderBy("o_orderpriority", "o_orderstatus")


@query(
    "top_rows",
    "select lang, source, n from (select lang, source, count(*) as n from documents group by all) order by n desc, lang, source limit 10",
)
def top_rows(spark, folder):
    return rows.histogram(table(spark, folder, "documents"), "lang", "source").orderBy(F.col("n").desc(), "lang", "source").limit(10)
