"""Physical layouts and catalogue statistics over the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import sharedfs
from ..sources import layout, statistics, tables
from .registry import query, table

# Small, so that the test tables already have several files and buckets, and keys dealt over pieces.
ROWS_PER_FILE = 1 << 14
ROWS_PER_BUCKET = 1 << 14


def _named(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex}"


@query(
    "range_layout",
    """select count(*) as n, count(*) filter (where l_shipdate >= timestamp '1996-01-01' and l_shipdate < timestamp '1997-01-01') as matched,
      coalesce(sum(l_quantity) filter (where l_shipdate >= timestamp '1996-01-01' and l_shipdate < timestamp '1997-01-01'), 0)::bigint as quantity,
      true as sorted_apart from lineitem""",
)
def range_layout(spark, folder):
    """Line items in files by ship date: a year is a run of whole files and at most two others."""
    path = sharedfs.new_folder(spark, "ranges")
    layout.write_ranges(table(spark, folder, "lineitem"), path, ["l_shipdate"], ROWS_PER_FILE)
    stored = spark.read.parquet(path)
    low, high = (F.lit(day).cast("timestamp") for day in ("1996-01-01", "1997-01-01"))
    year = stored.where((F.col("l_shipdate") >= low) & (F.col("l_shipdate") < high))
    read = year.agg(F.count("*").alias("matched"), F.coalesce(F.sum("l_quantity"), F.lit(0)).cast("long").alias("quantity"))
    ranges = layout.file_ranges(stored, "l_shipdate")
    within = layout.files_within(ranges, low, high).select((F.col("partly") <= 2).alias("sorted_apart"))
    # Three frames of one row each.
    return ranges.agg(F.sum("rows").alias("n")).join(read, F.lit(True)).join(within, F.lit(True))


@query(
    "bucketed_star",
    """select p_brand, l_returnflag, count(*) as n, sum(l_quantity)::bigint as quantity, max(p_retailprice) as dearest
      from lineitem join part on l_partkey = p_partkey group by 1, 2""",
)
def bucketed_star(spark, folder):
    """Line items and parts bucketed by part, joined where they lie."""
    lines = table(spark, folder, "lineitem").withColumnRenamed("l_partkey", "partkey")
    parts = table(spark, folder, "part").withColumnRenamed("p_partkey", "partkey")
    pair = layout.store_pair(lines, parts, ["partkey"], _named("parts"), ROWS_PER_BUCKET)
    sums = (F.count("*").alias("n"), F.sum("l_quantity").cast("long").alias("quantity"), F.max("p_retailprice").alias("dearest"))
    return pair.join(spark).groupBy("p_brand", "l_returnflag").agg(*sums)


@query(
    "bucketed_hot_key",
    """with f as (select case when l_linenumber <= 3 then 1 when l_linenumber = 4 then null else l_partkey end as partkey, l_quantity from lineitem)
      select p_brand, count(*) as n, sum(l_quantity)::bigint as quantity from f left join part on partkey = p_partkey group by 1""",
)
def bucketed_hot_key(spark, folder):
    """As before, with a key that half of the rows have, and a left join that keeps rows without one."""
    number = F.col("l_linenumber")
    key = F.when(number <= 3, F.lit(1).cast("long")).when(number == 4, F.lit(None)).otherwise(F.col("l_partkey"))
    lines = table(spark, folder, "lineitem").select(key.alias("partkey"), "l_quantity")
    parts = table(spark, folder, "part").select(F.col("p_partkey").alias("partkey"), "p_brand")
    pair = layout.store_pair(lines, parts, ["partkey"], _named("hot_parts"), ROWS_PER_BUCKET)
    return pair.join(spark, "left").groupBy("p_brand").agg(F.count("*").alias("n"), F.sum("l_quantity").cast("long").alias("quantity"))


def _column_sql(name: str, kind: str, bounds: bool = True) -> str:
    low, high = (f"min({name})::varchar", f"max({name})::varchar") if bounds else ("null::varchar", "null::varchar")
    return f'select \'{name}\' as "column", \'{kind}\' as type, count(*) as rows, count(*) - count({name}) as nulls, {low} as least, {high} as greatest from o'


@query(
    "catalogue_statistics",
    "with o as (select o_orderkey, o_custkey, o_orderdate::date as order_day, o_orderstatus, 'orders' as source_system from orders) "
    + " union all ".join(
        [
            _column_sql("o_orderkey", "bigint"),
            _column_sql("o_custkey", "bigint"),
            _column_sql("order_day", "date"),
            _column_sql("o_orderstatus", "string", False),
            _column_sql("source_system", "string", False),
        ]
    ),
)
def catalogue_statistics(spark, folder):
    """A table made from a query with a column of metadata, and what the catalogue then knows of it."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("order_day"), "o_orderstatus")
    name = _named("orders")
    tables.create_table_as(orders, name, {"source_system": F.lit("orders")}, ["order_day"], sharedfs.new_folder(spark, name))
    statistics.analyze(spark, name)
    return statistics.statistics(spark, name).drop("bytes", "distinct_about")
