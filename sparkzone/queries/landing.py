"""CSV landing, integrity proofs and routing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from .. import sharedfs
from ..functions import names, text
from ..functions.keys import fingerprint
from ..operators import integrity, signatures, sketches
from ..operators.joins import null_safe_join
from ..plans import landing
from ..sources import tables
from .registry import DATE, fp, query, table


ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "cents", "day")
ORDERS_SQL = "(select o_orderkey, o_custkey, o_orderstatus, o_orderpriority, cast(round(o_totalprice * 100) as bigint) as cents, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as day from orders)"


def whole_orders(spark, folder):
    """All columns of orders; prices and times as texts that engines write alike."""
    o = table(spark, folder, "orders")
    return o.select(*ORDER_COLUMNS[:4], F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("day"))


@query("row_fingerprint", f"select {fp(*ORDER_COLUMNS)} as row_hash, count(*) as n from {ORDERS_SQL} group by 1")
def row_fingerprint(spark, folder):
    return integrity.row_counts(whole_orders(spark, folder), list(ORDER_COLUMNS))


DOC_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
DIFF_SQL = f"""
with a as (select {fp(*DOC_COLUMNS)} as h, count(*) as n from (select * from documents union all select * from documents where source = 'src1') group by 1),
b as (select {fp(*DOC_COLUMNS)} as h, count(*) as n from (select * replace (case source when 'src2' then null else source end as source) from documents) group by 1)
select 'left' as side, h as row_hash, n from (select * from a except all select * from b) union all select 'right', h, n from (select * from b except all select * from a)
"""


@query("row_fingerprint_diff", DIFF_SQL)
def row_fingerprint_diff(spark, folder):
    """A table with doubled rows against one with edited rows, all columns compared."""
    d = table(spark, folder, "documents").select(*DOC_COLUMNS)
    left = d.unionAll(d.filter("source = 'src1'"))
    right = d.withColumn("source", F.when(F.col("source") != "src2", F.col("source")))
    return integrity.diff_tables(left, right)


@query("table_signature", "select true as same_rows, false as edited_rows, count(*) as row_count from orders")
def table_signature(spark, folder):
    """The signature of whole rows ignores their order and notices an edit."""
    o = whole_orders(spark, folder)
    edited = o.withColumn("cents", F.when(F.col("o_orderstatus") == "P", F.col("cents") + 1).otherwise(F.col("cents")))
    sign = lambda df: integrity.table_signature(df).select("signature").scalar()
    own = integrity.table_signature(o)
    return own.select(
        (F.col("signature") == sign(o.repartition("o_custkey"))).alias("same_rows"), (F.col("signature") == sign(edited)).alias("edited_rows"), "row_count"
    )


@query(
    "csv_mixed_headers",
    """select o_orderstatus, count(*) as n, cast(sum(o_orderkey) as bigint) as keys, cast(sum(o_custkey) as bigint) as customers, round(sum(case when o_orderstatus <> 'P' then o_totalprice end), 2) as price
    from orders group by 1""",
)
def csv_mixed_headers(spark, folder):
    """Files with two orders of columns, one of them lacking one."""
    root = sharedfs.new_folder(spark, "headers")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    turned = orders.select("o_totalprice", "o_orderstatus", "o_custkey", "o_orderkey")
    for part in (orders.filter("o_orderstatus = 'F'"), turned.filter("o_orderstatus = 'O'"), orders.drop("o_totalprice").filter("o_orderstatus = 'P'")):
        part.coalesce(1).write.mode("append").option("header", True).csv(f"{root}/raw")
    read = tables.read_raw_csv(spark, f"{root}/raw")
    return read.groupBy("o_orderstatus").agg(
        F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"), F.sum("o_custkey").alias("customers"), F.round(F.sum("o_totalprice"), 2).alias("price")
    )


@query(
    "csv_landing",
    """select o_orderstatus, count(*) as n, cast(sum(o_orderkey) as bigint) as keys, round(sum(o_totalprice), 2) as price, min(o_orderdate) as first_date from orders group by 1""",
)
def csv_landing(spark, folder):
    """Written as CSV, landed with inferred types, proven equal, and summed up."""
    root = sharedfs.new_folder(spark, "csv")
    orders = table(spark, folder, "orders").withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    orders.write.option("header", True).csv(f"{root}/raw")
    landing.land_csv(spark, f"{root}/raw", f"{root}/table", "orders", expected_columns=6)
    landed = tables.read_table(spark, f"{root}/table")
    return landed.groupBy("o_orderstatus").agg(
        F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"), F.round(F.sum("o_totalprice"), 2).alias("price"),
        F.min("o_orderdate").cast("timestamp_ntz").alias("first_date"),
    )


@query("replace_partition", "select case when o_orderstatus = 'F' then 'F' else o_orderstatus end as status, count(*) * case when o_orderstatus = 'F' then 2 else 1 end as n from orders group by o_orderstatus")
def replace_partition(spark, folder):
    """A second write replaces only the partition it contains."""
    path = sharedfs.new_folder(spark, "days")
    rows = table(spark, folder, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"))
    tables.replace_partitions(rows, path, "status")
    again = rows.filter("status = 'F'")
    tables.replace_partitions(again.unionAll(again), path, "status")
    return spark.read.parquet(path).groupBy("status").agg(F.count("*").alias("n"))


@query("append_merge", "select count(*) as n, count(*) filter (o_orderstatus = 'F') as extra from (select o_orderstatus from orders)")
def append_merge(spark, folder):
    """An appended batch may bring a new column."""
    path = sharedfs.new_folder(spark, "merge")
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    tables.append(rows.filter("o_orderstatus <> 'F'"), path)
    tables.append(rows.filter("o_orderstatus = 'F'").withColumn("extra", F.lit("x")), path)
    return tables.read_table(spark, path, merge_schema=True).agg(F.count("*").alias("n"), F.count("extra").alias("extra"))


@query("pending_files", "select page_id, url as path from pages where not contains(url, '/en/') and length(html) > 1000")
def pending_files(spark, folder):
    """Files of some size that no earlier run has marked as processed."""
    manifest = sharedfs.new_folder(spark, "manifest")
    files = table(spark, folder, "pages").select("page_id", F.col("url").alias("path"), F.when(F.char_length("html") > 1000, F.char_length("html")).otherwise(0).alias("length"))
    tables.mark_processed(files.filter(F.contains("path", F.lit("/en/"))), manifest)
    return tables.pending(spark, files, manifest).select("page_id", "path")


@query(
    "page_route",
    r"""with m as (select page_id, url as path, case when contains(url, '/fr/') then 'image/png' when contains(url, '/de/') then 'application/json' else 'text/csv' end as content_type from pages),
    p as (select *, case when content_type like 'image/%' then 'image' when content_type = 'application/json' then 'semistructured' else 'structured' end as category,
      regexp_replace(regexp_extract(case when content_type = 'text/csv' then 'Report ' || page_id || '.csv' else path end, '([^/]*)$', 1), '([^.])\.[^.]*$', '\1') as stem, regexp_extract(list_extract(string_split(path, '.'), -1), '^([^?]*)', 1) as ext from m)
    select page_id, category, 'persistent-landing/' || case category when 'structured' then 'structured/raw/' when 'image' then 'unstructured/image/' else 'semistructured/20260524/' end || stem || '_1779616800000.' || ext as destination from p""",
)
def page_route(spark, folder):
    url = F.col("url")
    kind = F.when(F.contains(url, F.lit("/fr/")), "image/png").when(F.contains(url, F.lit("/de/")), "application/json").otherwise("text/csv")
    manifest = table(spark, folder, "pages").select(
        "page_id",
        url.alias("path"),
        kind.alias("content_type"),
        F.concat(F.lit("Report "), F.col("page_id").cast("string"), F.lit(".csv")).alias("landing_name"),
        F.char_length("html").alias("length"),
    )
    return landing.route(manifest, DATE, "persistent-landing/").select("page_id", "category", "destination")


@query(
    "uri_parts",
    "select page_id, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/?#]*)', 1) as bucket, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*/*([^?#]*)', 1) as key from pages",
)
def uri_parts(spark, folder):
    return table(spark, folder, "pages").select("page_id", text.uri_bucket(F.col("url")).alias("bucket"), text.uri_key(F.col("url")).alias("key"))


@query("row_key_nulls", f"select l_orderkey, l_linenumber, {fp('a', 'b')} as key from (select *, case when l_returnflag = 'A' then null else l_returnflag end as a, case when l_linestatus = 'F' then null else l_linestatus end as b from lineitem)")
def row_key_nulls(spark, folder):
    """A null on the left and one on the right give different keys."""
    flag = F.when(F.col("l_returnflag") != "A", F.col("l_returnflag"))
    status = F.when(F.col("l_linestatus") != "F", F.col("l_linestatus"))
    return table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", fingerprint(flag, status).alias("key"))


SIGNED = ("l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate")
SIGNED_SQL = "l_orderkey", "l_linenumber", "l_returnflag", "strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')"
SUMS_SQL = """count(*) as rows, sum(('0x' || digest[1:15])::bigint)::varchar as sum_high, sum(('0x' || digest[17:31])::bigint)::varchar as sum_low"""


@query(
    "signature_after_append",
    f"""with d as (select l_returnflag, {fp(*SIGNED_SQL)} as digest from lineitem),
    twice as (select digest from d union all select digest from d where l_returnflag = 'N')
    select {SUMS_SQL}, (select count(*) from d where l_returnflag = 'R') as appended, (select count(*) from d where l_returnflag = 'N') * 2 as replaced from twice""",
)
def signature_after_append(spark, folder):
    """Signatures kept per file, brought up to date after an append and after a replaced partition, equal a full recount.

    ``appended`` and ``replaced`` are the rows that each of the two updates read.
    """
    root = sharedfs.new_folder(spark, "signed")
    rows = table(spark, folder, "lineitem").select(*SIGNED[:3], F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("l_shipdate"))
    sign = lambda: signatures.refresh(spark, f"{root}/table", f"{root}/state", SIGNED)
    tables.replace_partitions(rows.where("l_returnflag <> 'R'"), f"{root}/table", "l_returnflag")
    sign()
    tables.append(rows.where("l_returnflag = 'R'"), f"{root}/table", ["l_returnflag"])
    appended = sign()
    again = rows.where("l_returnflag = 'N'")
    tables.replace_partitions(again.unionAll(again), f"{root}/table", "l_returnflag")
    replaced = sign()
    read = lambda state: state.agg(F.coalesce(F.sum(F.when(F.col("read"), F.col("rows"))), F.lit(0))).scalar()
    sums = [F.col(c).cast("string").alias(c) for c in signatures.SUMS[1:]]
    return signatures.merged(replaced).select("rows", *sums, read(appended).alias("appended"), read(replaced).alias("replaced"))


@query(
    "distinct_users",
    """with e as (select strftime(ts, '%Y-%m') as month, user_id from events)
    select month, count(distinct user_id) as users, true as within from e group by 1 union all select null, count(distinct user_id), true from e""",
)
def distinct_users(spark, folder):
    """Exact distinct users per month and of all months, each beside an estimate from stored sketches per day.

    One day is counted anew and only its sketch is replaced; months and the total are unions of sketches.
    """
    root = sharedfs.new_folder(spark, "sketches")
    days = table(spark, folder, "events").select("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    tables.replace_partitions(sketches.distinct_sketches(days, ["day"], "user_id"), root, "day")
    again = days.where(F.col("day") == days.agg(F.min("day")).scalar())
    tables.replace_partitions(sketches.distinct_sketches(again, ["day"], "user_id"), root, "day")
    stored = spark.read.schema("sketch BINARY, day STRING").parquet(root).withColumn("month", F.substring("day", 1, 7))
    estimates = sketches.distinct_estimates(stored, ["month"]).unionByName(sketches.distinct_estimates(stored).withColumn("month", F.lit(None).cast("string")))
    months = days.withColumn("month", F.substring("day", 1, 7))
    exact = months.groupBy("month").agg(F.count_distinct("user_id").alias("users")).unionByName(
        months.agg(F.count_distinct("user_id").alias("users")).withColumn("month", F.lit(None).cast("string"))
    )
    off = F.abs(F.col("estimate") - F.col("users")) <= sketches.relative_error() * F.col("users")
    return null_safe_join(exact, estimates, ["month"]).select("month", "users", off.alias("within"))


@query(
    "csv_many_files",
    """select o_orderstatus, count(*) as n, cast(sum(o_orderkey) as bigint) as keys, cast(sum(o_custkey) as bigint) as customers, round(sum(case when o_orderstatus <> 'P' then o_totalprice end), 2) as price
    from orders group by 1""",
)
def csv_many_files(spark, folder):
    """Three headers over files of 100 rows each: all headers come from one job."""
    root = sharedfs.new_folder(spark, "files")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    turned = orders.select("o_totalprice", "o_orderstatus", "o_custkey", "o_orderkey")
    for part in (orders.filter("o_orderstatus = 'F'"), turned.filter("o_orderstatus = 'O'"), orders.drop("o_totalprice").filter("o_orderstatus = 'P'")):
        dealt = tables.spread_files(part, per_file=100)
        dealt.write.options(**tables.SMALL_FILES).mode("append").option("header", True).option("maxRecordsPerFile", 100).csv(f"{root}/raw")
    read = tables.read_raw_csv(spark, f"{root}/raw")
    return read.groupBy("o_orderstatus").agg(
        F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"), F.sum("o_custkey").alias("customers"), F.round(F.sum("o_totalprice"), 2).alias("price")
    )


# Folders as producers name them, and what each calls its measure; two of the names hold no data set.
LANDED = {
    "click": ("Click-Events_delta_1779580800000", "value"),
    "view": ("view_events_20260524T101500", "amount"),
    "purchase": ("purchase_events_17", "val"),
    "error": ("_staging", "value"),
    "signup": ("raw", "value"),
}


@query(
    "landed_datasets",
    """select case event_type when 'click' then 'click_events' when 'view' then 'view_events' else 'purchase_events' end as dataset,
      case event_type when 'click' then 'value' when 'view' then 'amount' else 'val' end as measure, count(*) as n, count(value) as measured, max(value) as greatest
      from events where event_type in ('click', 'view', 'purchase') group by all""",
)
def landed_datasets(spark, folder):
    """Data sets found below a landing folder, under stable names, whatever their producers call folder and measure."""
    root = sharedfs.new_folder(spark, "landing")
    events = table(spark, folder, "events")
    for kind, (name, measure) in LANDED.items():
        events.where(F.col("event_type") == kind).select("event_id", F.col("value").alias(measure)).write.parquet(f"{root}/{name}")
    parts = []
    for path in tables.discover_datasets(spark, root):
        rows = tables.read_table(spark, path)
        measure = names.pick_column(rows.columns, ("amount", "val", "value"))
        found = F.lit(names.table_name(path)).alias("dataset"), F.lit(measure).alias("measure")
        parts.append(rows.agg(F.count("*").alias("n"), F.count(measure).alias("measured"), F.max(measure).alias("greatest")).select(*found, "n", "measured", "greatest"))
    return reduce(DataFrame.unionByName, parts)
