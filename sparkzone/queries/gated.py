"""Gates over good and bad rows of the given tables: which of them raise."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import sharedfs
from ..functions import names
from ..operators import gates
from ..sources import tables
from .registry import query, table


def _raised(gate, *args) -> bool:
    try:
        gate(*args)
    except gates.GateError:
        return True
    return False


@query(
    "gate_outcomes",
    """with n as (select count(*) as n from orders), k as (select count(*) - count(distinct o_custkey) as again from orders)
    select gate, rows_seen, raised from (
      select 'columns_present' as gate, n as rows_seen, false as raised from n union all select 'column_missing', n, true from n
      union all select 'rows_as_expected', n, false from n union all select 'rows_missing', n, true from n union all select 'shape', n, true from n
      union all select 'unique_keys', n, false from n union all select 'repeated_keys', n, again > 0 from n, k
      union all select 'not_empty', n, false from n union all select 'empty', n, true from n
      union all select 'clean_text', n, false from n union all select 'tab_in_text', n, true from n
      union all select 'files_there', n, false from n union all select 'files_missing', n, true from n union all select 'raw_folder', n, true from n
      union all select 'source_not_empty', n, false from n union all select 'source_empty', n, true from n)""",
)
def gate_outcomes(spark, folder):
    """Each run-time gate on rows that pass it and on rows that don't."""
    orders = table(spark, folder, "orders")
    seen = orders.count()
    root = sharedfs.new_folder(spark, "gates")
    orders.write.parquet(f"{root}/orders")
    none = orders.filter("o_orderkey is null")
    tabbed = orders.withColumn("o_orderstatus", F.concat("o_orderstatus", F.lit("\t")))
    outcomes = {
        "columns_present": _raised(gates.require_columns, orders, ["o_orderkey"], "orders"),
        "column_missing": _raised(gates.require_columns, orders, ["o_orderkey", "o_nothing"], "orders"),
        "rows_as_expected": _raised(gates.require_rows, orders, "orders", seen),
        "rows_missing": _raised(gates.require_rows, orders, "orders", seen + 1),
        "shape": _raised(gates.require_shape, orders, "orders", seen, 7),
        "unique_keys": _raised(gates.require_unique, orders, "orders", ["o_orderkey"]),
        "repeated_keys": _raised(gates.require_unique, orders, "orders", ["o_custkey"]),
        "not_empty": _raised(gates.require_not_empty, orders, "orders"),
        "empty": _raised(gates.require_not_empty, none, "orders"),
        "clean_text": _raised(gates.require_clean_text, orders, "orders"),
        "tab_in_text": _raised(gates.require_clean_text, tabbed, "orders"),
        "files_there": _raised(gates.require_paths, spark, [f"{root}/orders"]),
        "files_missing": _raised(gates.require_paths, spark, [f"{root}/orders", f"{root}/nothing"]),
        "raw_folder": _raised(gates.require_paths, spark, [f"{root}/raw"]),
        "source_not_empty": _raised(tables.read_not_empty, orders, "orders"),
        "source_empty": _raised(tables.read_not_empty, none, "orders"),
    }
    rows = spark.createDataFrame(list(outcomes.items()), "gate STRING, raised BOOLEAN")
    return rows.join(orders.agg(F.count("*").alias("rows_seen")), F.lit(True))


@query(
    "damaged_units",
    """select case when l_linenumber = 1 then 'Â°C' else 'â€“' end as unit, count(*) as n from lineitem where l_linenumber <= 2 group by 1""",
)
def damaged_units(spark, folder):
    """Unit texts that a wrong decoding has left, in the measures of line items."""
    number = F.col("l_linenumber")
    unit = F.when(number == 1, "Â°C").when(number == 2, "â€“").when(number == 3, "°C").when(number == 4, None).otherwise("%")
    return gates.damaged_units(table(spark, folder, "lineitem").select(unit.alias("unit")))


@query(
    "normalized_headers",
    """select count(*) as n, sum(l_orderkey)::bigint as id, sum(l_partkey)::bigint as id_3, sum(l_suppkey)::bigint as id_2, sum(l_linenumber)::bigint as engine_sizel, sum(l_quantity)::bigint as col_2nd_co2 from lineitem""",
)
def normalized_headers(spark, folder):
    """Headers with marks, repeats and digits in front, and the sums of their columns."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
    read = names.normalize_headers(lines.toDF("Tweet_ID", "ID", "id 2", "Engine Size(L)".replace(" Size", "_Size"), "2nd CO2"))
    return read.agg(F.count("*").alias("n"), *[F.sum(c).cast("long").alias(c) for c in read.columns])
