"""Side-by-side run of a registered query and its SQL."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(round(value, 9) + 0.0)
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return str([_plain(v) for v in value])
    if value is None or isinstance(value, (bool, int, str)):
        return f"{type(value).__name__}:{value}"
    return f"{type(value).__name__}:{value}"


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql: str) -> str | None:
    """None if both agree, else what differs."""
    return compare_rows(spark_df.columns, [tuple(r) for r in spark_df.collect()], con, sql)


def compare_rows(mine_columns, mine, con, sql: str) -> str | None:
    cursor = con.execute(sql)
    oracle_columns = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    if sorted(mine_columns) != sorted(oracle_columns):
        return f"columns {sorted(mine_columns)} vs {sorted(oracle_columns)}"
    left, right = _rows(mine_columns, mine), _rows(oracle_columns, theirs)
    if left == right:
        return None
    names = sorted(mine_columns)
    only_left, only_right = list((left - right).items())[:2], list((right - left).items())[:2]
    return f"rows {len(mine)} vs {len(theirs)}; {names}; spark only {only_left}; sql only {only_right}"
