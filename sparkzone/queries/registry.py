"""Registry of queries and the small SQL vocabulary their oracles share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

DATE = "2026-05-24T10:00:00+00:00"
DAY = "20260524"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is omitted only where SQL cannot express it."""

    def register(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, folder)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql.strip()
        return fn

    return register


# --- SQL fragments -----------------------------------------------------------


def fp(*cols: str) -> str:
    """Row fingerprint."""
    parts = [f"coalesce(length(cast({c} as varchar)) || ':' || cast({c} as varchar), '<NULL>')" for c in cols]
    return f"md5(concat_ws(chr(31), {', '.join(parts)}))"


def tidy(c: str) -> str:
    """Whitespace, dashes, degree signs and control marks put right."""
    for pattern, to in (
        (r"[ \t\n\x0B\f\r]+", " "),
        ("â\\x{80}[\\x{93}\\x{94}]", "-"),
        ("(?i)[âÂ]\\s*[°º]\\s*c", "°C"),
        ("(?i)°\\s*c", "°C"),
        (r"[\x{00}-\x{08}\x{0B}\x{0C}\x{0E}-\x{1F}\x{7F}-\x{9F}]", ""),
    ):
        c = f"regexp_replace({c}, '{pattern}', '{to}', 'g')"
    return f"trim({c})"


TOKENS = "('', '-', '--', 'n/a', 'na', 'nan', 'none', 'null')"


def clean(c: str) -> str:
    low = f"lower({tidy(c)})"
    return f"case when {low} in {TOKENS} then null else {low} end"
