"""Statistics of catalogue tables: gathered once by a job, read from the catalogue from then on."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import BinaryType, BooleanType, DateType, NumericType, StringType, TimestampType

MEASURED = (NumericType, DateType, TimestampType, BooleanType, StringType, BinaryType)
SCHEMA = "column STRING, type STRING, rows BIGINT, bytes BIGINT, nulls BIGINT, distinct_about BIGINT, least STRING, greatest STRING"


def analyze(spark: SparkSession, table: str) -> None:
    """Gather rows, bytes and the statistics of all columns that can have them."""
    columns = [f.name for f in spark.table(table).schema.fields if isinstance(f.dataType, MEASURED)]
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")
    if columns:
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {', '.join(_quoted(c) for c in columns)}")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _described(spark: SparkSession, what: str) -> dict[str, str | None]:
    # Metadata: a row per property.
    return {r[0]: None if r[1] == "NULL" else r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {what}").collect()}


def statistics(spark: SparkSession, table: str) -> DataFrame:
    """A row per column, from the catalogue alone; the table's rows aren't read.

    Bounds are the catalogue's texts of numbers, days and times (UTC); texts have none. Distinct
    counts are estimates. Where ``analyze`` did not run, or a column can't be measured, they are null.
    """
    whole = next((v for k, v in _described(spark, table).items() if k == "Statistics"), None) or ""
    size, count = (re.search(p, whole) for p in (r"(\d+) bytes", r"(\d+) rows"))
    found = []
    for field in spark.table(table).schema.fields:
        about = _described(spark, f"{table} {_quoted(field.name)}") if isinstance(field.dataType, MEASURED) else {}
        number = lambda key: None if about.get(key) is None else int(about[key])  # noqa: B023, E731
        bounds = (about.get("min"), about.get("max"))
        found.append(
            (field.name, field.dataType.simpleString(), count and int(count[1]), size and int(size[1]), number("num_nulls"), number("distinct_count"), *bounds)
        )
    return spark.createDataFrame(found, SCHEMA)
