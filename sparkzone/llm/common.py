"""What the training-data operators share: readers, word rules and written cuts."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sharedfs import new_folder

# A word is a run of characters outside these six (fixed by the contracts).
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


# Rows that Spark hands to Python at once. Texts can be long, and a batch is held several
# times over: by Spark, by Arrow and as Python's own objects.
ROWS_AT_ONCE = 500


def for_python(frame: DataFrame) -> DataFrame:
    """The frame, whose session from now on hands rows to Python in small batches."""
    frame.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_AT_ONCE))
    return frame


def text_of(column: str = "text") -> Column:
    """A text with null read as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def id_text(column: str = "doc_id") -> Column:
    """A whole number as text: pandas reads a batch of numbers and nulls as floats, which change large ones."""
    return F.col(column).cast("string").alias(column)


def with_ids(rows: list[tuple], columns: list[str], ids: str = "doc_id") -> pd.DataFrame:
    """Rows as a frame whose ids, read by ``id_text``, are whole numbers or null again."""
    values = dict(zip(columns, zip(*rows) if rows else [()] * len(columns)))
    return pd.DataFrame({c: pd.array([None if x is None else int(x) for x in v], "Int64") if c == ids else list(v) for c, v in values.items()})


def written(frame: DataFrame, label: str) -> DataFrame:
    """The frame after a round through the folder all executors share.

    Lost executors cost nothing that was written, and later branches don't repeat the work.
    """
    spark = frame.sparkSession
    path = new_folder(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def free_name(columns: list[str], name: str) -> str:
    """``name``, with underscores before it until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name
