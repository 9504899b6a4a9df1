"""JSON documents from files, without a driver-side loop over records."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.rows import computed_once, once


@dataclass(frozen=True)
class Parsed:
    """``docs`` has one row per record (JSON text); ``malformed`` one per unreadable file."""

    docs: DataFrame
    malformed: DataFrame


END_MARK = "end-of-the-value"


def starts_with(c: Column, mark: str) -> Column:
    return F.startswith(F.ltrim(c), F.lit(mark))


def elements(c: Column) -> Column:
    """Elements of a JSON array as JSON texts; null if it is none."""
    return F.from_json(c, "array<string>")


def well_formed(c: Column) -> Column:
    """Whether the text is one JSON value and nothing else.

    Spark's parser stops after the first value, so the text is read as the first of two items: it is
    one value if the mark is the second.
    """
    pair = F.try_parse_json(F.concat(F.lit("["), c, F.lit(f',"{END_MARK}"]')))
    return F.coalesce(F.try_variant_get(pair, "$[1]", "string") == END_MARK, F.lit(False))


# A finished JSON file, or a part of a folder some job wrote under such a name. The name says
# how a file is read, whatever its size: ``.json`` is one text, ``.ndjson`` is lines.
WHOLE_FILE = r"\.json(/part-[^/]*)?$"
LINE_FILE = r"\.ndjson(/part-[^/]*)?$"
UNREADABLE = "invalid_json_payload"


def _text_files(spark: SparkSession, path: str | list[str], names: str, whole: bool, since: datetime | None = None) -> DataFrame:
    files = spark.read.option("recursiveFileLookup", True).text(path, wholetext=whole)
    # Conditions on file metadata prune the listing; rejected files are never opened.
    if since is not None:
        files = files.filter(F.col("_metadata.file_modification_time") >= F.lit(since))
    return (
        files.withColumn("source_file_path", F.col("_metadata.file_path"))
        .withColumn("bytes", F.col("_metadata.file_size"))
        .filter(F.col("source_file_path").rlike(names) & ~F.contains("source_file_path", F.lit("/_tmp/")))
    )


def read_payloads(spark: SparkSession, path: str | list[str], since: datetime | None = None) -> DataFrame:
    """Whole text of each finished ``.json`` file below a folder; a file is one value of one task."""
    return _text_files(spark, path, WHOLE_FILE, True, since).select(
        "source_file_path", F.regexp_replace("value", r"^\s+|\s+$", "").alias("payload"), "bytes"
    )


def _of_one_value(body: Column) -> Column:
    """Records of one well-formed JSON value; null if it is neither list nor object."""
    return F.when(starts_with(body, "["), elements(body)).when(starts_with(body, "{"), F.array(body))


def parse_payloads(payloads: DataFrame) -> Parsed:
    """A payload is an object, an array, or one JSON value per line; anything else rejects its file."""
    # Reading a payload may cost as much as parsing it, so the filter below must not repeat it.
    payloads = computed_once(payloads.select("source_file_path", F.col("payload").alias("__read")), "payload", F.col("__read")).drop("__read")
    body = F.col("payload")
    lines = F.filter(F.split(body, r"\r?\n"), lambda x: F.trim(x) != "")
    shaped = computed_once(payloads.filter(body != ""), "__whole", well_formed(body))
    by_line = F.when(~F.exists(lines, lambda x: ~well_formed(x)), lines)
    records = F.when(F.col("__whole"), _of_one_value(body)).otherwise(by_line)
    # An expression is exploded as it is; a column would be filtered first, which parses it again.
    return Parsed(
        shaped.select("source_file_path", F.explode(records).alias("record")),
        shaped.filter(records.isNull()).select("source_file_path", F.lit(UNREADABLE).alias("reason")),
    )


def _lines(spark: SparkSession, path: str | list[str], since: datetime | None = None) -> DataFrame:
    return _text_files(spark, path, LINE_FILE, False, since).filter(F.trim("value") != "").select("source_file_path", F.trim("value").alias("record"), "bytes")


def line_shapes(spark: SparkSession, path: str | list[str], since: datetime | None = None) -> DataFrame:
    """Per ``.ndjson`` file: lines ``n``, ``bad`` ones, ``first`` (the least text, the line itself if alone), size."""
    return _lines(spark, path, since).groupBy("source_file_path").agg(
        F.count_if(~well_formed(F.col("record"))).alias("bad"), F.count("*").alias("n"), F.min("record").alias("first"), F.max("bytes").alias("bytes")
    )


def read_lines(spark: SparkSession, path: str) -> Parsed:
    """``.ndjson`` files by line, so that one file is many tasks.

    One bad line rejects its whole file. A file of a single line is one value, as in ``parse_payloads``.
    """
    files = line_shapes(spark, path).withColumn("alone", F.col("n") == 1)
    readable = (F.col("bad") == 0) & (~F.col("alone") | F.substring("first", 1, 1).isin("[", "{"))
    kept = _lines(spark, path).join(files.filter(readable).select("source_file_path", "alone"), "source_file_path")
    records = F.when(F.col("alone"), _of_one_value(F.col("record"))).otherwise(F.array("record"))
    return Parsed(
        kept.select("source_file_path", F.explode(records).alias("record")),
        files.filter(~readable).select("source_file_path", F.lit(UNREADABLE).alias("reason")),
    )


def parse_documents(spark: SparkSession, path: str) -> Parsed:
    whole, lines = parse_payloads(read_payloads(spark, path)), read_lines(spark, path)
    return Parsed(whole.docs.unionByName(lines.docs), whole.malformed.unionByName(lines.malformed))


def flatten_snapshots(docs: DataFrame, col: str = "record") -> DataFrame:
    """One row per station from an object, a list of objects or a list of lists."""
    record = F.col(col)

    def listed(items: Column) -> Column:
        nested = F.flatten(F.transform(items, lambda x: F.when(starts_with(x, "["), elements(x)).otherwise(F.array(x))))
        stations = F.when(starts_with(F.get(items, F.lit(0)), "["), nested).otherwise(items)
        return F.filter(stations, lambda x: starts_with(x, "{"))

    stations = F.when(starts_with(record, "{"), F.array(record)).when(starts_with(record, "["), once(elements(record), listed))
    others = [c for c in docs.columns if c != col]
    return docs.select(*others, F.explode(stations).alias(col))
