"""File catalogues: technical metadata of images and JSON files."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import logicaldate
from ..functions.imagebytes import image_facts
from ..functions.labels import OWNER, RETENTION, STEWARD
from ..functions.times import file_epoch
from ..operators.rows import computed_once
from .documents import line_shapes, read_payloads, starts_with, well_formed

# Columns of a landing catalogue row, in order.
CATALOGUE_COLUMNS = (
    "file_id",
    "source_type",
    "file_path",
    "file_type",
    "event_time",
    "record_count",
    "metadata_blob",
    "processed_at",
    "source_system",
    "ingestion_time",
    "source_file_path",
    "validation_status",
    "schema_version",
    "owner",
    "data_steward",
    "data_classification",
    "pii_flag",
    "retention_policy",
)
LANDING_VERSION = "landing_file_catalog_v1"
CATALOGUE_DEFAULTS = {
    "validation_status": "valid",
    "schema_version": LANDING_VERSION,
    "owner": OWNER,
    "data_steward": STEWARD,
    "pii_flag": "no_direct_pii",
    "retention_policy": RETENTION,
}


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def normalize_catalogue(df: DataFrame, date) -> DataFrame:
    """Every catalogue column present, filled and in fixed order."""
    stamp = F.lit(logicaldate.iso(date)).cast("timestamp")

    def column(name: str) -> Column:
        present = F.col(name) if name in df.columns else F.lit(None)
        if name == "record_count":
            return F.coalesce(present.cast("long"), F.lit(0).cast("long"))
        if name == "processed_at":
            return F.coalesce(present.try_cast("timestamp"), stamp)
        if name == "event_time":
            return present.cast("timestamp")
        text = F.coalesce(present.cast("string"), F.lit(""))
        default = CATALOGUE_DEFAULTS.get(name)
        return text if default is None else F.when(text == "", default).otherwise(text)

    return df.select(*[column(c).alias(c) for c in CATALOGUE_COLUMNS])


# Paths that a reader is given one by one; more new files are found again by their time.
MAX_PATHS = 10_000


@dataclass(frozen=True)
class NewFiles:
    """Files a catalogue lacks: ``rows`` (path, file_path, changed), and what to read to see them.

    ``paths`` names each where there are at most ``MAX_PATHS``; else it is the folder, and files older
    than ``since``, the time of the oldest new one, are left out before they are opened.
    """

    rows: DataFrame
    paths: str | list[str]
    since: datetime | None

    def of(self, found: DataFrame, key: str) -> DataFrame:
        """The rows of ``found`` that are of new files."""
        if isinstance(self.paths, list):
            return found if self.paths else found.limit(0)
        return found.join(self.rows.select(F.col(key).alias("__new")), F.col(key) == F.col("__new"), "left_semi")


def listing(spark: SparkSession, path: str) -> DataFrame:
    """One row per non-empty file: path, file_path (as scans name it), changed. No file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).filter("length > 0")
    return files.select("path", F.col("_metadata.file_path").alias("file_path"), F.col("modificationTime").alias("changed"))


def new_files(spark: SparkSession, path: str, catalogue: DataFrame | None, key: str) -> NewFiles:
    """Files below a folder whose ``key`` (path or file_path) the catalogue's ``file_path`` lacks."""
    listed = listing(spark, path)
    rows = listed if catalogue is None else listed.join(catalogue.select(F.col("file_path").alias("__done")), F.col(key) == F.col("__done"), "left_anti")
    some = rows.select("path").limit(MAX_PATHS + 1).collect()
    if len(some) <= MAX_PATHS:
        return NewFiles(rows, sorted(r["path"] for r in some), None)
    return NewFiles(rows, path, rows.agg(F.min("changed")).first()[0])


def image_metadata(spark: SparkSession, paths: str | list[str], since: datetime | None = None) -> DataFrame:
    """Size, digest and dimensions per image, from one read; what isn't a readable image is marked corrupted."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths).filter("length > 0")
    if since is not None:
        raw = raw.filter(F.col("modificationTime") >= F.lit(since))
    # Only the digest and the dimensions leave the task that read the bytes.
    once = computed_once(raw, "facts", image_facts(F.col("content")))
    files = once.select(F.col("path").alias("file_path"), F.col("length").alias("file_size_bytes"), F.md5("content").alias("md5"), "facts")
    width, height, channels = (F.col(f"facts.{c}") for c in ("width", "height", "channels"))
    readable = F.coalesce((width > 0) & (height > 0) & channels.isNotNull(), F.lit(False))
    mode = F.when(channels == 1, "L").when(channels == 3, "RGB").when(channels == 4, "RGBA")
    return files.select(
        "file_path",
        "file_size_bytes",
        "md5",
        F.when(readable, width).otherwise(0).alias("width"),
        F.when(readable, height).otherwise(0).alias("height"),
        F.when(readable, F.round(width / height, 2)).alias("aspect_ratio"),
        F.when(readable, mode).alias("image_mode"),
        (~readable).alias("is_corrupted"),
    )


def profile_images(spark: SparkSession, path: str, date, catalogue: DataFrame | None = None, labels: DataFrame | None = None) -> DataFrame:
    """Landing catalogue rows for images not yet catalogued; only these are read.

    ``labels`` may add ``label``, ``url`` and ``source`` per ``file_path``.
    """
    todo = new_files(spark, path, catalogue, "path")
    found = image_metadata(spark, todo.paths or path, todo.since).withColumnRenamed("file_path", "path")
    found = todo.of(found, "path").withColumnRenamed("path", "file_path")
    if labels is not None:
        found = found.join(labels, "file_path", "left")
    optional = lambda name: F.col(name) if name in found.columns else F.lit(None).cast("string")
    blob = F.to_json(
        F.struct(
            optional("label").alias("label"),
            optional("url").alias("url"),
            "file_size_bytes",
            F.lit("image").alias("content_type"),
            "width",
            "height",
            "aspect_ratio",
            "image_mode",
            "is_corrupted",
            "md5",
        ),
        {"ignoreNullFields": "false"},
    )
    rows = found.select(
        file_name(F.col("file_path")).alias("file_id"),
        optional("source").alias("source_type"),
        "file_path",
        F.lit("Image").alias("file_type"),
        file_epoch(file_name(F.col("file_path")), date).alias("event_time"),
        F.lit(1).alias("record_count"),
        blob.alias("metadata_blob"),
        F.coalesce(optional("source"), F.lit("landing-zone")).alias("source_system"),
        F.lit(logicaldate.iso(date)).alias("ingestion_time"),
        F.col("file_path").alias("source_file_path"),
        F.lit("public_image_metadata").alias("data_classification"),
    )
    return normalize_catalogue(rows, date)


def nesting_level(payload: Column) -> Column:
    """Lists around the first value; an empty list does not count."""
    opening = F.regexp_extract(payload, r"^([\s\[]*)", 1)
    depth = F.regexp_count(opening, F.lit(r"\["))
    empty = F.startswith(F.substring(payload, F.char_length(opening) + 1, F.lit(1)), F.lit("]"))
    return depth - empty.cast("int")


def _flat_records(payload: Column, level: Column) -> Column:
    """Values that remain when lists within lists are spread down to ``level``.

    One walk over the brackets and values outside strings, with a state of three numbers, so
    that neither the plan nor the memory depends on the depth.
    """
    bare = F.regexp_replace(payload, r'"(?:[^"\\]|\\.)*"', "0")
    tokens = F.regexp_extract_all(bare, F.lit(r"[\[\]{}]|[^\[\]{},:\s]+"), F.lit(0))
    long = lambda n: F.lit(n).cast("long")
    start = F.struct(long(0).alias("lists"), long(0).alias("objects"), long(0).alias("found"))

    def step(s: Column, t: Column) -> Column:
        lists, objects, found = s["lists"], s["objects"], s["found"]
        inside = (objects == 0) & (lists >= 1)
        counts = inside & F.when(t == "[", lists == level).otherwise((t != "]") & (t != "}") & (lists <= level))
        return F.struct(
            F.when((t == "[") & (objects == 0), lists + 1).when((t == "]") & (objects == 0), lists - 1).otherwise(lists).alias("lists"),
            F.when(t == "{", objects + 1).when(t == "}", objects - 1).otherwise(objects).alias("objects"),
            (found + counts.cast("long")).alias("found"),
        )

    return F.when(level == 0, 1).otherwise(F.aggregate(tokens, start, step, lambda s: s["found"]))


def json_shape(payloads: DataFrame) -> DataFrame:
    """Nesting level, keys of the first object and flattened record count per payload."""
    leveled = payloads.filter(well_formed(F.col("payload"))).withColumn("nesting_level", nesting_level(F.col("payload")))
    opening = F.regexp_extract("payload", r"^([\s\[]*)", 1)
    first = F.substring(F.col("payload"), F.char_length(opening) + 1, F.char_length("payload"))
    keys = F.when(starts_with(first, "{"), F.json_object_keys(first))
    size = F.col("bytes") if "bytes" in payloads.columns else F.octet_length("payload")
    return leveled.select(
        "source_file_path",
        "nesting_level",
        F.coalesce(keys, F.array().cast("array<string>")).alias("schema_keys"),
        _flat_records(F.col("payload"), F.col("nesting_level")).cast("long").alias("record_count"),
        size.cast("long").alias("file_size_bytes"),
    )


def profile_json_files(spark: SparkSession, path: str, topic: str, date, catalogue: DataFrame | None = None) -> DataFrame:
    """Landing catalogue rows for JSON files not yet catalogued: one per file, and only these are read."""
    known = None if catalogue is None else catalogue.filter("file_type = 'JSON'").select("file_path")
    todo = new_files(spark, path, known, "file_path")
    whole = read_payloads(spark, todo.paths or path, todo.since).filter("payload <> ''")
    lines = line_shapes(spark, todo.paths or path, todo.since)
    # A file of a single line is one payload, like any other.
    single = lines.filter("n = 1").select("source_file_path", F.col("first").alias("payload"), "bytes")
    many = lines.filter("n > 1 and bad = 0").select(
        "source_file_path",
        F.lit(0).alias("nesting_level"),
        F.coalesce(F.json_object_keys("first"), F.array().cast("array<string>")).alias("schema_keys"),
        F.col("n").alias("record_count"),
        F.col("bytes").cast("long").alias("file_size_bytes"),
    )
    shapes = json_shape(whole.unionByName(single)).unionByName(many).withColumnRenamed("source_file_path", "file_path")
    shapes = todo.of(shapes, "file_path")
    name = file_name(F.col("file_path"))
    rows = shapes.select(
        name.alias("file_id"),
        F.lit(topic).alias("source_type"),
        "file_path",
        F.lit("JSON").alias("file_type"),
        F.lit(logicaldate.iso(date)).alias("event_time"),
        "record_count",
        F.to_json(F.struct("nesting_level", "schema_keys", "file_size_bytes")).alias("metadata_blob"),
        F.lit("kafka").alias("source_system"),
        F.lit(logicaldate.iso(date)).alias("ingestion_time"),
        F.concat(F.lit(f"kafka://{topic}/"), name).alias("source_file_path"),
        F.lit("public_environmental_observation").alias("data_classification"),
    )
    return normalize_catalogue(rows, date)
