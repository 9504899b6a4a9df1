"""Table scans and table writes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StringType, StructType

from .. import sharedfs
from ..functions.names import is_dataset_folder
from ..operators.gates import GateError, require_columns, require_paths
from ..operators.rows import computed_once, once


def read_raw_csv(spark: SparkSession, path: str, encoding: str | None = None, multi_line: bool = False, schema: str | None = None) -> DataFrame:
    """CSV with header; columns go by each file's own header, and a file may lack some.

    Types are the narrowest that all values of all files have, found in one aggregation over
    the texts; ``schema`` (``name type, ...``) saves that pass, and a value that does not fit it
    is an error, never a null. A file read with ``multi_line`` is one task.

    Files are listed one by one, so ``year=...`` folders do not become columns. The headers of a
    few are read one after another, which opens their first block only; those of many in one job.
    A folder of more than ``MANY_FILES`` is scanned as one, and the driver never names its files; the
    texts are stored in the shared folder, as opening the files again for the types and for the rows
    costs more than the copy.
    """
    options = {"header": True, "encoding": encoding or "UTF-8", "multiLine": multi_line, "mode": "FAILFAST", "escape": '"'}
    many = not multi_line and sharedfs.count_entries(spark, path) > MANY_FILES
    text = _texts_of_folder(spark, path, options) if many else _texts_of_files(spark, path, options)
    if many and not schema:
        text = sharedfs.cut_lineage(text, "texts")
    kinds = {f.name: f.dataType.simpleString() for f in StructType.fromDDL(schema)} if schema else _probe_types(text)
    return text.select(*[F.col(f"`{n}`").cast(kinds.get(n, "string")).alias(n) for n in text.columns])


# Files whose headers are read one by one, and those that are named one by one.
FEW_FILES = 16
MANY_FILES = 1_000


def _texts_of_files(spark: SparkSession, path: str, options: dict) -> DataFrame:
    """Rows of files named one by one, all columns as texts."""
    files = sharedfs.data_files(spark, path)
    if not files:
        raise GateError(f"no CSV under {path}")
    # A reader is made for each use, as one keeps the schema it was given.
    reader = lambda: spark.read.options(**options)
    alike = _by_first_line(spark, files, options["encoding"]) if len(files) > FEW_FILES and not options["multiLine"] else [[f] for f in files]
    by_header: dict[tuple[str, ...], list[str]] = {}
    for group in alike:
        by_header.setdefault(tuple(reader().csv(group[0]).columns), []).extend(group)
    # A file of empty lines has neither columns nor rows.
    texts = [reader().schema(_string_schema(names)).csv(sorted(group)) for names, group in by_header.items() if names]
    if not texts:
        raise GateError(f"no header under {path}")
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), texts)


def _lines(spark: SparkSession, encoding: str, path: str | list[str], **options) -> DataFrame:
    """Lines as a CSV reader splits and decodes them, one value each."""
    # A separator that no text has and no quote; a line that has it all the same is kept whole by the last column.
    plain = {"sep": "\u0001", "quote": "", "escape": "\u0002", "encoding": encoding, "columnNameOfCorruptRecord": "whole"}
    return spark.read.options(**plain, **options).schema("line STRING, whole STRING").csv(path).withColumn("line", F.coalesce("whole", "line"))


def _texts_of_folder(spark: SparkSession, path: str, options: dict) -> DataFrame:
    """The same for a folder of many files, which are opened once and never named to the driver.

    One scan stores their lines with file and place. The first line of a file is its header; the driver sees
    each distinct one, and one file that has it. Lines meet their header by file, so a large file is many tasks.
    """
    folder, depth = sharedfs.folder_of(spark, path)
    at = F.col("_metadata")
    scanned = _lines(spark, options["encoding"], path, recursiveFileLookup=True).select(
        F.regexp_replace(at["file_path"], "^[^/]*:(//[^/]*)?", "").alias("path"), at["file_name"].alias("file"), at["file_block_start"].alias("start"), "line"
    )
    # Conditions on file metadata prune the listing. Files in folders below, and those named as hidden, are not of the table.
    own = scanned.where((F.regexp_count("path", F.lit("/")) == depth + 1) & ~F.substring("file", 1, 1).isin("_", "."))
    # A blank line is no row.
    filled = own.where(F.rlike("line", F.lit(r"[^\x00-\x20]"))).select("file", "start", F.monotonically_increasing_id().alias("nth"), "line")
    lines = sharedfs.cut_lineage(filled, "lines")
    first = lines.groupBy("file").agg(F.min_by(F.struct("line", "nth"), F.struct("start", "nth")).alias("top"))
    headers = first.groupBy("top.line").agg(F.min("file").alias("file")).orderBy("file").collect()
    if not headers:
        raise GateError(f"no CSV header under {path}")
    named = spark.conf.get("spark.sql.caseSensitive") == "true"
    spelled: dict[str, str] = {}
    by_header: dict[tuple[str, ...], list[str]] = {}
    for header in headers:
        # The reader names the columns, as it does for few files. Names in metadata are encoded.
        found = [f"{folder}/{name}" for name in (unquote(header["file"]), header["file"])]
        names = tuple(spark.read.options(**options).csv(found[0] if sharedfs.exists(spark, found[0]) else found[1]).columns)
        by_header.setdefault(names, []).append(header["line"])
        for name in names:
            spelled.setdefault(name if named else name.lower(), name)

    def texts(names: tuple[str, ...]) -> Column:
        own = {(n if named else n.lower()): n for n in names}
        row = lambda read: F.struct(*[(read[own[k]] if k in own else F.lit(None).cast("string")).alias(n) for k, n in spelled.items()])
        return once(F.from_csv("line", _string_schema(names), {k: options[k] for k in ("mode", "escape")}), row)

    # One pass over the lines, whatever the number of headers: a line is parsed by its own.
    by = [(F.col("top.line").isin(same), texts(names)) for names, same in by_header.items()]
    parsed = reduce(lambda made, case: made.when(*case), by[1:], F.when(*by[0]))
    rows = lines.join(first, "file").where(F.col("nth") != F.col("top.nth"))
    return computed_once(rows, "row", parsed).select("row.*")


def _by_first_line(spark: SparkSession, files: list[str], encoding: str) -> list[list[str]]:
    """Files of one folder in groups that start with the same line, found in one job.

    What returns is the listing itself, in groups: a header line is one row, however many files have it.
    """
    lines = _lines(spark, encoding, files)
    at = F.col("_metadata")
    starts = lines.select("line", at["file_name"].alias("file"), at["file_block_start"].alias("start"), F.monotonically_increasing_id().alias("nth"))
    first = starts.where("start = 0 and trim(line) <> ''").groupBy("file").agg(F.min_by("line", "nth").alias("line"))
    groups = first.groupBy("line").agg(F.collect_list("file").alias("files")).collect()
    named = {f.rsplit("/", 1)[-1]: f for f in files}
    # In the order of their first files, which is that of the columns.
    found = sorted(sorted(named[unquote(name) if unquote(name) in named else name] for name in g["files"]) for g in groups)
    # A file of empty lines has none; it is read like any other.
    seen = {f for group in found for f in group}
    return found + [[f] for f in files if f not in seen]


def _string_schema(names: Sequence[str]) -> str:
    return ", ".join(f"`{n}` STRING" for n in names)


def _probe_types(text: DataFrame) -> dict[str, str]:
    """Narrowest type that every value of a column has, in one aggregation over all rows."""
    kinds = ("bigint", "double", "boolean", "timestamp")
    quoted = [F.col(f"`{c}`") for c in text.columns]
    fits = text.agg(
        *[
            F.struct(*[F.bool_and(c.try_cast(k).isNotNull() | c.isNull()).alias(k) for k in kinds], F.count(c).alias("n")).alias(f"c{i}")
            for i, c in enumerate(quoted)
        ]
    ).first()
    return {
        name: next((k for k in kinds if fits[f"c{i}"]["n"] and fits[f"c{i}"][k]), "string")
        for i, name in enumerate(text.columns)
    }


def read_table(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """Delta where a transaction log exists, else Parquet."""
    if sharedfs.exists(spark, f"{path.rstrip('/')}/_delta_log"):
        return spark.read.format("delta").load(path)
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


# Rows of one task ahead of heavy parsing, where a scan has to be dealt out anyway.
ROWS_PER_TASK = 250_000


def spread(scan: DataFrame) -> DataFrame:
    """A scan that would leave cores idle, spread over them ahead of heavy parsing.

    A row group of a file is read by one task, whatever the number of splits: those without the start of
    one are empty. So rows are counted per task, which opens only the ends of the files; a scan
    that deals them evenly to all cores is returned as it is.
    Only for plain scans: counting the rows of a plan with exchanges would run it.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    held = rows_per_partition(scan).agg(F.max("n").alias("most"), F.sum("n").alias("rows")).first()
    if not held["rows"] or held["most"] * cores <= held["rows"] * 1.5:
        return scan
    return scan.repartition(max(cores, scan.rdd.getNumPartitions(), -(-held["rows"] // ROWS_PER_TASK)))


# Files of one task, where few rows make a file each: creating one costs some ten milliseconds.
FILES_PER_TASK = 500
# Options of such a write. Hadoop's local file system puts a checksum file beside each file and starts processes
# to set the modes of both, which takes most of the time of a small file. Other file systems don't see these.
SMALL_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def spread_files(rows: DataFrame, per_file: int = 1, by: Sequence[str] = ()) -> DataFrame:
    """Rows dealt out ahead of a write of one file per ``per_file`` of them, whose time goes by files, not bytes.

    A table that is small as a scan would be written by one task. Rows alike in ``by`` stay in one
    task, so in one file of a folder per key. The rows are counted, so only for plain scans.
    """
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // (per_file * FILES_PER_TASK)))
    return rows.repartition(tasks, *by)


def discover_datasets(spark: SparkSession, base: str) -> list[str]:
    """Dataset folders directly below ``base``, sorted; each must hold data."""
    found = [p for p in sharedfs.child_folders(spark, base) if is_dataset_folder(p.rstrip("/").rsplit("/", 1)[-1])]
    require_paths(spark, found)
    return found


def read_not_empty(df: DataFrame, name: str) -> DataFrame:
    if df.isEmpty():
        raise GateError(f"source {name} is empty")
    return df


def training_frame(features: DataFrame) -> DataFrame:
    """The three columns the classifier reads; pruning reaches the scan."""
    needed = ("tweet_text", "disaster_type", "word_count")
    require_columns(features, needed, "text features")
    return read_not_empty(features.select(*needed), "text features")


def overwrite(df: DataFrame, path: str, sort_keys: Sequence[str] = (), partition_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Replace a table. The frame must not read from ``path``."""
    ordered = df.sortWithinPartitions(*partition_by, *sort_keys) if sort_keys else df
    writer = ordered.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "static")
    if fmt == "delta":
        writer = writer.option("overwriteSchema", True)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Append; new columns are allowed, readers merge schemas."""
    writer = df.write.format(fmt).mode("append").option("mergeSchema", True)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def replace_partitions(df: DataFrame, path: str, by: str) -> None:
    """Replace only the partitions present in the frame; a rerun leaves the same table."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def create_table_as(df: DataFrame, name: str, metadata: dict[str, Column], sort_keys: Sequence[str] = (), path: str | None = None) -> None:
    """Drop and recreate a catalogue table from a query plus constant metadata columns; ``path`` is a folder outside the warehouse."""
    full = df.select("*", *[c.alias(n) for n, c in metadata.items()])
    writer = (full.sortWithinPartitions(*sort_keys) if sort_keys else full).write.mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def rows_per_partition(df: DataFrame) -> DataFrame:
    """Rows each task of a write would hold."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count("*").alias("n"))


def storage_metrics(df: DataFrame) -> DataFrame:
    """Files, bytes and rows of a file-backed table; bytes are counted once per file."""
    per_file = df.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count("*").alias("rows"), F.max("_metadata.file_size").alias("bytes")
    )
    return per_file.agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))


def upsert(old: DataFrame | None, new: DataFrame, key: str, newest: str) -> DataFrame:
    """Old and new rows, the newest per key; a limit per task precedes the exchange."""
    rows = new if old is None else old.unionByName(new, allowMissingColumns=True)
    text_columns = [f.name for f in rows.schema.fields if isinstance(f.dataType, StringType)]
    order = [F.col(newest).desc_nulls_last(), *text_columns]
    ranked = rows.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.filter("__n = 1").drop("__n")


def mark_processed(paths: DataFrame, manifest: str) -> None:
    """Record finished objects; ``pending`` reads this back."""
    append(paths.select("path").distinct(), manifest)


def pending(spark: SparkSession, files: DataFrame, manifest: str) -> DataFrame:
    """Non-empty files not yet in the manifest of processed ones."""
    todo = files.filter("length > 0")
    if not sharedfs.exists(spark, manifest):
        return todo
    done = spark.read.parquet(manifest).select("path").distinct()
    return todo.join(done, "path", "left_anti")


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """One row per file: path, length, modification time. File contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    return reader.load(path).select("path", "length", "modificationTime")
