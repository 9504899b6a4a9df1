"""Image catalogue cleaning, with documents standing for image files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import sharedfs
from ..operators import gates
from ..plans import images as im
from ..sources.files import profile_images
from ..sources.tables import SMALL_FILES, list_files, spread_files
from .registry import DATE, query, table


def image_catalogue(spark: SparkSession, folder: str) -> DataFrame:
    """One catalogue row per document: its text digest is the content digest, so copies of a text are copies of an image."""
    d = table(spark, folder, "documents")
    src = F.col("source")
    meta = F.to_json(
        F.struct(
            F.col("lang").alias("label"),
            F.concat(F.lit("s3://raw/"), src).alias("url"),
            F.when(src == "src3", 0).otherwise(F.col("n_chars")).alias("file_size_bytes"),
            F.lit("image").alias("content_type"),
            F.when(src == "src4", 512).otherwise(640).alias("width"),
            F.lit(512).alias("height"),
            F.lit(1.25).alias("aspect_ratio"),
            F.lit("RGB").alias("image_mode"),
            F.when(src == "src5", True).when(src != "src6", False).alias("is_corrupted"),
            F.when(src != "src7", F.md5("text")).alias("md5"),
        )
    )
    extension = F.when(src == "src8", ".gif").when(src == "src4", ".png").otherwise(".JPG")
    return d.select(
        F.when(src != "src9", F.col("doc_id").cast("string")).alias("file_id"),
        F.when(src != "src10", F.concat(F.lit("s3://landing/persistent-landing/unstructured/image/"), F.col("doc_id").cast("string"), extension)).alias("file_path"),
        F.lit("Image").alias("file_type"),
        meta.alias("metadata_blob"),
    )


CATALOGUE_SQL = """
cat as (
  select case when source <> 'src9' then cast(doc_id as varchar) end as file_id,
    case when source <> 'src10' then 's3://landing/persistent-landing/unstructured/image/' || doc_id || case source when 'src8' then '.gif' when 'src4' then '.png' else '.JPG' end end as file_path,
    lang, source, n_chars, case when source <> 'src7' then md5(text) end as md5,
    case when source = 'src9' then 'missing_file_id' when source = 'src10' then 'missing_file_path' when source = 'src3' or n_chars <= 0 then 'empty_or_missing_source_file'
      when source = 'src5' then 'corrupted_image' when source = 'src7' then 'missing_md5' when source = 'src8' then 'unsupported_extension' when source = 'src6' then 'unknown_corruption_state' end as reason
  from documents),
good as (select *, row_number() over (partition by md5 order by file_path, file_id) as n from cat where reason is null)
"""


@query("image_canonical", f"with {CATALOGUE_SQL} select file_id, file_path, md5, lang as label from good where n = 1")
def image_canonical(spark, folder):
    valid = im.clean_images(image_catalogue(spark, folder), DATE).valid
    return valid.select("file_id", "file_path", "md5", F.col("meta.label").alias("label"))


@query(
    "image_rejects",
    f"""with {CATALOGUE_SQL} select file_id as id, file_path as source_file_path, reason, 'trusted' as zone, 'unstructured_file' as asset_type, 'image' as dataset_name, '2026-05-24T10:00:00+00:00' as rejected_at,
    'landing-zone' as source_system, '2026-05-24T10:00:00+00:00' as ingestion_time, 'rejected' as validation_status, 'unstructured_image_v1' as schema_version from cat where reason is not null""",
)
def image_rejects(spark, folder):
    return im.clean_images(image_catalogue(spark, folder), DATE).rejected


@query("image_duplicates", f"with {CATALOGUE_SQL} select file_id, file_path, md5, cast(1 as bigint) as copies from good where n > 1")
def image_duplicates(spark, folder):
    return im.clean_images(image_catalogue(spark, folder), DATE).duplicates


def _ignore(source: str, target: str) -> None:
    """Codec of the binding: the tables hold no pixels, so nothing is copied."""


def _fail_on_seven(source: str, target: str) -> None:
    if source.endswith("7.JPG"):
        raise OSError("unreadable")


def processed(spark: SparkSession, folder: str):
    valid = im.clean_images(image_catalogue(spark, folder), DATE).valid
    results = im.standardize_images(im.work_list(valid), "s3://trusted", _ignore, _fail_on_seven)
    return valid, results


@query(
    "image_route",
    f"""with {CATALOGUE_SQL} select file_id as id, case when source <> 'src4' and file_path like '%7.JPG' then null else 's3://trusted/unstructured/image/' || file_id || '.png' end as trusted_path,
    case when source = 'src4' then 'DIRECT_COPY' when file_path like '%7.JPG' then 'FAILED: unreadable' else 'TRANSFORMED' end as status from good where n = 1""",
)
def image_route(spark, folder):
    return processed(spark, folder)[1]


@query(
    "image_trusted_catalogue",
    f"""with {CATALOGUE_SQL} select file_id as id, 's3://trusted/unstructured/image/' || file_id || '.png' as trusted_path, case when source = 'src4' then 'DIRECT_COPY' else 'TRANSFORMED' end as status,
    file_path as raw_source_path, lang as label, 's3://raw/' || source as source_url, n_chars as file_size_bytes, md5, cast(512 as int) as current_width, 'valid' as validation_status,
    'public_image_metadata' as data_classification, 'no_direct_pii' as pii_flag from good where n = 1 and not (source <> 'src4' and file_path like '%7.JPG')""",
)
def image_trusted_catalogue(spark, folder):
    valid, results = processed(spark, folder)
    return im.split_results(results, valid, DATE)[0].select(
        "id", "trusted_path", "status", "raw_source_path", "label", "source_url", "file_size_bytes", "md5", "current_width", "validation_status",
        "data_classification", "pii_flag",
    )


@query(
    "image_failures",
    f"""with {CATALOGUE_SQL} select file_id as id, file_path as source_file_path, 'FAILED: unreadable' as reason, 'rejected' as validation_status from good where n = 1 and source <> 'src4' and file_path like '%7.JPG'""",
)
def image_failures(spark, folder):
    valid, results = processed(spark, folder)
    return im.split_results(results, valid, DATE)[1].select("id", "source_file_path", "reason", "validation_status")


@query(
    "image_gate",
    f"""with {CATALOGUE_SQL} select count(*) as catalogue_rows, 0 as missing_critical_fields, 0 as invalid_standardisation_rows, 0 as missing_lineage_metrics
    from good where n = 1 and not (source <> 'src4' and file_path like '%7.JPG')""",
)
def image_gate(spark, folder):
    valid, results = processed(spark, folder)
    return gates.image_gate_counts(im.split_results(results, valid, DATE)[0], "s3://trusted/")


@query(
    "image_status_counts",
    f"""with {CATALOGUE_SQL} select case when source = 'src4' then 'DIRECT_COPY' when file_path like '%7.JPG' then 'FAILED: unreadable' else 'TRANSFORMED' end as status, count(*) as n from good where n = 1 group by 1""",
)
def image_status_counts(spark, folder):
    # Summed over tasks, as which task held a row is not a property of the data.
    return im.status_counts(processed(spark, folder)[1]).groupBy("status").agg(F.sum("n").alias("n"))


def _bitmap(width: Column, height: Column) -> Column:
    """A small black bitmap, all of whose bytes are ASCII, as text."""
    zeros = lambda n: F.repeat(F.lit("\0"), F.lit(n) if isinstance(n, int) else n)
    number = lambda n: F.concat(F.char(n if isinstance(n, Column) else F.lit(n)), zeros(3))
    pixels = F.ceil(width * 24 / 32).cast("int") * 4 * height
    header = (F.lit("BM"), number(pixels + 54), zeros(4), number(54), number(40), number(width), number(height), F.lit("\1\0\x18\0"), zeros(24))
    return F.concat(*header, zeros(pixels))


@query(
    "image_files_incremental",
    """with s as (select s_suppkey, 1 + s_suppkey % 4 as w, 1 + s_suppkey % 3 as h, s_suppkey % 5 = 0 as broken, 1 + s_suppkey % 2 as run from supplier)
    select cast(run as int) as run, cast(case when broken then 0 else w end as int) as width, cast(case when broken then 0 else h end as int) as height, broken as is_corrupted, count(*) as n from s group by all""",
)
def image_files_incremental(spark, folder):
    """A bitmap file per supplier, catalogued in three runs: half of the files, the other half, and nothing new. Some files are cut short."""
    root = sharedfs.new_folder(spark, "bitmaps")
    key = F.col("s_suppkey")
    size = lambda n: (1 + key % n).cast("int")
    image = _bitmap(size(4), size(3))
    made = table(spark, folder, "supplier").select("s_suppkey", F.when(key % 5 == 0, F.left(image, F.lit(50))).otherwise(image).alias("image"))
    for run in (1, 2, 3):
        files = spread_files(made.where((1 + key % 2 == run) if run < 3 else F.lit(False)))
        files.select("image").write.options(**SMALL_FILES).mode("append").option("maxRecordsPerFile", 1).option("lineSep", " ").text(f"{root}/landing")
        known = spark.read.parquet(f"{root}/catalogue") if run > 1 else None
        profile_images(spark, f"{root}/landing", DATE, known).write.parquet(f"{root}/catalogue/run={run}")
    blob = lambda name, kind: F.get_json_object("metadata_blob", f"$.{name}").cast(kind).alias(name)
    rows = spark.read.parquet(f"{root}/catalogue").select("run", blob("width", "int"), blob("height", "int"), blob("is_corrupted", "boolean"))
    return rows.groupBy("run", "width", "height", "is_corrupted").agg(F.count("*").alias("n"))


@query(
    "catalogue_objects",
    """select s_nationkey, count(*) as rows_seen, count(*) filter (s_acctbal < 0) as missing, false as sample_of_stored_raised, count(*) filter (s_acctbal < 0) > 0 as sample_of_missing_raised
      from supplier group by s_nationkey""",
)
def catalogue_objects(spark, folder):
    """A catalogue row per supplier, and a bitmap for each that owes nothing: the rows without their object, and what the sampled gate says."""
    root = sharedfs.new_folder(spark, "objects")
    stored = F.col("s_acctbal") >= 0
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    image = _bitmap(F.lit(2), F.lit(2))
    owners = spread_files(suppliers.where(stored), by=["s_suppkey"])
    owners.select(image.alias("image"), "s_suppkey").write.options(**SMALL_FILES).partitionBy("s_suppkey").option("lineSep", " ").text(root)
    files = list_files(spark, root)
    # The writer chose the names of the files; the catalogue knows those it saw, and expects others.
    key = F.regexp_extract("path", "s_suppkey=([0-9-]+)", 1).try_cast("long")
    seen = files.select(F.col("path").alias("trusted_path"), key.alias("key"))
    expected = F.concat(F.lit(f"{root}/s_suppkey="), F.col("s_suppkey"), F.lit("/image.bmp"))
    catalogue = sharedfs.cut_lineage(
        suppliers.join(seen, F.col("s_suppkey") == F.col("key"), "left").select("s_suppkey", "s_nationkey", stored.alias("stored"), F.coalesce("trusted_path", expected).alias("trusted_path")),
        "catalogue",
    )
    raised = {}
    for name, rows in (("stored", catalogue.where("stored")), ("missing", catalogue.where("not stored"))):
        try:
            gates.require_objects(spark, gates.sampled_paths(rows, "trusted_path"))
            raised[name] = False
        except gates.GateError:
            raised[name] = True
    lost = gates.missing_objects(catalogue, files, "trusted_path").select("s_suppkey", F.lit(1).alias("lost"))
    missing = F.count("lost")
    return catalogue.join(lost, "s_suppkey", "left").groupBy("s_nationkey").agg(
        F.count("*").alias("rows_seen"),
        missing.alias("missing"),
        F.lit(raised["stored"]).alias("sample_of_stored_raised"),
        (F.lit(raised["missing"]) & (missing > 0)).alias("sample_of_missing_raised"),
    )
