"""Vector collection upkeep and search over the embeddings."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import sharedfs
from ..operators import vectors as vec
from ..plans import collections
from ..sources import versions
from ..sources.tables import upsert
from .registry import DATE, query, table


def collection(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "embeddings")
    return e.select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("embeddings"), F.col("label").cast("string").alias("label"),
        F.concat(F.lit("images/"), F.col("vec_id").cast("string")).alias("image_path"), F.lit("embeddings").alias("source_assets"),
        F.lit("2026-05-24T10:00:00+00:00").alias("created_at"), F.lit("exploitation_v1").alias("schema_version"),
        F.lit("stand-in").alias("embedding_model"), F.size("embedding").cast("long").alias("embedding_dimension"),
    )


def label_queries(spark: SparkSession, folder: str) -> DataFrame:
    """One query per label: the mean vector of all its members."""
    means = collection(spark, folder).groupBy("label").agg(Summarizer.mean(array_to_vector("embeddings")).alias("m"))
    return means.select(F.col("label").alias("query_id"), vector_to_array("m").alias("embeddings"))


TOP_SQL = """
with parts as (select label, i, avg(cast(embedding[i] as double)) as m from embeddings, generate_series(1, 64) g(i) group by all),
q as (select cast(label as varchar) as query_id, list(m order by i) as m from parts group by label),
s as (select query_id, vec_id as id, cast(label as varchar) as label, list_cosine_similarity(m, cast(embedding as double[])) as score from q, embeddings),
r as (select *, cast(row_number() over (partition by query_id order by score desc, id) as int) as rank from s)
"""


@query(
    "vector_topk",
    TOP_SQL
    + """select query_id, id, round(score, 6) as score, rank, label, 'images/' || id as image_path, 'embeddings' as source_assets, '2026-05-24T10:00:00+00:00' as created_at,
    'exploitation_v1' as schema_version, 'stand-in' as embedding_model, cast(64 as bigint) as embedding_dimension from r where rank <= 5""",
)
def vector_topk(spark, folder):
    hits = vec.top_k(label_queries(spark, folder), collection(spark, folder), 5, output=vec.HIT_FIELDS)
    return hits.withColumn("score", F.round("score", 6))


@query("vector_topk_tiled", TOP_SQL + "select query_id, id, round(score, 6) as score, rank from r where rank <= 5")
def vector_topk_tiled(spark, folder):
    """As if there were too many queries to send to every task."""
    hits = vec.top_k(label_queries(spark, folder), collection(spark, folder), 5, max_sent=2)
    return hits.withColumn("score", F.round("score", 6))


@query("vector_cells_exact", TOP_SQL + "select query_id, id, round(score, 6) as score, rank from r where rank <= 5")
def vector_cells_exact(spark, folder):
    stored, cells = vec.build_cells(collection(spark, folder), nlist=16)
    hits = vec.top_k_cells(label_queries(spark, folder), stored, cells, 5)
    return hits.withColumn("score", F.round("score", 6))


@query("vector_index_stored", TOP_SQL + "select query_id, id, round(score, 6) as score, rank from r where rank <= 5")
def vector_index_stored(spark, folder):
    """The index is written, opened as a later session would, and only the folders of cells in reach are read."""
    path = sharedfs.new_folder(spark, "index")
    vec.store_cells(*vec.build_cells(collection(spark, folder).select("id", "embeddings"), nlist=16), path)
    hits = vec.top_k_cells(label_queries(spark, folder), *vec.stored_cells(spark, path), 5, prune=True)
    return hits.withColumn("score", F.round("score", 6))


@query(
    "vector_collection_versions",
    """with e as (select vec_id, label from embeddings), first as (select 'first' as seen, count(*) as n, count(*) filter (label = 0) as zeros from e),
    last as (select 'last' as seen, count(*) as n, count(*) filter (label = 0) as zeros from e where label <> 9 or label is null)
    select * from first union all select 'after_failure', n, zeros from first union all select * from last union all select 'former', n, zeros from first""",
)
def vector_collection_versions(spark, folder):
    """A collection replaced by a frame that reads it: what readers see before, after a failed attempt, after, and by number."""
    root = sharedfs.new_folder(spark, "collection")
    seen = lambda name, rows: rows.agg(F.lit(name).alias("seen"), F.count("*").alias("n"), F.count_if(F.col("label") == "0").alias("zeros"))
    versions.publish(collection(spark, folder).select("id", "label", "embeddings"), root)
    parts = [seen("first", versions.read(spark, root))]
    changed = versions.read(spark, root).where("label <> '9' or label is null")
    versions.stage(changed, root)  # and the job ends here, before its commit
    parts.append(seen("after_failure", versions.read(spark, root)))
    versions.publish(changed, root)
    parts += [seen("last", versions.read(spark, root)), seen("former", versions.read(spark, root, 0))]
    return reduce(DataFrame.unionByName, parts)


@query(
    "vector_collection_refresh",
    """with e as (select *, coalesce(label, -1) < 5 as early from embeddings),
    u as (select 'outdated' as run, false as rebuilt, 4 as fields, count(*) as n, count(*) as newest from e where early
      union all select 'rebuilt', true, 11, count(*), count(*) from e where early
      union all select 'added', false, 11, count(*), count(*) filter (not early) from e
      union all select 'repeated', false, 11, count(*), count(*) filter (not early) from e)
    select run, rebuilt, fields, n, newest from u""",
)
def vector_collection_refresh(spark, folder):
    """A collection of an old form is built anew; later runs add to it, and a repeated run changes nothing."""
    root = sharedfs.new_folder(spark, "collection")
    encoded = collection(spark, folder).select("id", "image_path", "label", "embeddings", F.lit("SUCCESS").alias("status"))
    early = F.coalesce(F.col("label").cast("int"), F.lit(-1)) < 5
    days = {"outdated": "2026-05-23", "rebuilt": "2026-05-24", "added": "2026-05-25", "repeated": "2026-05-25"}
    parts = []
    for run, day in days.items():
        rows = vec.collection_rows(encoded.filter(early if run in ("outdated", "rebuilt") else ~early), "embeddings", "stand-in", 64, f"{day}T10:00:00+00:00")
        if run == "outdated":
            rebuilt = False
            versions.publish(rows.select("id", "label", "embeddings", "created_at"), root)
        else:
            rebuilt = collections.refresh(spark, rows, root)
        stored = versions.read(spark, root)
        newest = F.count_if(F.startswith("created_at", F.lit(day)))
        parts.append(stored.agg(F.count("*").alias("n"), newest.alias("newest")).select(F.lit(run).alias("run"), F.lit(rebuilt).alias("rebuilt"), F.lit(len(stored.columns)).alias("fields"), "n", "newest"))
    return reduce(DataFrame.unionByName, parts)


@query(
    "vector_cells_many_queries",
    """with u as (select vec_id, label, [cast(x as double) for x in embedding] as v from embeddings),
    s as (select a.vec_id as query_id, b.vec_id as id, list_cosine_similarity(a.v, b.v) as score from u a, u b where a.vec_id % 50 = 0)
    select query_id, id, round(score, 5) as score, cast(row_number() over (partition by query_id order by score desc, id) as int) as rank from s qualify rank <= 3""",
)
def vector_cells_many_queries(spark, folder):
    """Every fiftieth vector against all of them, all cells probed."""
    vectors = collection(spark, folder)
    stored, cells = vec.build_cells(vectors, nlist=16)
    asked = vectors.filter("id % 50 = 0").select(F.col("id").alias("query_id"), "embeddings")
    return vec.top_k_cells(asked, stored, cells, 3, nprobe=16).withColumn("score", F.round("score", 5))


@query("vector_cells_full_probe", "select 16 as nprobe, cast(1.0 as double) as recall")
def vector_cells_full_probe(spark, folder):
    """With every cell probed nothing may be missed."""
    return vector_cells_recall(spark, folder).filter("nprobe = 16")


@query("vector_cells_recall")
def vector_cells_recall(spark, folder):
    """Share of the exact hits found per number of cells probed; depends on the clustering, so SQL cannot state it."""
    queries, vectors = label_queries(spark, folder), collection(spark, folder)
    stored, cells = vec.build_cells(vectors, nlist=16)
    exact = vec.top_k(queries, vectors, 5).select("query_id", "id")
    parts = None
    for nprobe in (1, 4, 16):
        found = vec.top_k_cells(queries, stored, cells, 5, nprobe).select("query_id", "id", F.lit(1).alias("hit"))
        recall = exact.join(found, ["query_id", "id"], "left").agg(F.round(F.count("hit") / F.count("*"), 4).alias("recall"))
        part = recall.select(F.lit(nprobe).alias("nprobe"), "recall")
        parts = part if parts is None else parts.unionAll(part)
    return parts


@query(
    "vector_normalize",
    "select vec_id as id, cast(round(sqrt(list_sum([cast(x as double) * cast(x as double) for x in embedding])), 4) as double) as norm, cast(1.0 as double) as unit_norm from embeddings",
)
def vector_normalize(spark, folder):
    norm = lambda v: F.round(F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))), 4)
    c = collection(spark, folder).withColumn("unit", vec.l2_normalize(F.col("embeddings")))
    return c.select("id", norm(F.col("embeddings")).alias("norm"), norm(F.col("unit")).alias("unit_norm"))


@query(
    "vector_upsert",
    """with new as (select vec_id as id, cast(label as varchar) || '-new' as label, 2 as version from embeddings where label >= 5 union all select vec_id + 1000000, cast(label as varchar), 2 from embeddings where label = 0)
    select vec_id as id, coalesce(n.label, cast(e.label as varchar)) as label, cast(coalesce(n.version, 1) as int) as version from embeddings e left join new n on n.id = e.vec_id
    union all select id, label, version from new where id >= 1000000""",
)
def vector_upsert(spark, folder):
    old = collection(spark, folder).select("id", "label", F.lit(1).alias("version"))
    number = F.col("label").cast("int")
    changed = old.filter(number >= 5).select("id", F.concat("label", F.lit("-new")).alias("label"), F.lit(2).alias("version"))
    added = old.filter(number == 0).select((F.col("id") + 1_000_000).alias("id"), "label", F.lit(2).alias("version"))
    return upsert(old, changed.unionByName(added), "id", "version")


def image_rows(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "documents")
    path = F.when(F.col("source") != "src1", F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".jpg"))).otherwise(F.lit(" "))
    return d.select(
        F.col("doc_id").cast("string").alias("file_id"), path.alias("file_path"), F.col("lang").alias("label"),
        F.when(F.col("source") == "src2", "JSON").otherwise("Image").alias("file_type"), (F.col("source") == "src3").alias("is_corrupted"),
    )


@query(
    "pending_work",
    """with w as (select doc_id, sha256(doc_id || '||' || source || '/' || doc_id || '.jpg') as id, source || '/' || doc_id || '.jpg' as image_path, lang as label from documents where source not in ('src1', 'src2', 'src3'))
    select id, image_path, label from w where doc_id not in (select doc_id from labels where quality = 1)""",
)
def pending_work(spark, folder):
    done = table(spark, folder, "labels").join(table(spark, folder, "documents"), "doc_id")
    key = F.sha2(F.concat_ws("||", F.col("doc_id").cast("string"), F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".jpg"))), 256)
    status = done.select(key.alias("id"), F.when(F.col("quality") == 1, "SUCCESS").otherwise("FAILED_IMAGE_READ").alias("status"))
    return vec.pending_work(image_rows(spark, folder), status)


def _read(path: str) -> str:
    if path.startswith("src4/"):
        raise OSError("no such image")
    return path


def _embed(paths: list):
    """Stand-in encoder: two numbers from the path."""
    import numpy as np

    return np.array([[len(p), 1.0] for p in paths])


def encoded(spark: SparkSession, folder: str) -> DataFrame:
    return vec.encode(vec.pending_work(image_rows(spark, folder)), _read, _embed, 2)


@query(
    "vector_encode",
    """select source || '/' || doc_id || '.jpg' as image_path, case when source = 'src4' then 'FAILED_IMAGE_READ' else 'SUCCESS' end as status, case when source = 'src4' then 'no such image' else '' end as error_msg,
    cast(case when source = 'src4' then 0 else 2 end as int) as vector_dim from documents where source not in ('src1', 'src2', 'src3')""",
)
def vector_encode(spark, folder):
    return encoded(spark, folder).select("image_path", "status", "error_msg", "vector_dim")


@query(
    "vector_quality",
    """with n as (select count(*) as total, count(*) filter (source <> 'src4') as ok from documents where source not in ('src1', 'src2', 'src3'))
    select 'image_vector_catalog' as asset_name, 'collection_exists' as check_name, 'PASS' as status, 'image_vector_catalog' as observed_value from n
    union all select 'image_vector_catalog', 'embedding_dimension', 'PASS', '0' from n union all select 'image_vector_catalog', 'row_count_nonzero', 'PASS', ok::varchar from n
    union all select 'image_embedding_status', 'status_records_written', 'PASS', total || '/' || total from n union all select 'image_embedding_status', 'embedding_success_count', 'PASS', ok::varchar from n
    union all select 'image_embedding_status', 'embedding_failure_count', case when total = ok then 'PASS' else 'WARN' end, (total - ok)::varchar from n""",
)
def vector_quality(spark, folder):
    rows = encoded(spark, folder)
    stored = vec.collection_rows(rows, "documents", "stand-in", 2, DATE)
    status = vec.status_rows(rows, "documents", "stand-in", 2, "image_vector_catalog", DATE)
    checks = vec.vector_quality(stored, status, "image_vector_catalog", 2, DATE)
    return checks.select("asset_name", "check_name", "status", "observed_value")


IMAGE_ASSETS = vec.ImageAssets("image_vector_catalog", "documents", "statuses", "stand-in", 2)


@query(
    "image_asset_catalogue",
    """with n as (select count(*) as total, count(*) filter (source <> 'src4') as ok from documents where source not in ('src1', 'src2', 'src3')),
    a as (select 'image_vector_catalog' as asset_name, 'embedding' as asset_type, 'image_vector_catalog' as location, 'trusted-zone' as source_system, 'documents' as source_assets, 'image similarity search' as downstream_usage, ok as record_count, total, ok from n
      union all select 'image_embedding_status', 'metric', 'statuses', 'exploitation-zone', 'image_vector_catalog', 'embedding audit and retry monitoring', total, total, ok from n)
    select asset_name, 'image_search' as domain, asset_type, 'parquet' as storage_system, location, source_system, source_assets, downstream_usage, 'analytics' as owner,
      case when total = ok then 'PASS' else 'WARN' end as quality_status, record_count, '2026-05-24T10:00:00+00:00' as created_at, 'exploitation_v1' as schema_version,
      'stand-in' as embedding_model, cast(2 as bigint) as embedding_dimension from a""",
)
def image_asset_catalogue(spark, folder):
    rows = encoded(spark, folder)
    stored = vec.collection_rows(rows, "documents", "stand-in", 2, DATE)
    status = vec.status_rows(rows, "documents", "stand-in", 2, "image_vector_catalog", DATE)
    checks = vec.vector_quality(stored, status, "image_vector_catalog", 2, DATE)
    return vec.image_asset_catalogue(IMAGE_ASSETS, stored, status, checks, DATE)


@query(
    "image_asset_lineage",
    """select distinct asset_name, upstream_zone, upstream_assets, transformation_name, downstream_usage, '2026-05-24T10:00:00+00:00' as created_at, 'exploitation_v1' as schema_version, n as status_rows
    from (select count(*) as n from documents where source not in ('src1', 'src2', 'src3')), (values ('image_vector_catalog', 'trusted-zone', 'documents', 'image_vectorization.clip_embedding', 'image similarity search'),
      ('image_embedding_status', 'exploitation-zone', 'image_vector_catalog', 'image_vectorization.status_catalogue', 'embedding audit and retry monitoring'))
      as v(asset_name, upstream_zone, upstream_assets, transformation_name, downstream_usage)""",
)
def image_asset_lineage(spark, folder):
    """With the number of statuses behind it, from the table."""
    total = encoded(spark, folder).agg(F.count("*").alias("status_rows"))
    return vec.image_asset_lineage(spark, IMAGE_ASSETS, DATE).join(total, F.lit(True))
