"""Vector collections: pending work, encoding, exact and cell-pruned cosine search."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.keys import file_key
from ..functions.labels import ASSET_VERSION, asset_columns
from ..functions.names import pick_column
from .. import logicaldate
from ..sharedfs import cut_lineage
from .joins import not_yet_done
from .rows import keep_first

# Queries up to this many travel to every task; more are handled in tiles.
MAX_SENT_QUERIES = 4096
TILE_QUERIES = 1024
TILE_VECTORS = 8192
# Vectors in a file of a stored index.
CELL_ROWS = 1 << 19
# Scores held at once, and what the names of carried fields begin with.
SCORES_AT_ONCE = 1 << 21
FIELD = "field_"

# Fields of a vector collection.
COLLECTION_FIELDS = (
    "id",
    "image_path",
    "label",
    "source_system",
    "source_assets",
    "created_at",
    "schema_version",
    "exploitation_asset_type",
    "embedding_model",
    "embedding_dimension",
    "embeddings",
)
HIT_FIELDS = ("image_path", "label", "source_assets", "created_at", "schema_version", "embedding_model", "embedding_dimension")


def l2_normalize(v: Column) -> Column:
    """Unit vector; the norm is kept above 1e-12 so a zero vector stays finite."""
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))
    return F.transform(v, lambda x: (x / F.greatest(norm, F.lit(1e-12))).cast("float"))


def pending_work(catalogue: DataFrame, status: DataFrame | None = None, limit: int | None = None) -> DataFrame:
    """Readable, uncorrupted images with a stable id that are not embedded yet."""
    columns = catalogue.columns
    path = pick_column(columns, ("trusted_path", "image_path", "file_path", "path"))
    label = pick_column(columns, ("label", "source_type"), required=False)
    df = catalogue
    if "file_type" in columns:
        df = df.filter(F.lower("file_type") == "image")
    if "is_corrupted" in columns:
        df = df.filter(~F.col("is_corrupted"))
    ids = [c for c in dict.fromkeys(("id", "file_id", "landing_file_id", path)) if c in columns]
    rows = df.filter(F.trim(F.col(path).cast("string")) != "").select(
        file_key(*ids).alias("id"),
        F.col(path).cast("string").alias("image_path"),
        (F.col(label).cast("string") if label else F.lit("")).alias("label"),
    )
    done = None if status is None else status.filter("status = 'SUCCESS'").select("id")
    todo = not_yet_done(keep_first(rows, ["id"]), done, "id")
    # Ordered, so that a bounded run always takes the same images.
    return todo.orderBy("id").limit(limit) if limit else todo


Reader = Callable[[str], object]
Encoder = Callable[[list], np.ndarray]


def encode(work: DataFrame, read: Reader, encoder: Encoder, dimension: int, batch: int = 32) -> DataFrame:
    """Embeds images on the executors; every row comes back with a status.

    An unreadable image fails alone; a failing batch fails its own rows only.
    ``encoder`` is called with at most ``batch`` images. The outcome is written once, so that
    statuses and collection come from the same run of the encoder.
    """
    schema = "id STRING, image_path STRING, label STRING, status STRING, error_msg STRING, vector_dim INT, embeddings ARRAY<FLOAT>"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for start in range(0, len(frame), batch):
                out.extend(_encode_batch(frame.iloc[start : start + batch], read, encoder, dimension))
            yield pd.DataFrame(out, columns=["id", "image_path", "label", "status", "error_msg", "vector_dim", "embeddings"])

    return cut_lineage(work.select("id", "image_path", "label").mapInPandas(run, schema), "encoded")


def _encode_batch(rows: pd.DataFrame, read: Reader, encoder: Encoder, dimension: int) -> list[tuple]:
    loaded, out = [], []
    for row in rows.itertuples(index=False):
        try:
            loaded.append((row, read(row.image_path)))
        except Exception as error:  # noqa: BLE001
            out.append((row.id, row.image_path, row.label, "FAILED_IMAGE_READ", str(error), 0, None))
    if not loaded:
        return out
    try:
        vectors = np.asarray(encoder([image for _, image in loaded]), dtype=np.float32)
        vectors = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
        done = [(r.id, r.image_path, r.label, "SUCCESS", "", dimension, v) for (r, _), v in zip(loaded, vectors, strict=True)]
    except Exception as error:  # noqa: BLE001
        done = [(r.id, r.image_path, r.label, "FAILED_EMBEDDING", str(error), 0, None) for r, _ in loaded]
    return out + done


def collection_rows(encoded: DataFrame, source_assets: str, model: str, dimension: int, date) -> DataFrame:
    """Successful encodings in collection form."""
    return (
        encoded.filter("status = 'SUCCESS'")
        .withColumns(asset_columns("embedding", source_assets, logicaldate.iso(date)))
        .withColumns({"embedding_model": F.lit(model), "embedding_dimension": F.lit(dimension).cast("long")})
        .select(*COLLECTION_FIELDS)
    )


def status_rows(encoded: DataFrame, source_assets: str, model: str, dimension: int, collection: str, date, device: str = "cpu") -> DataFrame:
    """Outcome per image, for retry and audit."""
    stamp = logicaldate.iso(date)
    return encoded.drop("embeddings").withColumns(
        {
            "device": F.lit(device),
            "model_name": F.lit(model),
            "collection_name": F.lit(collection),
            "processed_at": F.lit(stamp),
            "embedding_model": F.lit(model),
            "embedding_dimension": F.lit(dimension).cast("long"),
            **asset_columns("embedding", source_assets, stamp),
        }
    )


def needs_rebuild(collection: DataFrame) -> bool:
    return not set(COLLECTION_FIELDS).issubset(collection.columns)


def vector_quality(collection: DataFrame | None, status: DataFrame, name: str, dimension: int, date) -> DataFrame:
    """Six non-fatal checks over a run's statuses and the collection."""
    rows = F.lit(0) if collection is None else collection.agg(F.count("*")).scalar()
    success = F.col("status") == "SUCCESS"
    run = status.agg(
        F.count("*").alias("total"),
        F.count_if(success).alias("success"),
        F.count_if(success & (F.col("vector_dim") != dimension)).alias("mismatch"),
        F.count_if(F.col("status").isNotNull()).alias("tracked"),
    ).withColumn("stored", rows)
    idle = F.col("total") == 0
    failed = F.col("total") - F.col("success")

    def check(asset: str, label: str, passed: Column, bad: str, observed: Column, expected: str) -> Column:
        return F.struct(
            F.lit(asset).alias("asset_name"),
            F.lit(label).alias("check_name"),
            F.when(passed, "PASS").otherwise(bad).alias("status"),
            observed.cast("string").alias("observed_value"),
            F.lit(expected).alias("expected_value"),
        )

    audit = "image_embedding_status"
    tracked = F.concat_ws("/", F.col("tracked").cast("string"), F.col("total").cast("string"))
    checks = F.array(
        check(name, "collection_exists", F.lit(collection is not None), "FAIL", F.lit(name), "existing collection"),
        check(name, "embedding_dimension", F.col("mismatch") == 0, "FAIL", F.col("mismatch"), "0 successful rows with wrong dimension"),
        check(name, "row_count_nonzero", (F.col("stored") > 0) | idle, "WARN", F.col("stored"), "> 0 after successful writes"),
        check(audit, "status_records_written", F.col("total") == F.col("tracked"), "FAIL", tracked, "all processed images tracked"),
        check(audit, "embedding_success_count", (F.col("success") > 0) | idle, "WARN", F.col("success"), "> 0 unless no pending images"),
        check(audit, "embedding_failure_count", failed == 0, "WARN", failed, "0 preferred; failures retained for retry/audit"),
    )
    stamped = {"created_at": F.lit(logicaldate.iso(date)), "schema_version": F.lit(ASSET_VERSION)}
    return run.select(F.explode(checks).alias("c")).select("c.*").withColumns(stamped)


# What the catalogue and the lineage say about the two image assets.
IMAGE_DOMAIN = "image_search"
IMAGE_ASSETS = {
    # kind: (asset type, zone before, transformation, use)
    "collection": ("embedding", "trusted-zone", "image_vectorization.clip_embedding", "image similarity search"),
    "status": ("metric", "exploitation-zone", "image_vectorization.status_catalogue", "embedding audit and retry monitoring"),
}
STATUS_ASSET = "image_embedding_status"


@dataclass(frozen=True)
class ImageAssets:
    """A vector collection and the statuses of the runs that filled it."""

    collection: str
    source: str
    status_location: str
    model: str
    dimension: int
    storage: str = "parquet"

    def rows(self) -> list[tuple]:
        """(kind, asset, location, made from) of both."""
        return [("collection", self.collection, self.collection, self.source), ("status", STATUS_ASSET, self.status_location, self.collection)]


def image_asset_catalogue(assets: ImageAssets, collection: DataFrame, status: DataFrame, checks: DataFrame, date) -> DataFrame:
    """Catalogue rows of both assets, with the model; one check that fails makes both WARN."""
    spark = collection.sparkSession
    counts = collection.agg(F.lit("collection").alias("kind"), F.count("*").alias("record_count")).unionAll(
        status.agg(F.lit("status").alias("kind"), F.count("*").alias("record_count"))
    )
    worst = checks.agg(F.when(F.coalesce(F.bool_and(F.col("status") == "PASS"), F.lit(True)), "PASS").otherwise("WARN").alias("quality_status"))
    said = [(kind, name, place, made, *[IMAGE_ASSETS[kind][i] for i in (0, 1, 3)]) for kind, name, place, made in assets.rows()]
    named = spark.createDataFrame(said, "kind STRING, asset_name STRING, location STRING, source_assets STRING, asset_type STRING, source_system STRING, downstream_usage STRING")
    # Two rows, two counts and one status.
    return named.join(counts, "kind").join(worst, F.lit(True)).select(
        "asset_name",
        F.lit(IMAGE_DOMAIN).alias("domain"),
        "asset_type",
        F.lit(assets.storage).alias("storage_system"),
        "location",
        "source_system",
        "source_assets",
        "downstream_usage",
        F.lit("analytics").alias("owner"),
        "quality_status",
        "record_count",
        F.lit(logicaldate.iso(date)).alias("created_at"),
        F.lit(ASSET_VERSION).alias("schema_version"),
        F.lit(assets.model).alias("embedding_model"),
        F.lit(assets.dimension).cast("long").alias("embedding_dimension"),
    )


def image_asset_lineage(spark: SparkSession, assets: ImageAssets, date) -> DataFrame:
    stamp = logicaldate.iso(date)
    rows = [(name, IMAGE_ASSETS[kind][1], made, IMAGE_ASSETS[kind][2], IMAGE_ASSETS[kind][3], stamp, ASSET_VERSION) for kind, name, _, made in assets.rows()]
    return spark.createDataFrame(
        rows,
        "asset_name STRING, upstream_zone STRING, upstream_assets STRING, transformation_name STRING, downstream_usage STRING, created_at STRING, schema_version STRING",
    )


# --- search ----------------------------------------------------------------


def _unit(matrix) -> np.ndarray:
    m = np.stack(matrix).astype(np.float64)
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)


class _Best:
    """The k best hits per query seen so far; ties go to the smaller id. A hit keeps its output fields."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.scores = [np.empty(0) for _ in range(queries)]
        self.ids = [np.empty(0, dtype=object) for _ in range(queries)]
        self.fields = [np.empty(0, dtype=object) for _ in range(queries)]

    def offer(self, query: int, scores: np.ndarray, frame: pd.DataFrame) -> None:
        if len(self.scores[query]) >= self.k:
            at = np.flatnonzero(scores >= self.scores[query][-1])
        elif len(scores) > 4 * self.k:
            # Keep every row tied with the k-th score, so the tie rule sees them all.
            at = np.flatnonzero(scores >= np.partition(scores, len(scores) - self.k)[len(scores) - self.k])
        else:
            at = np.arange(len(scores))
        if not len(at):
            return
        hits = frame.iloc[at]
        fields = np.empty(len(at), dtype=object)
        carried = [hits[c] for c in frame.columns if c.startswith(FIELD)]
        for n, values in enumerate(zip(*carried) if carried else [()] * len(at)):
            fields[n] = values
        s, i = np.concatenate([self.scores[query], scores[at]]), np.concatenate([self.ids[query], hits["id"].to_numpy(dtype=object)])
        f = np.concatenate([self.fields[query], fields])
        keep = np.lexsort((i, -s))[: self.k]
        self.scores[query], self.ids[query], self.fields[query] = s[keep], i[keep], f[keep]

    def frame(self, query_ids: Sequence, output: Sequence[str]) -> pd.DataFrame:
        lengths = [len(s) for s in self.scores]
        joined = lambda parts: np.concatenate(parts) if parts else np.empty(0, dtype=object)
        found = pd.DataFrame(
            {"query_id": np.repeat(np.asarray(query_ids, dtype=object), lengths), "id": joined(self.ids), "score": joined(self.scores).astype(float)}
        )
        fields = joined(self.fields)
        for n, name in enumerate(output):
            found[name] = pd.Series([f[n] for f in fields], dtype=object)
        return found

    def score_all(self, wanted: np.ndarray, matrix: np.ndarray, frame: pd.DataFrame) -> None:
        """Offer a frame of vectors to some queries, in blocks that bound the scores held at once."""
        if not len(frame) or not len(wanted):
            return
        unit = _unit(frame["v"].to_numpy()).T
        step = max(1, SCORES_AT_ONCE // len(frame))
        for at in range(0, len(wanted), step):
            some = wanted[at : at + step]
            for query, scores in zip(some, matrix[some] @ unit):
                self.offer(query, scores, frame)


def _final_top(partial: DataFrame, k: int) -> DataFrame:
    """Global top k from the k best per task; a limit per task precedes the exchange."""
    window = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    return partial.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)


def _result_schema(queries: DataFrame, vectors: DataFrame, query_id: str, id: str, output: Sequence[str]) -> str:
    kind = lambda df, c: df.schema[c].dataType.simpleString()
    fields = "".join(f", `{c}` {kind(vectors, c)}" for c in output)
    return f"query_id {kind(queries, query_id)}, id {kind(vectors, id)}, score DOUBLE{fields}"


def _candidates(vectors: DataFrame, id: str, vector: str, output: Sequence[str], *more: str | Column) -> DataFrame:
    """What a search reads of the vectors; output fields go by place."""
    return vectors.select(F.col(id).alias("id"), F.col(vector).alias("v"), *[F.col(c).alias(f"{FIELD}{n}") for n, c in enumerate(output)], *more)


def _scan_top_k(candidates: DataFrame, query_ids: list, matrix: np.ndarray, k: int, schema: str, output: Sequence[str]) -> DataFrame:
    """One pass over the vectors with a bounded set of queries in each task."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = _Best(len(query_ids), k)
        for frame in frames:
            best.score_all(np.arange(len(query_ids)), matrix, frame)
        yield best.frame(query_ids, output)

    return candidates.mapInPandas(run, schema)


def _tiled_top_k(probes: DataFrame, candidates: DataFrame, k: int, schema: str, output: Sequence[str]) -> DataFrame:
    """Queries (query_id, q, cell) meet the vectors of their cells, both in tiles of bounded size.

    Tiles are cut by a hash of the id, so neither a hot cell nor a popular one makes a large
    task. Only the k best per query leave a pair of tiles.
    """
    spread_of = lambda df, size, name: df.groupBy("cell").agg(F.ceil(F.count("*") / size).cast("int").alias(name))
    tiles = spread_of(probes, TILE_QUERIES, "q_tiles").join(spread_of(candidates, TILE_VECTORS, "v_tiles"), "cell")
    tile = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = probes.join(tiles, "cell").select("query_id", "q", "cell", tile("query_id", "q_tiles").alias("qt"), every("v_tiles").alias("vt"))
    fields = [c for c in candidates.columns if c != "cell"]
    right = candidates.join(tiles, "cell").select(*fields, "cell", tile("id", "v_tiles").alias("vt"), every("q_tiles").alias("qt"))

    def meet(q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        best = _Best(len(q), k)
        if len(q):
            best.score_all(np.arange(len(q)), _unit(q["q"].to_numpy()), v)
        return best.frame(q["query_id"].tolist(), output)

    by = ("cell", "qt", "vt")
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(meet, schema)


def _bounded_rows(df: DataFrame, bound: int) -> list | None:
    """The rows if there are at most ``bound``, else None; never reads more than that."""
    rows = df.limit(bound + 1).collect()
    return rows if len(rows) <= bound else None


def top_k(
    queries: DataFrame,
    vectors: DataFrame,
    k: int = 5,
    query_id: str = "query_id",
    id: str = "id",
    vector: str = "embeddings",
    output: Sequence[str] = (),
    max_sent: int = MAX_SENT_QUERIES,
) -> DataFrame:
    """Exact cosine top k per query: query_id, id, score, rank and the ``output`` fields of each hit.

    A vector stored twice can be hit twice. Up to ``max_sent`` queries travel to the vectors;
    more meet them in tiles, with the same result. ``top_k_cells`` prunes.
    """
    schema = _result_schema(queries, vectors, query_id, id, output)
    few = _bounded_rows(queries.select(query_id, vector), max_sent)
    if few is None:
        probes = queries.select(F.col(query_id).alias("query_id"), F.col(vector).alias("q"), F.lit(0).alias("cell"))
        partial = _tiled_top_k(probes, _candidates(vectors, id, vector, output, F.lit(0).alias("cell")), k, schema, output)
    else:
        matrix = _unit([r[1] for r in few]) if few else np.empty((0, 0))
        partial = _scan_top_k(_candidates(vectors, id, vector, output), [r[0] for r in few], matrix, k, schema, output)
    return _final_top(partial, k)


def build_cells(vectors: DataFrame, nlist: int = 128, vector: str = "embeddings", seed: int = 2026) -> tuple[DataFrame, DataFrame]:
    """(vectors with their cell, one row per cell with its unit centre and angular radius)."""
    unit = vectors.withColumn("__unit", array_to_vector(l2_normalize(F.col(vector))))
    model = KMeans(k=nlist, seed=seed, featuresCol="__unit", predictionCol="cell", distanceMeasure="cosine", maxIter=10).fit(unit)
    assigned = model.transform(unit)
    # nlist centres, a parameter and not a function of the data size.
    centres = [_unit([c])[0] for c in model.clusterCenters()]
    spark = vectors.sparkSession
    centre_rows = spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(centres)], "cell INT, centre ARRAY<DOUBLE>")
    dot = F.aggregate(
        F.zip_with(vector_to_array("__unit"), "centre", lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x
    )
    measured = assigned.join(centre_rows, "cell").withColumn("__angle", F.acos(F.least(F.greatest(dot, F.lit(-1.0)), F.lit(1.0))))
    radii = measured.groupBy("cell").agg(F.max("__angle").alias("radius"), F.count("*").alias("n"))
    return assigned.drop("__unit"), centre_rows.join(radii, "cell")


def top_k_cells(
    queries: DataFrame,
    cell_vectors: DataFrame,
    cells: DataFrame,
    k: int = 5,
    nprobe: int | None = None,
    query_id: str = "query_id",
    id: str = "id",
    vector: str = "embeddings",
    output: Sequence[str] = (),
    prune: bool = False,
) -> DataFrame:
    """Cosine top k that reads only some cells, for any number of queries.

    With ``nprobe`` the nearest cells are read and the result is approximate.
    Without it the result is exact: the nearest cell gives a score to beat, and
    a cell is read only if its centre and radius leave room for a better one.
    With ``prune`` the numbers of the cells to read, of which there are as many as the index
    has, become a filter on the vectors: those of a stored index are partitioned by cell, so the others
    are not even listed.
    """
    schema = _result_schema(queries, cell_vectors, query_id, id, output)
    # As many rows as there are cells, a parameter of the index.
    centres = cells.orderBy("cell").collect()
    numbers, middle = np.array([c["cell"] for c in centres]), _unit([c["centre"] for c in centres]).T
    radius = np.array([c["radius"] for c in centres])
    kind = queries.schema[query_id].dataType.simpleString()
    asked = queries.select(F.col(query_id).alias("query_id"), F.col(vector).cast("array<double>").alias("q"))

    def probe(wanted: DataFrame, choose) -> DataFrame:
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                if len(frame):
                    row, cell = np.nonzero(choose(_unit(frame["q"].to_numpy()) @ middle, frame))
                    yield pd.DataFrame({"query_id": frame["query_id"].to_numpy()[row], "q": frame["q"].to_numpy()[row], "cell": numbers[cell]})

        return wanted.mapInPandas(run, f"query_id {kind}, q ARRAY<DOUBLE>, cell INT")

    nearest = lambda n: lambda similarity, _: np.argsort(np.argsort(-similarity, axis=1), axis=1) < n
    plain = _result_schema(queries, cell_vectors, query_id, id, ())

    def found(probes: DataFrame, fields: Sequence[str]) -> DataFrame:
        searched = cell_vectors
        if prune:
            probes = cut_lineage(probes, "probes")
            wanted = [r["cell"] for r in probes.select("cell").distinct().collect()]
            searched = cell_vectors.where(F.col("cell").isin(wanted))
        return _final_top(_tiled_top_k(probes, _candidates(searched, id, vector, fields, "cell"), k, schema if fields == output else plain, fields), k)

    if nprobe is not None:
        return found(probe(asked, nearest(nprobe)), output)
    # The k-th score of the nearest cell is the one to beat.
    first = found(probe(asked, nearest(1)), ()).filter(F.col("rank") == k).select("query_id", F.col("score").alias("beat"))

    def reachable(similarity: np.ndarray, frame: pd.DataFrame) -> np.ndarray:
        best = np.cos(np.maximum(np.arccos(np.clip(similarity, -1, 1)) - radius[None, :], 0.0))
        # The margin covers the float32 rounding of stored unit vectors.
        return (best >= frame["beat"].fillna(-1.0).to_numpy()[:, None] - 1e-5) | nearest(1)(similarity, frame)

    return found(probe(asked.join(first, "query_id", "left"), reachable), output)


def store_cells(cell_vectors: DataFrame, cells: DataFrame, path: str) -> None:
    """An index on disk: vectors in a folder per cell, and the table of cells. ``path`` must be new.

    A task writes about ``CELL_ROWS`` vectors of one cell, so a popular cell is many files.
    """
    parts = cells.select("cell", F.ceil(F.col("n") / CELL_ROWS).alias("__parts"))
    place = F.pmod(F.xxhash64(*[c for c in cell_vectors.columns if c != "cell"]), F.col("__parts"))
    dealt = cell_vectors.join(parts, "cell").withColumn("__part", place).repartition("cell", "__part")
    dealt.drop("__parts", "__part").write.partitionBy("cell").parquet(f"{path.rstrip('/')}/vectors")
    cells.write.parquet(f"{path.rstrip('/')}/cells")


def stored_cells(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """What ``build_cells`` gave, from disk, for any later session; search it with ``prune``."""
    return spark.read.parquet(f"{path.rstrip('/')}/vectors"), spark.read.parquet(f"{path.rstrip('/')}/cells")
