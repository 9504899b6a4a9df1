from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkzone.operators import vectors as vec
from sparkzone.plans import collections
from sparkzone.sources import versions
from sparkzone.sources.tables import upsert

from .conftest import rows

DATE = "2026-05-24T10:00:00Z"
DIM = 8


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    # A third of all vectors are copies of one, so scores tie and one cell is hot.
    vectors = [rng.normal(size=DIM) for _ in range(200)] + [np.ones(DIM)] * 100
    queries = [rng.normal(size=DIM) for _ in range(9)] + [np.ones(DIM)]
    v = spark.createDataFrame([(i, [float(np.float32(x)) for x in a], f"l{i % 3}") for i, a in enumerate(vectors)], "id INT, embeddings ARRAY<FLOAT>, label STRING")
    q = spark.createDataFrame([(i, [float(x) for x in a]) for i, a in enumerate(queries)], "query_id INT, embeddings ARRAY<DOUBLE>")
    return q.cache(), v.repartition(5).cache(), np.array(queries), np.array(vectors, dtype=np.float32).astype(float)


def brute(queries, vectors, k):
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    scores = np.round(unit(queries) @ unit(vectors).T, 9)
    return {q: list(np.lexsort((np.arange(len(vectors)), -s))[:k]) for q, s in enumerate(scores)}


def found(hits):
    out = {}
    for r in hits.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append(r["id"])
        assert -1.0 - 1e-9 <= r["score"] <= 1.0 + 1e-9
    return out


def test_exact_search_by_every_route(data):
    queries, vectors, q, v = data
    expected = brute(q, v, 4)
    assert found(vec.top_k(queries, vectors, 4)) == expected
    assert found(vec.top_k(queries, vectors, 4, max_sent=3)) == expected
    stored, cells = vec.build_cells(vectors, nlist=6)
    assert stored.count() == 300
    assert found(vec.top_k_cells(queries, stored, cells, 4)) == expected
    assert found(vec.top_k_cells(queries, stored, cells, 4, nprobe=6)) == expected


def test_more_probes_never_lose_hits(data):
    queries, vectors, q, v = data
    stored, cells = vec.build_cells(vectors, nlist=6)
    expected = brute(q, v, 5)
    recall = []
    for nprobe in (1, 3, 6):
        hits = found(vec.top_k_cells(queries, stored, cells, 5, nprobe))
        recall.append(sum(len(set(hits.get(i, [])) & set(expected[i])) for i in expected))
    assert recall == sorted(recall) and recall[-1] == 50


def test_hits_carry_fields(data):
    queries, vectors, *_ = data
    hits = vec.top_k(queries, vectors, 2, output=["label"])
    assert hits.filter(F.col("label") != F.concat(F.lit("l"), (F.col("id") % 3).cast("string"))).count() == 0


@pytest.mark.parametrize("max_sent", [2, 100])
def test_an_id_stored_twice_gives_k_hits(spark, max_sent):
    v = spark.createDataFrame([(1, [1.0, 0.0], "a"), (1, [1.0, 0.1], "b"), (2, [0.0, 1.0], "c")], "id INT, embeddings ARRAY<FLOAT>, label STRING")
    q = spark.createDataFrame([(i, [1.0, 0.0]) for i in range(3)], "query_id INT, embeddings ARRAY<DOUBLE>")
    hits = vec.top_k(q, v, 2, output=["label"], max_sent=max_sent)
    assert rows(hits.select("query_id", "rank", "id", "label"), "query_id", "rank") == [(i, r, 1, x) for i in range(3) for r, x in ((1, "a"), (2, "b"))]


def test_upsert_keeps_the_newest(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "id INT, v STRING, at INT")
    new = spark.createDataFrame([(2, "c", 2), (3, "d", 2)], "id INT, v STRING, at INT")
    assert rows(upsert(old, new, "id", "at"), "id") == [(1, "a", 1), (2, "c", 2), (3, "d", 2)]
    assert rows(upsert(None, new, "id", "at"), "id") == [(2, "c", 2), (3, "d", 2)]


def test_pending_work(spark):
    cat = spark.createDataFrame(
        [("1", "a.png", "x", "image", False), ("1", "a.png", "x", "Image", False), ("2", " ", "x", "Image", False), ("3", "c.png", None, "Image", True),
         ("4", "d.png", None, "json", False), ("5", "e.png", "y", "Image", False)],
        "id STRING, trusted_path STRING, label STRING, file_type STRING, is_corrupted BOOLEAN",
    )
    work = vec.pending_work(cat)
    assert rows(work.select("image_path"), "image_path") == [("a.png",), ("e.png",)]
    status = work.filter("image_path = 'a.png'").select("id", F.lit("SUCCESS").alias("status")).unionAll(
        work.filter("image_path = 'e.png'").select("id", F.lit("FAILED_EMBEDDING").alias("status"))
    )
    assert rows(vec.pending_work(cat, status).select("image_path")) == [("e.png",)]
    assert vec.pending_work(cat, limit=1).collect() == vec.pending_work(cat.repartition(3), limit=1).collect()


def test_encoding_isolates_failures(spark):
    work = spark.createDataFrame([(str(i), "bad" if i == 3 else f"p{i}", "") for i in range(10)], "id STRING, image_path STRING, label STRING").coalesce(1)

    def read(path):
        if path == "bad":
            raise OSError("unreadable")
        return path

    def encoder(paths):
        assert len(paths) <= 4
        if "p9" in paths:
            raise RuntimeError("out of memory")
        return np.array([[3.0, 4.0]] * len(paths))

    out = vec.encode(work, read, encoder, 2, batch=4)
    assert rows(out.groupBy("status").count(), "status") == [("FAILED_EMBEDDING", 2), ("FAILED_IMAGE_READ", 1), ("SUCCESS", 7)]
    stored = vec.collection_rows(out, "src", "m", 2, DATE)
    assert tuple(stored.columns) == vec.COLLECTION_FIELDS and not vec.needs_rebuild(stored) and vec.needs_rebuild(stored.drop("label"))
    assert [round(x, 4) for x in stored.first()["embeddings"]] == [0.6, 0.8]
    status = vec.status_rows(out, "src", "m", 2, "c", DATE)
    checks = {r["check_name"]: r["status"] for r in vec.vector_quality(stored, status, "c", 2, DATE).collect()}
    assert checks["embedding_failure_count"] == "WARN" and checks["embedding_dimension"] == "PASS" and checks["row_count_nonzero"] == "PASS"
    assert {r["check_name"]: r["status"] for r in vec.vector_quality(None, status, "c", 2, DATE).collect()}["collection_exists"] == "FAIL"


def test_zero_vectors_stay_finite(spark):
    df = spark.createDataFrame([([0.0, 0.0],), ([3.0, 4.0],)], "v ARRAY<FLOAT>")
    assert [[round(x, 4) for x in r[0]] for r in df.select(vec.l2_normalize(F.col("v"))).collect()] == [[0.0, 0.0], [0.6, 0.8]]


def test_a_collection_without_all_fields_is_built_anew(spark, tmp_path):
    root = str(tmp_path / "collection")
    full = [f"'{i}' as {c}" if c != "id" else "{} as id" for i, c in enumerate(vec.COLLECTION_FIELDS)]
    row = lambda n: spark.sql("select " + ", ".join(full).format(n))
    assert collections.refresh(spark, row(1), root) and not collections.refresh(spark, row(2), root)
    versions.publish(versions.read(spark, root).drop("label"), root)
    assert collections.refresh(spark, row(3), root)
    assert [r["id"] for r in versions.read(spark, root).collect()] == [3]
    assert not collections.refresh(spark, row(3).limit(0), root) and versions.read(spark, root).count() == 1
