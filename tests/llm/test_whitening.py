from __future__ import annotations

from fractions import Fraction

import numpy as np
import pytest

from sparkzone.llm import whitening
from sparkzone.llm.common import table
from sparkzone.llm.queries import QUERIES

from .conftest import SMALL

SCHEMA = "vec_id LONG, embedding ARRAY<FLOAT>"


def exact_covariance(x):
    n, d = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(d)]
    return s, [[Fraction(sum(n * r[i] * n * r[j] for r in x) - n * s[i] * s[j], n**3) for j in range(d)] for i in range(d)]


def test_query_agrees_with_exact_statistics_and_a_plain_decomposition(spark):
    got = QUERIES["op11_embedding_whitening"](spark, SMALL).collect()
    rows = [(r["vec_id"], [float(c) for c in r["embedding"]]) for r in table(spark, SMALL, "embeddings").collect() if r["embedding"]]
    rows = [(i, [int(np.floor(1024 * c)) + 100000 for c in v]) for i, v in rows if np.isfinite(v).all()]
    x = np.array([v for _, v in rows])
    n = len(x)
    s = x.sum(axis=0)
    v = (n * x - s).T.astype(float) @ (n * x - s) / n**3
    e, c = np.linalg.eigh(v)
    e, c = e[::-1], c[:, ::-1]
    assert len(got) == 8 * n and {r["n"] for r in got} == {n}
    place = {i: k for k, (i, _) in enumerate(rows)}
    proj = (x - s / n) @ (c[:, :8] / np.sqrt(e[:8]))
    mine = np.zeros((n, 8))
    for r in got:
        mine[place[r["vec_id"]], r["component"] - 1] = r["whitened"]
        assert r["explained"] == pytest.approx(e[r["component"] - 1] / np.trace(v), rel=1e-9)
        assert r["deviation"] == int(((n * x[place[r["vec_id"]]] - s) ** 2).sum())
        assert r["identity_error"] < 1e-10
    signs = np.sign((mine * proj).sum(axis=0))
    assert np.abs(mine - proj * signs).max() < 1e-8


def test_covariance_is_the_exact_one_however_rows_are_dealt(spark):
    rng = np.random.default_rng(1)
    data = [(i, [float(c) for c in r]) for i, r in enumerate(rng.normal(size=(37, 5)))]
    models = [whitening.fit(spark.createDataFrame(data, SCHEMA).repartition(k)) for k in (1, 7)]
    assert models[0].sums == models[1].sums and (models[0].components == models[1].components).all()
    x = [[int(np.floor(1024 * float(np.float32(c)))) + 100000 for c in v] for _, v in data]
    s, v = exact_covariance(x)
    assert models[0].sums == s
    assert models[0].trace == pytest.approx(float(sum(v[i][i] for i in range(5))), rel=1e-15)
    for k in range(5):
        c = [Fraction(float(q)) for q in models[0].components[:, k]]
        res = [sum(v[i][j] * c[j] for j in range(5)) - Fraction(models[0].values[k]) * c[i] for i in range(5)]
        assert max(abs(float(q)) for q in res) < 1e-14 * models[0].values[0]


def clustered(values, seed=3):
    rng = np.random.default_rng(seed)
    q = np.linalg.qr(rng.normal(size=(len(values), len(values))))[0].astype(np.longdouble)
    for _ in range(3):  # orthonormal to the last bit
        q = q + q @ (np.eye(len(values)) - q.T @ q) / 2
    a = q @ np.diag(np.array(values, np.longdouble)) @ q.T
    return (a + a.T) / 2, q


@pytest.mark.parametrize(
    "values",
    [
        [9.0, 5.0, 3.0, 1.0, 0.5],
        [1.0, 1.0 + 1e-8, 1.0 + 2e-8, 0.3, 0.3 - 1e-9, 0.1],
        [4.0, 4.0 + 1e-6, 4.0 + 1e-12, 1e-3, 1e-3 + 1e-13, 1e-9],
        [2.0, 2.0, 2.0, 1.0, 0.0, 0.0],
        [1e12, 1.0, 1.0 + 1e-5, 1e-3],
    ],
)
def test_refinement_reaches_double_precision_within_clusters(values):
    a, q = clustered(values)
    e, x = whitening.eigen(a)
    order = np.argsort(-np.array(values), kind="stable")
    want = np.array(values)[order]
    assert np.abs(e - want).max() <= 4e-16 * max(values)
    assert np.abs(x.T @ x - np.eye(len(values))).max() < 1e-15
    # A vector is known up to rounding over the distance to the next eigenvalue.
    for k in range(len(want)):
        near = np.abs(want - want[k])
        gap = near[near > 0].min()
        same = np.flatnonzero(near == 0)
        if gap > 1e-14 * max(values):
            space = q[:, order[same]]
            missed = x[:, k] - space @ (space.T @ x[:, k])
            assert np.abs(missed).max() < max(4e-16, 1e-18 * max(values) / gap), (k, gap)


def test_one_float32_decomposition_alone_is_not_enough():
    a, _ = clustered([9.0, 5.0, 3.0, 1.0, 0.5])
    rough = np.linalg.eigh(a.astype(np.float32))[1].astype(float)
    assert np.abs(rough.T @ rough - np.eye(5)).max() > 1e-9


def test_unusable_rows_and_other_lengths_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    fine = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [0.0, 3.0]), (2**62 + 1, [-2.0, 0.5])]
    bad = [(9, None), (8, []), (7, [1.0, None]), (6, [nan, 1.0]), (5, [inf, 1.0]), (4, [1.0, 2.0, 3.0])]
    frame = spark.createDataFrame([(*r, "x") for r in fine + bad], SCHEMA + ", component STRING")
    out = whitening.whitened(frame, whitening.fit(frame)).collect()
    assert sorted((r["vec_id"] or 0, r["component"]) for r in out) == sorted((i or 0, k) for i, _ in fine for k in (1, 2))
    assert {r["n"] for r in out} == {4}
    assert whitening.identity_error(frame, whitening.fit(frame)) < 1e-12


def test_without_variance_and_without_rows(spark):
    empty = spark.createDataFrame([(1, None)], SCHEMA)
    assert whitening.fit(empty) is None and whitening.whitened(empty, None).collect() == []
    one = spark.createDataFrame([(1, [1.0, 2.0])], SCHEMA)
    model = whitening.fit(one)
    out = whitening.whitened(one, model).collect()
    assert [(r["whitened"], r["deviation"], r["explained"]) for r in out] == [(None, 0, None)] * 2
    assert whitening.identity_error(one, model) is None
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 5.0]) for i in range(4)], SCHEMA)
    kinds = [(r["component"], r["whitened"] is None) for r in whitening.whitened(line, whitening.fit(line)).orderBy("vec_id", "component").collect()]
    assert kinds[:3] == [(1, False), (2, True), (3, True)]


def test_huge_entries_have_a_result(spark):
    frame = spark.createDataFrame([(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [0.0, 3.0])], SCHEMA)
    model = whitening.fit(frame)
    out = whitening.whitened(frame, model).collect()
    # The bounds on both sides cancel; the entry of zero and the lower bound bring a shift each.
    assert len(out) == 6 and model.sums[0] == 2 * whitening.SHIFT
    assert all(r["deviation"] is None or r["deviation"] >= 0 for r in out)
