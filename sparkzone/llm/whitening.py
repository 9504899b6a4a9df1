"""Embedding whitening by eigenvectors refined in mixed precision.

1. *Statistics.* Entries become integers, so sums are exact and don't depend on how rows are
   dealt to tasks: counts and sums per dimension first, then sums of products of the entries
   less the whole part of their mean. The covariance is one rational number per pair of
   dimensions, rounded once. Tasks add up their own rows; what meets is a number per pair.
2. *Eigenvectors.* The covariance (a matrix of dimensions, whatever the number of rows) is
   decomposed in float32 and corrected by Ogita-Aishima steps, which are products of matrices:
   with ``R = I - X'X`` and ``S = X'VX``, ``X + X E`` has about the square of the error. They
   run in float64 until they no longer gain, then in the longest float of the machine.
   Eigenvalues closer than the step's bound can't be told apart by it: it only makes their
   vectors orthonormal, so each such cluster is solved on its own, from ``X_J' (V - mu) X_J``,
   whose own scale shows differences that vanish beside the largest eigenvalue.
3. *Projection.* Rows less their mean go onto the components, over the root of the eigenvalue.

Cases: a row whose vector is null, empty, or holds null or non-finite entries takes no part;
neither does one of another length than most of the rest have (ties: the longer one). An entry
that a long can't hold stays at the bound of 2^62. Where values are too far apart for exact sums in 64
bits, products are added as floats. Equal rows count each; ids may be null or repeat; an empty
table gives no rows. A component without variance (of one row, of constant entries, of more
components than independent dimensions) has a null ``whitened`` and isn't part of
``identity_error``, which is null if no component has any. Vectors of fewer dimensions than
components have that many. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed by the contract: an entry c is read as floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
BOUND = 1 << 62
LOW = (1 << 31) - 1
STEPS = 30


def _vectors(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
    """By length: places of the usable rows, and their entries as integers."""
    lists = batch.column(column)
    sizes = np.asarray(lists.value_lengths().fill_null(0), np.int64)
    flat = np.asarray(lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False), float)
    ends = np.cumsum(sizes)
    out = {}
    for size in np.unique(sizes[sizes > 0]).tolist():
        rows = np.flatnonzero(sizes == size)
        values = flat[(ends[rows] - size)[:, None] + np.arange(size)]
        fine = np.isfinite(values).all(axis=1)
        if fine.any():
            # Beyond 2^53 every double is whole, so the shift is added as integers.
            with np.errstate(over="ignore"):
                whole = np.clip(np.floor(SCALE * values[fine]), -float(BOUND), float(BOUND)).astype(np.int64)
            out[size] = rows[fine], np.clip(whole, -BOUND, BOUND - SHIFT) + SHIFT
    return out


def _totals(batches, column: str):
    """Per length and dimension: rows, sums (as high and low parts) and the greatest distance from ``SHIFT``."""
    held: dict[int, list] = {}
    for batch in batches:
        for size, (_, x) in _vectors(batch, column).items():
            n, high, low, most = held.get(size, (0, 0, 0, 0))
            x = x - SHIFT
            held[size] = n + len(x), high + (x >> 31).sum(axis=0), low + (x & LOW).sum(axis=0), max(most, int(x.max()), -int(x.min()))
    for size, (n, high, low, most) in held.items():
        one = np.ones(size, np.int64)
        yield pa.RecordBatch.from_pydict({"size": size * one, "i": np.arange(size), "n": n * one, "high": high, "low": low, "most": most * one})


def _products(batches, column: str, size: int, centre: np.ndarray, exact: bool, most: int):
    """Sums of products of centred entries, one row per pair of dimensions."""
    kind = np.int64 if exact else np.float64
    total = np.zeros((size, size), kind)
    # So many rows at once that a float64 product of whole numbers stays exact.
    rows = max(1, (1 << 53) // max(1, most * most)) if exact else 1 << 16
    for batch in batches:
        _, x = _vectors(batch, column).get(size, (None, None))
        if x is None:
            continue
        y = (x - centre).astype(np.float64)
        for at in range(0, len(y), rows):
            part = y[at : at + rows]
            total += (part.T @ part).astype(kind)
    i, j = np.triu_indices(size)
    yield pa.RecordBatch.from_pydict({"i": i, "j": j, "v": total[i, j]})


def refined(a: np.ndarray, x: np.ndarray, kind, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and orthonormal eigenvectors of ``a`` by Ogita-Aishima steps from ``x``, in precision ``kind``.

    Clusters, within which a step only orthogonalises, are solved on their own between steps.
    """
    a, x = a.astype(kind), x.astype(kind)
    n, eps, norm = len(a), np.finfo(kind).eps, float(np.abs(a).sum(axis=0).max())
    best = np.inf
    for _ in range(steps):
        r = np.eye(n, dtype=kind) - x.T @ x
        s = x.T @ a @ x
        s = (s + s.T) / 2
        e = np.diag(s) / (1 - np.diag(r))
        bound = 2 * (_spectral(s - np.diag(e)) + norm * _spectral(r))
        gap = e[None, :] - e[:, None]
        apart = np.abs(gap) > bound
        off = s + e[None, :] * r
        change = np.where(apart, off / np.where(apart, gap, 1), r / 2)
        x = x + x @ change
        x = _clusters_solved(a, x, bound, kind)
        size = float(np.abs(change).max())
        # No step gains once changes are rounding, which is when they stop falling.
        if size <= 4 * n * eps and size >= best / 4:
            break
        best = min(best, size)
    e = np.array([(v @ a @ v) / (v @ v) for v in x.T], kind)
    order = np.argsort(-e, kind="stable")
    x = x[:, order]
    return e[order], x / np.sqrt((x * x).sum(axis=0))


def _spectral(m: np.ndarray) -> float:
    return float(np.linalg.norm(m.astype(np.float64), 2))


def _clusters_solved(a: np.ndarray, x: np.ndarray, bound: float, kind) -> np.ndarray:
    """``x`` with the vectors of each run of close eigenvalues turned to diagonalise their own block."""
    e = np.array([(v @ a @ v) / (v @ v) for v in x.T], kind)
    order = np.argsort(e, kind="stable")
    breaks = np.flatnonzero(np.diff(e[order]) > bound) + 1
    x = x.copy()
    for group in np.split(order, breaks):
        if len(group) < 2:
            continue
        some = x[:, group]
        mean = e[group].mean()
        block = some.T @ (a @ some) - mean * (some.T @ some)
        block = (block + block.T) / 2
        scale = np.abs(block).max()
        if scale > 0:
            turn = np.linalg.eigh((block / scale).astype(np.float64))[1].astype(kind)
            x[:, group] = some @ turn
    return x


def eigen(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues and their unit vectors (columns) of a symmetric matrix, to double precision."""
    scale = np.abs(v).max()
    if not len(v) or scale == 0:
        return np.zeros(len(v)), np.eye(len(v))
    a = v / scale
    x = np.linalg.eigh(a.astype(np.float32))[1]
    for kind in (np.float64, np.longdouble):
        e, x = refined(a, x, kind)
    # Of the two signs, the one whose largest entry is positive.
    x = x * np.sign(x[np.abs(x).argmax(axis=0), np.arange(len(v))])
    return (e * scale).astype(np.float64), x.astype(np.float64)


@dataclass(frozen=True)
class Whitening:
    """What the rows' statistics say; of the size of the dimensions."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float

    @property
    def size(self) -> int:
        return len(self.sums)

    def positive(self, k: int) -> int:
        """How many of the first k components have variance beyond rounding."""
        floor = self.size * np.finfo(float).eps * max(self.values[0], 0.0) if self.size else 0.0
        return int((self.values[:k] > floor).sum())


def _covariance(n: int, left: list[int], products: dict[tuple[int, int], int], exact: bool) -> np.ndarray:
    """Covariance from sums and sums of products of centred whole numbers, in the machine's longest float."""
    size = len(left)
    v = np.zeros((size, size), np.longdouble)
    for (i, j), p in products.items():
        if exact:
            whole, rest = divmod(n * int(p) - left[i] * left[j], n * n)
            v[i, j] = np.longdouble(whole) + np.longdouble(rest / (n * n))
        else:
            v[i, j] = np.longdouble(p) / n - np.longdouble(left[i]) / n * (np.longdouble(left[j]) / n)
        v[j, i] = v[i, j]
    return v


def fit(vectors: DataFrame, column: str = "embedding") -> Whitening | None:
    """Mean and components of all usable vectors; None if there is none."""
    only = vectors.select(column)
    totals = only.mapInArrow(lambda b: _totals(b, column), "size long, i long, n long, high long, low long, most long")
    found = totals.groupBy("size", "i").agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low"), F.max("most").alias("most"))
    best = found.groupBy("size").agg(F.max("n").alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    if best is None:
        return None
    size, n = best["size"], best["n"]
    rows = found.where(F.col("size") == size).orderBy("i").collect()  # one per dimension
    sums = [(r["high"] << 31) + r["low"] + n * SHIFT for r in rows]
    centre = [s // n for s in sums]
    most = 2 * max(r["most"] for r in rows) + 1
    exact = most * most < 1 << 53 and n * most * most < 1 << 62
    shift = np.array(centre, np.int64)
    got = only.mapInArrow(lambda b: _products(b, column, size, shift, exact, most), f"i long, j long, v {'long' if exact else 'double'}")
    products = {(r["i"], r["j"]): r["v"] for r in got.groupBy("i", "j").agg(F.sum("v").alias("v")).collect()}  # one per pair of dimensions
    v = _covariance(n, [s - n * c for s, c in zip(sums, centre)], products, exact)
    values, components = eigen(v)
    return Whitening(n, sums, values, components, float(np.trace(v)))


def _projected(model: Whitening, x: np.ndarray, k: int) -> np.ndarray:
    """Rows on the first k components, of unit variance where there is any."""
    centre = [s // model.n for s in model.sums]
    part = np.array([(s - model.n * c) / model.n for s, c in zip(model.sums, centre)])
    live = model.positive(k)
    out = np.full((len(x), k), np.nan)
    out[:, :live] = ((x - np.array(centre, np.int64)) - part) @ (model.components[:, :live] / np.sqrt(model.values[:live]))
    return out


def _deviations(model: Whitening, x: np.ndarray) -> list[int]:
    """Exact sums over dimensions of (n x - S)^2."""
    n = model.n
    centre = np.array([s // n for s in model.sums], np.int64)
    rest = [s - n * int(c) for s, c in zip(model.sums, centre)]
    y = x - centre
    most = max(int(y.max()), -int(y.min())) + 1
    if model.size * (n * most) ** 2 < 1 << 63:
        d = n * y - np.array(rest, np.int64)
        return (d * d).sum(axis=1).tolist()
    return [sum((n * a - b) ** 2 for a, b in zip(row, rest)) for row in y.tolist()]


def identity_error(vectors: DataFrame, model: Whitening, k: int = COMPONENTS, column: str = "embedding") -> float | None:
    """The largest absolute entry of the whitened rows' covariance less the identity."""
    live = model.positive(min(k, model.size))
    if not live:
        return None

    def each(batches):
        one, two = np.zeros(live), np.zeros((live, live))
        for batch in batches:
            _, x = _vectors(batch, column).get(model.size, (None, None))
            if x is not None:
                w = _projected(model, x, live)
                one, two = one + w.sum(axis=0), two + w.T @ w
        i, j = np.indices((live + 1, live)).reshape(2, -1)
        yield pa.RecordBatch.from_pydict({"i": i, "j": j, "v": np.vstack([one, two]).ravel()})

    sums = np.zeros((live + 1, live))
    for r in vectors.select(column).mapInArrow(each, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        sums[r["i"], r["j"]] = r["v"]
    mean = sums[0] / model.n
    return float(np.abs(sums[1:] / model.n - np.outer(mean, mean) - np.eye(live)).max())


OUT = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double"


def whitened(vectors: DataFrame, model: Whitening | None, k: int = COMPONENTS, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """One row per usable vector and component, as ``OUT``; a deviation beyond 38 digits is null."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(column).alias("vector"))
    if model is None:
        return rows.limit(0).selectExpr("vec_id", "0 component", "0L n", "cast(null as decimal(38,0)) deviation", "0D whitened", "0D explained")
    k = min(k, model.size)
    shares = model.values[:k] / model.trace if model.trace > 0 else np.full(k, np.nan)
    schema = to_arrow_schema(StructType.fromDDL(OUT))
    limit = 10**38

    def each(batches):
        for batch in batches:
            at, x = _vectors(batch, "vector").get(model.size, (None, None))
            if x is None:
                continue
            ids = batch.column("vec_id").take(pa.array(np.repeat(at, k)))
            far = [d if d < limit else None for d in _deviations(model, x)]
            deviation = pa.array(far, pa.decimal128(38, 0)).take(pa.array(np.repeat(np.arange(len(x)), k)))
            w, share = _projected(model, x, k).ravel(), np.tile(shares, len(x))
            columns = [
                ids,
                pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                pa.array(np.full(len(w), model.n), pa.int64()),
                deviation,
                pa.array(w, pa.float64(), mask=np.isnan(w)),
                pa.array(share, pa.float64(), mask=np.isnan(share)),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return rows.mapInArrow(each, OUT)
