"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at most three bits apart have a common variant within one bit of the one
and two bits of the other; at most two bits apart, within one bit of both. At three bits their
parities differ, so it is enough that every fingerprint emits its variants within one bit, and
those of odd parity also those of two bits: half the radius, rounded down and up.

Variants are dealt by their leading bits. A fingerprint is sent once to every range of
variants that its ball touches, that is for flips among the leading bits only; the flips among
the others are made where they are looked up. Shuffled rows per fingerprint stay few (22 with
64 ranges) while the variants (65 or 2,081) never leave a task. The number of ranges follows
the number of distinct fingerprints.

At a variant, the fingerprints within one bit link to the first of them, and so do those that
reach it within two bits: a star, not all pairs. Sharing a variant this way implies the
distance; it is still verified. Stars of a range are reduced to a spanning forest, and
components are found over distinct fingerprints, so copies, however many, are one node.

Cases: null or empty text has fingerprint zero and links like any other; fewer words than a
shingle are one shingle; a bit that exactly half of the hashes set is 0; repeated rows share a
component; null ids never name a component unless it has no others; no rows in give no rows
out; extra columns are ignored.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .common import for_python, free_name, text_of, written
from .graph import components

SHINGLE, SEED, RADIUS, BITS = 3, 42, 3, 64
# Distinct fingerprints per range of variants; each brings about a thousand variants.
PER_RANGE = 4096
# Variants looked up at a time.
AT_ONCE = 1 << 19
FILTER_BITS = 22


def simhash(text: str) -> int:
    """The fingerprint as an unsigned number."""
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) < SHINGLE:
        return xxhash.xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(found) - SHINGLE + 1].tolist(), ends[SHINGLE - 1 :].tolist())
    hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], ">u8")
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        block = hashes[at : at + (1 << 15)].view(np.uint8).reshape(-1, 8)
        ones += np.add.reduce(np.unpackbits(block, axis=1), axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(">u8")[0])


@F.pandas_udf(LongType())
def _fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series(np.fromiter(map(simhash, texts), np.uint64, len(texts)).view(np.int64))


def fingerprinted(documents: DataFrame) -> DataFrame:
    """The documents with ``fp``, the fingerprint as a signed long."""
    return for_python(documents).withColumn("fp", _fingerprints(text_of()))


def _ball(bits: int, radius: int) -> np.ndarray:
    """Masks of at most ``radius`` ones among the lowest ``bits`` bits, fewest ones first."""
    return np.array([sum(1 << b for b in flips) for r in range(radius + 1) for flips in combinations(range(bits), r)], np.uint64)


def _local_links(fps: np.ndarray, route: int, lead: int) -> tuple[np.ndarray, np.ndarray]:
    """Links found in one range: fingerprints and the one each is linked to."""
    low = BITS - lead
    own_route = fps >> np.uint64(low) if lead else np.zeros(len(fps), np.uint64)
    flipped = np.bitwise_count(own_route ^ np.uint64(route)).astype(int)
    budget = 1 + np.bitwise_count(fps).astype(int) % 2
    tails = fps & np.uint64((1 << low) - 1)
    balls = [_ball(low, r) for r in range(3)]
    # Everything within one bit, by variant; the first of each variant is the centre of its star.
    keys, owners = [], []
    for left in (0, 1):
        who = np.flatnonzero(flipped == 1 - left)
        keys.append((tails[who, None] ^ balls[left][None, :]).ravel())
        owners.append(np.repeat(who, len(balls[left])))
    key, owner = np.concatenate(keys), np.concatenate(owners)
    if not len(key):
        return fps[:0], fps[:0]
    order = np.lexsort((owner, key))
    key, owner = key[order], owner[order]
    first = np.r_[True, key[1:] != key[:-1]]
    key, owner = key[first], owner[first]
    spread = lambda v: (v * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - FILTER_BITS)
    seen = np.zeros(1 << FILTER_BITS, bool)
    seen[spread(key)] = True
    left_at, right_at = [], []
    for left in (0, 1, 2):
        who = np.flatnonzero(budget - flipped == left)
        step = max(1, AT_ONCE // len(balls[left]))
        for at in range(0, len(who), step):
            some = who[at : at + step]
            variants = (tails[some, None] ^ balls[left][None, :]).ravel()
            maybe = np.flatnonzero(seen[spread(variants)])
            place = np.minimum(np.searchsorted(key, variants[maybe]), len(key) - 1)
            hit = key[place] == variants[maybe]
            a, b = some[maybe[hit] // len(balls[left])], owner[place[hit]]
            apart = a != b
            pair = np.unique(np.stack([a[apart], b[apart]]), axis=1)
            left_at.append(pair[0])
            right_at.append(pair[1])
    a, b = fps[np.concatenate(left_at)], fps[np.concatenate(right_at)]
    close = np.bitwise_count(a ^ b) <= RADIUS
    return a[close], b[close]


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[list[int], list[int]]:
    """Every node with another of its tree, one link per node at most."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while root.setdefault(top, top) != top:
            top = root[top]
        while root[x] != top:
            root[x], x = top, root[x]
        return top

    for x, y in zip(a.tolist(), b.tolist()):
        x, y = find(x), find(y)
        if x != y:
            root[max(x, y)] = min(x, y)
    return [n for n in root if find(n) != n], [find(n) for n in root if find(n) != n]


def links(fps: DataFrame) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that connect all within the radius."""
    total = fps.count()
    lead = min(28, max(0, math.ceil(math.log2(max(1, total / PER_RANGE)))))
    shift = BITS - lead
    near = [int(m) for m in _ball(lead, 1)]
    far = [int(m) for m in _ball(lead, 2)]
    masks = F.when(F.bit_count("fp") % 2 == 1, F.array(*map(F.lit, far))).otherwise(F.array(*map(F.lit, near)))
    lead_of = F.shiftrightunsigned("fp", shift) if lead else F.lit(0).cast("long")
    sent = fps.select("fp", lead_of.alias("lead"), F.explode(masks).alias("mask")).select("fp", F.col("lead").bitwiseXOR(F.col("mask").cast("long")).alias("route"))

    def link(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        found = group["fp"].to_numpy(np.int64).view(np.uint64)
        a, b = _forest(*_local_links(np.sort(found), int(key[0]), lead))
        return pd.DataFrame({"a": np.array(a, np.uint64).view(np.int64), "b": np.array(b, np.uint64).view(np.int64)})

    return sent.groupBy("route").applyInPandas(link, "a long, b long")


def _named(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """doc_id and fp of every document; the distinct fp with their least doc_id and their component.

    A component's key is its least fingerprint. Its least id is none: components of null ids
    have no id, and those of one repeated id share it.
    """
    docs = written(fingerprinted(documents.select("doc_id", "text")).select("doc_id", "fp"), "simhash")
    fps = written(docs.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    parts = components(links(fps))
    return docs, fps.join(parts.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, fp and component_id of every document."""
    docs, named = _named(documents)
    ids = named.groupBy("component").agg(F.min("least").alias("component_id"))
    return docs.join(named.select("fp", "component").join(ids, "component").drop("component"), "fp").select("doc_id", "fp", "component_id")


def one_of_each(documents: DataFrame) -> DataFrame:
    """One document of each component, that of the least (doc_id, fp), null ids last; of rows alike in both one stays."""
    first = F.min(F.struct(F.col("least").isNull().alias("none"), F.col("least").alias("keep_id"), F.col("fp").alias("keep_fp"))).alias("first")
    keep = _named(documents)[1].groupBy("component").agg(first).select("first.keep_id", "first.keep_fp")
    fp = free_name(documents.columns, "_fp")
    marked = for_python(documents).withColumn(fp, _fingerprints(text_of()))
    kept = marked.join(keep, marked["doc_id"].eqNullSafe(keep["keep_id"]) & (marked[fp] == keep["keep_fp"]), "left_semi")
    return kept.dropDuplicates(["doc_id", fp]).select(*documents.columns)
