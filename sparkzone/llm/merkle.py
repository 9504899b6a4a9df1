"""Merkle tree fingerprints of documents.

A text is cut into sections (at blank lines), a section into paragraphs (at line ends), a
paragraph into leaves of a few words each (after a mark that ends a clause, or at 5 words).
Every character belongs to exactly one leaf. A node's hash is over its children's hashes, up
to the root, which covers all of the text: equal texts have equal roots, and comparing two
trees from the top finds the branches, and so the character ranges, that differ.

A fingerprint is the tree in one string: the root, then sections separated by ``/``,
paragraphs by ``.``, each paragraph being its leaves' hashes of ``LEAF`` hex digits. Inner
hashes follow from the leaves, and are made only while comparing. Likeness is the Dice share
of common leaves, counting repeats.

Neighbours by id come from one exchange of the texts: rows are dealt to ranges of ids whose
bounds are quantiles, each range also gets the first row of the next range, and the text after
every text is the next row of its range. No range is ordered as a whole on one machine, and
the first document follows the last.

Cases: null text is empty, with the root of nothing and no leaves; two empty texts have
likeness 1, an empty and another 0; a single document follows itself; rows with equal ids
follow each other, ordered by text; null ids come first; no rows in give no rows out; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import xxhash
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import for_python, id_text, text_of, with_ids

LEAF = 8
SECTION = re.compile(r"\n(?:[ \t\r]*\n)+")
# Up to five words, fewer where a clause ends, with the white space after them.
CLAUSE = re.compile(r"\s+|\s*(?:[^\s.,;:!?]+\s+){0,4}(?:[^\s.,;:!?]+(?:[.,;:!?]+\s*|\s+|$)|[.,;:!?]+\s*)")
# Ranges of ids per shuffle partition, so that they even out.
RANGES_PER_PARTITION = 4


def _hash(data: bytes, digits: int) -> str:
    return xxhash.xxh3_128_hexdigest(data)[:digits]


def leaves(paragraph: str) -> list[str]:
    """Consecutive pieces that make up the paragraph."""
    out, at = [], 0
    for found in CLAUSE.finditer(paragraph):
        if found.start() > at:
            out.append(paragraph[at : found.start()])
        if found.end() > found.start():
            out.append(found.group())
        at = found.end()
    if at < len(paragraph):
        out.append(paragraph[at:])
    return out


def _split_after(pattern: re.Pattern, text: str) -> list[str]:
    out, at = [], 0
    for found in pattern.finditer(text):
        out.append(text[at : found.end()])
        at = found.end()
    return [*out, text[at:]] if at < len(text) else out


def tree(text: str) -> list[list[list[str]]]:
    """Leaf texts by section and paragraph; joined, they are the text."""
    return [[leaves(p) for p in section.splitlines(keepends=True)] for section in _split_after(SECTION, text)]


def fingerprint(text: str) -> str:
    sections = [[[_hash(leaf.encode(), LEAF) for leaf in p] for p in s] for s in tree(text)]
    # The root also covers the bytes themselves, so that short leaf hashes can't make two texts equal.
    root = _hash("/".join(node_hash(["".join(p) for p in s]) for s in sections).encode() + hashlib.sha256(text.encode()).digest(), 32)
    return ":".join((root, "/".join(".".join("".join(p) for p in s) for s in sections)))


def node_hash(children: list[str]) -> str:
    return _hash(" ".join(_hash(c.encode(), 32) for c in children).encode(), 32)


def _leaf_hashes(mark: str) -> list[str]:
    flat = mark.partition(":")[2].replace("/", "").replace(".", "")
    return [flat[i : i + LEAF] for i in range(0, len(flat), LEAF)]


def likeness(left: str, right: str) -> float:
    """0 to 1, from two fingerprints alone."""
    if left.partition(":")[0] == right.partition(":")[0]:
        return 1.0
    a, b = Counter(_leaf_hashes(left)), Counter(_leaf_hashes(right))
    total = a.total() + b.total()
    common = sum(min(n, b[h]) for h, n in a.items() if h in b)
    return 2.0 * common / total if total else 0.0


def differing(left: str, right: str) -> list[tuple[int, int]]:
    """(section, paragraph) of ``left`` whose hashes differ from those at the same place of ``right``.

    Branches with equal hashes are not looked into.
    """
    if left.partition(":")[0] == right.partition(":")[0]:
        return []
    a, b = ([s.split(".") for s in m.partition(":")[2].split("/")] for m in (left, right))
    out = []
    for i in range(max(len(a), len(b))):
        x, y = a[i] if i < len(a) else [], b[i] if i < len(b) else []
        if x and y and node_hash(x) == node_hash(y):
            continue
        out += [(i, j) for j in range(max(len(x), len(y))) if (x[j] if j < len(x) else None) != (y[j] if j < len(y) else None)]
    return out


def with_next(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """Ranges of rows in id order, each with the first row of the next range at its end.

    Columns: part, doc_id, text, last (whether the row only serves as the next one). The last
    range ends with the first row of all.
    """
    docs = documents.select("doc_id", text_of().alias("text"))
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(1, shuffles * RANGES_PER_PARTITION)
    # As many numbers as there are ranges: bounds, not data.
    got = docs.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)] or [0.5], 10 * ranges).alias("q")).first()["q"] or []
    cut = Bucketizer(splits=[-math.inf, *sorted({float(x) for x in got} or {0.0}), math.inf], inputCol="at", outputCol="range", handleInvalid="keep")
    # Ids that a double can't tell apart share a range, where they are ordered exactly.
    placed = cut.transform(docs.withColumn("at", F.col("doc_id").cast("double")))
    part = F.when(F.col("doc_id").isNull(), -1).otherwise(F.col("range").cast("int"))
    placed = placed.select("doc_id", "text", part.alias("part"))
    # The first id of each range, and the range before it that has rows.
    firsts = placed.groupBy("part").agg(F.min("doc_id").alias("first"))
    order = sorted((r["part"], r["first"]) for r in firsts.collect())  # one row per range
    if not order:
        return placed.withColumn("last", F.lit(False)).limit(0)
    serves = {}
    for (_, first), (before, _) in zip(order, [order[-1], *order[:-1]]):
        serves[first] = before
    heads = spark.createDataFrame([(k, v) for k, v in serves.items()], "head long, before int")
    own = placed.withColumn("last", F.lit(False))
    # The hint is safe: there is one head per range.
    again = docs.join(F.broadcast(heads), docs.doc_id.eqNullSafe(heads["head"])).select("doc_id", "text", F.col("before").alias("part"), F.lit(True).alias("last"))
    return own.unionByName(again.select(*own.columns)).repartition(shuffles, "part").sortWithinPartitions("part", "last", F.col("doc_id").asc_nulls_first(), "text")


COMPARED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compared(batches):
    previous = None
    for batch in batches:
        rows = []
        for part, doc_id, text, last in zip(batch["part"], batch["doc_id"], batch["text"], batch["last"]):
            mark = fingerprint(text)
            if previous is not None and previous[0] == part and not previous[4]:
                rows.append(_row(previous, text, mark))
            # Rows that only serve as the next one are sorted; the smallest is the right one.
            previous = (part, doc_id, text, mark, last)
        yield with_ids(rows, [c.split()[0] for c in COMPARED.split(", ")])


def _row(of: tuple, next_text: str, next_mark: str) -> tuple:
    _, doc_id, text, mark, _ = of
    n = len(text) // 4
    edited = text[: len(text) - n] + next_text[:n] if n else text
    edited_mark = fingerprint(edited) if n else mark
    return (doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), mark, edited_mark, likeness(mark, edited_mark), likeness(mark, next_mark))


def compare_neighbours(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and likenesses, as ``COMPARED``."""
    return with_next(spark, for_python(documents)).select("part", id_text(), "text", "last").mapInPandas(_compared, COMPARED)


def fingerprints(documents: DataFrame) -> DataFrame:
    """doc_id and fingerprint."""

    def run(batches):
        for b in batches:
            yield with_ids([(i, fingerprint(t)) for i, t in zip(b["doc_id"], b["text"])], ["doc_id", "fingerprint"])

    return for_python(documents).select(id_text(), text_of().alias("text")).mapInPandas(run, "doc_id long, fingerprint string")

