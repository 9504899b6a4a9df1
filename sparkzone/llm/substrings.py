"""Substring dedup by fixed-block anchors.

Windows are ``WINDOW`` words. Any window contains a whole block of ``BLOCK`` words of every
document that has it, wherever it lies there, since blocks start at every multiple of
``BLOCK``, half a window. So non-overlapping blocks of every document are indexed, every
rolling stretch of ``BLOCK`` words probes them, and a repeat of a window shows as a hit.

1. *Anchors.* Blocks and probes meet by hash. A probe hits if a document with a smaller id has
   the block; a block is hit if a document with a larger id probes it. Only the least and the
   greatest id per hash are compared, so a passage in very many documents makes no pairs.
   They are found within each chunk of documents first, so that a hash brings at most two
   entries per chunk to its bucket, however many documents have it; the bounds of all chunks
   go back to each chunk that has the hash, whose documents compare themselves with them.
2. *Extension.* The windows around hits, on both sides, are compared as a whole, again by least
   id per window. Consecutive repeated windows make up the maximal exact repeat.
3. *Removal.* Words in repeated windows of larger ids go.

A row per word would cost more than the texts. Tasks therefore exchange arrays: one row holds
what a chunk of documents has for one bucket of hashes (or the other way), and a reducer works
on arrays of one bucket. The number of buckets and of chunks, which are written once, follows
the size of the texts. Probes carry 32 bits besides their bucket, as a false hit only costs a comparison; windows are compared by 80 bits.

Cases: null text has no words; documents shorter than a window lose nothing and take part in
nothing; a window repeated within its own document only is no repeat; rows with equal ids don't
dedupe each other; a null id counts as larger than all others; no rows in give no rows out;
extra columns pass through ``without_repeats`` and are ignored otherwise.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, for_python, free_name, text_of, written

WINDOW, BLOCK = 50, 25
# Text bytes behind a bucket of hashes, the most buckets, and bytes of rows in a chunk.
BUCKET_BYTES, GROUP_BYTES, MOST = 4 << 20, 4 << 20, 1 << 17
# Words whose hashes a task gathers before it sends them, and entries of a bucket it compares at a time, about.
BATCH_WORDS, AT_ONCE = 1 << 18, 1 << 18
LAST_ID = (1 << 63) - 1
SPAN = re.compile(WORD)
# Odd multipliers of the rolling hashes.
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)

def word_hashes(text: str) -> np.ndarray:
    found = text.encode("utf-8", "surrogatepass").split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93) ^ (h >> np.uint64(32))


def rolling(words: np.ndarray, width: int, factor: int = FACTORS[0]) -> np.ndarray:
    """A hash of every stretch of ``width`` words, put together from stretches of powers of two."""
    n = len(words) - width + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    out, done = np.zeros(n, np.uint64), 0
    part, size = words, 1
    while True:
        shift = np.uint64(pow(factor, size, 1 << 64))
        if width & size:
            out *= shift
            out += part[done : done + n]
            done += size
        if done == width:
            return _mixed(out)
        part = part[:-size] * shift + part[size:]
        size *= 2


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)


def _rows(at: np.ndarray, schema: pa.Schema, chunk: int | None = None, **arrays: np.ndarray):
    """Arrays cut by the (sorted) bucket or chunk of their entries, as rows of binaries."""
    starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else np.zeros(0, int)
    ends = np.r_[starts[1:], len(at)]
    arrays = {k: np.ascontiguousarray(a) for k, a in arrays.items()}
    columns = [pa.array(at[starts], pa.int64())]
    for name in schema.names[1:]:
        if name == "chunk":
            columns.append(pa.array(np.full(len(starts), chunk, np.int64)))
        else:
            columns.append(pa.array([arrays[name][i:j].tobytes() for i, j in zip(starts, ends)], pa.binary()))
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def _joined(table: pa.Table, name: str, kind) -> np.ndarray:
    parts = [np.frombuffer(x.as_buffer(), kind) for x in table.column(name) if x.is_valid]
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def _chunks(table: pa.Table) -> np.ndarray:
    """The chunk of every entry."""
    sizes = [len(x.as_buffer()) // 8 for x in table.column("ids")]
    return np.repeat(table.column("chunk").to_numpy().astype(np.int64), np.array(sizes, np.int64))


ENTRY = pa.schema([("at", pa.int64()), ("chunk", pa.int64()), ("ids", pa.binary()), ("hashes", pa.binary()), ("kinds", pa.binary())])
ENTRY_SQL = "at long, chunk long, ids binary, hashes binary, kinds binary"
HIT = pa.schema([("at", pa.int64()), ("hashes", pa.binary()), ("least", pa.binary()), ("most", pa.binary())])
HIT_SQL = "at long, hashes binary, least binary, most binary"
REPEAT = pa.schema([("at", pa.int64()), ("hashes", pa.binary()), ("checks", pa.binary()), ("least", pa.binary())])
REPEAT_SQL = "at long, hashes binary, checks binary, least binary"


def _bound(keys: tuple[np.ndarray, ...], ids: np.ndarray, greatest: bool) -> np.ndarray:
    """Places of the least or greatest id per key; the first key is the one to sort by."""
    order = np.lexsort((ids, *keys[::-1]))
    new = np.zeros(max(0, len(ids) - 1), bool)
    for k in keys:
        new |= k[order][1:] != k[order][:-1]
    return order[np.r_[new, True] if greatest else np.r_[True, new]] if len(ids) else order


def _anchors(batches, buckets: int, key: str):
    """Blocks (kind 1) with their least id and probes (kind 0) with their greatest, per chunk."""

    def sent(chunk, held):
        hashes, ids, kinds = [], [], []
        for kind in (0, 1):
            h = np.concatenate([x[kind] for _, x in held])
            i = np.repeat(np.array([doc for doc, _ in held], np.int64), [len(x[kind]) for _, x in held])
            some = _bound((h,), i, kind == 0)
            hashes.append(h[some])
            ids.append(i[some])
            kinds.append(np.full(len(some), kind, np.uint8))
        h = np.concatenate(hashes)
        at = _bucket(h, buckets)
        order = np.argsort(at, kind="stable")
        return _rows(at[order], ENTRY, chunk, ids=np.concatenate(ids)[order], hashes=h[order].astype(np.uint32), kinds=np.concatenate(kinds)[order])

    for rows in batches:
        for chunk, docs in zip(rows.column("at").to_pylist(), _unpacked(rows)):
            held, n = [], 0
            for doc, text in zip(docs.column(key).to_pylist(), docs.column("text")):
                h = rolling(word_hashes(text.as_py() or ""), BLOCK)
                if len(h) < WINDOW - BLOCK + 1:
                    continue
                held.append((doc, (h, h[::BLOCK])))
                n += len(h)
                if n >= BATCH_WORDS:
                    yield sent(chunk, held)
                    held, n = [], 0
            if held:
                yield sent(chunk, held)


def _pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each pair once, in order."""
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])] if len(a) else np.zeros(0, bool)
    return a[new], b[new]


def _slices(h: np.ndarray):
    """Places of entries, equal hashes together, about ``AT_ONCE`` at a time."""
    parts = 1 + len(h) // AT_ONCE
    if parts == 1:
        yield np.arange(len(h))
        return
    # The lowest bits, as a bucket's hashes share the highest.
    which = (h.astype(np.uint32) * np.uint32(0x9E3779B1) >> np.uint32(16)) * np.uint32(parts) >> np.uint32(16)
    for k in range(parts):
        yield np.flatnonzero(which == k)


def _free() -> None:
    """Give memory of the group before back, which the worker else keeps."""
    pa.default_memory_pool().release_unused()


def _together(batches: list[pa.RecordBatch], schema: pa.Schema) -> pa.Table:
    _free()
    return pa.Table.from_batches(batches, schema)


def _hits(table: pa.Table) -> pa.Table:
    """Least id of blocks and greatest of probes per hash of one bucket, for every chunk that has it, if a probe can hit."""
    all_ids, all_h, all_kinds = _joined(table, "ids", np.int64), _joined(table, "hashes", np.uint32), _joined(table, "kinds", np.uint8)
    all_chunks, out = _chunks(table), []
    for some in _slices(all_h):
        ids, block = all_ids[some], all_kinds[some] == 1
        known, where = np.unique(all_h[some], return_inverse=True)
        least, most = np.full(len(known), LAST_ID, np.int64), np.full(len(known), -LAST_ID, np.int64)
        np.minimum.at(least, where[block], ids[block])
        np.maximum.at(most, where[~block], ids[~block])
        met = (least < most)[where]
        at, where = _pairs(all_chunks[some][met], where[met])
        out.append(_rows(at, HIT, hashes=known[where], least=least[where], most=most[where]))
    return _together(out, HIT)


def _known_hits(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, each once, with their bounds; equal ones of several buckets have the wider bounds."""
    h, least, most = _joined(table, "hashes", np.uint32), _joined(table, "least", np.int64), _joined(table, "most", np.int64)
    order = np.argsort(h, kind="stable")
    known, first = np.unique(h[order], return_index=True)
    if not len(known):
        return h, least, most
    return known, np.minimum.reduceat(least[order], first), np.maximum.reduceat(most[order], first)


def _known_repeats(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    h, check, least = _joined(table, "hashes", np.uint64), _joined(table, "checks", np.uint16), _joined(table, "least", np.int64)
    order = np.argsort(h, kind="stable")
    return h[order], check[order], least[order]


def _unpacked(table):
    """The documents of each row, as one batch."""
    for blob in table.column("docs"):
        with pa.ipc.open_stream(blob.as_buffer()) as stream:
            yield from stream


def _checks(words: np.ndarray) -> np.ndarray:
    return (rolling(words, WINDOW, FACTORS[1]) >> np.uint64(48)).astype(np.uint16)


def _windows(chunk: int, texts: pa.Table, hits: pa.Table, buckets: int, key: str) -> pa.Table:
    """Windows around the hits of a chunk's documents, by bucket of their hash, with the least and the greatest id of each."""
    known, least, most = _known_hits(hits)
    ids, hashes, checks = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.uint16)]
    for batch in _unpacked(texts) if len(known) else []:
        for doc, text in zip(batch.column(key).to_pylist(), batch.column("text")):
            words = word_hashes(text.as_py() or "")
            h = rolling(words, WINDOW)
            if not len(h):
                continue
            stretches = rolling(words, BLOCK).astype(np.uint32)
            place = np.minimum(np.searchsorted(known, stretches), len(known) - 1)
            same = known[place] == stretches
            hit = same & (least[place] < doc)
            hit[::BLOCK] |= same[::BLOCK] & (most[place[::BLOCK]] > doc)
            at = np.flatnonzero(hit)
            if not len(at):
                continue
            # A window that starts up to half its length before a hit, or at it, contains it.
            edge = np.zeros(len(words) + 2, np.int32)
            np.add.at(edge, np.maximum(at - (WINDOW - BLOCK), 0), 1)
            np.add.at(edge, at + 1, -1)
            start = np.flatnonzero(np.cumsum(edge)[: len(h)])
            some, first = np.unique(h[start], return_index=True)
            ids.append(np.full(len(some), doc, np.int64))
            hashes.append(some)
            checks.append(_checks(words)[start][first])
    i, h, check = np.concatenate(ids), np.concatenate(hashes), np.concatenate(checks)
    some = np.union1d(_bound((h, check), i, False), _bound((h, check), i, True))
    some = some[np.argsort(_bucket(h[some], buckets), kind="stable")]
    return pa.Table.from_batches([_rows(_bucket(h[some], buckets), ENTRY, chunk, ids=i[some], hashes=h[some], kinds=check[some])])


def _repeats(table: pa.Table) -> pa.Table:
    """The least id of each window of one bucket, for the chunks that have it in a document with a larger id."""
    all_ids, all_h, all_checks = _joined(table, "ids", np.int64), _joined(table, "hashes", np.uint64), _joined(table, "kinds", np.uint16)
    all_chunks, out = _chunks(table), []
    for some in _slices(all_h):
        order = some[np.lexsort((all_ids[some], all_checks[some], all_h[some]))]
        ids, h, check, chunk = all_ids[order], all_h[order], all_checks[order], all_chunks[order]
        new = np.r_[True, (h[1:] != h[:-1]) | (check[1:] != check[:-1])] if len(h) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        which = np.cumsum(new) - 1
        again = ids > ids[first][which]
        at, which = _pairs(chunk[again], which[again])
        place = first[which]
        out.append(_rows(at, REPEAT, hashes=h[place], checks=check[place], least=ids[place]))
    return _together(out, REPEAT)


def _removed(text: str, doc: int, repeats: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray | None:
    """Which words of the text go; None where none does."""
    known, check, least = repeats
    if not len(known):
        return None
    words = word_hashes(text)
    h = rolling(words, WINDOW)
    place = np.searchsorted(known, h)
    at = np.flatnonzero(known[np.minimum(place, len(known) - 1)] == h)
    if not len(at):
        return None
    place, own, again = place[at], _checks(words)[at], np.zeros(len(h), bool)
    # Windows of one hash but several checks lie side by side.
    while len(at):
        again[at] |= (check[place] == own) & (least[place] < doc)
        more = known[np.minimum(place + 1, len(known) - 1)] == h[at]
        more &= place + 1 < len(known)
        at, place, own = at[more], place[more] + 1, own[more]
    start = np.flatnonzero(again)
    if not len(start):
        return None
    edge = np.zeros(len(words) + 1, np.int32)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + WINDOW, -1)
    return np.cumsum(edge)[: len(words)] > 0


DIGEST = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _digests(texts: pa.Table, repeats: pa.Table) -> pa.Table:
    found = _known_repeats(repeats)
    columns: list[list] = [[], [], [], []]
    for batch in _unpacked(texts):
        for key, doc, text in zip(batch.column("_id").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            gone = _removed(text or "", key, found)
            words = (text or "").encode("utf-8", "surrogatepass").split()
            kept = words if gone is None else [w for w, g in zip(words, gone.tolist()) if not g]
            for column, value in zip(columns, (doc, len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest())):
                column.append(value)
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
    _free()
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "n_words", "n_removed", "kept_sha256"])


def cut_words(text: str, gone: np.ndarray) -> str:
    """The text without the words that go and the white space after each."""
    starts = [m.start() for m in SPAN.finditer(text)]
    ends = [*starts[1:], len(text)]
    out = [text[: starts[0]]] + [text[a:b] for a, b, g in zip(starts, ends, gone.tolist()) if not g]
    return "".join(out).rstrip(" \t\n\x0b\x0c\r")


def _cut_documents(texts: pa.Table, repeats: pa.Table, schema: pa.Schema, key: str) -> pa.Table:
    found = _known_repeats(repeats)
    out = []
    for batch in _unpacked(texts):
        new = []
        for doc, text in zip(batch.column(key).to_pylist(), batch.column("text").to_pylist()):
            gone = None if text is None else _removed(text, doc, found)
            new.append(text if gone is None else cut_words(text, gone))
        table = pa.Table.from_batches([batch]).drop_columns([key])
        changed = table.set_column(table.column_names.index("text"), "text", pa.array(new, pa.string()))
        if "n_chars" in changed.column_names:
            counts = [n if t is None or t == old else len(t) for n, t, old in zip(batch.column("n_chars").to_pylist(), new, batch.column("text").to_pylist())]
            changed = changed.set_column(changed.column_names.index("n_chars"), "n_chars", pa.array(counts, pa.int64()))
        out.append(changed)
    _free()
    return pa.concat_tables(out).cast(schema) if out else schema.empty_table()


def _gathered(batches):
    """Batches put together until they make a chunk."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= GROUP_BYTES:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _packed(documents: DataFrame, key: str = "_id") -> DataFrame:
    """Rows in chunks as they come, compressed and written once: the number ``at`` and an Arrow stream ``docs``."""
    keyed = for_python(documents).withColumn(key, F.coalesce("doc_id", F.lit(LAST_ID)))

    def pack(batches):
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        part = TaskContext.get().partitionId() << 32
        for n, batch in enumerate(b for b in _gathered(batches) if b.num_rows):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema, options=options) as stream:
                stream.write_batch(batch)
            yield pa.RecordBatch.from_arrays([pa.array([part + n], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["at", "docs"])

    return written(keyed.mapInArrow(pack, "at long, docs binary"), "chunks")


def _found(documents: DataFrame, packed: DataFrame, key: str = "_id") -> DataFrame:
    """Repeated windows by chunk of documents."""
    size = for_python(documents).agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = min(MOST, 1 + int(size) // BUCKET_BYTES)
    anchors = packed.mapInArrow(lambda b: _anchors(b, buckets, key), ENTRY_SQL)
    hits = written(anchors.groupBy("at").applyInArrow(_hits, HIT_SQL), "anchors")
    windows = packed.groupBy("at").cogroup(hits.groupBy("at")).applyInArrow(lambda at, d, h: _windows(at[0].as_py(), d, h, buckets, key), ENTRY_SQL)
    return written(windows.groupBy("at").applyInArrow(_repeats, REPEAT_SQL), "repeats")


def digests(documents: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and the digest of the kept words, per document."""
    packed = _packed(documents.select("doc_id", "text"))
    repeats = _found(documents, packed)
    return packed.groupBy("at").cogroup(repeats.groupBy("at")).applyInArrow(_digests, DIGEST)


def without_repeats(documents: DataFrame) -> DataFrame:
    """The documents, with repeated words cut out of their texts; others are unchanged."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(documents.schema)
    key = free_name(documents.columns, "_id")
    packed = _packed(documents, key)
    repeats = _found(documents, packed, key)
    return packed.groupBy("at").cogroup(repeats.groupBy("at")).applyInArrow(lambda d, r: _cut_documents(d, r, schema, key), documents.schema)
