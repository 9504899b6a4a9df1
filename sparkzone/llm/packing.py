"""Hierarchical multi-length packing.

A document is its token ids and an end id. Whole long windows are cut off its front; what is
left is routed to the tier of the shortest window that holds it. Tiers are packed from the
longest to the shortest: a window starts with the largest piece of its tier, and its gap is
filled with the largest pieces that fit, from whichever tier has them, and at the end by a cut
piece whose rest returns to its tier. Windows are therefore full. Full windows of a tier are
collected into step groups of the same number of tokens, so that steps of training weigh the
same.

A task packs its own documents, in blocks of bounded size: nothing is shuffled, and what a
block can't fill goes on to the next. The pieces left at a task's end fill the shorter tiers,
then windows of a power of two; none is padded.

Cases: null text is empty, a sequence of its end id only; an empty table gives no pieces;
repeated rows and ids are packed each on their own; extra columns are ignored; a document of
any length is cut as it comes.
"""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_right, insort
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import for_python, id_text, text_of, with_ids
from .tokens import UNUSUAL, default_path

TIERS = (2048, 1024, 512, 256)
END_ID = 1
# Tokens gathered before a block is packed, and tokens of a step group.
BLOCK_TOKENS = 1 << 20
STEP_TOKENS = 1 << 15
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, window int, step_group long"


class Encoder:
    """Token ids as the library gives them.

    Texts of usual characters go through the same vocabulary in rank form, which is several
    times faster and gives the same ids (tested); all others go through the library itself.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.ranked = None
        ranks_path = path.removesuffix(".json") + ".tiktoken"
        try:
            with open(ranks_path, "rb") as file:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        except FileNotFoundError:
            return
        import tiktoken

        import public_tokenizers

        special = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        self.ranked = tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def ids(self, text: str) -> np.ndarray:
        if self.ranked is None or UNUSUAL.search(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.ranked.encode_to_numpy(text, allowed_special="all").astype(np.uint32, copy=False)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


class Piece:
    """Some consecutive ids of one document."""

    __slots__ = ("doc", "start", "ids", "total")

    def __init__(self, doc, start: int, ids: np.ndarray, total: int):
        self.doc, self.start, self.ids, self.total = doc, start, ids, total

    def __len__(self) -> int:
        return len(self.ids)

    def split(self, n: int) -> tuple[Piece, Piece]:
        return Piece(self.doc, self.start, self.ids[:n], self.total), Piece(self.doc, self.start + n, self.ids[n:], self.total)


class Packer:
    """Packs pieces as they come; ``emit`` gets a window and its pieces."""

    def __init__(self, emit, tiers: tuple[int, ...] = TIERS):
        self.emit, self.tiers = emit, tiers
        self.pools: dict[int, list[Piece]] = {t: [] for t in tiers}
        self.held = 0

    def add(self, piece: Piece) -> None:
        longest = self.tiers[0]
        while len(piece) >= longest:
            window, piece = piece.split(longest)
            self.emit(longest, [window])
        if len(piece):
            self._route(piece)

    def _route(self, piece: Piece) -> None:
        tier = min(t for t in self.tiers if t >= len(piece))
        insort(self.pools[tier], piece, key=len)
        self.held += len(piece)

    def _take(self, most: int) -> Piece | None:
        """The largest piece of at most ``most`` ids, or the front of the smallest larger one."""
        for tier in self.tiers:
            pool = self.pools[tier]
            if pool and len(pool[0]) <= most:
                piece = pool.pop(bisect_right(pool, most, key=len) - 1)
                self.held -= len(piece)
                return piece
        for tier in reversed(self.tiers):
            if self.pools[tier]:
                piece = self.pools[tier].pop(0)
                self.held -= len(piece)
                front, rest = piece.split(most)
                self._route(rest)
                return front
        return None

    def _fill(self, window: int) -> None:
        pieces, gap = [], window
        while gap:
            piece = self._take(gap)
            pieces.append(piece)
            gap -= len(piece)
        self.emit(window, pieces)

    def pack(self) -> None:
        """Fill windows of every tier, the longest first, as long as pieces reach for a full one."""
        for tier in self.tiers:
            while self.pools[tier] and self.held >= tier:
                self._fill(tier)

    def finish(self) -> None:
        self.pack()
        window = self.tiers[0]
        while self.held:
            while window > self.held:
                window //= 2
            self._fill(window)


def _packed(batches, path: str, tiers: tuple[int, ...], end_id: int):
    made = encoder(path)
    base = TaskContext.get().partitionId() << 33
    rows: list[tuple] = []
    sequences, groups, open_groups = 0, 0, {}

    def emit(window: int, pieces: list[Piece]) -> None:
        nonlocal sequences, groups
        group, room = open_groups.get(window, (0, 0))
        if room < window:
            group, room = base + groups, STEP_TOKENS
            groups += 1
        open_groups[window] = group, room - window
        offset = 0
        for p in pieces:
            rows.append((p.doc, p.start, len(p), zlib.crc32(p.ids.astype("<u4").tobytes()), p.total, base + sequences, offset, window, group))
            offset += len(p)
        sequences += 1

    def flushed() -> pd.DataFrame:
        out = with_ids(rows, [c.split()[0] for c in PIECES.split(", ")])
        rows.clear()
        return out

    packer = Packer(emit, tiers)
    for batch in batches:
        for doc, text in zip(batch["doc_id"], batch["text"]):
            ids = np.append(made.ids(text), np.uint32(end_id))
            packer.add(Piece(doc, 0, ids, len(ids)))
            if packer.held >= BLOCK_TOKENS:
                packer.pack()
        if len(rows) > 10_000:
            yield flushed()
    packer.finish()
    yield flushed()


def pack_documents(documents: DataFrame, path: str | None = None, tiers: tuple[int, ...] = TIERS, end_id: int = END_ID) -> DataFrame:
    """The pieces of all documents, as ``PIECES``; ``window`` is the length of the piece's sequence."""
    path = path or default_path()
    return for_python(documents).select(id_text(), text_of().alias("text")).mapInPandas(lambda batches: _packed(batches, path, tiers, end_id), PIECES)


def sequences(pieces: DataFrame) -> DataFrame:
    """One row per sequence: its window, pieces and ids in it."""
    return pieces.groupBy("sequence_id", "window", "step_group").agg(F.count(F.lit(1)).alias("pieces"), F.sum("length").alias("tokens"))
