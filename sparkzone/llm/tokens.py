"""Token counts by prefix dynamic programming.

A sequence of byte-pair tokens is the encoding of its bytes exactly if every adjacent pair of
tokens is the encoding of theirs. So the encoding of a prefix ends in the one vocabulary
token that fits the encoding of the prefix before it, and counts follow byte by byte:
``count[j] = count[i] + 1`` for that token's start ``i``. The step from one prefix to the next
fits a signed byte; a text's steps are stored, and any question about a cut of the text is a
sum over them: nothing is encoded again, nor is the text needed, as steps also tell where code points end.

Texts repeat their words, so a task keeps the steps of the words it has met (a bounded table)
and a text is a join of them. The pattern that cuts texts before merging is the library's; for
texts with characters on which Unicode versions may differ, the library itself cuts.

Cases: null text is empty (no bytes, no tokens); special strings count as one token, as the
library reads them by default, and a cut inside one reads its part on its own; counts hold at
code-point boundaries; rows are independent, so repeated rows, ties and extra columns make no
difference; no rows in give no rows out.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Sequence
from functools import lru_cache
from operator import sub

import numpy as np
import regex
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import for_python, id_text, text_of, with_ids, written

# The byte alphabet of byte-level vocabularies, and their cutting pattern.
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CONTRACTIONS = ("'re", "'ve", "'ll")

# Characters on whose class this module's pattern and the library's surely agree (tested).
# The separators 1C to 1F are left out.
UNUSUAL = re.compile("[^\x00-\x1b\x20-ɏΑ-ΡΣ-ϿЀ-ҁ‐-‧‰-⁞₠-₿ぁ-ゖァ-ヺ一-龥가-힣]")
SPACES_MEET = re.compile(r"\s\s")
# Words whose steps a task remembers at most.
REMEMBERED = 250_000


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Prefixes:
    """Steps of token counts for texts under one byte-level vocabulary."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        spare = iter(range(256, 512))
        letters = {chr(b) if b in set(PRINTABLE) else chr(next(spare)): b for b in range(256)}
        spell = lambda token: bytes(letters[c] for c in token)
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in made["model"]["merges"]]
        self.special = [t["content"] for t in made["added_tokens"]]
        names = set(self.special)
        self.tokens = {spell(t) for t in made["model"]["vocab"] if t not in names}
        self.ranks = {(spell(a), spell(b)): n for n, (a, b) in enumerate(merges)}
        # All beginnings of tokens: no token that ends later can start where none of these fits.
        self.begins = {t[:k] for t in self.tokens for k in range(1, len(t) + 1)}
        self.cut = regex.compile(PATTERN).findall
        self.special_split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.fits: dict[tuple[bytes, bytes], bool] = {}
        # Words repeat, and words with marks about them share their pieces with others.
        self.pieces = _Memo(self._piece_steps)
        self.first, self.rest = _Memo(lambda word: self._word_steps("", word)), _Memo(lambda word: self._word_steps(" ", word))

    def _encoded(self, piece: bytes) -> list[bytes]:
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(pair, 1 << 60), i) for i, pair in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _fit(self, left: bytes, right: bytes) -> bool:
        known = self.fits.get((left, right))
        if known is None:
            if len(self.fits) > 2 * REMEMBERED:
                self.fits.clear()
            known = self.fits[left, right] = self._encoded(left + right) == [left, right]
        return known

    def counts(self, piece: bytes) -> list[int]:
        """Token counts of all prefixes of one piece, the empty one first."""
        tokens, begins, fits = self.tokens, self.begins, self.fits
        ends: list[bytes] = [b""]
        counts = [0]
        start = 0
        for j in range(1, len(piece) + 1):
            while piece[start:j] not in begins and start < j - 1:
                start += 1
            for i in range(start, j):
                token = piece[i:j]
                if token in tokens:
                    fit = i == 0 or fits.get((ends[i], token))
                    if fit or (fit is None and self._fit(ends[i], token)):
                        ends.append(token)
                        counts.append(counts[i] + 1)
                        break
        return counts

    def _steps(self, pieces: list[str]) -> bytes:
        """Steps over consecutive pieces, where no two white spaces meet."""
        return b"".join([self.pieces[p] for p in pieces])

    def _piece_steps(self, piece: str) -> bytes:
        counts = self.counts(piece.encode())
        if piece in CONTRACTIONS:  # its proper prefixes are cut after the apostrophe
            counts[1], counts[2] = 1, 1 + self.counts(piece[1:2].encode())[-1]
        return array("b", map(sub, counts[1:], counts)).tobytes()

    def _steps_with_runs(self, pieces: list[str]) -> bytes:
        """The same for any pieces: a prefix that ends in a run of white space has the run as one piece."""
        at, total, out = 0, 0, []
        text = "".join(pieces)
        blank = [c.isspace() and not "\x1c" <= c <= "\x1f" for c in text]
        for piece in pieces:
            counts = [total + n for n in self.counts(piece.encode())]
            if piece in CONTRACTIONS:
                counts[1], counts[2] = total + 1, total + 1 + self.counts(piece[1:2].encode())[-1]
            ends = np.cumsum([len(c.encode()) for c in piece]).tolist()
            for k, end in enumerate(ends):
                if blank[at + k] and at + k > 0 and blank[at + k - 1]:
                    begin = at + k
                    while begin > 0 and blank[begin - 1]:
                        begin -= 1
                    before = self._total_before(out, text[:begin])
                    counts[end] = before + self.counts(text[begin : at + k + 1].encode())[-1]
            out += counts[1:]
            at, total = at + len(piece), total + self.counts(piece.encode())[-1]
        return np.diff(np.array([0, *out])).astype(np.int8).tobytes()

    @staticmethod
    def _total_before(counts: list[int], text: str) -> int:
        n = len(text.encode())
        return counts[n - 1] if n else 0

    def steps(self, text: str) -> bytes:
        """One signed byte per byte of the text: the change of the count at that prefix."""
        if self.special_split and any(s in text for s in self.special):
            parts = self.special_split.split(text)
            return b"".join(self._special(p) if i % 2 else self.steps(p) for i, p in enumerate(parts))
        if not text:
            return b""
        if UNUSUAL.search(text):
            spans = self.library.pre_tokenizer.pre_tokenize_str(text)
            return self._steps_with_runs([text[a:b] for _, (a, b) in spans])
        if SPACES_MEET.search(text):
            return self._steps_with_runs(self.cut(text))
        words = text.split(" ")
        for memo in (self.pieces, self.first, self.rest):
            memo.trim()
        return self.first[words[0]] + b"".join(map(self.rest.__getitem__, words[1:]))

    def _word_steps(self, lead: str, word: str) -> bytes:
        text = lead + word
        return self.pieces[text] if word.isalpha() else self._steps(self.cut(text))

    def _special(self, text: str) -> bytes:
        """A special string is one token once complete, ordinary text before."""
        ordinary = np.frombuffer(self._steps(self.cut(text)), np.int8).astype(int)
        ordinary[-1] = 1 - ordinary[:-1].sum()
        return ordinary.astype(np.int8).tobytes()


class _Memo(dict):
    """Steps of the words or pieces met."""

    def __init__(self, steps_of):
        super().__init__()
        self.steps_of, self.older = steps_of, {}

    def __missing__(self, word: str) -> bytes:
        made = self.older.get(word)
        if made is None:
            made = self.steps_of(word)
        self[word] = made
        return made

    def trim(self) -> None:
        """Words not met again within the last ``REMEMBERED`` new ones are forgotten."""
        if len(self) > REMEMBERED:
            self.older = dict(self)
            self.clear()


@lru_cache(maxsize=2)
def prefixes(path: str) -> Prefixes:
    return Prefixes(path)


def count_at(steps: bytes, n_bytes: int) -> int:
    """Tokens of the first ``n_bytes`` bytes of the text that ``steps`` belongs to."""
    return int(np.frombuffer(steps, np.int8, n_bytes).sum(dtype=np.int64))


def longest_within(steps: bytes, text: bytes, budget: int) -> int:
    """Bytes of the longest prefix, at a code-point boundary, of at most ``budget`` tokens."""
    if len(steps) <= budget:
        return len(steps)
    counts = np.cumsum(np.frombuffer(steps, np.int8), dtype=np.int64)
    follows = np.append(np.frombuffer(text, np.uint8)[1:] & 0xC0, 0) != 0x80
    fit = np.flatnonzero((counts <= budget) & follows)
    return int(fit[-1]) + 1 if len(fit) else 0


def prefix_counts(documents: DataFrame, budget: int, path: str | None = None, keep_steps: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_tokens, bytes_in_budget, and with ``keep_steps`` the steps themselves."""
    path = path or default_path()
    schema = "doc_id long, n_bytes long, n_tokens long, bytes_in_budget long" + (", steps binary" if keep_steps else "")

    def run(batches):
        made = prefixes(path)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                steps, raw = made.steps(text), text.encode()
                row = (doc_id, len(raw), count_at(steps, len(steps)), longest_within(steps, raw, budget))
                rows.append((*row, steps) if keep_steps else row)
            yield with_ids(rows, ["doc_id", "n_bytes", "n_tokens", "bytes_in_budget", *(["steps"] if keep_steps else [])])

    return for_python(documents).select(id_text(), text_of().alias("text")).mapInPandas(run, schema)


# The step of a byte after which no code point ends; changes of the count are smaller.
INSIDE = -128


def marked_steps(steps: bytes, text: bytes) -> bytes:
    """Steps that also tell where code points end, so that cuts need no text.

    Bytes with more of their code point to come have ``INSIDE``, and the last one the change over all of it.
    """
    if text.isascii():
        return steps
    counts = np.cumsum(np.frombuffer(steps, np.int8), dtype=np.int64)
    last = np.append((np.frombuffer(text, np.uint8)[1:] & 0xC0) != 0x80, True)
    out = np.full(len(text), INSIDE, np.int64)
    out[last] = np.diff(counts[last], prepend=0)
    return out.astype(np.int8).tobytes()


def stored_counts(documents: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and marked steps of every document, written once and reread: all later questions are about these."""
    path = path or default_path()

    def run(batches):
        made = prefixes(path)
        for batch in batches:
            texts = [t.as_py() for t in batch.column("text")]
            steps = [marked_steps(made.steps(t), t.encode()) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(steps, pa.binary())], names=["doc_id", "steps"])

    docs = for_python(documents).select("doc_id", text_of().alias("text"))
    return written(docs.mapInArrow(run, "doc_id long, steps binary"), "prefix-counts")


def cut_answers(stored: DataFrame, budgets: Sequence[int], cuts: Sequence[int] = ()) -> DataFrame:
    """doc_id, n_bytes, n_tokens, and from the stored steps alone: ``bytes_within_<b>``, the bytes of the longest prefix of
    at most b tokens, and ``tokens_of_<c>``, the tokens of the longest prefix of whole code points within c bytes."""
    names = [*(f"bytes_within_{b}" for b in budgets), *(f"tokens_of_{c}" for c in cuts)]
    schema = ", ".join(f"{n} long" for n in ("doc_id", "n_bytes", "n_tokens", *names))

    def answers(steps: bytes) -> list[int]:
        step = np.frombuffer(steps, np.int8)
        ends = np.flatnonzero(step != INSIDE)
        counts = np.cumsum(step[ends], dtype=np.int64)
        row = [len(step), int(counts[-1]) if len(counts) else 0]
        for b in budgets:
            fit = np.flatnonzero(counts <= b)
            row.append(int(ends[fit[-1]]) + 1 if len(fit) else 0)
        for c in cuts:
            k = int(np.searchsorted(ends, c))
            row.append(int(counts[k - 1]) if k else 0)
        return row

    def run(batches):
        for batch in batches:
            rows = [answers(s.as_py()) for s in batch.column("steps")]
            columns = list(zip(*rows)) or [()] * (2 + len(names))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns)], names=["doc_id", "n_bytes", "n_tokens", *names])

    return stored.mapInArrow(run, schema)
