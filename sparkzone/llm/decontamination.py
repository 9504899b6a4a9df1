"""Benchmark decontamination by a generalised suffix automaton of the test items.

The items' normalised words become one automaton. A document's words run through it, and the
state after each word tells the longest stretch of any item that ends there. Where it reaches
the window, a whole window of an item ends: its words are hit. Items shorter than a window
count as a whole; the state's chain of shorter matches tells where one ends. Spans of hit words are
maximal, and carry the longest match in them. A document is contaminated by spans, and drops
out where they cover more than a share of its words.

Documents are only read through: nothing is shuffled, and a task holds one automaton. Its size
is bounded: items are dealt to parts of at most ``PART_WORDS`` words (a longer item is cut,
with cuts overlapping by a window less one, so each window lies whole in a cut), and documents
pass the parts one after another, the spans so far written in between. What goes to every task is one part's
words, at most ``PART_WORDS`` of them; the automaton is built where it is used.

Words are runs of digits, ASCII letters (lower-cased) and characters beyond ASCII.

Cases: null and empty texts have no words, as items or documents; items without words are
ignored; of items with equal ids each counts by its text, the id is listed once; a null item id
hits but can't be listed, so it isn't counted; repeated items and documents are fine, and rows of documents are
independent; no documents give no rows, no items give no hits; a text of any length is read in
whole; extra columns pass through ``without_leaks`` and are ignored otherwise.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .automaton import SuffixAutomaton
from .common import for_python, free_name, text_of, written

WINDOW = 10
# Words of items in one automaton, which has at most twice as many states.
PART_WORDS = 1 << 18
# Fixed by the contract: what isn't in a word. Other ASCII characters part words.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_PLAIN = bytes(b if b >= 128 or chr(b).isalnum() and not chr(b).isupper() else (b + 32 if chr(b).isupper() else 32) for b in range(256))
SPAN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_PLAIN).split() if text else []


class Matcher:
    """The automaton of some items, and which of them have a window that ends in a state."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window = window
        vocabulary: dict[bytes, int] = {}
        for _, found in items:
            for w in found:
                vocabulary.setdefault(w, len(vocabulary))
        self.vocabulary = vocabulary
        made = self.automaton = SuffixAutomaton(len(vocabulary))
        coded = [(name, [vocabulary[w] for w in found]) for name, found in items]
        ends = [made.add(sequence) for _, sequence in coded]
        made.finished()
        n = len(made.length)
        # Items by the state whose stretches include the window; and short items by their state.
        self.having: dict[int, set[str]] = {}
        self.short: dict[int, set[str]] = {}
        for (name, sequence), end in zip(coded, ends):
            if len(sequence) < window:
                self.short.setdefault(end, set()).update(() if name is None else (name,))
                continue
            state, matched = 0, 0
            for k, symbol in enumerate(sequence, 1):
                state, matched = made.follow(state, matched, symbol)
                if k >= window:
                    self.having.setdefault(self._holding(state), set()).update(() if name is None else (name,))
        # The next shorter match that is a whole short item, for every state.
        self.shorter = [-1] * n
        for state in sorted(range(1, n), key=made.length.__getitem__) if self.short else ():
            up = made.link[state]
            self.shorter[state] = up if up in self.short else self.shorter[up]

    def _holding(self, state: int) -> int:
        """Of a state's chain, the one that has its stretch of a window's length."""
        length, link = self.automaton.length, self.automaton.link
        while length[link[state]] >= self.window:
            state = link[state]
        return state

    def hits(self, found: list[bytes]) -> tuple[list[tuple[int, int, int]], set[str]]:
        """Maximal spans of hit words (first, end, longest match in it), and the items they are from."""
        made, window, having, short, shorter = self.automaton, self.window, self.having, self.short, self.shorter
        step, link, length, n = made.step, made.link, made.length, made.symbols
        spans: list[list[int]] = []
        items: set[str] = set()
        seen: set[int] = set()
        state = matched = 0
        for end, symbol in enumerate(map(self.vocabulary.get, found), 1):
            if symbol is None:
                state = matched = 0
                continue
            to = step.get(state * n + symbol)
            while to is None:
                state = link[state]
                matched = length[state]
                to = step.get(state * n + symbol)
            state, matched = to, matched + 1
            reach = 0
            if matched >= window:
                reach = window
                holding = self._holding(state)
                if holding not in seen:
                    seen.add(holding)
                    items |= having.get(holding, set())
            if short:
                at = state if state in short and matched == length[state] else shorter[state]
                while at > 0:
                    reach = max(reach, length[at])
                    if ~at not in seen:
                        seen.add(~at)
                        items |= short[at]
                    at = shorter[at]
            if reach:
                first = end - reach
                longest = matched if matched >= window else reach
                while spans and spans[-1][1] >= first:
                    a, _, m = spans.pop()
                    first, longest = min(first, a), max(longest, m)
                spans.append([first, end, longest])
        return [tuple(s) for s in spans], items


def merged(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    out: list[tuple[int, int, int]] = []
    for a, b, m in sorted(spans):
        if out and out[-1][1] >= a:
            a, b, m = out[-1][0], max(b, out[-1][1]), max(m, out[-1][2])
            out.pop()
        out.append((a, b, m))
    return out


def _cuts(items: DataFrame, window: int, most: int) -> DataFrame:
    """item, and the plain text of at most ``most`` of its words; cuts of one item overlap by a window less one."""
    if most < 2 * window:
        raise ValueError("a part holds two windows at least")

    def each(batches):
        for batch in batches:
            rows = []
            for name, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist()):
                found = words(text)
                rows += [(name, at, b" ".join(found[at : at + most]), len(found[at : at + most])) for at in range(0, max(1, len(found) - window + 1), most - window + 1) if found]
            columns = list(zip(*rows)) or [()] * 4
            kinds = (pa.string(), pa.int64(), pa.binary(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["item", "at", "cut", "n"])

    return items.mapInArrow(each, "item string, at long, cut binary, n long")


def _parts(items: DataFrame, key: str, window: int, most: int) -> tuple[DataFrame, int]:
    """Cuts of items with the number of their part, and how many parts there are.

    A hash deals cuts to parts of half the bound on average; one that is larger is halved again by the next bits.
    """
    plain = for_python(items).select(F.col(key).cast("string").alias("item"), text_of().alias("text"))
    # Equal rows say the same, and no hash would part them.
    cuts = written(_cuts(plain, window, most).distinct(), "items")
    total = cuts.agg(F.sum("n")).first()[0] or 0
    parts = max(1, -(-2 * int(total) // most)) if total > most else min(1, int(total))
    while parts:
        dealt = cuts.withColumn("part", F.pmod(F.xxhash64("item", "at", "cut"), F.lit(parts)))
        largest = dealt.groupBy("part").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0]
        if largest <= most:
            return dealt, parts
        parts *= 2
    return cuts.withColumn("part", F.lit(0)), 0


SPANS = "array<struct<first:int,end:int,longest:int>>"


def _marked(documents: DataFrame, items: list[tuple[str | None, bytes]], window: int, text: str, out: tuple[str, str, str]) -> DataFrame:
    """Documents with the spans and items of one part added to those they have."""
    from pyspark.sql.pandas.types import to_arrow_schema

    n_words, spans, found_items = out
    context = documents.sparkSession.sparkContext
    sent = context.broadcast(items)  # of one part: at most PART_WORDS words
    schema = to_arrow_schema(documents.schema)

    def each(batches: Iterator[pa.RecordBatch]):
        matcher = None
        for batch in batches:
            matcher = matcher or Matcher([(name, cut.split()) for name, cut in sent.value], window)
            sizes, all_spans, all_items = [], [], []
            for i, value in enumerate(batch.column(text)):
                found = words(value.as_py())
                had, names = batch.column(spans)[i].as_py(), batch.column(found_items)[i].as_py()
                new, more = matcher.hits(found)
                sizes.append(len(found))
                all_spans.append([{"first": a, "end": b, "longest": m} for a, b, m in merged([*new, *((s["first"], s["end"], s["longest"]) for s in had or ())])])
                all_items.append(sorted({*(names or ()), *more}))
            made = {n_words: sizes, spans: all_spans, found_items: all_items}
            yield pa.RecordBatch.from_arrays([pa.array(made[f.name], f.type) if f.name in made else batch.column(f.name) for f in schema], schema=schema)

    return documents.mapInArrow(each, documents.schema)


def marked(
    documents: DataFrame, items: DataFrame, window: int = WINDOW, key: str = "item_id", part_words: int = PART_WORDS, names: tuple[str, str, str] = ("n_words", "spans", "items")
) -> DataFrame:
    """The documents with three more columns: how many words they have, spans of hit words, and the ids of the items hit."""
    dealt, parts = _parts(items, key, window, part_words)
    out = for_python(documents).withColumns({names[0]: F.lit(0), names[1]: F.lit(None).cast(SPANS), names[2]: F.lit(None).cast("array<string>")})
    for part in range(max(1, parts)):
        rows = dealt.where(F.col("part") == part).select("item", "cut").collect()  # the bound of one part
        out = _marked(out, [(r["item"], bytes(r["cut"])) for r in rows], window, "text", names)
        if part + 1 < parts:
            out = written(out, "marked")
    return out


def n_hit(spans: str) -> F.Column:
    return F.expr(f"aggregate({spans}, 0L, (n, s) -> n + s.end - s.first)")


def digests(documents: DataFrame, items: DataFrame, window: int = WINDOW, part_words: int = PART_WORDS) -> DataFrame:
    """Per document: words, words hit, items hit and the digest of their ids."""
    found = marked(documents.select("doc_id", "text"), items, window, part_words=part_words)
    return found.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        n_hit("spans").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def cut_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and without what stands between them and after each."""
    at = [m.span() for m in SPAN.finditer(text)]
    out, last = [], 0
    for first, end in spans:
        out.append(text[last : at[first][0]])
        last = at[end][0] if end < len(at) else len(text)
    return "".join([*out, text[last:]])


def without_leaks(
    documents: DataFrame, items: DataFrame, window: int = WINDOW, longest: int = WINDOW, coverage: float = 0.5, key: str = "item_id", part_words: int = PART_WORDS
) -> DataFrame:
    """The documents, with their columns, less the spans whose longest match has ``longest`` words or more,
    and less the documents of which hit words are more than ``coverage``. ``n_chars`` follows the text."""
    names = tuple(free_name(documents.columns, n) for n in ("_n_words", "_spans", "_items"))
    found = marked(documents, items, window, key, part_words, names)
    n, spans, _ = names
    kept = found.where(n_hit(f"`{spans}`") <= F.lit(coverage) * F.col(n))

    @F.udf("string", useArrow=True)
    def cut(text, long):
        return cut_spans(text, [(s["first"], s["end"]) for s in long]) if long else text

    long = F.expr(f"filter(`{spans}`, s -> s.longest >= {int(longest)})")
    changed = kept.withColumn(spans, long).withColumn("text", cut("text", spans))
    if "n_chars" in documents.columns:
        changed = changed.withColumn("n_chars", F.when(F.size(spans) > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
    return changed.select(*(f"`{c}`" for c in documents.columns))
