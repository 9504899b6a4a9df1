from __future__ import annotations

import hashlib
import random
import re

import pytest

from sparkzone.llm import decontamination as D
from sparkzone.llm.automaton import SuffixAutomaton
from sparkzone.llm.queries import QUERIES, SQL
from tests.oracle import compare, connect

from .conftest import SMALL

ITEMS = "item_id LONG, text STRING"
PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return PATTERN.findall(lowered)


def plain(doc, items, window=10):
    w = plain_words(doc)
    hit, ids = set(), set()
    for name, text in items:
        item = plain_words(text)
        k = min(window, len(item))
        for a in range(len(item) - k + 1) if k else ():
            for b in range(len(w) - k + 1):
                if w[b : b + k] == item[a : a + k]:
                    hit |= set(range(b, b + k))
                    ids |= {str(name)} if name is not None else set()
    return len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit), hit


def test_query_agrees_with_its_sql(spark):
    name = "op12_suffix_automaton_decontamination"
    assert compare(QUERIES[name](spark, SMALL), connect(SMALL), SQL[name]) is None


@pytest.mark.parametrize("seed", range(40))
def test_automaton_has_exactly_the_stretches_and_longest_matches(seed):
    rng = random.Random(seed)
    sequences = [[rng.randrange(3) for _ in range(rng.randrange(1, 9))] for _ in range(rng.randrange(1, 6))]
    made = SuffixAutomaton(4)
    ends = [made.add(s) for s in sequences]
    stretches = {tuple(s[i:j]) for s in sequences for i in range(len(s)) for j in range(i, len(s) + 1)}
    assert [made.length[e] for e in ends] == [len(s) for s in sequences]
    assert sum(made.length[s] - made.length[made.link[s]] for s in range(1, len(made.length))) == len(stretches - {()})
    stream = [rng.randrange(4) for _ in range(60)]
    state = matched = 0
    for i, symbol in enumerate(stream, 1):
        state, matched = made.follow(state, matched, symbol)
        assert matched == max(k for k in range(i + 1) if tuple(stream[i - k : i]) in stretches)


@pytest.mark.parametrize("seed", range(60))
def test_hits_agree_with_brute_force(seed):
    rng = random.Random(seed)
    letters, window = "abcd"[: rng.randrange(2, 5)], rng.randrange(2, 5)
    items = [(n // 2, " ".join(rng.choice(letters) for _ in range(rng.randrange(0, 9)))) for n in range(rng.randrange(1, 7))]
    doc = " ".join(rng.choice(letters + "z") for _ in range(80))
    made = D.Matcher([(str(n), D.words(t)) for n, t in items if D.words(t)], window)
    spans, ids = made.hits(D.words(doc))
    n, _, _, digest, _, hit = plain(doc, items, window)
    assert {p for a, b, _ in spans for p in range(a, b)} == hit
    assert hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest() == digest
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


CASES = [
    (1, "One two THREE four five six seven eight nine ten eleven."),
    (1, "One two THREE four five six seven eight nine ten eleven."),
    (None, "über-ñandú 7 seven"),
    (2, None),
    (3, ""),
    (4, "... !"),
    (2**62 + 1, "zzz ÜBER ñandú 7 seven zzz"),
    (5, "nothing here"),
]
BENCH = [(7, "two three, four five six seven eight nine ten eleven twelve"), (7, "seven"), (None, "nothing here"), (10, "Ñandú 7"), (8, None), (9, "--"), (11, "seven"), (100, "über ÑANDÚ")]


@pytest.mark.parametrize("part_words", [D.PART_WORDS, 20])
def test_special_rows_and_parts(spark, make_docs, clashing, part_words):
    docs = make_docs(*CASES, **clashing, n_words="x", spans="y", items="z")
    out = D.digests(docs, spark.createDataFrame(BENCH, ITEMS), part_words=part_words).collect()
    want = [(i, *plain(t, BENCH)[:5]) for i, t in CASES]
    assert sorted(map(str, map(tuple, out))) == sorted(map(str, want))


def test_long_items_are_cut_without_losing_windows(spark, make_docs):
    rng = random.Random(4)
    item = " ".join(f"w{rng.randrange(50)}" for _ in range(300))
    parts = item.split()
    texts = [" ".join(parts[k : k + 13]) for k in range(0, 287)]
    docs = make_docs(*enumerate(texts))
    out = {r["doc_id"]: r["n_hit"] for r in D.digests(docs, spark.createDataFrame([(1, item)], ITEMS), part_words=40).collect()}
    assert out == {k: 13 for k in range(287)}
    assert D._parts(spark.createDataFrame([(1, item)], ITEMS), "item_id", 10, 40)[1] > 1


def test_no_items_and_no_documents(spark, make_docs):
    none = spark.createDataFrame([], ITEMS)
    assert [tuple(r)[1:4] for r in D.digests(make_docs((1, "a b")), none).collect()] == [(2, 0, 0)]
    assert D.digests(make_docs((1, "a")).limit(0), spark.createDataFrame(BENCH, ITEMS)).collect() == []


def test_spans_are_cut_and_covered_documents_go(spark, make_docs, clashing):
    passage = "two three four five six seven eight nine ten eleven twelve"
    filler = " ".join(f"filler{k}" for k in range(30))
    docs = make_docs((1, f"Start, {filler}; {passage}, and end."), (2, passage.title()), (3, None), (4, "clean text"), (5, "seven"), **clashing)
    bench = spark.createDataFrame(BENCH[:2], ITEMS)
    out = D.without_leaks(docs, bench)
    assert out.columns == docs.columns
    rows = {r["doc_id"]: r for r in out.collect()}
    assert set(rows) == {1, 3, 4}
    assert rows[1]["text"] == f"Start, {filler}; and end." and rows[1]["n_chars"] == len(rows[1]["text"])
    assert rows[4]["text"] == "clean text" and rows[3]["text"] is None and rows[4]["_id"] == "x"
    # A single word of an item is hit, but too short a span to be cut.
    longer = D.without_leaks(make_docs((5, f"seven {filler}")), bench, longest=5).collect()
    assert longer[0]["text"] == f"seven {filler}"
