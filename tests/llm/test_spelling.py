from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from sparkzone.llm import spelling
from sparkzone.llm.common import table
from sparkzone.llm.queries import QUERIES

from .conftest import SMALL

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def edits(word, letters):
    for i in range(len(word) + 1):
        yield from (word[:i] + c + word[i:] for c in letters)
        if i < len(word):
            yield word[:i] + word[i + 1 :]
            yield from (word[:i] + c + word[i + 1 :] for c in letters)


def plain_vocabulary(docs, least=6, often=5):
    counts = Counter()
    for doc_id, text in docs:
        for run in RUN.findall(text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least and n >= often}


def plain(words, ratio=5):
    letters = sorted({c for w in words for c in w})
    form, out = {}, {}
    for w, n in words.items():
        near = {e for e in edits(w, letters) if e in words and e != w}
        best = min(near, key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= ratio * n:
            form[w] = best
        out[w] = len(near)
    rows = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        rows.append((w, form.get(w), root, n, out[w], words.get(form.get(w))))
    return sorted(rows, key=str)


def test_query_agrees_with_brute_force(spark):
    folder = SMALL.replace("0.001", "0.01")
    docs = [(r["doc_id"], r["text"]) for r in table(spark, folder, "documents").collect()]
    got = QUERIES["op13_spelling_variants"](spark, folder)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = plain(plain_vocabulary(docs))
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert len(want) > 500 and any(r[1] for r in want)


@pytest.mark.parametrize("seed", range(60))
def test_blocks_meet_each_pair_once(seed):
    """Every way of cutting words into gaps finds each near pair in one block, from both sides."""
    rng = random.Random(seed)
    letters = "ab" if seed % 2 else "abcé"
    words = list({"".join(rng.choice(letters) for _ in range(rng.randrange(2, 8))) for _ in range(60)})
    counted = {w: rng.randrange(1, 4) for w in words}
    found: dict[str, list] = {w: [] for w in words}
    blocks: dict[tuple, list] = {}
    for w in words:
        for s in (len(w), len(w) - 1):
            if s < 2:
                continue
            cuts = [0, s // 2, s] if seed % 3 else sorted({0, s, *range(1, s, 1 + seed % 2)})
            for a, b in zip(cuts, cuts[1:]):
                blocks.setdefault((s, a, b, w[:a], w[len(w) - (s - b) :] if s > b else ""), []).append((w, counted[w]))
    for (s, a, b, _, _), held in blocks.items():
        for word, k, n, best in spelling.near_in_block(held, s, a, b):
            found[word].append((k, -n, best))
    for w in words:
        near = {e for e in edits(w, letters) if e in counted and e != w and min(len(e), len(w)) > 1}
        assert sum(k for k, _, _ in found[w]) == len(near), w
        if near:
            assert min(found[w], key=lambda f: f[1:])[1:] == min((-counted[x], x) for x in near)


@pytest.mark.parametrize("most", [2, 5, 10_000])
def test_large_blocks_are_split_without_losing_pairs(spark, most):
    rng = random.Random(8)
    # One beginning and one end are shared by most words, as in hot blocks.
    words = {f"abc{''.join(rng.choice('xyz') for _ in range(rng.randrange(2, 6)))}def": rng.randrange(5, 400) for _ in range(150)}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    got = {r["word"]: (r["n_near"], r["best_n"], r["best"]) for r in spelling.near_words(frame, most).collect()}
    for w in words:
        near = {e for e in edits(w, "abcdefxyz") if e in words and e != w}
        best = min(((-words[x], x) for x in near), default=None)
        assert got.get(w) == (None if best is None else (len(near), -best[0], best[1]))
    entries = spelling.blocks(frame, most)
    assert entries.where("b - a > 1").groupBy("key").count().where(f"count > {most}").isEmpty()


def test_special_rows(spark, make_docs, clashing):
    long = "straße " * 40 + "strase " * 5 + "strasse " * 200 + "STRASSÉ " * 6 + "x" * 70_000 + " 日本strasse" * 3
    docs = [(1, long), (1, long), (None, "strassen " * 30), (2, None), (3, ""), (2**62 + 1, "Strassen! ×÷×÷×÷ " * 6), (4, "abc def")]
    got = spelling.variants(make_docs(*docs, **clashing, word="x", form="y", key="z")).collect()
    want = plain(plain_vocabulary(docs))
    assert sorted((tuple(r) for r in got), key=str) == want
    assert {r["word"]: r["root"] for r in got}["strassen"] == "strasse"


def test_chains_are_followed_and_ties_go_to_the_smallest(spark):
    words = {"abcdefgh": 100_000, "abcdefg": 20_000, "abcdef": 4_000, "abcdez": 800, "abczez": 160, "tttttu": 50, "tttttv": 50, "tttttw": 10}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    near = spelling.near_words(frame).collect()
    assert {r["word"]: r["best"] for r in near}["tttttw"] == "tttttu"
    links = spark.createDataFrame([("abcdefg", "abcdefgh"), ("abcdef", "abcdefg"), ("abcdez", "abcdef"), ("abczez", "abcdez")], "word string, form string")
    assert {r["root"] for r in spelling._roots(links).collect()} == {"abcdefgh"}


def test_empty(spark, make_docs):
    assert spelling.variants(make_docs((1, "a")).limit(0)).collect() == []
    assert spelling.variants(make_docs((1, "rarely"))).collect() == []
