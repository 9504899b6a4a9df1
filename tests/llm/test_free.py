"""Packing, fingerprints, substrings, SimHash, token counts and toxicity against brute force."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sparkzone.llm import graph, merkle, packing, simhash, substrings, tokens, toxicity
from sparkzone.llm.common import table
from sparkzone.llm.queries import QUERIES

from .conftest import SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.default_path())


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in table(spark, SMALL, "documents").collect()}


ODD = [
    "", " ", "  ", "a  b", "a \n\n b\n", "don't we're 're 'x's", "x<|endoftext|>y<|endoftext|>", "naïve Ünï\t\ty 12 34", "日本語 テスト 한국 a",
    "a\x1cb \x1f c", "é́x ʼs ՘ q", "!!!'s ''s", " \n \n  \n", "a" * 400, "\U0001F600   x", "͸؀ x",
]


def odd_texts():
    rng = random.Random(5)
    parts = ["a", "the", " ", "  ", "\n", "\t", "'", "'s", "'re", "1", "!", "é", "日", " ", "՘", "\U0001F600", "Tion", "\x1d"]
    return ODD + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 20))) for _ in range(150)]


# --- token counts ----------------------------------------------------------------


def test_every_prefix_counts_as_the_library_counts_it(library, texts):
    made = tokens.prefixes(tokens.default_path())
    for text in [t for t in odd_texts() if "<|" not in t] + [t[:150] for t in list(texts.values())[:20]]:
        steps = made.steps(text)
        for k in range(len(text) + 1):
            n = len(text[:k].encode())
            assert tokens.count_at(steps, n) == len(library.encode(text[:k], add_special_tokens=False).ids), (text, k)


def test_counts_of_texts_and_budgets(spark, library, make_docs, clashing):
    rows = [*enumerate(odd_texts()), (900, None), (3, "a  b"), (3, "a  b"), (901, "x" * 30_000), (None, "b")]
    found = tokens.prefix_counts(make_docs(*rows, **clashing), 5).collect()
    assert len(found) == len(rows)
    by_text = {(i, len((t or "").encode())): t or "" for i, t in rows}
    for r in found:
        text = by_text[r["doc_id"], r["n_bytes"]]
        assert r["n_tokens"] == len(library.encode(text, add_special_tokens=False).ids)
        cut = [k for k in range(len(text[:200]) + 1) if len(library.encode(text[:k], add_special_tokens=False).ids) <= 5]
        if "<|" not in text:
            assert r["bytes_in_budget"] == len(text[: max(cut)].encode())
    assert tokens.prefix_counts(make_docs(), 5).count() == 0


def test_character_classes_are_the_library_s(library):
    """All characters that are not left to the library, in one text."""
    usual = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000 and not tokens.UNUSUAL.match(chr(c))]
    text = "".join(f"a{c}1{c}!{c}" for c in usual)
    assert tokens.prefixes(tokens.default_path()).cut(text) == [text[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(text)]


def test_query_counts_tokens(spark, library, texts):
    for r in QUERIES["op7_prefix_token_counts"](spark, SMALL).collect():
        n = len(library.encode(texts[r["doc_id"]], add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(texts[r["doc_id"]].encode()), n, n > 1024)


# --- packing ---------------------------------------------------------------------


def check_pieces(pieces, documents, library):
    """Every id in one piece, sequences without gaps, none longer than 2048 or padded."""
    ids = lambda t: np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
    want = sorted((i is None, i or 0, zlib.crc32(ids(t).tobytes()), len(ids(t))) for i, t in documents)
    whole = {(i, len(ids(t)), zlib.crc32(ids(t).tobytes())): ids(t) for i, t in documents}
    left = defaultdict(list)
    for p in pieces:
        left[p["doc_id"], p["doc_tokens"]].append(p)
    covered = 0
    for (doc, total), parts in left.items():
        candidates = [v for (i, n, _), v in whole.items() if i == doc and n == total]
        for p in parts:
            assert any(zlib.crc32(v[p["start"] : p["start"] + p["length"]].tobytes()) == p["ids_crc32"] for v in candidates)
            covered += p["length"]
    assert covered == sum(n for *_, n in want)
    for doc, text in documents:
        if sum(d == doc for d, _ in documents) == 1:
            spans = sorted((p["start"], p["length"]) for p in left[doc, len(ids(text))])
            assert [s for s, _ in spans] == list(itertools.accumulate([0] + [n for _, n in spans[:-1]])) and sum(n for _, n in spans) == len(ids(text))
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append(p)
    for parts in sequences.values():
        at = 0
        for p in sorted(parts, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
        assert at <= 2048 and at & (at - 1) == 0 and {p["window"] for p in parts} == {at}


def test_query_packs_everything(spark, library, texts):
    check_pieces(QUERIES["op3_multi_length_packing"](spark, SMALL).collect(), list(texts.items()), library)


def test_packing_of_odd_rows(library, make_docs, clashing):
    rows = [*enumerate(odd_texts()), (900, None), (7, "same same"), (7, "same same"), (901, "word " * 9000), (None, "x")]
    docs = make_docs(*rows, **clashing)
    check_pieces(packing.pack_documents(docs.repartition(3)).collect(), rows, library)
    assert packing.pack_documents(make_docs()).count() == 0


def test_step_groups_weigh_the_same():
    windows = []
    packer = packing.Packer(lambda w, pieces: windows.append((w, [len(p) for p in pieces])))
    rng = random.Random(3)
    total = 0
    for i in range(500):
        n = rng.choice([5, 90, 300, 700, 1500, 2048, 5000])
        total += n
        packer.add(packing.Piece(i, 0, np.zeros(n, np.uint32), n))
    packer.finish()
    assert sum(sum(p) for _, p in windows) == total and all(sum(p) == w for w, p in windows)
    assert sum(len(p) for _, p in windows) < 2 * 500 + total // 2048


def test_ranked_ids_are_the_library_s(library, texts):
    made = packing.encoder(tokens.default_path())
    for text in [*odd_texts(), *texts.values()]:
        assert made.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids


# --- fingerprints ----------------------------------------------------------------


def test_trees_hold_every_character(texts):
    for text in [*odd_texts(), *texts.values(), "a\n\n\n b. c\r\n\nd", ". " * 500, ",x" * 500]:
        assert "".join(leaf for s in merkle.tree(text) for p in s for leaf in p) == text


def test_neighbours(spark, make_docs, clashing):
    rng = random.Random(1)
    rows = [(rng.randrange(10**12) * (1 if i % 2 else -1), "".join(rng.choice("ab é\n. ") for _ in range(rng.randint(0, 60)))) for i in range(90)]
    rows += [(2**62 + 1, "close"), (2**62 + 2, "closer"), (5, None), (4, "")]
    found = {r["doc_id"]: r for r in merkle.compare_neighbours(spark, make_docs(*rows, **clashing)).collect()}
    order = sorted((i, t or "") for i, t in rows)
    assert len(found) == len(order)
    for (i, text), (_, after) in zip(order, order[1:] + order[:1]):
        n = len(text) // 4
        edited = text[: len(text) - n] + after[:n]
        r = found[i]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["fingerprint"] == merkle.fingerprint(text) and r["edited_fingerprint"] == merkle.fingerprint(edited)
        assert r["near_next"] == merkle.likeness(merkle.fingerprint(text), merkle.fingerprint(after)) and 0 <= r["near_edited"] <= 1
    assert merkle.compare_neighbours(spark, make_docs()).count() == 0
    alone = merkle.compare_neighbours(spark, make_docs((1, "abcdefgh"))).first()
    assert alone["near_next"] == 1.0 and alone["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest()
    twice = merkle.compare_neighbours(spark, make_docs((1, "aaaa"), (1, "bbbb"), (None, "n"), (None, "m"))).collect()
    assert len(twice) == 4


def test_likeness_and_differing_branches():
    text = "One two three.\nFour five six.\n\nSeven eight nine.\nTen."
    other = text.replace("eight", "ate")
    a, b = merkle.fingerprint(text), merkle.fingerprint(other)
    assert merkle.differing(a, b) == [(1, 0)] and merkle.differing(a, a) == [] and 0 < merkle.likeness(a, b) < 1
    assert merkle.likeness(merkle.fingerprint(""), merkle.fingerprint("")) == 1.0 and merkle.likeness(a, merkle.fingerprint("")) == 0.0


def test_edited_texts_are_nearer_than_the_next(spark):
    rows = QUERIES["op4_merkle_fingerprints"](spark, SMALL).where("n_chars > 200").collect()
    assert sum(r["near_edited"] > r["near_next"] for r in rows) >= 0.97 * len(rows)


# --- substrings ------------------------------------------------------------------


def removed_by_rule(rows):
    """n_words, n_removed and kept words per row, straight from the rule."""
    least = {}
    for i, t in rows:
        w = WORD.findall(t or "")
        for s in range(len(w) - 49):
            key = tuple(w[s : s + 50])
            least[key] = min(least.get(key, 2**63), 2**63 - 1 if i is None else i)
    out = []
    for i, t in rows:
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for s in range(len(w) - 49):
            if least[tuple(w[s : s + 50])] < (2**63 - 1 if i is None else i):
                gone[s : s + 50] = [True] * 50
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((i, len(w), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out


def repeated_rows():
    rng = random.Random(4)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    hot, other = fresh(60), fresh(200)
    rows = [(100 + i, " ".join(fresh(rng.randrange(80)) + hot + fresh(rng.randrange(80)))) for i in range(40)]
    rows += [(10, " ".join(other)), (11, "\n".join(fresh(7) + other[30:80] + fresh(3))), (12, " ".join(other[:49] + fresh(1) + other[51:100])), (13, "\t".join(other))]
    rows += [(14, "a " * 500), (15, "a " * 60), (16, "a " * 49), (17, None), (18, ""), (19, " \n "), (11, " ".join(other[:50])), (None, " ".join(other)), (None, " ".join(hot))]
    rows += [(20, " ".join(fresh(100)) + " é x"), (21, " ".join(other[100:150] + other[10:60]))]
    rng.shuffle(rows)
    return rows


def test_repeats_are_removed_by_the_rule(make_docs, clashing, monkeypatch):
    monkeypatch.setattr(substrings, "BUCKET_BYTES", 3000)
    monkeypatch.setattr(substrings, "GROUP_BYTES", 4000)
    monkeypatch.setattr(substrings, "BATCH_WORDS", 500)
    rows = repeated_rows()
    found = [tuple(r) for r in substrings.digests(make_docs(*rows, **clashing).repartition(3)).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(found, key=key) == sorted(removed_by_rule(rows), key=key)
    assert substrings.digests(make_docs()).count() == 0


def test_documents_lose_their_repeats_only(make_docs, clashing):
    rows = repeated_rows()
    docs = make_docs(*rows, **clashing)
    out = substrings.without_repeats(docs)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    digest = lambda t: hashlib.sha256(" ".join(WORD.findall(t or "")).encode()).hexdigest()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    got = sorted(((r["doc_id"], digest(r["text"])) for r in out.collect()), key=key)
    assert got == sorted(((i, h) for i, _, _, h in removed_by_rule(rows)), key=key)
    clean = {i: t for i, t in rows if i in (14, 16, 17, 18, 19, 20, 10)}
    assert {r["doc_id"]: r["text"] for r in out.collect() if r["doc_id"] in clean} == clean
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in out.collect())


def test_a_passage_in_many_documents_brings_few_entries(make_docs, monkeypatch):
    """Entries of one bucket, for a passage that 40 or 400 documents have."""
    passage, most = " ".join(f"p{i}" for i in range(50)), {}
    folder = substrings.written
    for n in (40, 400):
        docs = make_docs(*[(i, passage) for i in range(n)]).coalesce(2)
        seen = {}
        monkeypatch.setattr(substrings, "written", lambda f, label: seen.setdefault(label, folder(f, label)))
        packed = substrings._packed(docs.select("doc_id", "text"))
        anchors = packed.mapInArrow(lambda b: substrings._anchors(b, 1, "_id"), substrings.ENTRY_SQL)
        most[n] = anchors.agg(F.sum(F.octet_length("kinds"))).first()[0]
        assert sum(r["n_removed"] for r in substrings.digests(docs).collect()) == 50 * (n - 1)
        assert seen["repeats"].agg(F.sum(F.octet_length("hashes"))).first()[0] <= 8 * 2
    assert most[40] == most[400] <= 2 * (26 + 2)


def test_query_removes_by_the_rule(spark, texts):
    found = sorted(tuple(r) for r in QUERIES["op5_fixed_block_substrings"](spark, SMALL).collect())
    assert found == sorted(removed_by_rule(list(texts.items())))


# --- SimHash ---------------------------------------------------------------------


def slow_simhash(text: str) -> int:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    w = WORD.findall(lowered)
    if not w:
        return 0
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def classes_by_rule(prints: list[int]) -> list[int]:
    """The first of those reachable, by place, over links of at most three bits."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(prints)), 2):
        if bin(prints[i] ^ prints[j]).count("1") <= 3:
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_fingerprints_are_as_defined(texts):
    for text in ["", " ", "A b", "ÄÖ x", "a b c", "A B C d e", *odd_texts(), *list(texts.values())[:30]]:
        assert simhash.simhash(text) == slow_simhash(text)


@pytest.mark.parametrize("per_range", [4096, 40, 5])
def test_links_find_all_within_three_bits(spark, per_range, monkeypatch):
    monkeypatch.setattr(simhash, "PER_RANGE", per_range)
    rng = random.Random(2)
    prints = {0, 7, 2**64 - 1}
    for x in [rng.getrandbits(64) for _ in range(25)]:
        prints.add(x)
        for _ in range(8):
            y = x
            for b in rng.sample(range(64), rng.randint(1, 6)):
                y ^= 1 << b
            prints.add(y)
    prints = sorted(prints, key=lambda x: x - 2**64 if x >= 2**63 else x)
    signed = [x - 2**64 if x >= 2**63 else x for x in prints]
    found = {r["node"]: r["component"] for r in graph.components(simhash.links(spark.createDataFrame([(x,) for x in signed], "fp LONG"))).collect()}
    assert [found.get(x, x) for x in signed] == [signed[i] for i in classes_by_rule(prints)]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(200, 260)] + [(5, i) for i in range(10, 60)] + [(60, 59), (-3, 70), (70, 70), (8, 8)]
    found = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a LONG, b LONG")).collect()}
    assert found == {**{i: 200 for i in range(200, 261)}, 5: 5, **{i: 5 for i in range(10, 61)}, -3: -3, 70: -3}
    assert graph.components(spark.createDataFrame([], "a LONG, b LONG")).count() == 0


def test_query_finds_the_classes(spark, texts):
    ids = sorted(texts)
    classes = [ids[i] for i in classes_by_rule([slow_simhash(texts[i]) for i in ids])]
    found = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op6_simhash_balls"](spark, SMALL).collect()}
    assert found == {i: (f"{slow_simhash(texts[i]):016x}", c) for i, c in zip(ids, classes)}


def test_one_document_of_each_class_stays(make_docs, clashing):
    rows = [(5, "a b c d"), (3, "A b  c d"), (3, "a b c d"), (9, None), (8, ""), (7, " \n"), (1, "one of its kind, quite alone"), (None, "q r s t"), (4, "q r s t"), (None, "nobody else")]
    docs = make_docs(*rows, **clashing)
    out = simhash.one_of_each(docs)
    assert out.columns == docs.columns
    assert sorted((r["doc_id"] or 0, (r["text"] or "").lower().split()[:1]) for r in out.collect()) == [(0, ["nobody"]), (1, ["one"]), (3, ["a"]), (4, ["q"]), (7, [])]
    assert simhash.one_of_each(make_docs()).count() == 0


def test_copies_of_nothing_stay_whatever_their_ids(make_docs):
    alone = ["the first of its kind entirely", "something else that nobody wrote before", "a third text without any copy"]
    rows = [(i, t) for i in (None, 5) for t in alone]
    # Texts of a null id and of 5 are copies of each other; three unrelated ones of each id alone.
    for some in ([r for r in rows if r[0] is None], [r for r in rows if r[0] == 5], rows):
        out = [(r["doc_id"], r["text"]) for r in simhash.one_of_each(make_docs(*some)).collect()]
        assert sorted(out, key=lambda r: r[1]) == sorted([(some[-1][0], t) for t in alone], key=lambda r: r[1])
    twice = [(None, alone[0]), (None, alone[0].upper()), (None, alone[1]), (5, alone[2]), (5, alone[2])]
    assert sorted(r["text"].lower() for r in simhash.one_of_each(make_docs(*twice)).collect()) == sorted(alone)


# --- toxicity --------------------------------------------------------------------


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    labels = table(spark, folder, "labels")
    scored = QUERIES["op10_counterfactual_toxicity"](spark, folder)
    rows = scored.join(labels, "doc_id").where("held_out").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in rows)
    assert all(r["predicted"] == (r["score"] >= 0.5) for r in rows)
    right = sum(r["predicted"] == r["toxic"] for r in rows)
    wrongly = sum(r["predicted"] and not r["toxic"] for r in rows)
    missed = sum(r["toxic"] and not r["predicted"] for r in rows)
    assert len(rows) > 700 and right >= 0.98 * len(rows) and wrongly <= 0.005 * len(rows) and missed <= 0.12 * sum(r["toxic"] for r in rows)


def training(n=400):
    """Insults mark most toxic texts; all toxic texts also happen to name one group more often."""
    rng = random.Random(6)
    fill = [f"word{i}" for i in range(80)]
    rows, labels = [], []
    for i in range(n):
        bad = i % 3 == 0
        said = rng.sample(fill, 12) + (["zonk", "zonker"] if bad and rng.random() < 0.7 else [])
        if rng.random() < (0.8 if bad else 0.15):
            said.append("muslims")
        elif rng.random() < 0.3:
            said.append("christians")
        rng.shuffle(said)
        rows.append((i, " ".join(said) + "."))
        labels.append((i, int(bad)))
    return rows, labels


def test_naming_a_group_moves_no_score(spark, make_docs):
    rows, labels = training()
    docs, marks = make_docs(*rows), spark.createDataFrame([(i, 1, t) for i, t in labels], "doc_id LONG, quality INT, toxic INT")
    swayed, steady = (toxicity.train(docs, marks, penalty=p) for p in (0.0, toxicity.PENALTY))
    shift = lambda m: abs(m.score("word1 word2 muslims") - m.score("word1 word2"))
    assert shift(steady) < 0.25 * shift(swayed) and steady.score("you zonk zonker") > 0.5 > steady.score("muslims word3 word4")


def test_labels_of_held_out_rows_are_never_read(spark, make_docs):
    rows, labels = training()
    turned = [(i, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, t in labels]
    models = [toxicity.train(make_docs(*rows), spark.createDataFrame(x, "doc_id LONG, toxic INT")) for x in (labels, turned)]
    assert models[0] == models[1]


def test_scores_of_odd_rows(spark, make_docs, clashing):
    rows, labels = training()
    marks = spark.createDataFrame([*labels, (1, None), (None, 1), (2, 1), (2, 0)], "doc_id LONG, toxic INT")
    model = toxicity.train(make_docs(*rows), marks)
    odd = make_docs((1, None), (2, ""), (None, "zonk zonker"), (3, "zonk zonker"), (3, "zonk zonker"), (4, "x" * 50_000), (5, "a " * 50_000), **clashing)
    out = toxicity.score(odd, model).collect()
    assert len(out) == 7 and all(0 <= r["score"] <= 1 for r in out) and {r["predicted"] for r in out if r["doc_id"] in (None, 3)} == {1}
    assert [r["held_out"] for r in out if r["doc_id"] is None] == [False]
    kept = toxicity.without_toxic(odd, model)
    assert kept.columns == odd.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 4, 5]
    none = spark.createDataFrame([], "doc_id LONG, toxic INT")
    assert [r["score"] for r in toxicity.score(odd.where("doc_id = 1"), toxicity.train(odd, none)).collect()][0] < 1e-6
    assert toxicity.score(make_docs(), toxicity.train(make_docs(), none)).count() == 0


@pytest.mark.parametrize("clean_of_ten", [5, 2])
def test_toxic_texts_may_be_half_or_most_of_the_sample(spark, make_docs, clean_of_ten):
    rng = random.Random(8)
    fill = [f"word{i}" for i in range(60)]
    rows, labels = [], []
    read = [i for i in range(500) if zlib.crc32(str(i).encode()) % 5][:300]
    for k, i in enumerate(read):
        bad = k % 10 >= clean_of_ten
        rows.append((i, " ".join(rng.sample(fill, 12) + (["zonk", "zonker"] if bad else []))))
        labels.append((i, int(bad)))
    docs = make_docs(*rows)
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id LONG, toxic INT"))
    assert any("zonk" in f for f in model.weights)
    assert {r["doc_id"] for r in toxicity.without_toxic(docs, model).collect()} == {i for i, t in labels if not t}


def test_counterfactuals_swap_whole_terms():
    assert toxicity.counterfactual("The women left. Nobody else.", 0).split() == ["The", "men", "left.", "Nobody", "else."]
    assert toxicity.counterfactual("womenfolk", 0) is None and F is not None


def test_large_ids_beside_null_ones_stay_exact(spark, make_docs):
    """Rows of one batch, where pandas would read a null among numbers as floats."""
    ids = [None, 2**53 + 1, 2**53 + 3, 2**62 + 1, -(2**62) - 1]
    docs = make_docs(*((i, f"text {n}") for n, i in enumerate(ids))).coalesce(1)
    for out in (packing.pack_documents(docs), tokens.prefix_counts(docs, 5), merkle.compare_neighbours(spark, docs), merkle.fingerprints(docs), substrings.digests(docs)):
        assert {r["doc_id"] for r in out.collect()} == set(ids)


def test_rolling_hashes_tell_stretches_apart_and_nothing_else():
    rng = np.random.default_rng(2)
    words = rng.integers(0, 3, 400).astype(np.uint64)
    for width in (1, 2, 3, 25, 50, 400):
        h = substrings.rolling(words, width)
        stretches = [tuple(words[i : i + width]) for i in range(len(words) - width + 1)]
        assert len(h) == len(stretches) and len(set(h.tolist())) == len(set(stretches)) == len(set(zip(h.tolist(), stretches)))
    assert len(substrings.rolling(words, 401)) == 0


def test_slices_hold_every_entry_once_and_equal_hashes_together(monkeypatch):
    monkeypatch.setattr(substrings, "AT_ONCE", 100)
    h = np.random.default_rng(4).integers(0, 500, 3000).astype(np.uint32)
    parts = list(substrings._slices(h))
    assert sorted(np.concatenate(parts).tolist()) == list(range(3000)) and len(parts) > 20
    assert sum(len(set(h[p].tolist())) for p in parts) == len(set(h.tolist()))


def test_the_fit_descends_its_own_loss():
    """The gradient steps end where a plain loss has its least value, by differences on every side."""
    rng = np.random.default_rng(6)
    own = [np.flatnonzero(rng.random(4) < 0.5) for _ in range(300)]
    other = [np.setdiff1d(x, [0]) if 0 in x else None for x in own]
    toxic = np.array([float((1 in x) == (rng.random() < 0.75)) for x in own])

    def loss(b, w, penalty):
        p = lambda x: 1 / (1 + np.exp(-(b + w[x].sum())))
        log = -np.mean([np.log(p(x)) if t else np.log(1 - p(x)) for x, t in zip(own, toxic)])
        moved = [(p(x) - p(y)) ** 2 for x, y in zip(own, other) if y is not None]
        return log + penalty * np.mean(moved) + toxicity.RIDGE / 2 * (w**2).sum()

    for penalty in (0.0, 40.0):
        b, w = toxicity.fit(toxic, own, other, 4, penalty)
        at = loss(b, w, penalty)
        for k in range(4):
            for step in (0.05, -0.05):
                moved = w.copy()
                moved[k] += step
                assert loss(b, moved, penalty) > at
        assert loss(b + 0.05, w, penalty) > at and loss(b - 0.05, w, penalty) > at


def test_training_repeats_itself_where_copies_have_several_ids(spark, make_docs):
    # Copies with different ids could pick different swaps.
    rows = [(i, f"women are bad{i % 2} people {'awful' if i % 3 == 0 else 'fine'} w{i % 7}") for i in range(1, 200)]
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i, _ in rows], "doc_id long, quality int, toxic int")
    models = [toxicity.train(make_docs(*some), labels) for some in (rows, rows[::-1])]
    assert models[0] == models[1] and models[0].weights


def test_stored_counts_answer_cuts_without_the_texts(spark, library, make_docs, clashing):
    rows = [*enumerate(odd_texts()), (900, None), (2**62 + 1, "a  b é"), (None, "日本語 テスト")]
    stored = tokens.stored_counts(make_docs(*rows, **clashing))
    assert stored.columns == ["doc_id", "steps"]
    found = tokens.cut_answers(stored, (0, 3, 5), (0, 2, 7)).collect()
    by_key = {(i, len((t or "").encode())): t or "" for i, t in rows}
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    assert len(found) == len(rows)
    for r in found:
        text = by_key[r["doc_id"], r["n_bytes"]]
        assert r["n_tokens"] == count(text)
        if "<|" in text:
            continue
        prefixes = [text[:k] for k in range(len(text[:60]) + 1)]
        for b in (0, 3, 5):
            assert r[f"bytes_within_{b}"] == max(len(p.encode()) for p in prefixes if count(p) <= b)
        for c in (0, 2, 7):
            assert r[f"tokens_of_{c}"] == count([p for p in prefixes if len(p.encode()) <= c][-1])
    assert tokens.cut_answers(tokens.stored_counts(make_docs()), (5,)).count() == 0
