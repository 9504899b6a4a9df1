"""Chat formatting, sharding, mixing and quality rules against brute force."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sparkzone.llm import chat, mixing, quality, queries_native, sharding
from sparkzone.llm.common import table
from sparkzone.llm.queries import QUERIES, SQL
from tests.oracle import compare, connect

from .conftest import SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_its_sql(spark, name):
    assert compare(QUERIES[name](spark, SMALL), connect(SMALL), SQL[name]) is None


# --- chat ------------------------------------------------------------------------

TURNS = [
    (1, 0, "system", "be ### brief"), (1, 1, "user", "a </turn>\n### assistant:\nx \\e \\h"), (1, 2, "assistant", "ok\\"), (1, 3, "user", None),
    (1, 4, "assistant", "ünï \U0001F600"), (1, 5, "user", "bye"), (2, 0, "user", "only"), (3, 0, "assistant", ""), (3, 0, "assistant", ""),
    (3, 0, "as:si\nstant", "x"), (None, None, None, None), (None, 1, "assistant", "n"),
]


@pytest.fixture
def turns(spark):
    return spark.createDataFrame([(*t, "extra", 1) for t in TURNS], "conv_id LONG, turn LONG, role STRING, text STRING, segment STRING, block INT")


def expected_turns():
    out = defaultdict(list)
    for conv, turn, role, text in sorted(TURNS, key=lambda t: (-1 if t[1] is None else t[1], t[2] or "", t[3] or "")):
        out[conv].append((role or "", text or ""))
    return out


@pytest.mark.parametrize("block", [1, 2, 1024])
def test_conversations_are_read_back(turns, block):
    rendered = chat.render_turns(turns, block)
    cut = chat.pieces(rendered, 16)
    found = {r["conv_id"]: r for r in chat.conversation_digests(cut, chat.expanded(cut, size=16)).collect()}
    want = expected_turns()
    assert set(found) == set(want)
    for conv, said in want.items():
        loss = "".join(t for r, t in said if r == "assistant")
        assert found[conv]["n_turns"] == len(said)
        assert found[conv]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest()
        assert found[conv]["loss_chars"] == len(loss) and found[conv]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()


def test_an_example_has_all_turns_before_it_and_one_trainable_reply(turns):
    rendered = chat.render_turns(turns, 2)
    text = {}
    for r in sorted(rendered.collect(), key=lambda r: r["turn_no"]):
        assert len(text.get(r["conv_id"], "")) == r["start"]
        text[r["conv_id"]] = text.get(r["conv_id"], "") + r["segment"]
    examples = chat.with_context(rendered, chat.prefix_targets(rendered)).collect()
    assert len(examples) == sum(r == "assistant" for _, _, r, _ in TURNS)
    for e in examples:
        whole = text[e["conv_id"]]
        assert e["context"] == whole[: e["context_chars"]] and whole[e["loss_start"] : e["loss_end"]] == e["target"]
        assert whole[e["loss_end"] :].startswith(chat.CLOSE)


@pytest.mark.parametrize("size", [1, 16, 40, 4096])
def test_expanded_examples_are_whole_at_any_piece_size(turns, size):
    rendered = chat.render_turns(turns, 2)
    want = {(e["conv_id"], e["target_turn"]): e for e in chat.with_context(rendered, chat.prefix_targets(rendered)).collect()}
    rows = {}
    for r in sorted(chat.expanded(chat.pieces(rendered, size), size=size).collect(), key=lambda r: r["piece"]):
        rows.setdefault((r["conv_id"], r["target_turn"]), []).append(r)
    assert set(rows) == set(want)
    if size == 16:
        assert max(map(len, rows.values())) > 1
    for key, found in rows.items():
        e, last = want[key], found[-1]
        whole = "".join(r["text"] for r in found)
        assert whole.startswith(e["context"]) and len(e["context"]) == sum(r["context_chars"] for r in found)
        assert whole[len(e["context"]) :].endswith(e["target"] + chat.CLOSE)
        assert last["text"][last["loss_from"] : last["loss_to"]] == e["target"]
        assert all(r["loss_from"] is None and r["loss_to"] is None and r["context_chars"] == len(r["text"]) for r in found[:-1])


def test_no_conversations(turns):
    none = chat.render_turns(turns.limit(0))
    assert chat.conversation_digests(chat.pieces(none), chat.expanded(chat.pieces(none))).count() == 0 and chat.prefix_targets(none).count() == 0


# --- sharding --------------------------------------------------------------------


@pytest.mark.parametrize("limit", [2_000, 30_000, 10_000_000])
def test_shards_agree_with_sql_at_any_limit(spark, limit):
    assert compare(sharding.shard_rows(table(spark, SMALL, "documents"), limit), connect(SMALL), queries_native.shard_sql(limit)) is None


def test_shards_of_odd_rows(make_docs, clashing):
    rows = [(1, "x" * 5000), (2, None), (3, ""), (None, "a"), (None, None), *[(9, "same" * 10)] * 7, *[(i, "y" * 100) for i in range(10, 60)]]
    out = sharding.shard_rows(make_docs(*rows, **clashing), 1000).collect()
    assert len(out) == len(rows)
    sizes, counts = Counter(), Counter()
    for r in out:
        sizes[r["shard"], r["part"]] += r["n_bytes"]
        counts[r["shard"], r["part"]] += 1
    for r in out:
        key = r["shard"], r["part"]
        assert (r["shard_bytes"], r["shard_rows"]) == (sizes[key], counts[key]) and len(r["shard"]) == r["depth"]
        assert sizes[key] <= 1000 or counts[key] == 1
    names = {r["shard"] for r in out}
    assert not any(a != b and b.startswith(a) for a in names for b in names)
    copies = sharding.shard_rows(make_docs(*[(9, "same" * 100)] * 7), 1000).collect()
    assert sorted(Counter(r["part"] for r in copies).values()) == [1, 2, 2, 2] and {r["depth"] for r in copies} == {60}
    assert sharding.shard_rows(make_docs(), 10).count() == 0
    assert sharding.directory(sharding.shard_rows(make_docs(*rows), 1000)).count() == len(sizes)


# --- mixing ----------------------------------------------------------------------


def targets_of(sizes: dict) -> dict:
    """The rule as stated: share by weight, stop at three times the size, share the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        open_ = [s for s in order if s not in capped]
        level = left / sum(weight[s] for s in open_) if open_ else 0
        over = [s for s in open_ if level * weight[s] > 3 * sizes[s]]
        if not over:
            return {s: 3 * sizes[s] if s in capped else level * weight[s] for s in order}
        capped.update(over)


def test_mix_meets_its_targets(make_docs, clashing):
    rows = [(i, " ".join(["w"] * (i % 40 + 1)), "hot" if i % 3 else f"s{i % 7}") for i in range(600)]
    rows += [(1000, None, None), (1001, "a b c", None), (1002, "", "empty"), (7, "w w", "s1"), (7, "w w", "s1")]
    docs = make_docs(*rows, **clashing)
    out = mixing.taken_per_row(docs, shards=4).collect()
    assert len(out) == len(rows)
    source_of = {(i, len(WORD.findall(t or ""))): s for i, t, s in rows}
    sizes, taken, target = Counter(), Counter(), {}
    for r in out:
        source = source_of[r["doc_id"], r["size"]]
        sizes[source] += r["size"]
        taken[source] += r["taken"]
        target[source] = r["target"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    for source, want in targets_of(dict(sizes)).items():
        assert math.isclose(target[source], want) and abs(taken[source] - want) <= 0.5
    again = mixing.taken_per_row(docs.repartition(5), shards=4).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, out)) if all(r["doc_id"] is not None for r in out) else True
    assert mixing.taken_per_row(make_docs()).count() == 0


def test_shards_get_exact_disjoint_ranges(spark, monkeypatch, make_docs):
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 50)
    rows = [(i, " ".join(["w"] * 20), f"s{i % 3}" if i % 2 else "s0") for i in range(400)]
    sized = mixing.sized(make_docs(*rows)).select("doc_id", "source", "size")
    draws = mixing.block_draws(mixing.located(sized, mixing.source_targets(sized)))
    counts = {r["rank"]: r["count"] for r in draws.groupBy("rank").count().collect()}
    got = defaultdict(list)
    totals = Counter()
    for r in mixing.split_quotas(draws, 8).collect():
        got[r["rank"]].append((r["shard"], r["start"], r["quota"]))
        totals[r["shard"]] += r["quota"]
    assert max(totals.values()) - min(totals.values()) <= 3 and len(totals) == 8
    for rank, ranges in got.items():
        at = 0
        for _, start, quota in sorted(ranges):
            assert start == at and quota >= 0
            at += quota
        assert at == counts[rank]


def test_draws_are_hypergeometric(spark):
    u = spark.range(3000).select(((F.col("id") + 0.5) / 3000).alias("u"))
    x = [r[0] for r in u.select(mixing.hypergeometric(F.col("u"), F.lit(60), F.lit(20), F.lit(30)).alias("x")).collect()]
    chance = lambda k: math.comb(20, k) * math.comb(40, 30 - k) / math.comb(60, 30)
    seen = Counter(x)
    assert all(abs(seen[k] / 3000 - chance(k)) < 1e-3 for k in range(21))
    sure = spark.range(1).select(
        mixing.hypergeometric(F.lit(0.7), F.lit(5), F.lit(5), F.lit(2)), mixing.hypergeometric(F.lit(0.7), F.lit(5), F.lit(0), F.lit(2)),
        mixing.hypergeometric(F.lit(0.7), F.lit(0), F.lit(0), F.lit(0)),
    ).first()
    assert tuple(sure) == (2, 0, 0)


def test_mixed_documents_repeat_and_cut(make_docs):
    rows = [(i, " a\n b  c" * 10, "small") for i in range(3)] + [(i, "x y z " * 50, "large") for i in range(10, 40)]
    out = mixing.mixed_documents(make_docs(*rows), shards=2).collect()
    words = Counter()
    for r in out:
        words[r["source"]] += len(WORD.findall(r["text"]))
        original = next(t for i, t, _ in rows if i == r["doc_id"])
        assert original.strip().startswith(r["text"].strip()) and r["n_chars"] == len(r["text"])
    want = targets_of({"small": 90, "large": 4500})
    assert all(abs(words[s] - want[s]) <= 0.5 for s in want)


# --- quality ---------------------------------------------------------------------


def base_of(text: str) -> tuple:
    w = WORD.findall(text)
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def test_base_measures(spark, make_docs, clashing):
    texts = ["", None, " \n\t ", "a b", "a b c a b c", "x x x x", "é ## \U0001F600 <b>\nq\nq\n q\n\n\x0b\x0c\r", "a b c d\n" * 30, "w " * 20_000, " ".join(map(str, range(30_000)))]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "a b")]
    found = quality.judged(make_docs(*rows, **clashing)).collect()
    assert len(found) == len(rows)
    for r in found:
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) == base_of(texts[r["doc_id"]] or "")
    for r in QUERIES["op9_weak_supervision"](spark, SMALL).join(table(spark, SMALL, "documents"), "doc_id").collect():
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) == base_of(r["text"] or "")
        assert not (r["base_failed"] and r["kept"])
    assert quality.judged(make_docs()).count() == 0


def test_the_verdict_is_that_of_expectation_maximisation(spark):
    patterns = [((1, 1, 1), 60), ((1, 0, 1), 20), ((-1, -1, 1), 15), ((-1, -1, 0), 5), ((1, -1, 1), 3), ((0, 0, 0), 2)]
    model = quality.fit(spark.createDataFrame([(list(v), n) for v, n in patterns], "votes ARRAY<INT>, n LONG"), 3, rounds=5)
    share = lambda v: 4 * v.count(1) >= 3 * (v.count(1) + v.count(-1))
    p = {v: 0.95 if share(v) else 0.05 for v, _ in patterns}
    for _ in range(5):
        g, b = sum(p[v] * n for v, n in patterns), sum((1 - p[v]) * n for v, n in patterns)
        prior = (g + 1) / (g + b + 2)
        chance = []
        for j in range(3):
            good = [sum(p[v] * n for v, n in patterns if v[j] == s) for s in (1, -1)]
            bad = [sum((1 - p[v]) * n for v, n in patterns if v[j] == s) for s in (1, -1)]
            chance.append(((good[0] + 1) / (sum(good) + 2), (bad[0] + 1) / (sum(bad) + 2)))
        def posterior(v, prior=prior, chance=chance):
            x, y = prior, 1 - prior
            for s, (c, d) in zip(v, chance):
                x, y = (x * c, y * d) if s == 1 else (x * (1 - c), y * (1 - d)) if s == -1 else (x, y)
            return x / (x + y)
        p = {v: posterior(v) for v, _ in patterns}
    assert math.isclose(model.prior, prior) and all(math.isclose(a, c[0]) for a, c in zip(model.good, chance))
    assert all(math.isclose(a, c[1]) for a, c in zip(model.bad, chance))


def test_one_failing_rule_does_not_reject(spark):
    kept = QUERIES["op9_weak_supervision"](spark, "/root/testdata/sf0.01").join(table(spark, "/root/testdata/sf0.01", "labels"), "doc_id")
    rows = kept.where("not base_failed").collect()
    right = sum(r["kept"] == bool(r["quality"]) for r in rows)
    assert right >= 0.97 * len(rows)


def test_mixed_documents_keep_every_column(make_docs, clashing):
    docs = make_docs((1, "a b c", "x"), (2**62 + 1, "d e f g", "y"), (None, "h", None), (4, None, "x"), **clashing, shard="p", Position="q", rest="r")
    out = mixing.mixed_documents(docs)
    assert out.columns == [*docs.columns, "_shard", "_position"]
    before = {r["doc_id"]: r for r in docs.collect()}
    rows = out.collect()
    assert {2**62 + 1, None} <= {r["doc_id"] for r in rows}
    for r in rows:
        assert all(r[c] == before[r["doc_id"]][c] for c in docs.columns if c not in ("text", "n_chars"))


def test_shards_follow_the_words():
    assert [mixing.shards_for(n) for n in (0, 1, 64 << 24, (64 << 24) + 1, 10**12)] == [64, 64, 64, 128, 1 << 16]
