"""The pipeline's stages, each on its own input."""

from __future__ import annotations

import re

import corpus_pipeline
from sparkzone.llm import mixing, simhash, toxicity
from sparkzone.llm.common import table, written

from .conftest import SMALL
from .test_free import classes_by_rule, slow_simhash
from .test_native import targets_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_stages(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "simhash_near_dedup", "substring_dedup", "mixing", "packing"]
    docs = table(spark, SMALL, "documents")
    columns, seen = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(written(stage(spark, seen[-1], SMALL), name))
    raw, clean, single, unique, mixed, packed = [f.collect() for f in seen]
    assert all(f.columns == columns for f in seen[:-1])

    model = toxicity.train(docs, table(spark, SMALL, "labels"))
    assert sorted(r["doc_id"] for r in clean) == sorted(r["doc_id"] for r in raw if model.score(r["text"] or "") < 0.5)

    ordered = sorted(clean, key=lambda r: r["doc_id"])
    classes = classes_by_rule([slow_simhash(r["text"] or "") for r in ordered])
    assert sorted(r["doc_id"] for r in single) == sorted({ordered[i]["doc_id"] for i in classes})

    windows = {}
    for r in sorted(single, key=lambda r: r["doc_id"]):
        w = WORD.findall(r["text"] or "")
        for s in range(len(w) - 49):
            windows.setdefault(tuple(w[s : s + 50]), r["doc_id"])
    after = {r["doc_id"]: r["text"] for r in unique}
    assert set(after) == {r["doc_id"] for r in single}
    for r in single:
        w = WORD.findall(r["text"] or "")
        gone = [False] * len(w)
        for s in range(len(w) - 49):
            if windows[tuple(w[s : s + 50])] < r["doc_id"]:
                gone[s : s + 50] = [True] * 50
        assert WORD.findall(after[r["doc_id"]] or "") == [x for x, g in zip(w, gone) if not g]
        assert any(gone) or after[r["doc_id"]] == r["text"]

    size = lambda rows, s: sum(len(WORD.findall(r["text"] or "")) for r in rows if r["source"] == s)
    sources = {r["source"] for r in unique}
    want = targets_of({s: size(unique, s) for s in sources})
    assert all(abs(size(mixed, s) - want[s]) <= 0.5 for s in sources)

    assert len({p["doc_id"] for p in packed}) == len({r["doc_id"] for r in mixed})
    assert corpus_pipeline.run(spark, SMALL).count() == len(packed)


def test_stages_without_documents(spark):
    docs = table(spark, SMALL, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        assert out.count() == 0
        docs = docs if out.columns != docs.columns else out
    assert simhash.one_of_each(docs).count() == mixing.mixed_documents(docs).count() == 0
