from __future__ import annotations

import pytest

SMALL = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text[, source]), with extra columns that helpers might also use."""

    def make(*rows, **extra):
        data = [(i, t, "en", (rest[0] if rest else "s"), None if t is None else len(t), *extra.values()) for i, t, *rest in rows]
        more = "".join(f", {name} {'LONG' if isinstance(v, int) else 'STRING'}" for name, v in extra.items())
        return spark.createDataFrame(data, DOCUMENTS + more)

    return make


CLASHING = {n: "x" for n in ("_id", "_fp", "fp", "at", "id", "part", "size", "words", "h", "block", "component_id", "toxic", "votes", "score", "steps", "range", "rank", "row")}


@pytest.fixture
def clashing():
    return CLASHING
