"""Toxicity by a counterfactual-regularised classifier.

A logistic model over what is present in a text: words, beginnings of words, and beginnings
that several different words share (insults are inflected). It is fitted
on a sample of labelled documents of bounded size. Each sampled document whose sentences name
a group gets a counterfactual: the same document with every such term swapped for another of
its category, or for none. The fit adds ``PENALTY`` times the squared change of the score to
its loss, so that naming a group moves no score; what a text says about the group still does.

A feature is a candidate if the odds of its documents to be toxic are over twice those of the
sample. That works at every share of toxic documents, also where most are, or where the sample's
share is above the labels' since copies, which count once in it, are mostly of clean texts.

The sample (``SAMPLE`` documents, by hash of the id) is the one bounded thing: it is sent to
the tasks as ids, and the driver sees its statistics for ``LEXICON`` features and, per
document, which of these are present. Every document is scored, over its whole text.

Rows with crc32(doc_id as text) mod ``FOLDS`` = 0 are held out: their labels are never read
into the fit. Nothing but the text enters a score.

Cases: null text is empty and scores the base rate, as do texts without known features; a
label that is null is no label; a document with several labels is toxic if one says so; with
labels of one kind only, or none, every score is the share of toxic ones (0 if unknown); null
ids are held out by no fold and carry no label; of sampled copies with one label the least id
counts; repeated rows score alike; no rows in give no
rows out; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import for_python, text_of, written

FOLDS = 5
SAMPLE = 10_000
LEXICON = 4_000
LEAST_DOCUMENTS = 4
# Features a task counts before it sends them.
COUNTED = 100_000
BEGINNINGS = (3, 4, 5, 6, 7)
SHARED_BY = (1, 2, 3, 4)
PENALTY = 40.0
RIDGE = 1e-5
ROUNDS = 400

# Names of groups, by category and language; terms of one line may be swapped.
IDENTITIES = (
    "women men girls boys woman man female male trans nonbinary",
    "christian muslim jewish hindu buddhist atheist catholic christians muslims jews hindus buddhists atheists catholics",
    "black white asian latino african european arab indigenous american mexican chinese indian",
    "gay lesbian bisexual straight heterosexual homosexual queer",
    "disabled blind deaf autistic elderly young old immigrant refugee immigrants refugees",
    "frauen männer mädchen jungen frau mann",
    "christen muslime juden hindus buddhisten atheisten",
    "schwarze weiße asiaten araber afrikaner europäer ausländer einwanderer flüchtlinge",
    "femmes hommes filles garçons femme homme",
    "chrétiens musulmans juifs hindous bouddhistes athées",
    "noirs blancs asiatiques arabes africains européens immigrés réfugiés",
    "mujeres hombres niñas niños mujer hombre",
    "cristianos musulmanes judíos hindúes budistas ateos",
    "negros blancos asiáticos árabes africanos europeos inmigrantes refugiados",
)

SENTENCE = re.compile(r"[^.!?\n]+[.!?\n]*")
EDGE = re.compile(r"^[\W_]+|[\W_]+$")


def _group_of() -> dict[str, list[str]]:
    return {term: line.split() for line in IDENTITIES for term in line.split()}


def words(text: str) -> set[str]:
    """The distinct words of a text, in lower case, without marks at their ends."""
    return {EDGE.sub("", w) if not w.isalnum() else w for w in set(text.lower().split())} - {""}


def features(found: set[str]) -> set[str]:
    """Words, beginnings, and beginnings that several different words share."""
    begun: dict[str, int] = {}
    for w in found:
        for n in BEGINNINGS:
            if len(w) > n:
                begun[w[:n]] = begun.get(w[:n], 0) + 1
    out = set(found)
    for beginning, times in begun.items():
        out.update(f"{k}^{beginning}" for k in SHARED_BY if times >= k)
    return out


def counterfactual(text: str, turn: int) -> str | None:
    """The text with the group terms of its sentences swapped; None where it names no group.

    ``turn`` picks the substitute: each other term of the line in order, and then none.
    """
    groups, changed, out = _group_of(), False, []
    for sentence in SENTENCE.findall(text):
        tokens = sentence.split()
        swapped = []
        for token in tokens:
            word = EDGE.sub("", token.lower())
            if word in groups:
                others = [t for t in groups[word] if t != word] + [""]
                swapped.append(others[turn % len(others)])
                changed = True
            else:
                swapped.append(token)
        out.append(" ".join(swapped))
    return "\n".join(out) if changed else None


@dataclass(frozen=True)
class Model:
    bias: float
    weights: dict[str, float]

    def score(self, text: str) -> float:
        known = self.weights
        z = self.bias + sum(known[f] for f in features(words(text)) if f in known)
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -60, 60))))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def _sample(documents: DataFrame, labels: DataFrame, bound: int) -> DataFrame:
    """doc_id, toxic and text of at most about ``bound`` labelled documents that are not held out."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    # The hint is safe: ``bound`` rows of two numbers.
    found = documents.select("doc_id", text_of().alias("text")).join(F.broadcast(picked), "doc_id")
    # Copies teach nothing new and would outweigh other words. The least id of theirs picks the swap, on every run.
    return written(found.groupBy("text", "toxic").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "text", "toxic"), "toxicity-sample")


def _lexicon(sample: DataFrame, size: int) -> list[str]:
    """The features that mark toxic texts best, by the chi-squared statistic."""

    def each(batches):
        # Counts are summed before they are sent, as far as a bounded table reaches.
        toxic, seen = Counter(), Counter()
        for b in batches:
            for text, t in zip(b["text"], b["toxic"]):
                found = features(words(text))
                seen.update(found)
                if t:
                    toxic.update(found)
                if len(seen) > COUNTED:
                    yield pd.DataFrame({"feature": list(seen), "toxic": [toxic[f] for f in seen], "docs": list(seen.values())})
                    toxic, seen = Counter(), Counter()
        yield pd.DataFrame({"feature": list(seen), "toxic": [toxic[f] for f in seen], "docs": list(seen.values())})

    counts = sample.mapInPandas(each, "feature string, toxic long, docs long").groupBy("feature").agg(F.sum("toxic").alias("a"), F.sum("docs").alias("n"))
    total = sample.agg(F.sum("toxic").alias("toxic"), F.count(F.lit(1)).alias("docs")).first()
    pos, docs = float(total["toxic"]), float(total["docs"])
    a, n = F.col("a").cast("double"), F.col("n").cast("double")
    gain = (a * docs - n * pos) ** 2 / (n * (docs - n + 1.0))
    # Only signs of toxic texts: what is rare in them is no evidence for a text that has both.
    # Odds, unlike shares, can be twice the sample's however many of it are toxic.
    sign = a * (docs - pos) > 2 * (n - a) * pos
    best = counts.where((F.col("n") >= LEAST_DOCUMENTS) & sign).orderBy(gain.desc(), "feature").limit(size)
    return [r["feature"] for r in best.select("feature").collect()]


def _present(sample: DataFrame, index: dict[str, int]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray | None]]:
    """Labels, present features, and those of the counterfactual, per sampled document."""

    def each(batches):
        pick = lambda text: sorted(index[f] for f in features(words(text)) if f in index)
        for b in batches:
            rows = []
            for doc_id, text, toxic in zip(b["doc_id"], b["text"], b["toxic"]):
                other = counterfactual(text, int(doc_id))
                rows.append((doc_id, toxic, pick(text), None if other is None else pick(other)))
            yield pd.DataFrame(rows, columns=["doc_id", "toxic", "own", "other"])

    schema = "doc_id long, toxic int, own array<int>, other array<int>"
    rows = sample.mapInPandas(each, schema).orderBy("doc_id", "toxic").collect()
    return (
        np.array([r["toxic"] for r in rows], float),
        [np.array(r["own"], int) for r in rows],
        [None if r["other"] is None else np.array(r["other"], int) for r in rows],
    )


def _flat(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    rows = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    return rows, np.concatenate(lists) if len(rows) else np.zeros(0, int)


def fit(toxic: np.ndarray, own: list[np.ndarray], other: list[np.ndarray | None], size: int, penalty: float = PENALTY) -> tuple[float, np.ndarray]:
    """Bias and weights, by gradient steps on the mean of log loss + penalty * (change of score)^2."""
    n = len(toxic)
    r, c = _flat(own)
    pairs = [i for i, x in enumerate(other) if x is not None]
    pr, pc = _flat([other[i] for i in pairs])
    qr, qc = _flat([own[i] for i in pairs])
    w, b = np.zeros(size), float(np.log((toxic.sum() + 1) / (n - toxic.sum() + 1)))
    moment, square, mb, sb = np.zeros(size), np.zeros(size), 0.0, 0.0
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -60, 60)))
    for step in range(1, ROUNDS + 1):
        error = (sigmoid(b + np.bincount(r, w[c], n)) - toxic) / n
        g = np.bincount(c, error[r], size) + RIDGE * w
        gb = error.sum()
        if pairs:
            s = sigmoid(b + np.bincount(qr, w[qc], len(pairs)))
            t = sigmoid(b + np.bincount(pr, w[pc], len(pairs)))
            change = 2 * penalty * (s - t) / len(pairs)
            up, down = change * s * (1 - s), change * t * (1 - t)
            g += np.bincount(qc, up[qr], size) - np.bincount(pc, down[pr], size)
            gb += up.sum() - down.sum()
        # Adam's step, which needs no tuning to the scale of features.
        moment, square = 0.9 * moment + 0.1 * g, 0.999 * square + 0.001 * g * g
        mb, sb = 0.9 * mb + 0.1 * gb, 0.999 * sb + 0.001 * gb * gb
        fix1, fix2 = 1 - 0.9**step, 1 - 0.999**step
        w -= 0.05 * (moment / fix1) / (np.sqrt(square / fix2) + 1e-8)
        b -= 0.05 * (mb / fix1) / (np.sqrt(sb / fix2) + 1e-8)
    return float(b), w


def train(documents: DataFrame, labels: DataFrame, bound: int = SAMPLE, size: int = LEXICON, penalty: float = PENALTY) -> Model:
    sample = _sample(for_python(documents), labels, bound)
    share = sample.agg(F.avg("toxic")).first()[0]
    if share is None or share in (0.0, 1.0):
        base = min(max(share or 0.0, 1e-9), 1 - 1e-9)
        return Model(float(np.log(base / (1 - base))), {})
    terms = dict.fromkeys([*_lexicon(sample, size), *_group_of()])
    index = {f: i for i, f in enumerate(terms)}
    bias, weights = fit(*_present(sample, index), len(index), penalty)
    return Model(bias, {f: float(weights[i]) for f, i in index.items() if weights[i]})


def score(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    docs = for_python(documents).select("doc_id", text_of().alias("text"))
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), _scored(model)(F.col("text")).alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )


def _scored(model: Model):
    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(model.score).astype(float)

    return run


def without_toxic(documents: DataFrame, model: Model) -> DataFrame:
    """The documents whose score stays below one half, with their columns."""
    return for_python(documents).where(_scored(model)(text_of()) < 0.5)
