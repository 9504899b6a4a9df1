"""Quality rules by weak supervision.

Each rule votes good (1), bad (-1) or abstains (0). Nothing says beforehand how far a rule can
be trusted: expectation-maximisation estimates, for good and for bad documents, how often each
rule votes good when it votes at all, together with the share of good documents. A document is
kept if its posterior probability of being good reaches one half, so one failing rule does not
reject it and one passing rule does not save it.

Documents enter the estimate only through their vote pattern, of which there are 3^rules at
most; all documents are counted, and each round is one aggregation over that table.

Base failures (under 50 words, or over half of the words in repeated windows) are final and
don't take part in the estimate.

Cases: null or empty text has no words and fails the base rule; repeated rows are separate
documents; ties in the posterior are kept; no documents in give none out; extra columns are
ignored. Windows are compared by their words, not by a hash: hashes only find candidates.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, WORD, text_of, written

MIN_WORDS = 50
SPACES = " \t\n\x0b\x0c\r"
# Position bits of a packed (hash, position) number; the other 33 hold the hash.
POSITION = 31
ROUNDS = 20
SMOOTH = 1.0

# A word of letters with the marks that prose puts around it.
PLAIN = r"(?<![^\x20\x09-\x0D])[(\"'«¿¡]*\p{L}[\p{L}\p{M}'’-]*[.,;:!?)\"'»]*(?![^\x20\x09-\x0D])"


@dataclass(frozen=True)
class Rule:
    """Votes good up to ``good``, bad from ``bad`` on, and abstains between them.

    With ``good`` above ``bad`` the measure counts the other way round.
    """

    name: str
    measure: str
    good: float
    bad: float

    def vote(self) -> Column:
        value = F.expr(self.measure)
        if self.good < self.bad:
            return F.when(value <= self.good, 1).when(value >= self.bad, -1).otherwise(0)
        return F.when(value >= self.good, 1).when(value <= self.bad, -1).otherwise(0)


RULES = (
    Rule("symbols_per_word", "try_divide(n_symbols, n_words)", 0.05, 0.2),
    Rule("symbols_per_char", "try_divide(n_symbols, word_chars)", 0.01, 0.05),
    Rule("plain_words", "try_divide(n_plain, n_words)", 0.8, 0.65),
    Rule("word_length", "abs(try_divide(word_chars, n_words) - 5.5)", 1.5, 2.0),
    Rule("repeated_words", "try_divide(n_repeat_words, n_words)", 0.1, 0.3),
    Rule("repeated_lines", "try_divide(n_dup_lines, n_lines)", 0.15, 0.3),
    Rule("capitals", "try_divide(n_upper, word_chars)", 0.15, 0.4),
)


def _hold(frame: DataFrame, *keep: str, **made: Column) -> DataFrame:
    """Compute columns behind a generator, which keeps the optimizer from copying them into later expressions."""
    return frame.select(*keep, F.inline(F.array(F.struct(*[c.alias(n) for n, c in made.items()]))))


def _repeat_words(frame: DataFrame, keep: list[str]) -> DataFrame:
    """Adds n_repeat_words: the words within 3-word windows that occur twice or more."""
    windows = F.col("n_words").cast("int") - 2
    indexes = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    mask = (1 << POSITION) - 1
    high = lambda x: F.shiftright(x, POSITION)
    w = F.col("words")
    packed = F.transform(
        indexes(windows), lambda i: F.shiftleft(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)), POSITION).bitwiseOR(i.cast("long"))
    )
    frame = _hold(frame, *keep, "words", packed=F.sort_array(packed))
    s = F.col("packed")
    alike = lambda k, j: F.coalesce(high(F.get(s, k)) == high(F.get(s, j)), F.lit(False))
    found = F.filter(indexes(F.size(s)), lambda k: alike(k, k + 1) | alike(k, F.when(k > 0, k - 1)))
    frame = _hold(frame, *keep, "words", maybe=F.transform(found, lambda k: F.get(s, k).bitwiseAND(F.lit(mask)).cast("int")))
    spelled = F.transform("maybe", lambda p: F.struct(F.concat_ws(" ", F.get(w, p), F.get(w, p + 1), F.get(w, p + 2)).alias("g"), p.alias("p")))
    frame = _hold(frame, *keep, spelled=F.sort_array(spelled))
    g = F.col("spelled")
    same = lambda k, j: F.coalesce(F.get(g, k)["g"] == F.get(g, j)["g"], F.lit(False))
    true = F.filter(indexes(F.size(g)), lambda k: same(k, k + 1) | same(k, F.when(k > 0, k - 1)))
    frame = _hold(frame, *keep, at=F.sort_array(F.transform(true, lambda k: F.get(g, k)["p"])))
    at = F.col("at")
    # Each window covers three words, less where the next one begins sooner.
    covered = F.transform(indexes(F.size(at)), lambda k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - F.get(at, k), F.lit(3))))
    return _hold(frame, *keep, n_repeat_words=F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x))


def measures(documents: DataFrame) -> DataFrame:
    """doc_id and what the base rule and the voting rules look at."""
    held = _hold(documents, "doc_id", text=text_of(), bare=F.btrim(text_of(), F.lit(SPACES)))
    words = F.when(F.col("bare") == "", F.array().cast("array<string>")).otherwise(F.split("bare", SPACE))
    held = _hold(held, "doc_id", "text", words=words)
    has_word = lambda line: line.rlike(WORD)
    held = _hold(
        held,
        "doc_id",
        "words",
        n_words=F.size("words").cast("long"),
        word_chars=F.length(F.array_join("words", "")).cast("long"),
        n_symbols=F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long"),
        n_plain=F.regexp_count("text", F.lit(PLAIN)).cast("long"),
        n_upper=F.regexp_count("text", F.lit(r"\p{Lu}")).cast("long"),
        lines=F.filter(F.split("text", "\n"), has_word),
    )
    kept = ["doc_id", "n_words", "word_chars", "n_symbols", "n_plain", "n_upper"]
    held = held.select(*kept, "words", F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"))
    return _repeat_words(held, [*kept, "n_lines", "n_dup_lines"])


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def with_votes(measured: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    return measured.withColumn("votes", F.array(*[F.coalesce(r.vote(), F.lit(0)).cast("int") for r in rules]))


@dataclass(frozen=True)
class Model:
    """Share of good documents, and per rule the chance of a good vote, given a vote, among good and bad ones."""

    prior: float
    good: tuple[float, ...]
    bad: tuple[float, ...]

    def posterior(self, votes: Column) -> Column:
        odds = F.log(F.lit(self.prior / (1 - self.prior)))
        for j, (g, b) in enumerate(zip(self.good, self.bad, strict=True)):
            vote = F.get(votes, F.lit(j))
            odds = odds + F.when(vote == 1, F.log(F.lit(g / b))).when(vote == -1, F.log(F.lit((1 - g) / (1 - b)))).otherwise(0.0)
        return 1 / (1 + F.exp(-odds))


def majority(votes: Column) -> Column:
    """The posterior that the first round starts from: high where three quarters of the votes are good."""
    count = lambda v: F.size(F.filter(votes, lambda x: x == v))
    return F.when(4 * count(1) >= 3 * (count(1) + count(-1)), 0.95).otherwise(0.05)


def fit(patterns: DataFrame, n_rules: int, rounds: int = ROUNDS) -> Model | None:
    """Expectation-maximisation over ``patterns`` (votes, n); None where there are none."""
    model = None
    for _ in range(rounds):
        p = majority(F.col("votes")) if model is None else model.posterior(F.col("votes"))
        weighed = patterns.select("votes", (p * F.col("n")).alias("g"), ((1 - p) * F.col("n")).alias("b"))
        sums = [F.sum("g"), F.sum("b")]
        for j in range(n_rules):
            vote = F.get("votes", F.lit(j))
            sums += [F.sum(F.when(vote == v, F.col(c)).otherwise(0.0)) for c in ("g", "b") for v in (1, -1)]
        got = weighed.agg(*sums).first()
        if got[0] is None:
            return None
        chance = lambda yes, no: (yes + SMOOTH) / (yes + no + 2 * SMOOTH)
        new = Model(
            chance(got[0], got[1]),
            tuple(chance(got[2 + 4 * j], got[3 + 4 * j]) for j in range(n_rules)),
            tuple(chance(got[4 + 4 * j], got[5 + 4 * j]) for j in range(n_rules)),
        )
        if new == model:
            break
        model = new
    return model


def judged(documents: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Measures, base_failed, votes, posterior and kept for every document."""
    measured = written(with_votes(measures(documents), rules).withColumn("base_failed", base_failed()), "quality")
    patterns = written(measured.where(~F.col("base_failed")).groupBy("votes").agg(F.count(F.lit(1)).alias("n")), "quality-votes")
    model = fit(patterns, len(rules))
    posterior = model.posterior(F.col("votes")) if model else F.lit(0.0)
    return measured.withColumn("posterior", posterior).withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= 0.5))
