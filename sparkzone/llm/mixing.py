"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

A source's rows fall into blocks by hash. The mix draws each source's blocks in permuted
order, once per whole repeat and then as far as the target goes; the block in which it ends
is drawn in part, and so is the row in which it ends. How many of each source's draws a
shard gets comes from a tree: a node halves its draws, and the share of each source in the
left half is multivariate hypergeometric, drawn source by source. A leaf therefore holds
an exact count per source and a range of that source's draw order, disjoint from all others.
Rows are put in a random order within their shard only.

Sources (code points, null last) weigh 1, 2, 3, repeating. A target stops at ``MAX_REPEATS``
times the source's size; what is over goes to the others by weight.

Only source and block tables are ever ordered. A source has ``MAX_BLOCKS`` blocks at most,
so that its largest order is bounded while blocks grow with the data; a source that holds a
third of all rows is spread over its blocks. The tree is as wide as there are sources: one
row per node with a list of quotas.

Cases: null text has size 0; sources of size 0 have target 0; null source is a source; rows
of size 0 are taken 0 times; repeated rows are drawn separately; no rows in give no rows out.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, WORD, free_name, text_of, written

BLOCK_WORDS = 4096
MAX_BLOCKS = 65_536
MAX_REPEATS = 3
# Shards at least, and words of a shard from which there are more.
SHARDS, SHARD_WORDS = 64, 1 << 24
SEED = "mix-1"
# Tables up to so many rows (about 60 bytes each) are sent to every task; larger ones are joined by shuffle.
SENT_ROWS = 100_000


def hashed(*parts: Column, at: int = 1) -> Column:
    """60 bits of the md5 of the parts, as other engines compute them too."""
    texts = [F.coalesce(p.cast("string"), F.lit("null")) for p in parts]
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(SEED), *texts)), at, 15), 16, 10).cast("long")


def sized(documents: DataFrame) -> DataFrame:
    return documents.withColumn("size", F.regexp_count(text_of(), F.lit(WORD)).cast("long"))


def source_targets(rows: DataFrame) -> DataFrame:
    """source, rank, source_size, weight, target, want (whole words), repeats, rest, blocks."""
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    s = rows.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("rank", F.row_number().over(by_name).cast("long"))
    s = s.withColumn("weight", ((F.col("rank") - 1) % 3 + 1).cast("double")).withColumn("cap", F.lit(float(MAX_REPEATS)) * F.col("source_size"))
    # Sources reach their cap in the order of cap over weight. The level rises with each that
    # does and falls from the first that does not, so the highest is the right one.
    order = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    s = s.withColumn("total", F.sum("source_size").over(everything).cast("double"))
    s = s.withColumn("capped", F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    s = s.withColumn("open_weight", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
    s = s.withColumn("level", (F.col("total") - F.col("capped")) / F.col("open_weight"))
    target = F.least(F.col("cap"), F.max("level").over(everything) * F.col("weight"))
    want = F.floor(F.col("target") + 0.5)
    s = s.withColumn("target", target).withColumn("want", want)
    repeats = F.when(F.col("source_size") > 0, F.floor(F.col("want") / F.greatest(F.col("source_size"), F.lit(1)))).otherwise(F.lit(0))
    blocks = F.least(F.lit(MAX_BLOCKS), F.greatest(F.lit(1), F.ceil(F.col("source_size") / BLOCK_WORDS))).cast("long")
    return s.withColumn("repeats", repeats).withColumn("rest", F.col("want") - F.col("repeats") * F.col("source_size")).withColumn("blocks", blocks).select(
        "source", "rank", "source_size", "weight", "target", "want", "repeats", "rest", "blocks"
    )


def _sent(frame: DataFrame) -> DataFrame:
    """Hint a broadcast only for a table whose rows were counted."""
    return F.broadcast(frame) if frame.limit(SENT_ROWS + 1).count() <= SENT_ROWS else frame


def located(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows with their source's figures, block, and hash order within the block."""
    named = _sent(sources.withColumnRenamed("source", "source_name"))
    out = rows.join(named, rows.source.eqNullSafe(named.source_name)).drop("source_name")
    key = (F.col("doc_id"), F.col("rank"), F.col("size"))
    return out.withColumn("block", hashed(*key) % F.col("blocks")).withColumn("order", hashed(*key, at=16))


def block_draws(placed: DataFrame) -> DataFrame:
    """rank, block, repeat, draw (from 0 per source), words, drawn (words taken of it)."""
    blocks = placed.groupBy("rank", "block").agg(F.sum("size").alias("words"), F.first("repeats").alias("repeats"), F.first("rest").alias("rest"))
    each = blocks.withColumn("repeat", F.explode(F.sequence(F.lit(0).cast("long"), F.col("repeats"))))
    order = Window.partitionBy("rank", "repeat").orderBy(hashed(F.lit("block"), F.col("rank"), F.col("repeat"), F.col("block")), "block")
    each = each.withColumn("nth", F.row_number().over(order)).withColumn("upto", F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    each = each.withColumn("all_blocks", F.count(F.lit(1)).over(Window.partitionBy("rank", "repeat")))
    before = F.col("upto") - F.col("words")
    each = each.withColumn("drawn", F.when(F.col("repeat") < F.col("repeats"), F.col("words")).otherwise(F.greatest(F.lit(0), F.least(F.col("words"), F.col("rest") - before))))
    return each.where("drawn > 0").select("rank", "block", "repeat", (F.col("repeat") * F.col("all_blocks") + F.col("nth") - 1).alias("nth"), "words", "drawn").withColumn(
        "draw", F.row_number().over(Window.partitionBy("rank").orderBy("nth")).cast("long") - 1
    ).drop("nth")


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, which also keeps the expression small."""
    return F.transform(F.array(value), use)[0]


def _log_factorial(k: Column) -> Column:
    """Stirling's series, shifted by seven so that it holds from zero on."""
    product = lambda k: (k + 1.0) * (k + 2.0) * (k + 3.0) * (k + 4.0) * (k + 5.0) * (k + 6.0) * (k + 7.0)
    series = lambda y: (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y * y * y)
    return _bound(k, lambda k: series(k + 8.0) - F.log(product(k)))


def hypergeometric(u: Column, population: Column, marked: Column, drawn: Column) -> Column:
    """The ``u`` quantile of the count of marked among drawn, within 9 standard deviations of its mean."""

    def quantile(p: Column) -> Column:
        n, k, d, low, high = (p[name] for name in ("n", "k", "d", "low", "high"))
        weight = lambda x: -_log_factorial(x) - _log_factorial(k - x) - _log_factorial(d - x) - _log_factorial(n - k - d + x)
        logs = F.transform(F.sequence(low, high), lambda x: weight(x.cast("double")))
        odds = lambda ws: _bound(F.array_max(ws), lambda top: F.transform(ws, lambda w: F.exp(w - top)))
        total = lambda ps: F.aggregate(ps, F.lit(0.0), lambda a, x: a + x)
        # How many of the running sums stay at or below the wanted share.
        passed = lambda ps, goal: F.aggregate(
            ps,
            F.struct(F.lit(0.0).alias("sum"), F.lit(0).cast("long").alias("n")),
            lambda a, x: F.struct((a["sum"] + x).alias("sum"), (a["n"] + F.when(a["sum"] + x <= goal, 1).otherwise(0)).alias("n")),
        )["n"]
        return F.least(high, low + _bound(odds(logs), lambda ps: passed(ps, u * total(ps))))

    def bounds(p: Column) -> Column:
        n, k, d = (p[name] for name in ("n", "k", "d"))
        wide = lambda mean: F.sqrt(F.greatest(F.lit(0.0), mean * (1 - k / F.greatest(n, F.lit(1.0))))) * 9 + 3
        ends = lambda mean: F.struct(
            n.alias("n"),
            k.alias("k"),
            d.alias("d"),
            F.greatest(F.lit(0.0), d - (n - k), F.floor(mean - wide(mean)).cast("double")).cast("long").alias("low"),
            F.least(k, d, F.ceil(mean + wide(mean)).cast("double")).cast("long").alias("high"),
        )
        return _bound(d * k / F.greatest(n, F.lit(1.0)), ends)

    given = F.struct(population.cast("double").alias("n"), marked.cast("double").alias("k"), drawn.cast("double").alias("d"))
    return _bound(_bound(given, bounds), quantile)


def split_quotas(draws: DataFrame, shards: int, seed: str = SEED) -> DataFrame:
    """rank, shard, start, quota: the range of a source's draws that each shard gets."""
    levels = (shards - 1).bit_length()
    if shards != 1 << levels:
        raise ValueError("shards must be a power of two")
    counts = draws.groupBy("rank").agg(F.count(F.lit(1)).alias("quota"))
    listed = F.array_sort(F.collect_list(F.struct("rank", "quota")))
    nodes = counts.agg(listed.alias("q")).select(
        F.lit(0).cast("long").alias("node"),
        F.transform("q", lambda s: s["rank"]).alias("ranks"),
        F.transform("q", lambda s: s["quota"]).alias("quotas"),
        F.transform("q", lambda s: F.lit(0).cast("long")).alias("starts"),
    )
    for level in range(levels):
        total = F.aggregate("quotas", F.lit(0).cast("long"), lambda a, q: a + q)
        nodes = nodes.withColumn("total", total).withColumn("level", F.lit(level))
        start = F.struct(F.col("total").alias("people"), F.floor(F.col("total") / 2).alias("room"), F.array().cast("array<bigint>").alias("left"))

        def step(a: Column, q: Column) -> Column:
            u = hashed(F.lit(seed), F.col("level"), F.col("node"), F.size(a["left"])) / float(1 << 60)
            took = hypergeometric(u, a["people"], q, a["room"])
            return F.transform(
                F.array(took), lambda x: F.struct((a["people"] - q).alias("people"), (a["room"] - x).alias("room"), F.concat(a["left"], F.array(x)).alias("left"))
            )[0]

        nodes = nodes.withColumn("left", F.aggregate("quotas", start, step, lambda a: a["left"]))
        halves = F.array(
            F.struct((F.col("node") * 2).alias("node"), F.col("left").alias("quotas"), F.col("starts").alias("starts")),
            F.struct(
                (F.col("node") * 2 + 1).alias("node"),
                F.zip_with("quotas", "left", lambda q, x: q - x).alias("quotas"),
                F.zip_with("starts", "left", lambda s, x: s + x).alias("starts"),
            ),
        )
        nodes = nodes.select("ranks", F.inline(halves))
    return nodes.select(F.col("node").alias("shard"), F.explode(F.arrays_zip("ranks", "quotas", "starts")).alias("s")).select(
        F.col("s.ranks").alias("rank"), "shard", F.col("s.starts").alias("start"), F.col("s.quotas").alias("quota")
    )


def mix(rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The drawn rows: all columns of ``rows`` (which need doc_id, source, size), and rank,
    source_size, target, repeat, shard, position (sort key within the shard), words taken."""
    sources = written(source_targets(rows), "mix-sources")
    placed = located(rows, sources)
    draws = written(block_draws(placed), "mix-draws")
    quotas = split_quotas(draws, shards).where("quota > 0")
    dealt = quotas.select("rank", "shard", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("quota") - 1)).alias("draw"))
    dealt = written(draws.join(dealt, ["rank", "draw"]), "mix-dealt")
    taken = placed.join(_sent(dealt.drop("draw")), ["rank", "block"])
    whole = taken.where(F.col("drawn") == F.col("words")).withColumn("taken", F.col("size"))
    # One block per source at most is drawn in part: its rows in hash order, as far as it goes.
    inside = Window.partitionBy("rank", "block", "repeat").orderBy("order", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    part = taken.where(F.col("drawn") < F.col("words")).withColumn("upto", F.sum("size").over(inside))
    part = part.withColumn("taken", F.greatest(F.lit(0), F.least(F.col("size"), F.col("drawn") - F.col("upto") + F.col("size")))).drop("upto")
    out = whole.unionByName(part).where("taken > 0")
    out = out.withColumn("position", hashed(F.lit("place"), F.col("shard"), F.col("repeat"), F.col("doc_id")))
    return out.drop("weight", "want", "repeats", "rest", "blocks", "block", "order", "words", "drawn")


def taken_per_row(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, source_size, target, taken, draws for every row."""
    narrow = sized(documents.select("doc_id", "source", "text")).select(F.monotonically_increasing_id().alias("row"), "doc_id", "source", "size")
    rows = written(narrow, "mix-rows")
    drawn = mix(rows, shards).groupBy("row").agg(F.sum("taken").alias("taken"), F.count(F.lit(1)).alias("draws"))
    sources = _sent(source_targets(rows).select(F.col("source").alias("source_name"), "source_size", "target"))
    out = rows.join(drawn, "row", "left").join(sources, rows.source.eqNullSafe(sources.source_name))
    zero = F.lit(0).cast("long")
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", zero).alias("taken"), F.coalesce("draws", zero).alias("draws"))


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word; it must have more words than that."""
    start = F.ltrim(text, F.lit(" \t\n\x0b\x0c\r"))
    rest = F.get(F.split(start, SPACE, (n + 1).cast("int")), n.cast("int"))
    return F.rtrim(F.substring(start, F.lit(1), F.length(start) - F.length(rest)), F.lit(" \t\n\x0b\x0c\r"))


def shards_for(words: int) -> int:
    """A power of two that keeps shards of ``SHARD_WORDS`` words at most, and is at least ``SHARDS``."""
    return max(SHARDS, 1 << max(0, (int(words) - 1) // SHARD_WORDS).bit_length())


def mixed_documents(documents: DataFrame, shards: int | None = None) -> DataFrame:
    """The mix as documents with all their columns: a row per draw, in shard and random order; the row in
    which a source's target ends keeps its first words only. Shards follow the words unless given;
    columns ``shard`` and ``position`` are added, as ``_shard`` and so on where documents have such ones."""
    own = sized(documents.select("doc_id", "source", "text", F.struct(*(F.col(f"`{c}`") for c in documents.columns if c != "text")).alias("others")))
    if shards is None:
        shards = shards_for(own.agg(F.sum("size")).first()[0] or 0)
    out = mix(own, shards)
    is_cut = F.col("taken") < F.col("size")
    out = out.withColumn("text", F.when(is_cut, first_words(F.col("text"), F.col("taken"))).otherwise(F.col("text")))

    def column(name: str) -> Column:
        if name == "text":
            return F.col("text")
        if name == "n_chars":
            return F.when(is_cut, F.length("text").cast("long")).otherwise(F.col("others.n_chars")).alias(name)
        return F.col(f"others.`{name}`").alias(name)

    added = [F.col(c).alias(free_name(documents.columns, c)) for c in ("shard", "position")]
    dealt = out.repartition(shards, "shard").sortWithinPartitions("shard", "position")
    return dealt.select(*map(column, documents.columns), *added)
