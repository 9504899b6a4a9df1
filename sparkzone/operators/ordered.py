"""Ordered computations that survive a group holding a third of all rows.

A Spark window sends each of its groups to one task. The functions here deal the rows to
ranges of (group, order, digest) instead, so that any group, and any run of equal or missing
values within it, is cut as often as its rows ask for; ``ranges``, by default the session's
shuffle partitions, says how many there are. The ranges are written once, as later steps have to see the same
cuts. Windows then run within a group's part of a range, and what crosses a border, the last
rows or a count, comes from the few groups that do. There is one plan for every size and for
every type that can be ordered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.keys import fingerprint
from ..sharedfs import cut_lineage
from .joins import null_safe_join
from .rows import top_per_key


def _ranged(df: DataFrame, ranges: int | None, keys: Sequence[str], *order: Column) -> DataFrame:
    """Adds ``__chunk``: the number of the row's range, ascending with (keys, order)."""
    by = [*[F.col(k).asc_nulls_first() for k in keys], *order]
    ranged = df.repartitionByRange(ranges, *by) if ranges else df.repartitionByRange(*by)
    return cut_lineage(ranged.withColumn("__chunk", F.spark_partition_id()), "ranges")


def _spanning(work: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Groups that a border cuts: the last one of a range, where the next range begins with it."""
    group = F.struct(*keys)
    ends = work.groupBy("__chunk").agg(F.min(group).alias("low"), F.max(group).alias("high"))
    # One row per range.
    following = F.lead("low").over(Window.orderBy("__chunk"))
    return ends.withColumn("next", following).filter(F.col("next").isNotNull() & F.col("high").eqNullSafe(F.col("next"))).select("high.*").distinct()


def partition_average(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Average of a value over its group, on every row."""
    means = df.groupBy(*keys).agg(F.avg(value).alias(out))
    return null_safe_join(df, means, keys)


def rolling_average(
    df: DataFrame, keys: Sequence[str], order: str, value: str, out: str, rows: int = 5, tie: Column | None = None, ranges: int | None = None
) -> DataFrame:
    """Average of the current and the ``rows - 1`` preceding rows of the group.

    Rows with equal ``order`` are ordered by a fingerprint, which ``tie`` may replace.
    """
    before = rows - 1
    tied = df.withColumn("__tie", fingerprint(*df.columns) if tie is None else tie)
    work = _ranged(tied, ranges, keys, F.col(order).asc_nulls_first(), F.col("__tie"))
    needed = list(dict.fromkeys([*keys, order, value]))
    cut = null_safe_join(work.select(*needed, "__tie", "__chunk"), _spanning(work, keys), keys, "left_semi")
    backwards = [F.col(order).desc_nulls_last(), F.col("__tie").desc()]
    tails = top_per_key(cut, [*keys, "__chunk"], backwards, before, "__r")
    # A few rows per range of a cut group.
    placed = tails.withColumn("__pos", F.row_number().over(Window.partitionBy(*keys).orderBy("__chunk", F.col("__r").desc())))
    starts = placed.groupBy(*keys, "__chunk").agg(F.min("__pos").alias("__first"))
    wanted = starts.filter("__first > 1").select(
        *keys,
        F.col("__chunk").alias("__into"),
        F.explode(F.sequence(F.greatest(F.lit(1), F.col("__first") - before), F.col("__first") - 1)).alias("__pos"),
    )
    carried = null_safe_join(wanted, placed.drop("__chunk", "__r"), [*keys, "__pos"], "inner")
    carried = carried.select(*needed, "__tie", F.col("__into").alias("__chunk"), F.lit(True).alias("__carried"))
    both = work.withColumn("__carried", F.lit(False)).unionByName(carried, allowMissingColumns=True)
    window = Window.partitionBy(*keys, "__chunk").orderBy(order, "__tie").rowsBetween(-before, 0)
    averaged = both.withColumn(out, F.avg(value).over(window))
    return averaged.filter(~F.col("__carried")).select(*df.columns, out)


def rank_in_group(df: DataFrame, keys: Sequence[str], by: str, out: str, ranges: int | None = None) -> DataFrame:
    """SQL ``rank()`` by descending value within each group."""
    descending = F.col(by).desc_nulls_last()
    # The digest splits runs of one value.
    work = _ranged(df, ranges, keys, descending, F.xxhash64(*df.columns))
    ranked = work.withColumn("__inner", F.rank().over(Window.partitionBy(*keys, "__chunk").orderBy(descending)))
    parts = null_safe_join(work.select(*keys, by, "__chunk"), _spanning(work, keys), keys, "left_semi")
    sums = parts.groupBy(*keys, "__chunk").agg(
        F.count("*").alias("__n"), F.max(by).alias("__high"), F.min(by).alias("__low"), F.count_if(F.col(by).isNull()).alias("__nulls")
    )
    ahead = Window.partitionBy(*keys).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = cut_lineage(sums.withColumn("__ahead", F.coalesce(F.sum("__n").over(ahead), F.lit(0))), "ranges-sums")
    # A value at a border can lie in several ranges; its rank is the one of the first of them.
    leading = sums.select(*keys, F.col("__high").alias(by), (F.col("__ahead") + 1).alias("__rank"))
    valued = null_safe_join(parts, sums.select(*keys, "__chunk", "__ahead", "__low", "__nulls"), [*keys, "__chunk"], "inner")
    last = F.when(F.col("__nulls") == 0, F.col("__low"))
    counted = valued.groupBy(*keys, "__chunk").agg(
        F.first(last).alias(by), (F.first("__ahead") + F.count_if(~F.col(by).eqNullSafe(last)) + 1).alias("__rank")
    )
    firsts = leading.unionByName(counted.drop("__chunk")).groupBy(*keys, by).agg(F.min("__rank").alias("__rank"))
    joined = null_safe_join(ranked, sums.select(*keys, "__chunk", "__ahead"), [*keys, "__chunk"])
    joined = null_safe_join(joined, firsts, [*keys, by])
    own = F.coalesce("__ahead", F.lit(0)) + F.col("__inner")
    return joined.withColumn(out, F.least(own, F.coalesce("__rank", own)).cast("int")).select(*df.columns, out)


def stratified_split(
    df: DataFrame, label: str, key: str, test: float = 0.2, seed: int = 2026
) -> tuple[DataFrame, DataFrame]:
    """(train, test): exactly ``ceil(test * n)`` rows of each label go to test, repeatably.

    Rows are ordered by a seeded digest. Counts per digest prefix find the prefix in which a
    label's quota ends, and counts below it the longer prefix; of a label's rows about one in
    16 million are left to rank, and no order is longer than 4,096 prefixes.
    What a step finds, a row per label, is written: its size is known then, so that rows meet it
    where they are, instead of being exchanged by label, which would leave a task per label.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    marked = df.withColumn("__digest", digest)
    totals = cut_lineage(marked.groupBy(label).agg(F.ceil(F.count("*") * F.lit(test)).alias("__take")), "split-totals")
    edge = null_safe_join(marked.select(label, "__digest"), totals, [label])
    for digits in (3, 6):
        edge = edge.withColumn("__prefix", F.substring("__digest", 1, digits))
        counts = edge.groupBy(label, "__prefix").agg(F.count("*").alias("__n"), F.first("__take").alias("__take"))
        running = Window.partitionBy(label).orderBy("__prefix").rowsBetween(Window.unboundedPreceding, 0)
        ends = counts.withColumn("__upto", F.sum("__n").over(running)).filter("__upto >= __take and __upto - __n < __take")
        cut = cut_lineage(ends.select(label, "__prefix", (F.col("__take") - F.col("__upto") + F.col("__n")).alias("__take")), "split-cut")
        edge = null_safe_join(edge.drop("__take"), cut, [label, "__prefix"], "inner").drop("__prefix")
    ranked = edge.withColumn("__r", F.row_number().over(Window.partitionBy(label).orderBy("__digest")))
    limits = cut_lineage(ranked.filter("__r = __take").select(label, F.col("__digest").alias("__last")), "split-limits")
    joined = null_safe_join(marked, limits, [label])
    in_test = F.coalesce(F.col("__digest") <= F.col("__last"), F.lit(False))
    return joined.filter(~in_test).select(*df.columns), joined.filter(in_test).select(*df.columns)
