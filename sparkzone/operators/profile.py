"""Data profiles and classification metrics, each in one or two aggregations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.keys import fingerprint
from ..sharedfs import cut_lineage


def overview(df: DataFrame, text: str) -> DataFrame:
    """Rows, duplicate rows, blank and very short texts."""
    body = F.coalesce(F.col(text), F.lit(""))
    flagged = df.select(
        fingerprint(*df.columns).alias("row"), (F.trim(body) == "").alias("blank"), (F.char_length(body) < 5).alias("short")
    )
    # Copies collapse before the exchange, which count(distinct) over all columns would not allow.
    per_row = flagged.groupBy("row", "blank", "short").agg(F.count("*").alias("n"))
    return per_row.agg(
        F.sum("n").alias("row_count"),
        (F.sum("n") - F.count("*")).alias("duplicate_rows"),
        F.coalesce(F.sum(F.when(F.col("blank"), F.col("n"))), F.lit(0)).alias("blank_texts"),
        F.coalesce(F.sum(F.when(F.col("short"), F.col("n"))), F.lit(0)).alias("short_texts"),
    )


def missing_share(df: DataFrame) -> DataFrame:
    """Percentage of missing values per column, one row each."""
    shares = F.array(
        *[F.struct(F.lit(c).alias("column"), F.avg(F.col(c).isNull().cast("double") * 100).alias("missing_pct")) for c in df.columns]
    )
    return df.agg(shares.alias("a")).select(F.explode("a").alias("s")).select("s.*")


def label_share(df: DataFrame, label: str) -> DataFrame:
    """Rows and percentage per label; the total is taken over the label counts."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("pct", F.col("n") * 100.0 / total)


def exact_quantiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """column, share, value: quantiles with linear interpolation, exact at any size.

    Values are counted, the counts dealt to ranges of (column, value), and only a range's sums
    are added up across ranges; of the values, those at the wanted positions are kept.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    counts = df.select(F.explode(pairs).alias("p")).select("p.*").where("value is not null").groupBy("column", "value").agg(F.count("*").alias("n"))
    ranged = counts.repartitionByRange("column", "value").withColumn("range", F.spark_partition_id())
    ranged = cut_lineage(ranged, "quantiles")
    sums = ranged.groupBy("column", "range").agg(F.sum("n").alias("n"))
    earlier = Window.partitionBy("column").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("column", "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"), F.sum("n").over(Window.partitionBy("column")).alias("all"))
    inside = Window.partitionBy("column", "range").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    placed = ranged.withColumn("upto", F.sum("n").over(inside)).join(sums, ["column", "range"])
    last = F.col("before") + F.col("upto") - 1
    wanted = F.array(*[F.struct(F.lit(float(q)).alias("share"), (F.lit(float(q)) * (F.col("all") - 1)).alias("at")) for q in shares])
    near = placed.select("column", "value", (last - F.col("n") + 1).alias("first"), last.alias("last"), F.explode(wanted).alias("w")).select("*", "w.*")
    low, high = F.floor("at"), F.ceil("at")
    holds = lambda at: (F.col("first") <= at) & (at <= F.col("last"))
    part = F.col("at") - low
    weight = F.when(holds(low), 1 - part).otherwise(0.0) + F.when(holds(high), part).otherwise(0.0)
    return near.where(holds(low) | holds(high)).groupBy("column", "share").agg(F.sum(weight * F.col("value")).alias("value"))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles per numeric column."""

    def stats(c: str):
        v = F.col(c).cast("double")
        return F.struct(
            F.lit(c).alias("column"), F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max")
        )

    plain = df.agg(F.array(*[stats(c) for c in columns]).alias("a")).select(F.explode("a").alias("s")).select("s.*")
    found = exact_quantiles(df, columns, (0.25, 0.5, 0.75)).groupBy("column").agg(F.array_sort(F.collect_list(F.struct("share", "value"))).alias("q"))
    return plain.join(found, "column", "left").withColumn("quartiles", F.transform("q", lambda x: x["value"])).drop("q")


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per value of each listed column."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select(F.explode(pairs).alias("p")).groupBy("p.column", "p.value").agg(F.count("*").alias("n"))


def classification_metrics(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Accuracy and weighted precision, recall and F1 from the confusion counts.

    Only (label, prediction) counts leave the scan; the windows run over those.
    A class nobody predicts has precision 0.
    """
    confusion = df.groupBy(F.col(truth).alias("t"), F.col(predicted).alias("p")).agg(F.count("*").alias("n"))
    tagged = (
        confusion.withColumn("support", F.sum("n").over(Window.partitionBy("t")))
        .withColumn("predicted", F.sum("n").over(Window.partitionBy("p")))
        .groupBy("t")
        .agg(
            F.max("support").alias("support"),
            F.coalesce(F.sum(F.when(F.col("t") == F.col("p"), F.col("n"))), F.lit(0)).alias("hit"),
            F.max(F.when(F.col("t") == F.col("p"), F.col("predicted"))).alias("predicted"),
        )
    )
    recall = F.col("hit") / F.col("support")
    precision = F.coalesce(F.try_divide(F.col("hit"), F.col("predicted")), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0))
    per_class = tagged.withColumns({"recall": recall, "precision": precision}).withColumn("f1", f1)
    total = F.sum("support")
    weighted = lambda c: F.sum(F.col(c) * F.col("support")) / total
    return per_class.agg(
        total.alias("row_count"),
        (F.sum("hit") / total).alias("accuracy"),
        weighted("precision").alias("precision"),
        weighted("recall").alias("recall"),
        weighted("f1").alias("f1"),
    )
