from __future__ import annotations

import random

import pytest
from pyspark.sql import Window, functions as F

from sparkzone.functions.keys import fingerprint
from sparkzone.operators.ordered import _ranged, partition_average, rank_in_group, rolling_average, stratified_split


@pytest.fixture(scope="module")
def skewed(spark):
    """One group with most rows, heavy ties, missing orders and missing keys."""
    rng = random.Random(7)
    data = []
    for i in range(3000):
        group = "hot" if rng.random() < 0.7 else rng.choice(["a", "b", None])
        order = None if rng.random() < 0.05 else (2000 if rng.random() < 0.4 else rng.randint(1990, 2020))
        data.append((i, group, order, None if rng.random() < 0.1 else float(rng.randint(0, 50))))
    return spark.createDataFrame(data, "id INT, grp STRING, year INT, v DOUBLE").cache()


def as_set(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


@pytest.mark.parametrize("rows", [2, 5])
def test_rolling_average_in_chunks_equals_the_window(skewed, rows):
    window = Window.partitionBy("grp").orderBy("year", fingerprint("id")).rowsBetween(-(rows - 1), 0)
    expected = skewed.withColumn("r", F.round(F.avg("v").over(window), 9))
    chunked = rolling_average(skewed, ["grp"], "year", "v", "r", rows, fingerprint("id"), ranges=40)
    assert as_set(chunked.withColumn("r", F.round("r", 9))) == as_set(expected)


def test_rank_in_chunks_equals_the_window(skewed):
    expected = skewed.withColumn("k", F.rank().over(Window.partitionBy("grp").orderBy(F.col("v").desc_nulls_last())))
    assert as_set(rank_in_group(skewed, ["grp"], "v", "k", ranges=40)) == as_set(expected)
    assert as_set(rank_in_group(skewed, ["grp"], "v", "k")) == as_set(expected)


@pytest.mark.parametrize("column", ["CAST(v AS STRING)", "CAST(NULL AS STRING)", "IF(grp = 'hot', NULL, year)", "1"])
def test_rank_of_any_type_and_of_missing_values(skewed, column):
    df = skewed.withColumn("x", F.expr(column))
    expected = df.withColumn("k", F.rank().over(Window.partitionBy("grp").orderBy(F.col("x").desc_nulls_last())))
    assert as_set(rank_in_group(df, ["grp"], "x", "k", ranges=40)) == as_set(expected)


def test_partition_average_joins_null_groups(skewed):
    window = skewed.withColumn("m", F.round(F.avg("v").over(Window.partitionBy("grp")), 9))
    assert as_set(partition_average(skewed, ["grp"], "v", "m").withColumn("m", F.round("m", 9))) == as_set(window)


def test_a_hot_group_and_value_are_cut(spark):
    # A third of the rows in one group, all with one order value: no range holds many of them.
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("g"), F.lit(1).alias("o"), "id")
    work = _ranged(df, 30, ["g"], F.col("o").asc_nulls_first(), F.md5(F.col("id").cast("string")))
    largest = work.filter("g = 'hot'").groupBy("__chunk").count().agg(F.max("count")).first()[0]
    assert largest <= 2 * 30_000 / 30


def test_split_leaves_rows_where_they_are(spark):
    # Two labels: an exchange by label would bring the rows of eight tasks to two.
    df = spark.range(0, 4_000, 1, 8).select("id", F.when(F.col("id") % 10 == 0, "rare").otherwise("usual").alias("grp"))
    for part in stratified_split(df, "grp", "id"):
        assert part.select(F.spark_partition_id()).distinct().count() == 8


def test_split_is_exact_and_repeatable(spark, skewed):
    train, test = stratified_split(skewed, "grp", "id")
    assert train.count() + test.count() == 3000
    sizes = {r["grp"]: r["n"] for r in skewed.groupBy("grp").agg(F.count("*").alias("n")).collect()}
    for label, n in ((r["grp"], r["n"]) for r in test.groupBy("grp").agg(F.count("*").alias("n")).collect()):
        assert n == -(-sizes[label] // 5)
    again = stratified_split(skewed.repartition(7), "grp", "id")[1]
    assert as_set(again.select("id")) == as_set(test.select("id"))
