"""Files by ranges, bucketed pairs and catalogue statistics."""

from __future__ import annotations

import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sparkzone.operators.gates import GateError
from sparkzone.sources import layout, statistics, tables

from .conftest import rows


def plan(frame):
    return frame.sparkSession.sparkContext._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "formatted")


def named(label):
    return f"{label}_{uuid.uuid4().hex}"


def test_files_hold_ranges_even_of_one_value(spark, tmp_path):
    path = str(tmp_path / "t")
    # Two thirds have one value; a column has the name the layout would use.
    made = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.col("id")).when(F.col("id") == 1, F.lit(None)).otherwise(700).alias("k"), F.lit("x").alias("__place"))
    layout.write_ranges(made, path, ["k"], 200)
    stored = spark.read.parquet(path)
    assert Counter(rows(stored)) == Counter(rows(made))
    files = sorted((r["least"], r["greatest"], r["rows"], r["nulls"]) for r in layout.file_ranges(stored, "k").collect())
    assert sum(f[2] for f in files) == 3000 and sum(f[3] for f in files) == 1
    assert len(files) >= 10 and max(f[2] for f in files) < 600
    assert all(a[1] <= b[0] for a, b in zip(files, files[1:]))
    found = layout.files_within(layout.file_ranges(stored, "k"), F.lit(2000), F.lit(2300)).first()
    assert 1 <= found["met"] < found["files"] / 2 and found["partly"] <= 2
    assert "PushedFilters: [IsNotNull(k), GreaterThanOrEqual(k,2000)]" in plan(stored.where("k >= 2000"))


def test_a_table_without_rows_has_a_layout(spark, tmp_path):
    path = str(tmp_path / "t")
    layout.write_ranges(spark.createDataFrame([], "k BIGINT, v STRING"), path, ["k"])
    assert spark.read.parquet(path).columns == ["k", "v"] and spark.read.parquet(path).count() == 0


def pair_of(spark, **options):
    """A key with two thirds of all rows, keys without a partner, nulls, a repeated key of the dimension."""
    i = F.col("id")
    key = F.when(i % 3 > 0, F.lit(7)).when(i % 5 == 0, F.lit(None)).otherwise(i % 20).cast("long")
    fact = spark.range(3000).select(key.alias("k"), i.alias("v"), F.lit("fact").alias("__piece"))
    dimension = spark.createDataFrame([(7, "seven"), (7, "again"), (3, "three"), (None, "none"), (99, "unused")], "k BIGINT, name STRING")
    return fact, dimension, layout.store_pair(fact, dimension, ["k"], named("pair"), **options)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_a_bucketed_join_is_the_plain_one(spark, how):
    fact, dimension, pair = pair_of(spark, rows_per_bucket=250)
    assert Counter(rows(pair.join(spark, how))) == Counter(rows(fact.join(dimension, "k", how)))


def test_a_bucketed_join_moves_nothing_and_splits_its_hot_key(spark):
    _, _, pair = pair_of(spark, rows_per_bucket=250)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(pair.join(spark))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in text and "Exchange" not in text
    hot = spark.table(pair.fact).where("k = 7")
    cut, pieces = -(-hot.count() // 250), hot.groupBy(pair.piece).count()
    assert cut > 8 and pieces.count() == cut and pieces.agg(F.max("count")).first()[0] < 400
    assert spark.table(pair.dimension).where("k = 7").count() == 2 * cut
    assert spark.table(pair.fact).where("k is null").select(pair.piece).distinct().count() > 4
    with pytest.raises(ValueError):
        pair.join(spark, "full")


def test_a_pair_may_be_empty_but_not_of_two_types(spark):
    none = spark.createDataFrame([], "k BIGINT, v STRING")
    pair = layout.store_pair(none, spark.createDataFrame([], "k BIGINT, name STRING"), ["k"], named("none"))
    assert pair.buckets == 1 and pair.join(spark, "left").count() == 0
    with pytest.raises(GateError):
        layout.store_pair(none, spark.createDataFrame([("1",)], "k STRING"), ["k"], named("types"))


def test_the_catalogue_knows_a_table_made_from_a_query(spark, tmp_path):
    name = named("made")
    made = spark.range(1000).select("id", F.array("id").alias("list"), F.when(F.col("id") > 9, F.col("id").cast("string")).alias("odd `name"))
    tables.create_table_as(made, name, {"source_system": F.lit("test")}, path=str(tmp_path / "t"))
    assert {r["rows"] for r in statistics.statistics(spark, name).collect()} == {None}
    statistics.analyze(spark, name)
    found = {r["column"]: r for r in statistics.statistics(spark, name).collect()}
    assert list(found) == ["id", "list", "odd `name", "source_system"] and {r["rows"] for r in found.values()} == {1000}
    assert (found["id"]["least"], found["id"]["greatest"], found["id"]["nulls"]) == ("0", "999", 0) and abs(found["id"]["distinct_about"] - 1000) < 150
    assert found["odd `name"]["nulls"] == 10 and found["list"]["nulls"] is None and found["source_system"]["distinct_about"] == 1
    # Replaced by another run: what was known of the old rows is gone.
    tables.create_table_as(made.limit(5), name, {}, path=str(tmp_path / "t"))
    statistics.analyze(spark, name)
    assert {r["rows"] for r in statistics.statistics(spark, name).collect()} == {5}
