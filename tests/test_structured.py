from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from sparkzone.functions.keys import fingerprint, surrogate_key
from sparkzone.functions.numbers import ratio
from sparkzone.operators.gates import GateError
from sparkzone.operators.rows import keep_first, later_copies
from sparkzone.plans import star
from sparkzone.plans.rules import CLIMATE, TEMPERATURES, TWEETS, VEHICLES, TableRules
from sparkzone.plans.structured import clean_structured

from .conftest import rows

DATE = "2026-05-24T10:00:00Z"


def vehicles(spark, *records):
    return spark.createDataFrame(list(records), "`Make` STRING, `Model` STRING, `Vehicle Class` STRING, `Cylinders` STRING, `Engine Size(L)` DOUBLE")


def test_bad_numbers_become_null_not_errors(spark):
    df = vehicles(spark, ("A", "m", "SUV", "abc", math.nan), ("B", "m", "SUV", "-4", math.inf), ("C", "m", "SUV", "6", -1.0), ("D", "m", "SUV", "8", 2.5))
    cleaned = clean_structured(df, VEHICLES, DATE).valid
    assert rows(cleaned.select("make", "cylinders", "engine_sizel"), "make") == [("a", None, None), ("b", None, None), ("c", 6, None), ("d", 8, 2.5)]


def test_zero_denominator(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 4.0), (None, 2.0)], "a DOUBLE, b DOUBLE")
    assert [r[0] for r in df.select(ratio(F.col("a"), F.col("b"))).collect()] == [None, 0.25, None]


def test_null_token_rows_are_quarantined_but_blank_rows_vanish(spark):
    df = vehicles(spark, ("N/A", "--", "null", "nan", None), (None, "  ", None, None, None), ("A", "b", "c", None, None))
    out = clean_structured(df, VEHICLES, DATE, "src")
    assert out.valid.count() == 1 and out.rejected.count() == 1
    assert rows(out.audit().select("before_rows", "after_rows"), "before_rows") == [(1, 1), (2, 1), (3, 2)]
    event = out.event().first()
    assert event["rejected_record_count"] == 1 and event["reason"] == "missing_required_values" and len(event["event_id"]) == 16
    assert out.event().first()["event_id"] == event["event_id"]


def test_missing_column_rejects_the_table(spark):
    out = clean_structured(spark.createDataFrame([("a",)], "make STRING"), VEHICLES, DATE)
    assert out.valid is None and out.event().first()["reason"] == "missing_required_columns"


def test_strings(spark):
    raw = [" A\tB ", "x\u0001y", "Decâ\u0080\u0093Jan", "--", "â\u0080\u0093", "ok  ok", "plain", None]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(raw)], "make STRING, note STRING").withColumns({"model": F.lit("m"), "vehicle_class": F.lit("v")})
    assert [r[1] for r in rows(clean_structured(df, VEHICLES, DATE).valid.select("make", "note"), "make")] == [
        "a b", "xy", "dec-jan", None, None, "ok ok", "plain", None,
    ]


def test_units_and_months(spark):
    units = ["Â°c", "celsius", "Degrees  C", "° C", "Kelvin", "-"]
    df = spark.createDataFrame([(u, "Dec - Feb", "1961" if i else "1800") for i, u in enumerate(units)], "unit STRING, months STRING, year STRING").withColumn("area", F.lit("X"))
    out = clean_structured(df, TEMPERATURES, DATE)
    assert sorted(r[0] or "" for r in out.valid.select("unit").collect()) == ["", "Kelvin", "°C"]
    assert {r[0] for r in out.valid.select("months").collect()} == {"dec-feb"}
    assert out.rejected.count() == 1  # the year out of range


def test_arrays(spark):
    df = spark.createDataFrame([("1", "['#Flood', ' ', 'Quake']"), ("2", "[]"), ("3", ""), ("4", None)], "`Tweet ID` STRING, hashtags STRING")
    out = clean_structured(df, TWEETS, DATE).valid
    assert rows(out.select("id", "hashtags"), "id") == [("1", ["#flood", "quake"]), ("2", []), ("3", None), ("4", None)]
    assert rows(star.bridge_hashtag(out), "hashtag") == [("1", "flood"), ("1", "quake")]


def test_year_range_and_key_fill(spark):
    df = spark.createDataFrame([("a", "1800", 1.0), ("a", "1999", -5.0), ("b", "2200", 1.0)], "country STRING, year STRING, gdp DOUBLE")
    out = clean_structured(df, CLIMATE, DATE)
    assert rows(out.valid.select("country", "year", "gdp")) == [("a", 1999, None)]
    assert out.rejected.count() == 2


def test_duplicates_and_unique_keys(spark):
    same = clean_structured(spark.createDataFrame([("1", "x"), ("1", "x")], "id STRING, tweet_text STRING"), TWEETS, DATE)
    assert same.verify() == 1
    differing = clean_structured(spark.createDataFrame([("1", "x"), ("1", "y")], "id STRING, tweet_text STRING"), TWEETS, DATE)
    with pytest.raises(GateError):
        differing.verify()
    plain = clean_structured(spark.createDataFrame([(1, "x"), (1, "y")], "id INT, t STRING"), TableRules("other", whole_row_duplicates=False), DATE)
    assert plain.valid.count() == 1


def test_valid_and_rejected_hold_every_row(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("id"), F.when(F.col("id") % 3 != 0, F.col("id")).cast("string").alias("v"))
    out = clean_structured(df, TableRules("t", required=("id", "v")), DATE)
    assert out.valid.count() + out.rejected.count() == 500


def test_null_position_matters_in_keys(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None), ("ab", None, None)], "x STRING, y STRING, z STRING")
    assert df.select(fingerprint("x", "y", "z")).distinct().count() == 3
    two = spark.createDataFrame([("a", None), (None, "a")], "x STRING, y STRING")
    assert two.select(surrogate_key("x", "y")).distinct().count() == 2


def test_star_join_keeps_fact_rows(spark):
    df = vehicles(spark, *[(f"m{i % 7}", f"x{i}", "SUV", "4", float(i)) for i in range(60)])
    extra = {c: F.lit(1.0) for c in star.VEHICLE_MEASURES}
    cleaned = clean_structured(df, VEHICLES, DATE).valid.withColumns({**extra, "transmission": F.lit(None).cast("string"), "fuel_type": F.lit("z")})
    fact, dim = star.fact_vehicle_emission(cleaned), star.dim_vehicle(cleaned)
    assert fact.join(dim, "vehicle_key").count() == cleaned.count() == 60
    assert dim.select("vehicle_key").distinct().count() == dim.count()


def test_keep_first_and_later_copies_hold_every_row(spark):
    df = spark.createDataFrame([("k", "b"), ("k", "a"), ("k", "a"), ("j", "z")], "key STRING, v STRING")
    assert rows(keep_first(df, ["key"]), "key") == [("j", "z"), ("k", "a")]
    assert rows(later_copies(df, ["key"], ["v"]), "v") == [("k", "a", 1), ("k", "b", 1)]


def test_per_task_limit_precedes_the_exchange(spark):
    plan = keep_first(spark.range(10).selectExpr("id % 2 AS k", "id"), ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan
