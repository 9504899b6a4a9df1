from __future__ import annotations

import math
import warnings

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from sparkzone.operators import profile
from sparkzone.operators.gates import GateError
from sparkzone.plans import classifier, governance as gov

from .conftest import rows

DATE = "2026-05-24T10:00:00Z"


def test_quality_rolls_up(spark, tmp_path):
    good = gov.Asset("dim_country", spark.createDataFrame([("a",), ("b",)], "country_key STRING"), "src", key="country_key")
    bad = gov.Asset("dim_area", spark.createDataFrame([("a",), ("a",)], "area_key STRING"), "src", key="area_key")
    empty = gov.Asset("mart_x", spark.createDataFrame([], "v STRING"), "src")
    assets = gov.publish(spark, [good, bad, empty], str(tmp_path), DATE, {"dim_country": ["country_key"]})
    found = {r["asset_name"]: (r["quality_status"], r["record_count"]) for r in gov.catalogue(assets, DATE).collect()}
    assert found == {"dim_country": ("PASS", 2), "dim_area": ("FAIL", 2), "mart_x": ("FAIL", 0)}
    checks = {(r["asset_name"], r["check_name"]): r["observed_value"] for r in gov.quality(assets, DATE).collect()}
    assert checks[("dim_area", "dimension_key_unique")] == "1/2" and len(checks) == 8
    assert {r["transformation_name"] for r in gov.lineage(assets, DATE).collect()} >= {"structured_exploitation.dim_area"}
    again = gov.publish(spark, [good, bad, empty], str(tmp_path), DATE)
    assert rows(gov.output_counts(again), "asset_name") == [("dim_area", 2), ("dim_country", 2), ("mart_x", 0)]


def test_metadata_gaps_fail(spark):
    df = gov.with_metadata(spark.range(2).toDF("x"), "mart_x", "", DATE)  # no source assets
    checks = {r["check_name"]: r["status"] for r in gov.quality([gov.Asset("mart_x", df, "")], DATE).collect()}
    assert checks["metadata_complete"] == "FAIL"


def test_summary_keeps_what_cannot_be_read(spark):
    class Broken:
        columns = ["x"]

        @property
        def schema(self):
            raise OSError("gone")

    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always")
        out = gov.trusted_summary({"a": ("table", spark.range(3)), "b": ("collection", Broken())}, DATE)
    found = {r["dataset_name"]: (r["record_count"], r["validation_status"], r["schema_json"] is None) for r in out.collect()}
    assert found == {"a": (3, "valid", False), "b": (None, "unreadable", True)} and seen


TEXTS = [("the red cat sat", "a"), ("the red dog ran", "a"), ("blue sky above town", "b")]


def test_weights_match_the_formula(spark):
    df = spark.createDataFrame(TEXTS, "tweet_text STRING, disaster_type STRING").coalesce(1)
    out = df
    stages = classifier.fit_features(df)
    for stage in stages:
        out = stage.transform(out)
    vocabulary = stages[3].vocabulary
    first = out.filter("tweet_text = 'the red cat sat'").select(vector_to_array("features")).first()[0]
    idf = lambda d: math.log((1 + 3) / (1 + d)) + 1
    raw = {"the": idf(2), "red": idf(2), "cat": idf(1), "sat": idf(1), "the red": idf(2), "red cat": idf(1), "cat sat": idf(1)}
    norm = math.sqrt(sum(v * v for v in raw.values()))
    got = {vocabulary[i]: v for i, v in enumerate(first) if v}
    assert got.keys() == raw.keys() and all(abs(got[t] - raw[t] / norm) < 1e-9 for t in raw)


def test_words_of_any_script_need_two_letters(spark):
    df = spark.createDataFrame([("Été à la plage x", "a")], "tweet_text STRING, disaster_type STRING")
    assert classifier.fit_features(df)[0].transform(df).first()["words"] == ["été", "la", "plage"]


def test_training_metrics_and_abstention(spark, tmp_path):
    data = [(i, f"storm wind rain number{i}", "storm", 4) for i in range(30)] + [(100 + i, f"fire smoke heat item{i}", "fire", 4) for i in range(20)] + [(999, "too short", "fire", 2)]
    df = spark.createDataFrame(data, "id INT, tweet_text STRING, disaster_type STRING, word_count INT")
    fitted = classifier.train_classifier(df, key="id", iterations=30)
    assert (fitted.train_size, fitted.test_size) == (40, 10)
    m = fitted.metrics().first()
    assert m["accuracy"] == 1.0 and m["f1"] == 1.0 and m["row_count"] == 50
    unsure = spark.createDataFrame([("nothing known here",)], "tweet_text STRING")
    sure = spark.createDataFrame([("storm wind rain",)], "tweet_text STRING")
    assert classifier.predict_or_unknown(fitted.model, fitted.labels, unsure, 0.95).first()["predicted_label"] == "unknown"
    assert classifier.predict_or_unknown(fitted.model, fitted.labels, sure, 0.5).first()["predicted_label"] == "storm"
    out = classifier.run(spark, df, str(tmp_path / "models"), str(tmp_path / "metrics"), DATE)
    assert out.count() == 1 and out.first()["model_artifact_bytes"] > 0
    for broken in (df.filter("disaster_type = 'fire'"), df.filter("word_count < 3"), df.filter("disaster_type = 'storm' or id = 100")):
        with pytest.raises(GateError):
            classifier.usable_texts(broken)


def test_one_task_of_texts_is_spread_before_it_is_split(spark, monkeypatch):
    # Some MB in one task, as a file of one row group is read.
    body = F.concat_ws(" ", *[F.sha2(F.concat(F.col("id").cast("string"), F.lit(f"-{i}")), 512) for i in range(4)])
    label = F.when(F.col("id") % 2 == 0, "even").otherwise("odd")
    df = spark.range(0, 16_000, 1, 1).select("id", body.alias("tweet_text"), label.alias("disaster_type"), F.lit(4).alias("word_count"))
    tasks = []
    split = classifier.stratified_split

    def watched(texts, *rest):
        tasks.append(texts.select(F.spark_partition_id()).distinct().count())
        return split(texts.limit(200), *rest)

    monkeypatch.setattr(classifier, "stratified_split", watched)
    classifier.train_classifier(df, key="id", iterations=1)
    assert tasks[0] > 1


def test_counted_rows_are_stored_without_texts(spark):
    df = spark.createDataFrame(TEXTS, "tweet_text STRING, disaster_type STRING")
    stages, counted = classifier._fit_counts(df, 100)
    assert set(counted.columns) == {"disaster_type", "tf"} and counted.count() == 3 and counted.inputFiles()
    assert len(stages) == 4


def test_classification_metrics_by_hand(spark):
    pairs = [("a", "a")] * 3 + [("a", "b")] + [("b", "b")] * 2 + [("c", "a")]
    m = profile.classification_metrics(spark.createDataFrame(pairs, "t STRING, p STRING"), "t", "p").first()
    precision = (4 * 3 / 4 + 2 * 2 / 3 + 0) / 7
    recall = (4 * 3 / 4 + 2 * 1 + 0) / 7
    f1 = (4 * 0.75 + 2 * 0.8) / 7
    assert [round(m[c], 9) for c in ("accuracy", "precision", "recall", "f1")] == [round(x, 9) for x in (5 / 7, precision, recall, f1)]


def test_profile_counts(spark):
    df = spark.createDataFrame([("x y z", 1), ("x y z", 1), (" ", 2), (None, 3)], "t STRING, n INT")
    assert profile.overview(df, "t").first().asDict() == {"row_count": 4, "duplicate_rows": 1, "blank_texts": 2, "short_texts": 2}
    assert rows(profile.missing_share(df), "column") == [("n", 0.0), ("t", 25.0)]
    assert profile.describe(df, ["n"]).first()["quartiles"] == [1.0, 1.5, 2.25]
    assert rows(profile.label_share(df.toDF("t", "k"), "k").withColumn("pct", F.col("pct").cast("int")), "k")[0] == (1, 2, 50)
