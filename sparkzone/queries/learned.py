"""The text classifier over documents and their languages. What it learns is not a matter of SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import sharedfs
from ..plans import classifier, star
from .registry import DATE, query, table


def training(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as texts, labelled by the quality reviewers gave them."""
    docs = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id")
    kind = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").otherwise("poor")
    # The documents of one row group are one task of the scan; every core gets some of them.
    rows = docs.select(F.col("doc_id").alias("id"), "text", kind.alias("kind")).hint("rebalance")
    facts = star.text_features(rows, "id", "text", "kind")
    return facts.select("tweet_id", "tweet_text", "disaster_type", "word_count")


def trained(spark: SparkSession, folder: str) -> classifier.Trained:
    return classifier.train_classifier(training(spark, folder), key="tweet_id", iterations=50)


@query("classifier_metrics")
def classifier_metrics(spark, folder):
    fitted = trained(spark, folder)
    stored = classifier.store_model(spark, fitted.model, sharedfs.new_folder(spark, "model"), DATE)
    return classifier.metrics_record(fitted, *stored, DATE).drop("model_uri", "model_artifact_sha256", "model_artifact_bytes")


@query("classifier_reject")
def classifier_reject(spark, folder):
    """Every labelled text scored; unsure answers become unknown."""
    fitted = trained(spark, folder)
    answers = classifier.predict_or_unknown(fitted.model, fitted.labels, training(spark, folder), 0.6)
    return answers.groupBy("disaster_type", "predicted_label").agg(F.count("*").alias("n"), F.round(F.min("confidence"), 4).alias("least_confidence"))


KINDS_SQL = "k as (select case when toxic = 1 then 'toxic' when quality = 1 then 'good' else 'poor' end as kind, text from documents join labels using (doc_id)), u as (select kind from k where len(regexp_extract_all(text, '\\S+')) > 3)"


@query("classifier_split", f"with {KINDS_SQL}, n as (select kind, count(*) as n from u group by 1) select sum(n - ceil(n * 0.2))::bigint as train_size, sum(ceil(n * 0.2))::bigint as test_size, sum(n)::bigint as row_count from n")
def classifier_split(spark, folder):
    """The stored model's record names the exact sizes of its parts."""
    fitted = trained(spark, folder)
    stored = classifier.store_model(spark, fitted.model, sharedfs.new_folder(spark, "model"), DATE)
    return classifier.metrics_record(fitted, *stored, DATE).select("train_size", "test_size", "row_count")


@query("classifier_threshold", "select count(*) as answers, 0 as unsure_but_named, 0 as sure_but_unknown, 0 as other_names from documents join labels using (doc_id)")
def classifier_threshold(spark, folder):
    """Answers below the threshold are unknown, all others one of the labels."""
    fitted = trained(spark, folder)
    answers = classifier.predict_or_unknown(fitted.model, fitted.labels, training(spark, folder), 0.6)
    unknown, unsure = F.col("predicted_label") == "unknown", F.col("confidence") < 0.6
    return answers.agg(
        F.count("*").alias("answers"),
        F.count_if(unsure & ~unknown).cast("int").alias("unsure_but_named"),
        F.count_if(~unsure & unknown).cast("int").alias("sure_but_unknown"),
        F.count_if(~F.col("predicted_label").isin("unknown", "toxic", "good", "poor")).cast("int").alias("other_names"),
    )


MEASURES = ("accuracy", "precision", "recall", "f1")

# Plain SQL over the stored predictions: per class, then weighted by its size.
RECOUNT = """
with t as (select disaster_type as kind, count(*) as size, count_if(predicted_label = disaster_type) as hit from {p} group by 1),
n as (select predicted_label as kind, count(*) as named from {p} group by 1),
k as (select size, hit, coalesce(named, 0) as named from t left join n using (kind)),
m as (select size, hit, hit / size as recall, if(named = 0, 0, try_divide(hit, named)) as precision from k)
select sum(hit) / sum(size) as accuracy, sum(size * precision) / sum(size) as precision, sum(size * recall) / sum(size) as recall,
  sum(size * if(precision + recall = 0, 0, try_divide(2 * precision * recall, precision + recall))) / sum(size) as f1
from m
"""


@query(
    "classifier_recount",
    f"with {KINDS_SQL}, n as (select kind, count(*) as n from u group by 1) select sum(ceil(n * 0.2))::bigint as predictions, true as accuracy, true as precision, true as recall, true as f1 from n",
)
def classifier_recount(spark, folder):
    """The reported measures, against a recount in SQL of the predictions they were taken from."""
    fitted = trained(spark, folder)
    stored = sharedfs.cut_lineage(fitted.predictions.select("disaster_type", "predicted_label"), "predictions")
    recount = spark.sql(RECOUNT, p=stored)
    told = classifier.Trained(fitted.model, fitted.labels, stored, fitted.train_size, fitted.test_size).metrics()
    both = told.select(*[F.col(m).alias(f"told_{m}") for m in MEASURES]).join(recount, F.lit(True))
    agree = [(F.abs(F.col(m) - F.col(f"told_{m}")) < 1e-9).alias(m) for m in MEASURES]
    return both.select(F.lit(fitted.test_size).cast("long").alias("predictions"), *agree)


@query(
    "classifier_runs",
    f"with {KINDS_SQL}, n as (select kind, count(*) as n from u group by 1) select 2 as runs, 2 as models, sum(n)::bigint as row_count, sum(n - ceil(n * 0.2))::bigint as train_size, sum(ceil(n * 0.2))::bigint as test_size from n",
)
def classifier_runs(spark, folder):
    """Two whole runs of the job on the same texts: a model and an appended row of measures each."""
    root = sharedfs.new_folder(spark, "runs")
    texts = sharedfs.cut_lineage(training(spark, folder), "texts")
    for day in (DATE, "2026-05-25T10:00:00+00:00"):
        recorded = classifier.run(spark, texts, f"{root}/models", f"{root}/metrics", day, iterations=50)
    seen = recorded.groupBy("row_count", "train_size", "test_size")
    return seen.agg(F.count("*").cast("int").alias("runs"), F.countDistinct("model_uri").cast("int").alias("models"))
