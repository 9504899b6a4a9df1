"""Text classifier: TF-IDF over one- and two-word terms, logistic regression, abstention."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import (
    IDF,
    CountVectorizer,
    ElementwiseProduct,
    NGram,
    Normalizer,
    RegexTokenizer,
    SQLTransformer,
    StringIndexer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import logicaldate
from ..functions.keys import fingerprint
from ..operators.gates import GateError
from ..operators.ordered import stratified_split
from ..operators.profile import classification_metrics
from ..sharedfs import cut_lineage
from ..sources.tables import append, training_frame

# How a run is described.
MODEL_NAME = "tfidf_logistic_regression"
MODEL_VERSION = "v1"
TASK = "natural_disaster_tweet_classifier"
SCHEMA_VERSION = "consumption_v1"
SOURCE_ASSETS = "exploitation_analytics.fact_tweet_features"
SEED = 2026
MAX_TERMS = 20_000
# Words of two or more letters or digits of any script.
WORD = r"(?U)\b\w\w+\b"


@dataclass(frozen=True)
class Trained:
    model: PipelineModel
    labels: list[str]
    predictions: DataFrame
    train_size: int
    test_size: int

    def metrics(self) -> DataFrame:
        measured = classification_metrics(self.predictions, "disaster_type", "predicted_label")
        total = F.lit(self.train_size + self.test_size).cast("long")
        return measured.withColumns(
            {"row_count": total, "train_size": F.lit(self.train_size).cast("long"), "test_size": F.lit(self.test_size).cast("long")}
        )


def usable_texts(df: DataFrame) -> DataFrame:
    """Texts of more than three words, of at least two classes with two rows each."""
    kept = df.filter("word_count > 3")
    checked = kept.groupBy("disaster_type").agg(F.count("*").alias("n")).agg(F.count("*").alias("classes"), F.min("n").alias("least")).first()
    if not checked["classes"]:
        raise GateError("no text has more than three words")
    if checked["classes"] < 2:
        raise GateError("at least two classes are needed")
    if checked["least"] < 2:
        raise GateError("every class needs at least two rows")
    return kept


def _fit_counts(train: DataFrame, terms: int) -> tuple[list, DataFrame]:
    """Fitted stages from text to term counts, and the counted rows, written without their texts."""
    front = [
        RegexTokenizer(inputCol="tweet_text", outputCol="words", pattern=WORD, gaps=False, toLowercase=True),
        NGram(n=2, inputCol="words", outputCol="pairs"),
        SQLTransformer(statement="SELECT *, concat(words, pairs) AS terms FROM __THIS__"),
    ]
    tokens = train
    for stage in front:
        tokens = stage.transform(tokens)
    counts = CountVectorizer(inputCol="terms", outputCol="tf", vocabSize=terms).fit(tokens)
    counted = counts.transform(tokens).drop("tweet_text", "words", "pairs", "terms")
    return [*front, counts], cut_lineage(counted, "counts")


def _fit_weights(counted: DataFrame) -> list:
    """Fitted stages from term counts to unit vectors, with the smoothed ``idf + 1`` weighting."""
    idf = IDF(inputCol="tf", outputCol="unused").fit(counted)
    weights = DenseVector([w + 1.0 for w in idf.idf])
    return [ElementwiseProduct(scalingVec=weights, inputCol="tf", outputCol="weighted"), Normalizer(p=2.0, inputCol="weighted", outputCol="features")]


def fit_features(train: DataFrame, terms: int = MAX_TERMS) -> list:
    """Fitted stages from text to unit TF-IDF vectors."""
    count, counted = _fit_counts(train, terms)
    return [*count, *_fit_weights(counted)]


def train_classifier(df: DataFrame, key: str | None = None, terms: int = MAX_TERMS, iterations: int = 1000) -> Trained:
    """Exact 80/20 split per class, then fit on the train part and predict the test part."""
    # A file of one row group is read by one task, however large; the passes below read even parts.
    texts = usable_texts(cut_lineage(df.hint("rebalance"), "texts"))
    if key is None:
        texts, key = texts.withColumn("row_key", fingerprint("tweet_text", "disaster_type")), "row_key"
    # Labels, terms and weights are all fitted on these rows.
    train, test = (cut_lineage(part, "split") for part in stratified_split(texts, "disaster_type", key, 0.2, SEED))
    train_size, test_size = train.count(), test.count()
    indexer = StringIndexer(inputCol="disaster_type", outputCol="label", stringOrderType="alphabetAsc", handleInvalid="keep").fit(train)
    count, counted = _fit_counts(train, terms)
    weigh = _fit_weights(counted)
    prepared = indexer.transform(counted)
    for stage in weigh:
        prepared = stage.transform(prepared)
    # Written once: the fit passes over it once per iteration.
    prepared = cut_lineage(prepared.select("features", "label"), "training")
    # The penalty of C = 1 on a summed loss, written for Spark's mean loss.
    regression = LogisticRegression(
        maxIter=iterations, family="multinomial", regParam=1.0 / train_size, elasticNetParam=0.0, standardization=False
    ).fit(prepared)
    model = PipelineModel([*count, *weigh, regression])
    labels = list(indexer.labels)
    return Trained(model, labels, predict(model, labels, test), train_size, test_size)


def predict(model: PipelineModel, labels: list[str], df: DataFrame) -> DataFrame:
    """Adds the predicted label and its probability."""
    names = F.array(*[F.lit(x) for x in labels])
    scored = model.transform(df).withColumn("__p", vector_to_array("probability"))
    return scored.select(
        *df.columns,
        F.try_element_at(names, F.col("prediction").cast("int") + 1).alias("predicted_label"),
        F.array_max("__p").alias("confidence"),
    )


def predict_or_unknown(model: PipelineModel, labels: list[str], df: DataFrame, threshold: float = 0.6) -> DataFrame:
    """A prediction below the threshold becomes ``unknown``."""
    answered = predict(model, labels, df)
    return answered.withColumn("predicted_label", F.when(F.col("confidence") < threshold, "unknown").otherwise(F.col("predicted_label")))


def store_model(spark: SparkSession, model: PipelineModel, root: str, date) -> tuple[str, str, int]:
    """(path, digest, bytes) of a saved model."""
    stamp = "".join(ch if ch.isalnum() else "_" for ch in logicaldate.iso(date)).strip("_")
    path = f"{root.rstrip('/')}/model_name={MODEL_NAME}/model_version={MODEL_VERSION}/created_at={stamp}"
    model.write().overwrite().save(path)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(F.sha2("content", 256).alias("d"), "length")
    # A saved model is a handful of small files.
    sealed = files.agg(F.sha2(F.concat_ws(",", F.array_sort(F.collect_list("d"))), 256).alias("digest"), F.sum("length").alias("bytes")).first()
    return path, sealed["digest"], sealed["bytes"]


def metrics_record(trained: Trained, path: str, digest: str, size: int, date) -> DataFrame:
    return trained.metrics().select(
        "row_count",
        "accuracy",
        "precision",
        "recall",
        "f1",
        "train_size",
        "test_size",
        F.lit("exploitation_zone").alias("source_system"),
        F.lit(SOURCE_ASSETS).alias("source_assets"),
        F.lit(logicaldate.iso(date)).alias("created_at"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        F.lit(TASK).alias("consumption_task"),
        F.lit(MODEL_NAME).alias("model_name"),
        F.lit(MODEL_VERSION).alias("model_version"),
        F.lit(path).alias("model_uri"),
        F.lit(digest).alias("model_artifact_sha256"),
        F.lit(size).cast("long").alias("model_artifact_bytes"),
    )


def run(spark: SparkSession, features: DataFrame, model_root: str, metrics_path: str, date, iterations: int = 1000) -> DataFrame:
    """Check the input, train, store the model and append one metrics row."""
    trained = train_classifier(training_frame(features), iterations=iterations)
    record = metrics_record(trained, *store_model(spark, trained.model, model_root, date), date)
    append(record, metrics_path)
    return spark.read.option("mergeSchema", True).parquet(metrics_path)
