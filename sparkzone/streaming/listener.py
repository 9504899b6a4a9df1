"""Progress of streams as a table: one small file per event, written as it happens.

The listener hears of every query of its session, also of those that someone else started. Files
are named by query, run and batch, so a repeated event overwrites itself, and go to the folder
all share through Hadoop's FileSystem: no Spark job runs for them, and a restarted driver goes
on in the same folder. ``progress`` reads them as one row per batch.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from .. import sharedfs

SOURCE = "struct<description: STRING, startOffset: STRING, endOffset: STRING, numInputRows: BIGINT>"
EVENT = (
    f"kind STRING, query_id STRING, run_id STRING, name STRING, at STRING, batch_id BIGINT, input_rows BIGINT, output_rows BIGINT, "
    f"took_ms BIGINT, ran BOOLEAN, sources ARRAY<{SOURCE}>, observed MAP<STRING, MAP<STRING, STRING>>, error STRING"
)


def _texts(value):
    """A JSON value as text, however the offset or metric looks."""
    return value if value is None or isinstance(value, str) else json.dumps(value, sort_keys=True)


class ProgressLog(StreamingQueryListener):
    """Writes starts, batches, and ends with their errors below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()
        # What a callback raises is lost in Spark's log; ``wait`` tells it.
        self.failures: list[BaseException] = []

    def _end_of(self, run_id: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run_id, threading.Event())

    def _put(self, file: str, **event) -> None:
        path = f"{self.root}/query={event['query_id']}/run={event['run_id']}/{file}.json"
        try:
            sharedfs.write_text(self.spark, path, json.dumps(event) + "\n")
        except Exception as error:  # noqa: BLE001
            self.failures.append(error)

    def onQueryStarted(self, event) -> None:
        self._end_of(str(event.runId))
        self._put("started", kind="started", query_id=str(event.id), run_id=str(event.runId), name=event.name, at=event.timestamp)

    def onQueryProgress(self, event) -> None:
        p = json.loads(event.progress.json)
        observed = {name: {k: _texts(v) for k, v in row.items()} for name, row in (p.get("observedMetrics") or {}).items()}
        sources = [{**{k: _texts(s.get(k)) for k in ("description", "startOffset", "endOffset")}, "numInputRows": s.get("numInputRows")} for s in p.get("sources", [])]
        self._put(
            f"batch-{p['batchId']}",
            kind="progress",
            query_id=p["id"],
            run_id=p["runId"],
            name=p.get("name"),
            at=p["timestamp"],
            batch_id=p["batchId"],
            input_rows=sum(s["numInputRows"] or 0 for s in sources),
            output_rows=(p.get("sink") or {}).get("numOutputRows"),
            took_ms=p.get("batchDuration"),
            ran="addBatch" in p.get("durationMs", {}),
            sources=sources,
            observed=observed,
        )

    def onQueryIdle(self, event) -> None:
        """An idle trigger says nothing of any batch."""

    def onQueryTerminated(self, event) -> None:
        self._put("ended", kind="ended", query_id=str(event.id), run_id=str(event.runId), error=event.exception)
        self._end_of(str(event.runId)).set()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until the end of a stopped query has been written; events arrive after the query itself is done."""
        if not self._end_of(str(query.runId)).wait(seconds):
            raise TimeoutError(f"no end of run {query.runId} within {seconds} s")
        if self.failures:
            raise RuntimeError("an event could not be written") from self.failures[0]

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)


def events(spark: SparkSession, root: str) -> DataFrame:
    """All stored events, as ``EVENT``."""
    return spark.read.schema(EVENT).option("recursiveFileLookup", True).json(root)


def progress(spark: SparkSession, root: str) -> DataFrame:
    """One row per query and batch that ran: as its last run tells it, with the number of runs that tried it.

    Columns: query_id, name, batch_id, run_id, at, input_rows, output_rows, took_ms, sources, observed.
    A batch with an error has no progress of that run; ``failures`` tells the run.
    """
    ran = events(spark, root).where("kind = 'progress' and ran")
    last = Window.partitionBy("query_id", "batch_id").orderBy(F.col("at").desc(), F.col("run_id").desc())
    newest = ran.withColumn("nth", F.row_number().over(last)).where("nth = 1")
    return newest.select("query_id", "name", "batch_id", "run_id", "at", "input_rows", "output_rows", "took_ms", "sources", "observed")


def runs(spark: SparkSession, root: str) -> DataFrame:
    """One row per run: query_id, run_id, name, started, active, batches, input_rows, error."""
    return (
        events(spark, root)
        .groupBy("query_id", "run_id")
        .agg(
            F.max(F.when(F.col("kind") == "started", F.col("name"))).alias("name"),
            F.min(F.when(F.col("kind") == "started", F.col("at"))).alias("started"),
            (F.count_if(F.col("kind") == "ended") == 0).alias("active"),
            F.count_if("ran").alias("batches"),
            F.coalesce(F.sum("input_rows"), F.lit(0)).alias("input_rows"),
            F.max("error").alias("error"),
        )
    )
