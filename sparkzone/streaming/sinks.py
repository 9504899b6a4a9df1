"""Micro-batch sinks. Replaying a batch leaves the sink as it was."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import logicaldate
from ..functions.keys import offset_digest

BatchWriter = Callable[[DataFrame, int], None]


def parquet_writer(path: str) -> BatchWriter:
    """Each batch owns one folder, which a replay overwrites."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")

    return write


def forget_batch(spark: SparkSession, url: str, table: str, properties: Mapping[str, str], batch_id: int) -> None:
    """Delete what an earlier attempt at a batch left in a database table."""
    jvm = spark.sparkContext._jvm
    login = jvm.java.util.Properties()
    for key, value in properties.items():
        login.setProperty(key, value)
    connection = jvm.java.sql.DriverManager.getConnection(url, login)
    try:
        if connection.getMetaData().getTables(None, None, table, None).next():
            connection.createStatement().executeUpdate(f"DELETE FROM {table} WHERE batch_id = {int(batch_id)}")
    finally:
        connection.close()


def jdbc_writer(url: str, table: str, properties: Mapping[str, str], forget=forget_batch, save=None) -> BatchWriter:
    """Rows with their ``batch_id`` to a database table; a replay first deletes its own.

    ``forget`` and ``save`` stand for the two database calls, so that the order can be tested without one.
    """
    put = save or (lambda rows: rows.write.jdbc(url, table, mode="append", properties=dict(properties)))

    def write(batch: DataFrame, batch_id: int) -> None:
        forget(batch.sparkSession, url, table, properties, batch_id)
        put(batch.withColumn("batch_id", F.lit(batch_id)))

    return write


def write_batches(
    stream: DataFrame,
    checkpoint: str,
    writer: BatchWriter,
    keep: Column | None = None,
    name: str | None = None,
    on_counts: Callable[[int, int, int], None] | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Checkpointed append of the rows that pass ``keep``.

    Rows in and rows kept are observed during the write, so a batch is read
    once. ``on_counts`` gets (batch id, received, kept).
    """
    condition = F.lit(True) if keep is None else keep

    def process(batch: DataFrame, batch_id: int) -> None:
        seen = Observation(f"batch-{batch_id}")
        counted = batch.observe(seen, F.count("*").alias("received"), F.count_if(condition).alias("kept"))
        writer(counted.filter(condition), batch_id)
        if on_counts:
            on_counts(batch_id, seen.get["received"], seen.get["kept"])

    target = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint).outputMode("append")
    if name:
        target = target.queryName(name)
    return (target.trigger(availableNow=True) if available_now else target).start()


def append_files(stream: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Plain file append; Spark's own sink log makes it exactly-once."""
    target = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return (target.trigger(availableNow=True) if available_now else target).start()


def console(stream: DataFrame, name: str, rows: int = 10) -> StreamingQuery:
    return stream.writeStream.format("console").option("truncate", False).option("numRows", rows).queryName(name).start()


def offset_ranges(batch: DataFrame) -> DataFrame:
    """First and last offset per partition of a batch."""
    return batch.groupBy("partition").agg(F.min("offset").alias("start"), F.max("offset").alias("end"), F.count("*").alias("n"))


def batch_label(ranges: DataFrame) -> DataFrame:
    """One row naming a batch by its partitions and a digest of its offset ranges."""
    entry = F.struct(F.col("partition").cast("int").alias("partition"), "start", "end")
    # One entry per Kafka partition: bounded by the topic, not by the data.
    listed = ranges.agg(F.array_sort(F.collect_list(entry)).alias("r"), F.sum("n").alias("rows"))
    names = F.concat_ws("-", F.transform("r", lambda x: x["partition"].cast("string")))
    digest = offset_digest(F.to_json("r"))
    return listed.filter("rows > 0").select(F.concat(F.lit("p"), names, F.lit("_"), digest).alias("label"), F.to_json("r").alias("ranges"), "rows")


def _land(batch: DataFrame, root: str, topic: str, day: str) -> None:
    label = batch_label(offset_ranges(batch)).first()
    if label is None:
        return
    folder = f"{root.rstrip('/')}/{topic}/{day}"
    batch.select(F.col("value").cast("string")).write.mode("overwrite").option("compression", "none").text(f"{folder}/{label['label']}.ndjson")
    audit = batch.sparkSession.createDataFrame(
        [(topic, day, label["label"], label["ranges"], label["rows"])], "topic STRING, day STRING, label STRING, ranges STRING, rows BIGINT"
    )
    audit.write.mode("overwrite").parquet(f"{root.rstrip('/')}/_audit/{topic}/{day}/{label['label']}")


def land_kafka(stream: DataFrame, root: str, topic: str, date, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Raw messages to ``root/topic/day/label`` with an audit row per batch.

    The label follows from the offsets, so a replayed batch overwrites itself;
    Spark commits the offsets only after both writes.
    """
    day = logicaldate.compact_day(date)

    def process(batch: DataFrame, batch_id: int) -> None:
        # The name has to be known before the write: both come from one read of the source.
        batch = batch.persist()
        try:
            _land(batch, root, topic, day)
        finally:
            batch.unpersist()

    target = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    return (target.trigger(availableNow=True) if available_now else target).start()


def stop_all(queries: list[StreamingQuery]) -> None:
    for query in queries:
        if query.isActive:
            query.stop()


def status(query: StreamingQuery) -> dict:
    """Name, activity and last progress of a query."""
    progress = query.lastProgress
    return {
        "name": query.name,
        "active": query.isActive,
        "message": query.status["message"],
        "input_rows": progress["numInputRows"] if progress else 0,
    }

