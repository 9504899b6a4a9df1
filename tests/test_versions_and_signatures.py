"""Versions of tables, signatures that add up, distinct sketches, stored indexes and stream progress."""

from __future__ import annotations

import re

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from sparkzone.operators import signatures, sketches, vectors
from sparkzone.sources import versions
from sparkzone.streaming import listener, sinks

from .conftest import rows


def ids(frame):
    return sorted(r[0] for r in frame.select("id").collect())


def test_a_version_is_seen_only_once_committed(spark, tmp_path):
    root = str(tmp_path / "t")
    assert versions.versions(spark, root) == [] and versions.latest(spark, root) == -1
    with pytest.raises(FileNotFoundError):
        versions.read(spark, root)
    assert versions.publish(spark.range(3), root) == 0
    reader = versions.read(spark, root)
    staged = versions.stage(versions.read(spark, root).where("id > 0"), root)
    assert ids(versions.read(spark, root)) == [0, 1, 2]
    assert versions.commit(spark, staged) == 1
    assert ids(versions.read(spark, root)) == [1, 2] and ids(versions.read(spark, root, 0)) == ids(reader) == [0, 1, 2]


def test_the_second_of_two_writers_is_told(spark, tmp_path):
    root = str(tmp_path / "t")
    versions.publish(spark.range(1), root)
    one, two = versions.stage(spark.range(2), root), versions.stage(spark.range(5), root)
    versions.commit(spark, two)
    with pytest.raises(versions.Conflict):
        versions.commit(spark, one)
    assert ids(versions.read(spark, root)) == [0, 1, 2, 3, 4] and versions.versions(spark, root) == [0, 1]


def test_former_versions_are_cleaned(spark, tmp_path):
    root = str(tmp_path / "t")
    for n in range(4):
        versions.publish(spark.range(n + 1).withColumn("g", F.lit(n)), root, ("g",) if n % 2 else ())
    assert versions.clean(spark, root, keep=2) == [0, 1] and versions.versions(spark, root) == [2, 3]
    assert ids(versions.read(spark, root)) == [0, 1, 2, 3] and len(list((tmp_path / "t" / "data").iterdir())) == 2
    assert versions.publish(spark.range(1), root) == 4


def test_sums_tell_copies_apart_where_xor_does_not(spark):
    sign = lambda *values: tuple(signatures.signature(spark.createDataFrame([(v,) for v in values], "x string"), ["x"]).first())
    assert sign("a", "a") != sign("b", "b") and sign("a", "b", "a") == sign("b", "a", "a")
    assert sign(None) != sign("") and sign() == (0, 0, 0)
    whole = spark.range(100).withColumn("g", F.col("id") % 7)
    parts = signatures.signature(whole, ["id", "g"], by=["g"])
    assert tuple(signatures.merged(parts).first()) == tuple(signatures.signature(whole, ["id", "g"]).first())


def test_only_new_and_changed_files_are_read(spark, tmp_path):
    table, state = str(tmp_path / "table"), str(tmp_path / "state")
    refresh = lambda: signatures.refresh(spark, table, state, ["id"])
    read = lambda s: s.where("read").agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    total = lambda: tuple(signatures.signature(spark.read.parquet(table), ["id"]).first())
    spark.range(10).write.parquet(table)
    spark.range(0).coalesce(1).write.mode("append").parquet(table)
    first = refresh()
    assert read(first) == 10 and tuple(signatures.merged(first).first()) == total()
    assert read(refresh()) == 0 and refresh().where("read").isEmpty()
    spark.range(100, 103).write.mode("append").parquet(table)
    second = refresh()
    assert read(second) == 3 and tuple(signatures.merged(second).first()) == total()
    spark.range(5).write.mode("overwrite").parquet(table)
    third = refresh()
    assert read(third) == 5 and tuple(signatures.merged(third).first()) == total()


def test_sketches_of_days_make_those_of_months(spark):
    df = spark.range(20_000).select((F.col("id") % 30).alias("day"), (F.col("id") % 7_000).alias("user"))
    stored = sketches.distinct_sketches(df, ["day"], "user")
    got = sketches.distinct_estimates(stored).first()[0]
    assert abs(got - 7_000) <= sketches.relative_error() * 7_000
    assert sketches.distinct_estimates(stored.limit(0)).first()[0] == 0
    none = sketches.distinct_sketches(spark.createDataFrame([(1, None)], "day int, user long"), ["day"], "user")
    assert sketches.distinct_estimates(none, ["day"]).first()["estimate"] == 0


def test_a_stored_index_lists_only_cells_in_reach(spark, tmp_path, capsys):
    spread = spark.range(400).select("id", F.array(*[F.rand(s) + F.when(F.col("id") % 8 == s, 9.0).otherwise(0.0) for s in range(8)]).alias("embeddings"))
    frame = spark.createDataFrame(spread.collect(), spread.schema)
    path = str(tmp_path / "index")
    vectors.store_cells(*vectors.build_cells(frame, nlist=8), path)
    stored, cells = vectors.stored_cells(spark, path)
    assert ids(stored) == list(range(400)) and cells.count() == 8
    queries = frame.where("id < 2").select(F.col("id").alias("query_id"), "embeddings")
    hits = vectors.top_k_cells(queries, stored, cells, 3, prune=True)
    assert rows(hits.select("query_id", "id", "rank"), "query_id", "rank") == rows(vectors.top_k(queries, frame, 3).select("query_id", "id", "rank"), "query_id", "rank")
    capsys.readouterr()
    hits.explain("formatted")
    plan = capsys.readouterr().out
    filters = re.findall(r"PartitionFilters: \[.*?cell#\d+ IN \(([\d,]+)\)", plan) + re.findall(r"PartitionFilters: \[.*?\(cell#\d+ = (\d+)\)", plan)
    assert filters and all(len(f.split(",")) < 8 for f in filters), plan


def test_progress_is_stored_per_batch_across_a_restart(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "log")

    def run(writer):
        stream = spark.readStream.schema("id long").parquet(folder)
        started = sinks.write_batches(stream, str(tmp_path / "ck"), writer, name="told-by-test", available_now=True)
        try:
            started.awaitTermination()
        except StreamingQueryException:
            pass
        return started

    def fails(batch, batch_id):
        raise RuntimeError("no luck")

    write = sinks.parquet_writer(str(tmp_path / "out"))
    with listener.ProgressLog(spark, root) as log:
        spark.range(5).write.parquet(folder)
        log.wait(run(write))
        spark.range(7).write.mode("append").parquet(folder)
        log.wait(run(fails))
    with listener.ProgressLog(spark, root) as log:  # as after a restart of the driver
        log.wait(run(write))
    told = listener.progress(spark, root).where("name = 'told-by-test'")
    assert rows(told.select("batch_id", "input_rows"), "batch_id") == [(0, 5), (1, 7)]
    offsets = rows(told.select(F.col("sources")[0]["startOffset"], F.col("sources")[0]["endOffset"]), "batch_id")
    assert offsets[0][1] == offsets[1][0] is not None
    runs = listener.runs(spark, root).where("name = 'told-by-test'").collect()
    assert len(runs) == 3 and not any(r["active"] for r in runs)
    assert sorted("no luck" in (r["error"] or "") for r in runs) == [False, False, True]
