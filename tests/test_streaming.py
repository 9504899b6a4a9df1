from __future__ import annotations

import json
import os

from pyspark.sql import functions as F

from sparkzone.sources.documents import parse_documents
from sparkzone.streaming import events as ev, sinks

from .conftest import rows

GOOD = {"interval": 900, "is_day": 1, "temperature": 20.0, "time": "2024-01-01T10:00:00", "weathercode": 1, "winddirection": 90, "windspeed": 5.0}


def put(folder, name, messages):
    folder.mkdir(exist_ok=True)
    lines = [json.dumps({"topic": t, "partition": i % 2, "offset": i, "value": json.dumps(v)}) for i, (t, v) in enumerate(messages)]
    (folder / name).write_text("\n".join(lines))


def source(spark, folder):
    return spark.readStream.schema("topic STRING, partition INT, offset BIGINT, value STRING").option("maxFilesPerTrigger", 1).json(str(folder))


def weather(**changes):
    return (ev.WEATHER_TOPIC, {**GOOD, **changes})


def test_only_plausible_weather_is_kept(spark, tmp_path):
    bad = [weather(temperature=61), weather(windspeed=-1), weather(winddirection=361), weather(interval=0), weather(time=None), ("other", GOOD)]
    put(tmp_path / "in", "a.json", [weather(), *bad])
    counts = []
    query = sinks.write_batches(
        ev.weather_stream(source(spark, tmp_path / "in")), str(tmp_path / "ck"), sinks.parquet_writer(str(tmp_path / "out")), ev.plausible_weather(),
        on_counts=lambda *c: counts.append(c), available_now=True,
    )
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1 and counts == [(0, 6, 1)]


def test_restart_and_replay_neither_lose_nor_double(spark, tmp_path):
    writer = sinks.parquet_writer(str(tmp_path / "out"))
    calls = []

    def failing(batch, batch_id):
        writer(batch, batch_id)
        calls.append(batch_id)
        if len(calls) == 2:
            raise RuntimeError("killed after the write, before the commit")

    def run(target):
        query = sinks.write_batches(ev.weather_stream(source(spark, tmp_path / "in")), str(tmp_path / "ck"), target, available_now=True)
        try:
            query.awaitTermination()
        except Exception:  # noqa: BLE001 - the failure under test
            pass

    for n in range(3):
        put(tmp_path / "in", f"{n}.json", [weather(weathercode=n * 10 + i) for i in range(4)])
    run(failing)
    run(writer)
    put(tmp_path / "in", "9.json", [weather(weathercode=99)])
    run(writer)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == 13 and out.select("weathercode").distinct().count() == 13


def test_stations_are_exploded(spark, tmp_path):
    snapshot = [{"id": i, "name": f"s{i}", "country": {"name": "Spain"}, "coordinates": {"latitude": 1.5}, "datetimeFirst": {"local": "x"}} for i in (1, 2)]
    put(tmp_path / "in", "a.json", [(ev.STATION_TOPIC, snapshot), (ev.STATION_TOPIC, []), weather()])
    stream = ev.station_stream(source(spark, tmp_path / "in"))
    assert len(stream.columns) == 14
    sinks.append_files(stream, str(tmp_path / "out"), str(tmp_path / "ck"), available_now=True).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert rows(out.select("station_id", "country", "latitude", "datetimeFirst"), "station_id") == [(1, "Spain", 1.5, "x"), (2, "Spain", 1.5, "x")]


def test_hours_close_with_the_watermark(spark, tmp_path):
    hours = [weather(time=f"2024-01-01T{h:02d}:30:00", temperature=float(h)) for h in (1, 1, 2, 6)]
    put(tmp_path / "in", "a.json", hours)
    put(tmp_path / "in", "b.json", [weather(time="2024-01-01T06:40:00")])
    put(tmp_path / "in", "c.json", [weather(time="2024-01-01T01:10:00")])  # too late
    for age, name in enumerate(("c.json", "b.json", "a.json")):
        os.utime(tmp_path / "in" / name, (1_700_000_000 - 100 * age,) * 2)
    stream = ev.hourly_stream(ev.weather_stream(source(spark, tmp_path / "in")))
    query = sinks.append_files(stream, str(tmp_path / "out"), str(tmp_path / "ck"), available_now=True)
    query.awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert rows(out.select(F.hour("hour_start"), "observation_count"), "hour_start") == [(1, 2), (2, 1)]
    assert sinks.status(query)["active"] is False


def test_landing_is_named_by_offsets(spark, tmp_path):
    put(tmp_path / "in", "a.json", [weather(weathercode=i) for i in range(5)])
    for run in ("one", "two"):  # a second run from scratch writes the same names
        sinks.land_kafka(source(spark, tmp_path / "in"), str(tmp_path / "land"), "weather", "2026-05-24", str(tmp_path / f"ck-{run}"), available_now=True).awaitTermination()
    audit = spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path / "land" / "_audit")).first()
    assert json.loads(audit["ranges"]) == [{"partition": 0, "start": 0, "end": 4}, {"partition": 1, "start": 1, "end": 3}]
    assert audit["label"].startswith("p0-1_") and audit["rows"] == 5
    assert parse_documents(spark, str(tmp_path / "land" / "weather")).docs.count() == 5


def test_a_replayed_batch_leaves_the_table_as_it_was(spark):
    table, calls = [], []

    def forget(session, url, name, properties, batch_id):
        calls.append((url, name, batch_id))
        table[:] = [r for r in table if r["batch_id"] != batch_id]

    writer = sinks.jdbc_writer("jdbc:x", "t", {"user": "u"}, forget, lambda df: table.extend(df.collect()))
    for batch_id in (0, 1, 1, 0):
        writer(spark.range(3), batch_id)
    assert sorted((r["batch_id"], r["id"]) for r in table) == [(b, i) for b in (0, 1) for i in range(3)] and len(calls) == 4
