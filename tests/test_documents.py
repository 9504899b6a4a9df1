from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import functions as F

from sparkzone.functions.times import elapsed_days, event_time, file_epoch
from sparkzone.plans import stations as st
from sparkzone.plans.documents import clean_documents, write_documents
from sparkzone.sources.documents import parse_documents
from sparkzone.sources.files import profile_json_files

from .conftest import rows

DATE = "2026-05-24T10:00:00Z"


def station(number, **changes):
    record = {
        "id": number,
        "name": f" Station {number} ",
        "locality": "Barcelona",
        "country": {"id": 7, "code": "ES", "name": "Spain"},
        "owner": {"id": 1, "name": "O"},
        "provider": {"id": 2, "name": "P"},
        "coordinates": {"latitude": 41.5, "longitude": 2.0},
        "isMobile": False,
        "sensors": [{"id": 10, "name": "pm", "parameter": {"id": 3, "name": "pm25", "units": "µg", "displayName": "PM2.5"}}],
        "instruments": "none",
        "licenses": [],
        "datetimeFirst": {"utc": "2024-01-01T23:50:00Z", "local": "x"},
        "datetimeLast": {"utc": "2024-01-02T00:10:00Z", "local": "y"},
    }
    record.update(changes)
    return {k: v for k, v in record.items() if v is not None}


def write(folder, **files):
    for name, text in files.items():
        (folder / name.replace("__", ".")).write_text(text)
    return str(folder)


def test_every_shape_of_file(spark, tmp_path):
    path = write(
        tmp_path,
        object__json=json.dumps(station(1)),
        list__json=json.dumps([station(2), station(3)]),
        nested__json=json.dumps([[station(4)], [station(5)]]),
        lines__ndjson="\n".join(json.dumps(station(i)) for i in (6, 7)) + "\n",
        broken__json='{"id": 1',
        halfbroken__ndjson='{"id": 8}\n{"id"',
        scalar__json="17",
        ignored__txt="{}",
    )
    parsed = parse_documents(spark, path)
    out = clean_documents(parsed.docs, "airquality-barcelona", DATE)
    assert sorted(int(r[0]) for r in out.valid.select(F.col("doc")["id"]).collect()) == [1, 2, 3, 4, 5, 6, 7]
    assert sorted(r[0].rsplit("/", 1)[1] for r in parsed.malformed.select("source_file_path").collect()) == ["broken.json", "halfbroken.ndjson", "scalar.json"]


def test_files_of_several_lines(spark, tmp_path):
    path = write(
        tmp_path,
        pretty__json=json.dumps(station(1), indent=2),
        list__json=json.dumps([station(2), station(3)], indent=1),
        nested__json=json.dumps([[station(4)], [station(5)]], indent=1),
        inline__json="\n".join(json.dumps(station(i)) for i in (6, 7)),
        lines__ndjson="\n\n".join(json.dumps(station(i)) for i in (8, 9)) + "\n",
        single__ndjson=json.dumps([station(10), station(11)]),
        scalars__ndjson="1\n2\n",
        scalar__ndjson="1\n",
        # Good and complete lines beside a broken one: none of them may come through.
        half__ndjson=json.dumps(station(12)) + "\n" + json.dumps(station(13)) + '\n{"id"',
        half__json=json.dumps(station(14)) + '\n{"id"',
        broken__json='{\n"id":\n1\n',
    )
    parsed = parse_documents(spark, path)
    assert parsed.docs.count() == 13
    out = clean_documents(parsed.docs.filter("record like '%id%'"), "airquality-barcelona", DATE)
    assert sorted(int(r[0]) for r in out.valid.select(F.col("doc")["id"]).collect()) == list(range(1, 12))
    bad = [r[0].rsplit("/", 1)[1] for r in parsed.malformed.select("source_file_path").collect()]
    assert sorted(bad) == ["broken.json", "half.json", "half.ndjson", "scalar.ndjson"]


def docs(spark, *records):
    return spark.createDataFrame([("f", json.dumps(r)) for r in records], "source_file_path STRING, record STRING")


def test_fields_are_cleaned_and_flattened(spark):
    out = clean_documents(docs(spark, station(1, **{"Extra Key!": " X "})), "airquality-barcelona", DATE).valid
    doc = out.first()["doc"]
    assert doc["name"] == "station 1" and doc["country_name"] == "spain" and doc["country_code"] == "es"
    assert doc["latitude"] == "41.5" and doc["ismobile"] == "false" and doc["extra_key"] == "x"
    assert json.loads(doc["sensors"])[0]["parameter"]["displayName"] == "PM2.5"  # nested values keep their case


def test_a_later_key_wins(spark):
    out = clean_documents(docs(spark, {"a b": "first", "A-B": "second", "time": "t", "temperature": 1}), "weather-barcelona", DATE).valid
    assert out.first()["doc"]["a_b"] == "second"


def test_text_that_looks_nested_is_still_text(spark):
    out = clean_documents(docs(spark, {"time": "[T] ", "temperature": 1}), "weather-barcelona", DATE).valid
    assert out.first()["doc"]["time"] == "[t]"


def test_required_fields(spark):
    out = clean_documents(docs(spark, {"time": "t", "temperature": None}, {"time": "t"}, {"time": "t", "temperature": 0}), "weather-barcelona", DATE)
    assert out.valid.count() == 1 and out.rejected.count() == 2
    assert {tuple(r[0]) for r in out.rejected.select("record_keys").collect()} == {("temperature", "time"), ("time",)}


def test_daily_partition_is_replaced(spark, tmp_path):
    good = {"time": "t", "temperature": 1}
    for count in (3, 2):
        write_documents(clean_documents(docs(spark, *[good] * count), "weather-barcelona", DATE), "weather-barcelona", str(tmp_path))
    write_documents(clean_documents(docs(spark, good), "weather-barcelona", "2026-05-25"), "weather-barcelona", str(tmp_path))
    table = spark.read.parquet(str(tmp_path / "weather_barcelona"))
    assert rows(table.groupBy("trusted_partition_date").count(), "trusted_partition_date") == [(20260524, 2), (20260525, 1)]


def test_lower_cased_timestamps_parse(spark):
    df = spark.createDataFrame([("2024-01-01t10:15",), ("2024-01-01t10:15:00z",), ("soon",), (None,)], "t STRING")
    parsed = [r[0] for r in df.select(F.date_format(event_time(F.col("t")), "yyyy-MM-dd HH:mm")).collect()]
    assert parsed == ["2024-01-01 10:15", "2024-01-01 10:15", None, None]


def test_elapsed_days_are_not_calendar_days(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 23, 50), datetime(2024, 1, 2, 0, 10)), (datetime(2024, 1, 2), datetime(2024, 1, 1, 23))], "a TIMESTAMP, b TIMESTAMP")
    assert [r[0] for r in df.select(elapsed_days(F.col("a"), F.col("b"))).collect()] == [0, -1]


def test_epoch_in_file_names(spark):
    df = spark.createDataFrame([("x_1779580800000.jpg",), ("x_1779580800.jpg",), ("x_abc.jpg",)], "n STRING")
    seen = [r[0] for r in df.select(F.date_format(file_epoch(F.col("n"), DATE), "yyyy-MM-dd HH:mm")).collect()]
    assert seen == ["2026-05-24 00:00", "2026-05-24 00:00", "2026-05-24 10:00"]


def test_station_assets(spark):
    records = [station(1), station(1, name="zzz"), station(2, country=None, instruments=[{"id": 5, "name": "i"}])]
    assets = st.station_assets(clean_documents(docs(spark, *records), "airquality-barcelona", DATE).valid)
    assert rows(assets["dim_station"].select("station_id", "station_name", "country_id", "sensor_count", "instrument_count"), "station_id") == [
        (1, "station 1", 7, 1, 0), (2, "station 2", None, 1, 1),
    ]
    assert rows(assets["fact_station_availability"].select("station_id", "active_days"), "station_id") == [(1, 0), (2, 0)]
    assert assets["bridge_station_sensor"].count() == 2 and assets["dim_license"].count() == 0
    catalog = assets["mart_station_sensor_catalog"]
    assert rows(catalog.select("station_id", "country_name", "parameter_display_name"), "station_id") == [(1, "Spain", "PM2.5"), (2, None, "PM2.5")]


def test_missing_keys_match_missing_keys(spark):
    records = [station(1, country={"name": "Nowhere"}), station(2)]
    assets = st.station_assets(clean_documents(docs(spark, *records), "airquality-barcelona", DATE).valid)
    catalog = assets["mart_station_sensor_catalog"]
    assert rows(catalog.select("station_id", "country_name"), "station_id") == [(1, "Nowhere"), (2, "Spain")]


def test_latest_weather_ignores_missing_times(spark):
    records = [
        {"time": "2024-01-01T10:00", "temperature": 5, "weathercode": 45, "windspeed": 1.5, "is_day": 1},
        {"time": "later", "temperature": 9, "weathercode": 200, "windspeed": 2.5, "is_day": 0},
    ]
    stations = st.station_frame(clean_documents(docs(spark, station(1)), "airquality-barcelona", DATE).valid)
    assets = st.weather_assets(clean_documents(docs(spark, *records), "weather-barcelona", DATE).valid)
    dims = st.dim_station(stations), st.dim_sensor(stations), st.dim_named(stations, "provider"), st.dim_named(stations, "owner")
    row = st.mart_environment_overview(*dims, assets["mart_weather_timeseries"], "Barcelona").first()
    assert (row["latest_temperature"], row["latest_weather_description"], row["avg_temperature"], row["station_count"]) == (5.0, "Fog", 7.0, 1)
    summary = rows(assets["mart_weather_summary"].select("observation_hour", "observation_count"), "observation_hour")
    assert summary == [(None, 1), (10, 1)]
    assert rows(assets["dim_weather_code"], "weathercode") == [(45, "Fog"), (200, "Unknown")]


def test_json_catalogue_skips_known_files(spark, tmp_path):
    path = write(tmp_path, a__json=json.dumps([[{"k": 1, "l": 2}, {"k": 2}], [{"k": 3}]]), b__json="[]", c__json='{"z": 1, "y": 2}')
    first = profile_json_files(spark, path, "weather", DATE)
    found = {r["file_id"]: (r["record_count"], json.loads(r["metadata_blob"])) for r in first.collect()}
    assert found["a.json"][0] == 3 and found["a.json"][1]["nesting_level"] == 2 and found["a.json"][1]["schema_keys"] == ["k", "l"]
    assert found["b.json"][1]["nesting_level"] == 0 and found["c.json"][0] == 1
    first.write.parquet(str(tmp_path / "catalogue"))
    write(tmp_path, d__json="{}")
    again = profile_json_files(spark, path, "weather", DATE, spark.read.parquet(str(tmp_path / "catalogue")))
    assert [r["file_id"] for r in again.collect()] == ["d.json"]


def test_a_rerun_leaves_the_same_rejects(spark, tmp_path):
    good, bad = {"time": "2024-01-01T10:00:00Z", "temperature": 1.0}, {"time": "2024-01-01T10:00:00Z"}
    path = f"{tmp_path}/weather_barcelona_rejected"
    for _ in range(2):
        write_documents(clean_documents(docs(spark, good, bad), "weather-barcelona", DATE), "weather-barcelona", str(tmp_path))
        assert spark.read.parquet(path).count() == 1
    write_documents(clean_documents(docs(spark, good), "weather-barcelona", DATE), "weather-barcelona", str(tmp_path))
    assert spark.read.parquet(path).count() == 0


def test_shape_files_follow_the_table(spark, monkeypatch):
    from sparkzone.queries import QUERIES, SQL, documents

    from .oracle import compare, connect

    folder = "/root/testdata/sf0.001"
    monkeypatch.setattr(documents, "PER_FILE", 20, raising=False)
    root = documents._shape_files(spark, folder)
    users = spark.read.parquet(f"{folder}/conversations.parquet").where("role = 'user'").count()
    for name in ("list.json", "nested.json", "broken.json"):
        texts = [r[0] for r in spark.read.text(f"{root}/{name}", wholetext=True).collect()]
        assert len(texts) > users // 40 and max(t.count("conv_id") for t in texts) < max(100, users // 2)
    for name in ("doc_multiline_files", "json_file_catalogue"):
        assert compare(QUERIES[name](spark, folder), connect(folder), SQL[name]) is None


def test_keys_cleaned_together_as_one_by_one(spark):
    """Plain keys are cleaned in one text; odd ones, among them the mark between keys, one by one."""
    from sparkzone.plans.documents import normalize_records

    records = [
        '{"ID": 1, "isMobile": "  Yes ", "a1": null}',
        '{" Key One ": "X", "b,c": "{not json", "\\u00e9t\\u00e9": [1, 2]}',
        '{"a\\u0001b": "x", "c": "y"}',
        '{"A": "first", "a": "second"}',
        "{}",
    ]
    docs = spark.createDataFrame([(str(i), r) for i, r in enumerate(records)], "source_file_path STRING, record STRING")
    found = {r["source_file_path"]: r["doc"] for r in normalize_records(docs, False).collect()}
    assert found == {
        "0": {"id": "1", "ismobile": "yes", "a1": None},
        "1": {"key_one": "x", "b_c": "{not json", "t": "[1,2]"},
        "2": {"a_b": "x", "c": "y"},
        "3": {"a": "second"},
        "4": {},
    }


def _json_parses(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("from_json(")


def test_each_json_text_is_parsed_once(spark, tmp_path):
    from sparkzone.plans import stations as st
    from sparkzone.sources.documents import flatten_snapshots

    records = [("p", '{"id": 1}'), ("q", '[{"id": 2}, 5]'), ("r", '[[{"id": 3}], {"id": 4}]'), ("s", "7")]
    docs = spark.createDataFrame(records, "source_file_path STRING, record STRING")
    flat = flatten_snapshots(docs)
    # The list itself, and the lists within it.
    assert _json_parses(flat) == 2
    assert sorted(r["record"] for r in flat.collect()) == ['{"id": 1}', '{"id":2}', '{"id":3}', '{"id":4}']

    maps = spark.sql("""select map('id', '7', 'name', 'x', 'sensors', '[{"id": 1}]') as doc""")
    st.station_frame(maps).write.parquet(f"{tmp_path}/frame")
    marts = st.station_marts(spark.read.parquet(f"{tmp_path}/frame"))
    assert _json_parses(marts["mart_station_sensor_catalog"]) == 0
    assert [tuple(r) for r in marts["bridge_station_sensor"].collect()] == [(7, 1)]


def test_a_list_of_stations_is_parsed_once_per_asset(spark):
    """An exploded column is also filtered; where it's an expression, that parses it again."""
    doc = {"id": "7", "name": "x", "sensors": '[{"id": 1}, {"id": 1}]', "instruments": '[{"id": 5, "name": "i"}, null]', "licenses": "none"}
    frame = st.station_frame(spark.createDataFrame([(doc,), ({"id": "8"},)], "doc map<string,string>"))
    found = {}
    for array, name in (("sensors", "sensor"), ("instruments", "instrument"), ("licenses", "license")):
        dimension = st.dim_sensor(frame) if name == "sensor" else st.dim_item(frame, array, name)
        bridge = st.bridge_station(frame, array, name)
        assert _json_parses(dimension) == 1 and _json_parses(bridge) == 1
        found[name] = rows(dimension.select(f"{name}_id"), f"{name}_id"), rows(bridge, f"{name}_id")
    assert found == {"sensor": ([(1,)], [(7, 1)]), "instrument": ([(None,), (5,)], [(7, None), (7, 5)]), "license": ([], [])}


def test_a_record_is_cleaned_in_one_step(spark):
    """A payload is copied for itself, its check, its records, its stations and their maps, not for each value in between."""
    from sparkzone.plans.documents import normalize_records
    from sparkzone.sources.documents import parse_payloads

    record = json.dumps(station(1, country_name="own", Locality="later", note="[T] ", **{"A b": 1, "a-B": 2}))
    payloads = spark.createDataFrame([("a", record), ("b", f"[[{record}], {record}]"), ("c", f"{record} x")], "source_file_path STRING, payload STRING")
    found = normalize_records(parse_payloads(payloads).docs, True)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Generate explode") <= 5
    docs = {r["source_file_path"]: r["doc"] for r in found.collect()}
    assert sorted(docs) == ["a", "b"] and found.count() == 3
    picked = ("country_name", "country_code", "locality", "note", "a_b", "latitude", "owner_id", "instruments")
    for doc in docs.values():
        assert [doc[k] for k in picked] == ["spain", "es", "later", "[t]", "2", "41.5", "1", "none"]
