from __future__ import annotations

import json
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from sparkzone import sharedfs
from sparkzone.operators import gates, integrity
from sparkzone.operators.gates import GateError
from sparkzone.plans import images as im, landing
from sparkzone.queries import images as image_queries, landing as landing_queries
from sparkzone.functions.imagebytes import image_facts
from sparkzone.sources import files, tables
from sparkzone.sources.files import CATALOGUE_COLUMNS, profile_images

from .conftest import rows

DATE = "2026-05-24T10:00:00Z"


def csv(folder, text, name="a.csv", encoding="utf-8"):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(text.encode(encoding))
    return str(folder)


def test_csv_types_encoding_and_partition_like_folders(spark, tmp_path):
    path = csv(tmp_path / "year=2020", 'name,n,x,day,year\n"Málaga, ES",1,1.5,2024-01-01 00:00:00,1999\nb,,2,2024-01-02 00:00:00,2000\n', encoding="latin-1")
    df = tables.read_raw_csv(spark, path, "ISO-8859-1")
    assert df.dtypes == [("name", "string"), ("n", "bigint"), ("x", "double"), ("day", "timestamp"), ("year", "bigint")]
    assert rows(df.select("name", "n", "year"), "year") == [("Málaga, ES", 1, 1999), ("b", None, 2000)]


def test_landing_proves_then_retires(spark, tmp_path):
    raw, target, retired = csv(tmp_path / "raw", "a,b\n1,x\n1,x\n2,\n"), str(tmp_path / "table"), []
    first = landing.land_csv(spark, raw, target, "t", 3, 2, retire=retired.append)
    assert first.written and first.match and retired == [raw]
    assert not landing.land_csv(spark, raw, target, "t", retire=retired.append).written and len(retired) == 2
    with pytest.raises(GateError):
        landing.land_csv(spark, csv(tmp_path / "raw2", "a,b\n1,x\n"), target, "t", expected_rows=2)


def test_edited_and_swapped_copies_are_detected(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c")], "k INT, v STRING")
    edited = df.withColumn("v", F.when(F.col("k") == 3, "C").otherwise(F.col("v")))
    swapped = spark.createDataFrame([(1, "a"), (2, None), (2, None), (3, "c")], "k INT, v STRING")
    assert integrity.compare(df, df.repartition(3))
    assert integrity.compare(df, edited).differences == 2
    assert integrity.compare(df, swapped).differences == 4
    assert not integrity.compare(df, df.withColumnRenamed("v", "w")) and not integrity.compare(df, df.limit(3))
    left = df.exceptAll(swapped).count() + swapped.exceptAll(df).count()
    assert left == 2  # one row too many on either side


def test_discovery_and_path_gates(spark, tmp_path):
    for name in ("b", "a", "raw", "_staging", ".x"):
        csv(tmp_path / name, "x\n1\n")
    assert [p.rsplit("/", 1)[1] for p in tables.discover_datasets(spark, str(tmp_path))] == ["a", "b"]
    (tmp_path / "empty").mkdir()
    with pytest.raises(GateError):
        tables.discover_datasets(spark, str(tmp_path))
    with pytest.raises(GateError):
        gates.require_paths(spark, [str(tmp_path / "raw")])
    with pytest.raises(GateError):
        gates.require_objects(spark, [str(tmp_path / "nowhere")])


def test_pending_files(spark, tmp_path):
    csv(tmp_path / "in", "1", "one.csv"), csv(tmp_path / "in", "2", "two.csv"), csv(tmp_path / "in", "", "none.csv")
    files, manifest = tables.list_files(spark, str(tmp_path / "in")), str(tmp_path / "manifest")
    assert tables.pending(spark, files, manifest).count() == 2
    tables.mark_processed(files.filter(F.endswith("path", F.lit("one.csv"))), manifest)
    assert [r["path"].rsplit("/", 1)[1] for r in tables.pending(spark, files, manifest).collect()] == ["two.csv"]


def test_gates(spark):
    df = spark.createDataFrame([("a\tb", "°C"), ("x", "Â°C")], "t STRING, unit STRING")
    with pytest.raises(GateError):
        gates.require_clean_text(df, "t")
    gates.require_clean_text(df.filter("t = 'x'"), "t")
    assert rows(gates.damaged_units(df)) == [("Â°C", 1)]
    with pytest.raises(GateError):
        gates.require_columns(df, ["z"], "t")
    with pytest.raises(GateError):
        gates.require_not_empty(df.filter("t = 'none'"), "t")


def test_lineage_cut_survives_in_shared_files(spark):
    df = sharedfs.cut_lineage(spark.range(10).withColumn("x", F.col("id") * 2))
    assert df.count() == 10 and "parquet" in df._jdf.queryExecution().executedPlan().toString().lower()


def png(width, height):
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    header = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    pixels = b"".join(b"\0" + b"\1\2\3" * width for _ in range(height))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(pixels)) + chunk(b"IEND", b"")


def test_image_files_to_trusted_catalogue(spark, tmp_path):
    folder = tmp_path / "persistent-landing" / "image"
    folder.mkdir(parents=True)
    (folder / "a_1779580800000.png").write_bytes(png(512, 512))
    (folder / "b.png").write_bytes(png(512, 512))
    (folder / "c.jpg").write_bytes(png(4, 2))
    (folder / "d.png").write_bytes(b"no image")
    (folder / "e.png").write_bytes(b"")
    catalogue = profile_images(spark, str(folder), DATE)
    assert tuple(catalogue.columns) == CATALOGUE_COLUMNS and catalogue.count() == 4
    blob = {r["file_id"]: json.loads(r["metadata_blob"]) for r in catalogue.collect()}
    assert (blob["c.jpg"]["width"], blob["c.jpg"]["height"], blob["c.jpg"]["aspect_ratio"], blob["c.jpg"]["image_mode"]) == (4, 2, 2.0, "RGB")
    assert blob["d.png"]["is_corrupted"] and blob["d.png"]["file_size_bytes"] == 8
    assert profile_images(spark, str(folder), DATE, catalogue.filter("file_id <> 'b.png'")).count() == 1
    out = im.clean_images(catalogue, DATE)
    assert rows(out.valid.select("file_id"), "file_id") == [("a_1779580800000.png",), ("c.jpg",)]
    assert rows(out.rejected.select("id", "reason")) == [("d.png", "corrupted_image")]
    assert rows(out.duplicates.select("file_id", "copies")) == [("b.png", 1)]

    def refuse(source, target):
        raise ValueError("bad pixels")

    results = im.standardize_images(im.work_list(out.valid), "s3://trusted", lambda s, t: None, refuse)
    trusted, failed = im.split_results(results, out.valid, DATE)
    assert [r["status"] for r in trusted.collect()] == ["DIRECT_COPY"]
    assert rows(failed.select("id", "reason")) == [("c.jpg", "FAILED: bad pixels")]
    assert gates.require_image_catalogue(trusted, 1, "s3://trusted/")["catalogue_rows"] == 1
    with pytest.raises(GateError):
        gates.require_image_catalogue(trusted.withColumn("md5", F.lit(None).cast("string")), 1, "s3://trusted/")


def test_image_rejection_order(spark):
    def row(id="i", path="p.jpg", size=1, corrupted=False, md5="m"):
        return (id, path, "Image", json.dumps({"file_size_bytes": size, "is_corrupted": corrupted, "md5": md5}))

    bad = [row(id=None), row(path=None), row(size=0), row(size=None), row(corrupted=True), row(md5=None), row(path="p.gif"), row(corrupted=None), row()]
    out = im.clean_images(spark.createDataFrame(bad, "file_id STRING, file_path STRING, file_type STRING, metadata_blob STRING"), DATE)
    assert sorted(r["reason"] for r in out.rejected.collect()) == sorted(
        ["missing_file_id", "missing_file_path", "empty_or_missing_source_file", "empty_or_missing_source_file", "corrupted_image", "missing_md5",
         "unsupported_extension", "unknown_corruption_state"]
    )
    assert out.valid.count() == 1


def test_side_effects_run_once(spark, tmp_path):
    """Each output of one run is derived from the same, written, outcome."""
    calls = tmp_path / "calls"
    calls.mkdir()

    def note(*what):
        import uuid

        (calls / uuid.uuid4().hex).write_text(" ".join(map(str, what)))

    work = spark.createDataFrame([(str(i), f"p/{i}.png", 512, 512, "RGB") for i in range(6)], "id STRING, file_path STRING, width INT, height INT, image_mode STRING")
    valid = spark.createDataFrame([(str(i), f"p/{i}.png", ("l", "u", 1, "m")) for i in range(6)], "file_id STRING, file_path STRING, meta STRUCT<label STRING, url STRING, file_size_bytes LONG, md5 STRING>")
    results = im.standardize_images(work, "s3://trusted", note, note)
    trusted, failed = im.split_results(results, valid, DATE)
    assert trusted.count() == 6 and failed.count() == 0 and im.status_counts(results).count() >= 1
    assert len(list(calls.iterdir())) == 6

    from sparkzone.operators import vectors as vec

    seen = tmp_path / "seen"
    seen.mkdir()

    def encoder(paths):
        import numpy as np

        for p in paths:
            (seen / p.replace("/", "_")).open("a").write("x")
        return np.ones((len(paths), 2))

    rows_ = vec.encode(work.withColumn("image_path", F.col("file_path")).withColumn("label", F.lit("")), lambda p: p, encoder, 2)
    stored, status = vec.collection_rows(rows_, "s", "m", 2, DATE), vec.status_rows(rows_, "s", "m", 2, "c", DATE)
    assert vec.vector_quality(stored, status, "c", 2, DATE).count() == 6 and stored.count() == 6
    assert [f.read_text() for f in seen.iterdir()] == ["x"] * 6


def test_catalogued_files_are_not_opened(spark, tmp_path):
    folder = tmp_path / "image"
    folder.mkdir()
    (folder / "a.png").write_bytes(png(4, 4))
    (folder / "b.png").write_bytes(png(4, 2))
    first = profile_images(spark, str(folder), DATE)
    first.write.parquet(str(tmp_path / "catalogue"))
    known = spark.read.parquet(str(tmp_path / "catalogue"))
    assert profile_images(spark, str(folder), DATE, known).count() == 0
    (folder / "c.png").write_bytes(png(2, 2))
    again = profile_images(spark, str(folder), DATE, known)
    assert [r["file_id"] for r in again.collect()] == ["c.png"] and len(again.inputFiles()) == 1


def test_csv_columns_go_by_name_and_types_by_all_rows(spark, tmp_path):
    csv(tmp_path / "in", "x,y\n1,10\n2,20\n", "a.csv"), csv(tmp_path / "in", "y,x\n30,3\n", "b.csv"), csv(tmp_path / "in", "x\n4\n", "c.csv")
    read = tables.read_raw_csv(spark, str(tmp_path / "in"))
    assert rows(read.select("x", "y"), "x") == [(1, 10), (2, 20), (3, 30), (4, None)]
    lines = spark.read.parquet("/root/testdata/sf0.1/lineitem.parquet").select(F.col("l_orderkey").cast("string").alias("k")).limit(250_000)
    lines.unionAll(spark.range(1).select(F.lit("1.5").alias("k"))).coalesce(1).write.option("header", True).csv(str(tmp_path / "late"))
    for multi_line in (False, True):
        late = tables.read_raw_csv(spark, str(tmp_path / "late"), multi_line=multi_line)
        assert late.dtypes == [("k", "double")] and late.filter("k = 1.5").count() == 1
    fixed = tables.read_raw_csv(spark, str(tmp_path / "in"), schema="x INT, y DOUBLE")
    assert fixed.dtypes == [("x", "int"), ("y", "double")]


def test_headers_of_many_files_come_from_one_job(spark, tmp_path, monkeypatch):
    for n in range(40):
        text = f"a b,ü\n{n},x{n}\n" if n % 2 else f'\n"ü",a b\nx{n},{n}\n'
        csv(tmp_path / "in", text, f"file {n}%20.csv")
    csv(tmp_path / "in", "\n\n", "blank.csv")
    calls = []
    real = tables._by_first_line
    monkeypatch.setattr(tables, "_by_first_line", lambda *a: calls.append(real(*a)) or calls[-1])
    read = tables.read_raw_csv(spark, str(tmp_path / "in"))
    assert sorted(map(len, calls[0])) == [1, 20, 20]
    assert rows(read.select("a b", "ü"), "a b") == [(n, f"x{n}") for n in range(40)]
    monkeypatch.setattr(tables, "FEW_FILES", 100)
    assert rows(tables.read_raw_csv(spark, str(tmp_path / "in")).select("a b", "ü"), "a b") == [(n, f"x{n}") for n in range(40)]
    assert len(calls) == 1
    (tmp_path / "latin").mkdir()
    for n in range(20):
        (tmp_path / "latin" / f"{n}.csv").write_bytes(f"ä,b\n{n},é\n".encode("latin-1"))
    monkeypatch.setattr(tables, "FEW_FILES", 16)
    assert rows(tables.read_raw_csv(spark, str(tmp_path / "latin"), "ISO-8859-1").select("ä", "b"), "ä") == [(n, "é") for n in range(20)]


def jpeg(width, height, components=3, before=()):
    part = lambda mark, body: bytes([0xFF, mark]) + struct.pack(">H", len(body) + 2) + body
    head = b"".join(part(0xE0 + n % 16, body) for n, body in enumerate(before))
    frame = part(0xC0, struct.pack(">BHHB", 8, height, width, components) + b"\0\0\0" * components)
    return b"\xff\xd8" + head + b"\xff" + part(0xDB, b"\0" * 65) + frame + part(0xDA, b"\0" * 6) + b"\x12\x34" * 40 + b"\xff\xd9"


def bitmap(width, height, bits=24):
    row = (bits * width + 31) // 32 * 4 * abs(height)
    return b"BM" + struct.pack("<IIIIiiHHIIIIII", 54 + row, 0, 54, 40, width, height, 1, bits, 0, 0, 0, 0, 0, 0) + b"\0" * row


def test_image_sizes_come_from_the_bytes(spark):
    whole = {
        "png": (png(300, 70_000 // 300), (300, 233, 3)),
        "jpeg": (jpeg(640, 480), (640, 480, 3)),
        "gray": (jpeg(5, 9, 1), (5, 9, 1)),
        "exif": (jpeg(40_000, 2, 3, [b"\xff\xd8\xff\xc0" * 16_000, b"x", b""] * 5), (40_000, 2, 3)),
        "bmp": (bitmap(17, 4), (17, 4, 3)),
        "upside down": (bitmap(17, -4), (17, 4, 3)),
        "gif": (b"GIF89a" + struct.pack("<HH", 7, 6) + b"\0\0\0;", (7, 6, 3)),
    }
    broken = {
        "cut png": png(9, 9)[:-12],
        "wrong checksum": png(9, 9).replace(struct.pack(">II", 9, 9), struct.pack(">II", 9, 8)),
        "cut jpeg": jpeg(9, 9)[:-2],
        "no size": b"\xff\xd8\xff\xe0\0\x04ab\xff\xd9",
        "four colours": jpeg(9, 9, 4),
        "cut bmp": bitmap(9, 9)[:-1],
        "start only": b"\x89PNG\r\n\x1a\n",
        "text": b"no image",
        "one byte": b"\xff",
    }
    data = [(n, bytearray(b)) for n, b in {**{k: v[0] for k, v in whole.items()}, **broken}.items()]
    found = spark.createDataFrame(data, "name string, content binary").select("name", image_facts(F.col("content")).alias("f")).collect()
    for r in found:
        facts = r["f"] and tuple(r["f"])
        if r["name"] in whole:
            assert facts == whole[r["name"]][1], r["name"]
        else:
            assert facts is None or None in facts, r["name"]


def test_more_new_files_than_paths_are_found_by_their_time(spark, tmp_path, monkeypatch):
    import os

    folder = tmp_path / "im age"
    folder.mkdir()
    for n in range(6):
        (folder / f"a%20 {n}.png").write_bytes(png(4, 4 + n))
        os.utime(folder / f"a%20 {n}.png", (1_700_000_000 + n,) * 2)
    first = profile_images(spark, str(folder), DATE)
    first.write.parquet(str(tmp_path / "catalogue"))
    known = spark.read.parquet(str(tmp_path / "catalogue"))
    monkeypatch.setattr(files, "MAX_PATHS", 1)
    for n, at in (("b", 1_800_000_000), ("c", 1_700_000_003)):
        (folder / f"{n}.png").write_bytes(png(2, 2))
        os.utime(folder / f"{n}.png", (at, at))
    again = profile_images(spark, str(folder), DATE, known)
    assert sorted(r["file_id"] for r in again.collect()) == ["b.png", "c.png"]
    plan = again._jdf.queryExecution().optimizedPlan().toString()
    assert "modificationTime" in plan
    assert profile_images(spark, str(folder), DATE, known.unionByName(again)).count() == 0
    assert profile_images(spark, str(folder), DATE, known.limit(0)).count() == 8


def test_rows_without_their_object_and_a_repeatable_sample(spark):
    files = spark.createDataFrame([("/a", 5), ("/a", 5), ("/b", 0)], "path STRING, length LONG")
    catalogue = spark.createDataFrame([(1, "/a"), (2, "/b"), (3, "/c"), (4, None), (5, "/a")], "id INT, at STRING")
    assert sorted(r["id"] for r in gates.missing_objects(catalogue, files, "at").collect()) == [2, 3, 4]
    assert gates.missing_objects(catalogue.limit(0), files, "at").count() == 0
    assert gates.missing_objects(catalogue, files.limit(0), "at").count() == 5
    assert sorted(gates.sampled_paths(catalogue, "at")) == ["/a", "/b", "/c"]
    assert gates.sampled_paths(catalogue, "at", 2) == gates.sampled_paths(catalogue.repartition(3), "at", 2)


def test_a_single_row_group_is_spread_whatever_its_splits(spark, tmp_path):
    path = str(tmp_path / "one")
    spark.range(0, 40_000, 1, 1).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text")).write.parquet(path)
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {n: spark.conf.get(n) for n in names}
    try:
        for n in names:
            spark.conf.set(n, "65536")
        scan = spark.read.parquet(path)
        held = lambda df: sorted(r["n"] for r in tables.rows_per_partition(df).collect())
        assert scan.rdd.getNumPartitions() >= 4 and held(scan) == [40_000]
        dealt = tables.spread(scan)
        assert len(held(dealt)) >= 4 and max(held(dealt)) < 20_000
        assert sorted(dealt.collect()) == sorted(scan.collect())
    finally:
        for n, value in old.items():
            spark.conf.set(n, value)
    even = spark.range(0, 4_000, 1, 4)
    assert tables.spread(even) is even and tables.spread(even.limit(0)).count() == 0


def suppliers_of_one_task(spark, tmp_path, *more):
    """Forty suppliers in one row group, and the folders that a query over them makes."""
    some = [(k, k % 3, -5.0 if k % 4 == 0 else 5.0) for k in range(40)] + list(more)
    spark.createDataFrame(some, "s_suppkey LONG, s_nationkey INT, s_acctbal DOUBLE").coalesce(1).write.parquet(str(tmp_path / "tables" / "supplier.parquet"))
    return str(tmp_path / "tables"), lambda spark, label: str(tmp_path / label)


def test_objects_of_one_row_group_are_written_by_many_tasks_and_a_key_by_one(spark, tmp_path, monkeypatch):
    folder, new_folder = suppliers_of_one_task(spark, tmp_path, (1, 0, 5.0), (1, 0, 5.0))
    monkeypatch.setattr(sharedfs, "new_folder", new_folder)
    found = rows(image_queries.catalogue_objects(spark, folder), "s_nationkey")
    assert found == [(0, 16, 4, False, True), (1, 13, 3, False, True), (2, 13, 3, False, True)]
    made = [(p.parent.name, p.name[:10]) for p in (tmp_path / "objects").rglob("part-*")]
    assert len(made) == len({key for key, _ in made}) == 30 and len({task for _, task in made}) > 1


def test_image_files_of_one_row_group_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    folder, new_folder = suppliers_of_one_task(spark, tmp_path)
    monkeypatch.setattr(sharedfs, "new_folder", new_folder)
    found = image_queries.image_files_incremental(spark, folder)
    assert {r["run"]: r["n"] for r in found.groupBy("run").agg(F.sum("n").alias("n")).collect()} == {1: 20, 2: 20}
    made = [p.name for p in (tmp_path / "bitmaps" / "landing").glob("part-*") if p.stat().st_size]
    assert len(made) == 40 and len({name[:10] for name in made}) > 1


def test_csv_files_of_one_row_group_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    some = [(k, k % 7, "FOP"[k % 3], k / 4) for k in range(2_400)]
    spark.createDataFrame(some, "o_orderkey LONG, o_custkey LONG, o_orderstatus STRING, o_totalprice DOUBLE").coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    monkeypatch.setattr(sharedfs, "new_folder", lambda spark, label: str(tmp_path / label))
    found = {r["o_orderstatus"]: tuple(r)[1:] for r in landing_queries.csv_many_files(spark, str(tmp_path)).collect()}
    for status in "FOP":
        mine = [r for r in some if r[2] == status]
        price = sum(r[3] for r in mine) if status != "P" else None
        assert found[status] == (800, sum(r[0] for r in mine), sum(r[1] for r in mine), price)
    made = [p for p in (tmp_path / "files" / "raw").glob("part-*")]
    assert len({p.name[:10] for p in made}) > 1 and max(len(p.read_text().splitlines()) for p in made) == 101


def test_many_files_are_listed_and_read_as_few_are(spark, tmp_path, monkeypatch):
    folder = tmp_path / "many files"
    for i in range(20):
        csv(folder, "n,A b\n" + f"{i},x\n{i},\n" if i % 2 else f"A b,n,day\ny,{i},2024-01-0{i % 9 + 1}\n", f"a %20 é{i}.csv")
    for name, text in (("_hidden.csv", "n\n1\n"), (".h.csv", "n\n1\n"), ("_k=1", "n\n1\n"), ("none.csv", "")):
        csv(folder, text, name)
    csv(folder / "k=1", "n\n7\n")
    few, kept = sharedfs.data_files(spark, str(folder)), tables.read_raw_csv(spark, str(folder))
    monkeypatch.setattr(sharedfs, "FEW_ENTRIES", 0)
    monkeypatch.setattr(tables, "MANY_FILES", 0)
    assert len(few) == 20 and sharedfs.data_files(spark, str(folder)) == few and sharedfs.data_files(spark, few[0]) == few[:1]
    again = tables.read_raw_csv(spark, str(folder))
    assert again.schema == kept.schema and rows(again, *again.columns) == rows(kept, *kept.columns) and again.count() == 30


def test_a_folder_of_many_files_is_read_without_naming_them(spark, tmp_path, monkeypatch):
    folder = tmp_path / "many %20 files"
    for i in range(12):
        csv(folder, ("\n  \nB,n\r\n" f'"x,""{i}""",{i}\r\n\t\r\n' "y\u0001z,\r\n") if i % 2 else f"n,day\n{i},2024-01-01\n", f"a é%20{i}.csv")
    csv(folder, "\n", "blank.csv"), csv(folder, "n\n99\n", "_hidden.csv"), csv(folder / "below", "n\n98\n"), csv(folder / "k=1", "n\n97\n")
    kept = tables.read_raw_csv(spark, str(folder))
    assert kept.count() == 18

    def named(*_):
        raise AssertionError("files were named to the driver")

    monkeypatch.setattr(tables, "MANY_FILES", 5)
    monkeypatch.setattr(sharedfs, "data_files", named)
    monkeypatch.setattr(tables, "_by_first_line", named)
    read = tables.read_raw_csv(spark, str(folder))
    assert read.schema == kept.schema and rows(read, *read.columns) == rows(kept, *kept.columns)
    assert {r["B"] for r in read.collect()} == {None, "y\u0001z", *(f'x,"{i}"' for i in range(1, 12, 2))}
    fixed = tables.read_raw_csv(spark, str(folder), schema="n INT")
    assert fixed.dtypes[0] == ("n", "int") and fixed.agg(F.sum("n")).first()[0] == 66
    csv(folder, "n,day\n1,2024-01-01,one too many\n", "broken.csv")
    with pytest.raises(Exception, match="(?i)malformed"):
        tables.read_raw_csv(spark, str(folder)).collect()
