"""Silver versions: staged, sealed in one step, merged and cleared."""

from __future__ import annotations

import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from layerwise.config import Settings
from layerwise.plans import daily
from layerwise.sources import layers, versions

SCHEMA = "part_date string, src_file string, id int"


def put(spark, path, data, version=None, files=None):
    version = version or versions.new_version()
    df = spark.createDataFrame(data, SCHEMA) if data else None
    if df is not None:
        versions.stage(df, path, version)
    versions.commit(spark, path, version, spark.createDataFrame(files or [d[:2] for d in data], "part_date string, src_file string"))
    return version


def current(spark, path, date=None):
    found = versions.read_current(spark, path, date)
    return None if found is None else rows(found.select("part_date", "src_file", "id"))


def test_files_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "Device")
    assert current(spark, path) is None and versions.file_versions(spark, path) is None
    put(spark, path, [("20250416", "a", 1), ("20250416", "b", 2), ("20250417", "a", 3)])
    put(spark, path, [("20250416", "b", 4), ("20250416", "b", 5)])
    assert current(spark, path) == [("20250416", "a", 1), ("20250416", "b", 4), ("20250416", "b", 5), ("20250417", "a", 3)]
    assert current(spark, path, "20250417") == [("20250417", "a", 3)]
    put(spark, path, [], files=[("20250416", "b")])
    assert current(spark, path, "20250416") == [("20250416", "a", 1)]
    put(spark, path, [], files=[("20250416", "a")])
    assert current(spark, path, "20250416") is None
    assert current(spark, path) == [("20250417", "a", 3)]


def test_what_is_not_sealed_is_not_read(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "Device")
    put(spark, path, [("20250416", "a", 1)])
    staged = versions.new_version()
    versions.stage(spark.createDataFrame([("20250416", "a", 2)], SCHEMA), path, staged)
    assert current(spark, path) == [("20250416", "a", 1)]
    with monkeypatch.context() as patch:
        patch.setattr(versions, "seal", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            versions.commit(spark, path, staged, spark.createDataFrame([("20250416", "a")], "part_date string, src_file string"))
    assert current(spark, path) == [("20250416", "a", 1)]
    assert versions.drop_replaced(spark, path) == []
    versions.seal(spark, path, staged)
    assert current(spark, path) == [("20250416", "a", 2)]


def test_versions_are_merged_and_cleared(spark, tmp_path):
    path = str(tmp_path / "Device")
    old = [put(spark, path, [("20250416", f"f{k}", k)]) for k in range(4)]
    old.append(put(spark, path, [("20250416", "f1", 9)]))
    before = current(spark, path)
    merged = versions.merge_versions(spark, path, "20250416")
    assert current(spark, path) == before
    folder = tmp_path / "Device" / "part_date=20250416" / f"part_version={merged}"
    assert len(list(folder.glob("part-*.parquet"))) == 1
    assert versions.drop_replaced(spark, path) == sorted(old)
    assert current(spark, path) == before
    assert os.listdir(folder.parent) == [folder.name]
    assert versions.merge_versions(spark, path, "20250417") is None


def test_columns_may_differ_between_versions(spark, tmp_path):
    path = str(tmp_path / "Device")
    put(spark, path, [("20250416", "a", 1)])
    version = versions.new_version()
    wider = spark.createDataFrame([("20250416", "b", 2, "x")], SCHEMA + ", extra string")
    versions.stage(wider, path, version)
    versions.commit(spark, path, version, wider.select("part_date", "src_file"))
    found = versions.read_current(spark, path)
    assert rows(found.select("id", "extra")) == [(1, None), (2, "x")]


def test_a_run_that_breaks_off_leaves_silver_as_it_was(spark, tmp_path, monkeypatch):
    layout = daily.Layout(**{n: str(tmp_path / n) for n in ("landing", "raw", "silver", "gold", "logs")}, brands={}, schemas={}, rules={})
    settings = Settings(expected_tables=("Device",))
    os.mkdir(layout.landing)

    def land(text):
        (tmp_path / "landing" / "North TV_Device_20250416.csv").write_text(text)

    def silver():
        return rows(versions.read_current(spark, f"{layout.silver}/Device", "20250416").select("a", "b"))

    land("a,b\n1,2\n3,4\n")
    daily.landing_to_silver(spark, layout, settings, copy_raw=False)
    assert silver() == [("1", "2"), ("3", "4")]
    land("a,b\n5,6\n7,8,9\n")
    with monkeypatch.context() as patch:
        patch.setattr(versions, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            daily.landing_to_silver(spark, layout, settings, copy_raw=False)
    assert silver() == [("1", "2"), ("3", "4")]
    daily.landing_to_silver(spark, layout, settings, copy_raw=False)
    assert silver() == [("5", "6")]
    rejects = f"{layout.logs}/landing_rejects/Device"
    assert rows(versions.read_current(spark, rejects).select("record")) == [("7,8,9",)]
    land("a,b\n5,6\n")
    daily.landing_to_silver(spark, layout, settings, copy_raw=False)
    assert versions.read_current(spark, rejects) is None


def test_stream_enters_files_it_cannot_read(spark, tmp_path):
    from layerwise.streaming.arrivals import stream_to_gold

    landing = tmp_path / "landing"
    landing.mkdir()
    layout = daily.Layout(**{n: str(tmp_path / n) for n in ("landing", "raw", "silver", "gold", "logs")}, brands={}, schemas={}, rules={})
    settings = Settings(expected_tables=("Device",))
    (landing / "North TV_Device_20250416.csv").write_text("a,b\n1,2\n")
    (landing / "South TV_Device_20250416.csv").write_bytes("a,b\n1,é\n".encode("latin-1"))
    stream_to_gold(spark, layout, settings, str(tmp_path / "cp")).awaitTermination()
    ledger = layers.read_log(spark, layout.logs, "ledger")
    assert rows(ledger.select("table_name", "filedate", "status")) == [("Device", "20250416", "failed")]
    gold = layers.read_layer(spark, layout.gold, "Device", "20250416")
    assert rows(gold.select("a", "b", F.col("src_brand"))) == [("1", "2", "North TV")]


def test_upsert_rewrites_only_files_with_its_keys(spark, tmp_path):
    path, date = str(tmp_path / "Device"), "20250416"
    version = versions.new_version()
    data = [(date, f"f{k // 10}", k, f"v{k}", "x") for k in range(50)]
    df = spark.createDataFrame(data, "part_date string, src_file string, id int, v string, w string")
    versions.stage(df, path, version)
    versions.commit(spark, path, version, df.select("part_date", "src_file"))
    source = spark.createDataFrame([(3, "old", 1), (3, "new", 2), (27, "new", 1), (77, "more", 1), (None, "no key", 1)], "id int, v string, at int")
    done = versions.upsert_files(spark, path, date, source, ["id"], latest="at")
    assert (done.files, done.rewritten, done.inserted) == (5, 2, 2)
    found = {r["id"]: (r["v"], r["w"]) for r in versions.read_current(spark, path, date).where("id IS NOT NULL").collect()}
    assert found == {k: (f"v{k}", "x") for k in range(50)} | {3: ("new", "x"), 27: ("new", "x"), 77: ("more", None)}
    current = versions.file_versions(spark, path, date).where("current").groupBy("part_version").count()
    assert sorted(r["count"] for r in current.collect()) == [3, 3]
    again = versions.upsert_files(spark, path, date, source.where("id = 77").drop("at"), ["id"])
    assert (again.files, again.rewritten, again.inserted) == (6, 1, 0)
    with pytest.raises(ValueError, match="nothing"):
        versions.upsert_files(spark, path, "20250417", source, ["id"], latest="at")
