"""Streams run to completion with availableNow."""

from __future__ import annotations

from conftest import rows
from pyspark.sql import functions as F

from layerwise.config import Settings
from layerwise.plans.daily import Layout
from layerwise.sources import layers
from layerwise.streaming.arrivals import drop_late_repeats, stream_to_gold


def run(query):
    query.awaitTermination(300)
    assert query.exception() is None and not query.isActive


def test_new_files_reach_gold_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    folders = {n: str(tmp_path / n) for n in ("landing", "raw", "silver", "gold", "logs")}
    layout = Layout(**folders, brands={}, schemas={}, rules={})
    settings = Settings(expected_tables=("Device",))
    checkpoint = str(tmp_path / "checkpoint")

    def go():
        run(stream_to_gold(spark, layout, settings, checkpoint, reference="20250416"))

    def gold():
        found = layers.read_layer(spark, layout.gold, "Device")
        return rows(found.groupBy("part_date", "BRAND").agg(F.count("*").alias("n")))

    (landing / "North TV_Device_20250416.csv").write_text("a,b\n1,2\n3,4\n")
    (landing / "North TV_Device_20250401.csv").write_text("a,b\n1,2\n")
    (landing / "notes.txt").write_text("x")
    go()
    assert gold() == [("20250416", "North TV", 2)]
    go()
    assert gold() == [("20250416", "North TV", 2)]
    (landing / "South+ One_Device_20250416.csv").write_text("b;c\n9;8\n")
    go()
    assert gold() == [("20250416", "North TV", 2), ("20250416", "South+ One", 1)]
    # another brand with the same slug does not replace it
    (landing / "South One_Device_20250416.csv").write_text("b,c\n7,6\n")
    go()
    wanted = [("20250416", "North TV", 2), ("20250416", "South One", 1), ("20250416", "South+ One", 1)]
    assert gold() == wanted
    # a lost checkpoint replays all files without changing the layers
    checkpoint = str(tmp_path / "other")
    go()
    assert gold() == wanted


def test_repeats_are_dropped_within_the_window(spark, tmp_path):
    source = str(tmp_path / "in")
    data = [(1, "2025-04-16 00:00:00"), (1, "2025-04-16 05:00:00"), (2, "2025-04-16 01:00:00")]
    df = spark.createDataFrame(data, "k int, t string").select("k", F.col("t").cast("timestamp_ntz").alias("t"))
    df.write.parquet(source)
    stream = drop_late_repeats(spark.readStream.schema(df.schema).parquet(source), ["k"], "t")
    query = (
        stream.writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start()
    )
    run(query)
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2]


def test_a_brand_in_two_batches_is_logged_whole_and_loaded(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    folders = {n: str(tmp_path / n) for n in ("landing", "raw", "silver", "gold", "logs")}
    layout = Layout(**folders, brands={}, schemas={}, rules={})
    settings = Settings(expected_tables=("Device", "User"), target_names={"Device": "S_DEVICE", "User": "S_USER"})
    for name in ("S_DEVICE", "S_USER"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    checkpoint = str(tmp_path / "checkpoint")
    for name in ("North TV_Device_20250416.csv", "North TV_User_20250416.csv"):
        (landing / name).write_text("a,b\n1,2\n3,4\n")
        run(stream_to_gold(spark, layout, settings, checkpoint, load=True))
    log = layers.read_log(spark, layout.logs, "raw_logs")
    assert rows(log.select("file_count", "status")) == [(1, "Partial"), (2, "OK")]
    last = log.orderBy(F.desc("process_date")).first()
    assert (last.file_count, last.status) == (2, "OK")
    assert spark.table("S_DEVICE").count() == spark.table("S_USER").count() == 2
    ledger = layers.read_log(spark, layout.logs, "ledger")
    assert rows(ledger.select("table_name", "status")) == [("Device", "success"), ("User", "success")]
