"""New files as a stream, and duplicate events within a bounded window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from layerwise.config import Settings
from layerwise.functions.names import decode_file_name, parse_source_name
from layerwise.operators import presence
from layerwise.operators.incremental import in_window, ledger_entry
from layerwise.plans.daily import Layout, gold_to_target, landing_to_silver, silver_to_gold
from layerwise.sources import layers
from layerwise.sources.landing import csv_glob, file_inventory


def arriving_files(spark: SparkSession, landing: str, max_files: int = 1000) -> DataFrame:
    """Stream of new landing files: names only, contents are not read."""
    files = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", csv_glob())
        .option("maxFilesPerTrigger", max_files)
        .load(landing)
    )
    name = decode_file_name(F.col("_metadata.file_name"))
    named = files.select(
        "path", name.alias("file_name"), F.col("modificationTime").alias("modified_at")
    )
    parsed = parse_source_name(F.col("file_name"))
    return named.select(
        "path",
        "file_name",
        "modified_at",
        parsed["brand"].alias("brand"),
        parsed["table"].alias("table_name"),
        parsed["filedate"].alias("filedate"),
    ).filter("filedate IS NOT NULL")


def stream_to_gold(
    spark: SparkSession,
    layout: Layout,
    settings: Settings,
    checkpoint: str,
    reference: str | None = None,
    load: bool = False,
) -> StreamingQuery:
    """Bring newly landed files to gold, then stop: one ``availableNow`` run.

    With ``load`` the touched table dates go on to their targets, each with its ledger entry. A
    table date of which a file cannot be read is entered as failed, with or without ``load``; the
    file's next delivery makes another entry.
    The raw log of a touched brand and date covers all its files in the landing folder, those
    of earlier micro-batches too.

    Each micro-batch (at most ``maxFilesPerTrigger`` names) rewrites the silver partitions of
    its files and then the gold partitions of the touched table dates, so a repeated batch
    changes nothing. With a reference date, files older than the lookback window are left to
    an explicit rerun.
    """
    arrivals = arriving_files(spark, layout.landing)
    if reference:
        arrivals = arrivals.filter(
            in_window(F.col("filedate"), reference, settings.lookback_days)
        )

    def to_gold(batch: DataFrame, batch_id: int) -> None:
        paths = [row.path for row in batch.select("path").collect()]
        if not paths:
            return
        session = batch.sparkSession
        files = landing_to_silver(session, layout, settings, paths=paths, log_raw=False)
        _log_raw(session, layout, settings, files)
        touched = files.groupBy("table_name", "filedate").agg(F.bool_and("valid").alias("readable"))
        for table, date, readable in touched.collect():
            silver_to_gold(session, layout, table, date, files)
            number = gold_to_target(session, layout, settings, table, date) if load else None
            if load or not readable:
                status = "failed" if not readable else "no_data" if number is None else "success"
                layers.append_log(ledger_entry(session, date, status, table), layout.logs, "ledger")

    return (
        arrivals.writeStream.foreachBatch(to_gold)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _log_raw(spark: SparkSession, layout: Layout, settings: Settings, files: DataFrame) -> None:
    """Raw-log rows of the brands and dates that a micro-batch touched, over all their files."""
    touched = files.select("brand", "filedate").distinct()
    for row in touched.select("filedate").distinct().collect():
        listed = file_inventory(spark, layout.landing, csv_glob(row.filedate))
        named = listed.select(parse_source_name(F.col("file_name")).alias("n")).select(
            F.col("n.brand").alias("brand"), F.col("n.table").alias("table_name"), F.col("n.filedate").alias("filedate")
        )
        present = named.filter("brand <> '' AND table_name <> ''").join(touched, ["brand", "filedate"], "left_semi")
        log = presence.raw_log(present, settings.expected_tables).withColumn("reseller", F.lit(""))
        layers.append_log(log.withColumn("process_date", F.current_timestamp()), layout.logs, "raw_logs")


def drop_late_repeats(
    events: DataFrame, keys: Sequence[str], event_time: str, lookback_days: int = 3
) -> DataFrame:
    """First event per key of a stream, with state kept for the lookback window only."""
    kind = events.schema[event_time].dataType.simpleString()
    if kind == "timestamp_ntz":
        events = events.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return events.withWatermark(event_time, f"{lookback_days} days").dropDuplicatesWithinWatermark(
        list(keys)
    )
