"""Which dates and files to process, keep or clean up.

Dates are ``YYYYMMDD`` text, whose order is that of time. Every selection is an aggregate or a
one-sided join over frames that stay distributed.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from layerwise.session import local_frame


def as_date(token: str) -> date:
    return datetime.strptime(token, "%Y%m%d").date()


def token_of(day: date) -> str:
    return day.strftime("%Y%m%d")


def is_date_token(column: Column) -> Column:
    return column.rlike("^[0-9]{8}$")


def window_start(reference: str, days: int) -> str:
    """First date of a window of ``days`` that ends with the reference date."""
    return token_of(as_date(reference) - timedelta(days=days - 1))


def in_window(column: Column, reference: str, days: int) -> Column:
    return is_date_token(column) & column.between(window_start(reference, days), reference)


def lookback_dates(spark: SparkSession, reference: str, days: int) -> DataFrame:
    """The window's dates as rows."""
    end = F.lit(as_date(reference))
    every_day = F.sequence(F.date_sub(end, days - 1), end)
    days_apart = spark.range(1).select(F.explode(every_day).alias("day"))
    return days_apart.select(F.date_format("day", "yyyyMMdd").alias("filedate"))


def date_window_intersect(dates: DataFrame, reference: str, days: int) -> DataFrame:
    """Available dates inside the lookback window."""
    return dates.select("filedate").distinct().filter(in_window(F.col("filedate"), reference, days))


def pending_dates(
    available: DataFrame,
    processed: DataFrame,
    reference: str,
    days: int = 3,
    force: bool = False,
) -> DataFrame:
    """Dates in the window that are not done yet, sorted; with ``force`` done ones as well."""
    dates = date_window_intersect(available, reference, days)
    if not force:
        dates = dates.join(processed.select("filedate").distinct(), "filedate", "left_anti")
    return dates.orderBy("filedate")


def late_files(files: DataFrame, reference: str, days: int = 3) -> DataFrame:
    """Files dated before the lookback window, which only an explicit rerun of their date reads."""
    start = window_start(reference, days)
    return files.filter(is_date_token(F.col("filedate")) & (F.col("filedate") < start))


def latest_n_dates(dates: DataFrame, n: int) -> DataFrame:
    """The last ``n`` dates in order of time; ``n = 0`` keeps all."""
    distinct = dates.select("filedate").filter(is_date_token(F.col("filedate"))).distinct()
    if n > 0:
        distinct = distinct.orderBy(F.col("filedate").desc()).limit(n)
    return distinct.orderBy("filedate")


def _per_table(ledger: DataFrame) -> DataFrame:
    failed = F.col("status") == "failed"
    return ledger.groupBy("filedate", "table_name").agg(
        F.max_by("status", "processed_at").alias("status"),
        F.max("processed_at").alias("processed_at"),
        F.bool_or(failed).alias("ever_failed"),
    )


def ledger_latest(ledger: DataFrame) -> DataFrame:
    """Status per date as of its last entry: a good rerun clears a failure."""
    return ledger.groupBy("filedate").agg(
        F.max_by("status", "processed_at").alias("status"),
        F.max("processed_at").alias("last_processed"),
    )


def ledger_sticky(ledger: DataFrame) -> DataFrame:
    """Status per date where one failure counts for ever."""
    return ledger.groupBy("filedate").agg(
        F.when(F.bool_or(F.col("status") == "failed"), "failed")
        .otherwise(F.max_by("status", "processed_at"))
        .alias("status"),
        F.max("processed_at").alias("last_processed"),
    )


def processed_dates(
    ledger: DataFrame, expected: Sequence[str] | None = None, sticky: bool = False
) -> DataFrame:
    """Dates whose status is success and whose recorded expected tables all are.

    An entry with a NULL table is for the whole date; its success covers tables recorded
    earlier.
    """
    tables = _per_table(ledger)
    counted = F.col("table_name").isNotNull()
    if expected is not None:
        counted = counted & F.col("table_name").isin(list(expected))
    ok = F.col("status") == "success"
    whole = F.col("table_name").isNull()
    dates = tables.groupBy("filedate").agg(
        F.max_by("status", "processed_at").alias("status"),
        F.bool_or("ever_failed").alias("ever_failed"),
        F.max(F.when(whole & ok, F.col("processed_at"))).alias("covered_at"),
        F.max(F.when(counted & ~ok, F.col("processed_at"))).alias("open_at"),
    )
    tables_done = F.col("open_at").isNull() | F.coalesce(
        F.col("covered_at") > F.col("open_at"), F.lit(False)
    )
    date_done = ~F.col("ever_failed") if sticky else F.lit(True)
    return dates.filter((F.col("status") == "success") & tables_done & date_done).select("filedate")


def latest_file_per_group(
    files: DataFrame, group: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """One file per group, the last one in order: a file that is delivered again replaces itself."""
    latest = Window.partitionBy(*group).orderBy(*[F.desc_nulls_last(name) for name in order])
    # at most one row per group and map task is shuffled
    return files.withColumn("__rank", F.row_number().over(latest)).filter("__rank = 1").drop("__rank")


def retention_plan(rows: DataFrame, reference: str, keep_days: int) -> DataFrame:
    """Rows per date with ``keep`` or ``expire``; ``keep_days = 0`` keeps all."""
    counts = rows.groupBy("filedate").agg(F.count(F.lit(1)).alias("n_rows"))
    if keep_days <= 0:
        return counts.withColumn("action", F.lit("keep"))
    cutoff = token_of(as_date(reference) - timedelta(days=keep_days))
    expired = is_date_token(F.col("filedate")) & (F.col("filedate") < cutoff)
    return counts.withColumn("action", F.when(expired, "expire").otherwise("keep"))


def retained(rows: DataFrame, reference: str, keep_days: int) -> DataFrame:
    """Rows inside the retention, as a filter on the date that prunes partitions."""
    if keep_days <= 0:
        return rows
    cutoff = token_of(as_date(reference) - timedelta(days=keep_days))
    return rows.filter(~is_date_token(F.col("filedate")) | (F.col("filedate") >= cutoff))


def cleanup_candidates(rows: DataFrame, processed: DataFrame) -> DataFrame:
    """Rows per date that is fully loaded and may be cleaned. Rows are counted before the join."""
    counts = rows.groupBy("filedate").agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.join(processed.select("filedate").distinct(), "filedate", "left_semi")


def ledger_entry(
    spark: SparkSession, filedate: str, status: str, table: str | None = None
) -> DataFrame:
    """One ledger row, stamped now."""
    entry = local_frame(
        spark, [(filedate, table, status)], "filedate string, table_name string, status string"
    )
    return entry.withColumn("processed_at", F.current_timestamp())
