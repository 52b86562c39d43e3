"""Quality metrics, the gate over them, alerts and the run log, all as DataFrames.

Input is the gold log: one small row per brand, table and date.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Message texts that alert consumers match on.
EXCEEDED = "DATA QUALITY %s: Overall error rate is %.2f%%, exceeding threshold of %s%%"
ACCEPTABLE = "Data quality acceptable: Error rate %.2f%%"
NO_METRICS = "No data quality metrics available"


def dq_by_table(gold_log: DataFrame, date_folder: str | None = None) -> DataFrame:
    """Records, errors and error percent per table, of one date or of each."""
    log = gold_log if date_folder is None else gold_log.filter(F.col("date_folder") == date_folder)
    sums = log.groupBy("date_folder", "table_name").agg(
        F.sum("records_before_agg").alias("total_records"),
        F.sum("records_error").alias("error_records"),
    )
    percent = F.lit(100).cast("decimal(20,0)") * F.col("error_records")
    percent = F.round(percent / F.nullif(F.col("total_records"), F.lit(0)), 2)
    return sums.withColumn("error_percent", percent.cast("double"))


def dq_gate(
    by_table: DataFrame, error_threshold: float = 5.0, warning_threshold: float = 10.0
) -> DataFrame:
    """OK, WARNING or ERROR per date, with its message.

    The error threshold is tested first, so with the default values (error below warning) no
    date can be a WARNING.
    """
    totals = by_table.groupBy("date_folder").agg(
        F.sum("total_records").alias("total_records"),
        F.sum("error_records").alias("error_records"),
    )
    return _gated(totals, error_threshold, warning_threshold)


def overall_gate(
    by_table: DataFrame, error_threshold: float = 5.0, warning_threshold: float = 10.0
) -> DataFrame:
    """The gate over all given tables: always one row, OK where there are no metrics."""
    totals = by_table.agg(
        F.coalesce(F.sum("total_records"), F.lit(0)).alias("total_records"),
        F.coalesce(F.sum("error_records"), F.lit(0)).alias("error_records"),
    )
    nothing = F.col("total_records") == 0
    gate = _gated(totals, error_threshold, warning_threshold)
    return gate.withColumn(
        "message", F.when(nothing, NO_METRICS).otherwise(F.col("message"))
    )


def _gated(totals: DataFrame, error_threshold: float, warning_threshold: float) -> DataFrame:
    share = F.col("error_records").cast("double") / F.col("total_records") * 100
    gated = totals.withColumn(
        "error_percentage", F.when(F.col("total_records") > 0, share).otherwise(0.0)
    )
    percent = F.col("error_percentage")

    def exceeds(level: str, threshold: float) -> Column:
        return F.format_string(EXCEEDED, F.lit(level), percent, F.lit(str(threshold)))

    return gated.withColumns(
        {
            "status": F.when(percent > error_threshold, "ERROR")
            .when(percent > warning_threshold, "WARNING")
            .otherwise("OK"),
            "message": F.when(percent > error_threshold, exceeds("ERROR", error_threshold))
            .when(percent > warning_threshold, exceeds("WARNING", warning_threshold))
            .otherwise(F.format_string(ACCEPTABLE, percent)),
        }
    )


def run_status(gate: DataFrame, expected_tables: int) -> DataFrame:
    """Run status and table counts of a gate row."""
    status = F.col("status")
    half = expected_tables // 2
    return gate.select(
        *[c for c in gate.columns if c not in ("status", "message")],
        F.when(status == "ERROR", "WARNING")
        .when(status == "WARNING", "SUCCESS_WITH_WARNINGS")
        .otherwise("SUCCESS")
        .alias("run_status"),
        F.lit(expected_tables).cast("bigint").alias("tables_processed"),
        F.when(status == "ERROR", 0)
        .when(status == "WARNING", expected_tables - half)
        .otherwise(expected_tables)
        .cast("bigint")
        .alias("tables_success"),
        F.when(status == "ERROR", expected_tables)
        .when(status == "WARNING", half)
        .otherwise(0)
        .cast("bigint")
        .alias("tables_warning"),
        F.when(status != "OK", F.col("message")).otherwise("").alias("error_message"),
        status.alias("gate_status"),
        F.col("message").alias("gate_message"),
    )


def run_log(runs: DataFrame, gate: DataFrame, expected_tables: int) -> DataFrame:
    """One row per run: duration, status, table and record counts, steps and JSON details.

    ``runs`` has process_id, date_folder, execution_start, execution_end and steps.
    """
    status = run_status(gate, expected_tables)
    seconds = F.timestamp_diff("SECOND", F.col("execution_start"), F.col("execution_end"))
    details = F.to_json(
        F.struct(
            F.col("gate_status").alias("status"),
            F.col("gate_message").alias("message"),
        )
    )
    return runs.join(status, "date_folder", "left").select(
        "process_id",
        "date_folder",
        "execution_start",
        "execution_end",
        seconds.alias("duration_seconds"),
        F.coalesce("run_status", F.lit("SUCCESS")).alias("status"),
        "tables_processed",
        "tables_success",
        "tables_warning",
        F.lit(0).cast("bigint").alias("tables_error"),
        "total_records",
        (F.col("total_records") - F.col("error_records")).alias("valid_records"),
        "error_records",
        F.coalesce("error_message", F.lit("")).alias("error_message"),
        F.col("steps").alias("steps_completed"),
        details.alias("processing_details"),
    )


def failed_run_log(runs: DataFrame, expected_tables: int) -> DataFrame:
    """Run-log rows of runs that broke off: ``run_log`` columns with status ERROR.

    ``runs`` has what ``run_log`` asks for and ``error_message``. No table counts as processed.
    """
    seconds = F.timestamp_diff("SECOND", F.col("execution_start"), F.col("execution_end"))
    zero = F.lit(0).cast("bigint")
    details = F.to_json(F.struct(F.lit("ERROR").alias("status"), F.col("error_message").alias("message")))
    return runs.select(
        "process_id",
        "date_folder",
        "execution_start",
        "execution_end",
        seconds.alias("duration_seconds"),
        F.lit("ERROR").alias("status"),
        zero.alias("tables_processed"),
        zero.alias("tables_success"),
        zero.alias("tables_warning"),
        F.lit(expected_tables).cast("bigint").alias("tables_error"),
        zero.alias("total_records"),
        zero.alias("valid_records"),
        zero.alias("error_records"),
        "error_message",
        F.col("steps").alias("steps_completed"),
        details.alias("processing_details"),
    )


def failure_alerts(runs: DataFrame) -> DataFrame:
    """A CRITICAL alert row for each run that broke off."""
    details = F.to_json(
        F.struct(F.col("error_message").alias("message"), F.lit("CRITICAL").alias("severity"))
    )
    return runs.select(
        "date_folder",
        F.lit("CRITICAL").alias("alert_type"),
        F.col("error_message").alias("message"),
        details.alias("details"),
    )


def dq_alerts(gate: DataFrame, severities: Sequence[str] = ("WARNING", "ERROR", "CRITICAL")) -> DataFrame:
    """Alert rows (date, type, message, JSON details) for gates that are not OK."""
    raised = gate.filter(F.col("status").isin(list(severities)))
    details = F.to_json(
        F.struct(F.col("message").alias("message"), F.col("status").alias("severity"))
    )
    return raised.select(
        "date_folder",
        F.col("status").alias("alert_type"),
        "message",
        details.alias("details"),
    )
