"""The daily flow: landing -> raw and silver -> gold -> target, with its logs.

Every step rewrites exactly the partitions it has data for, so a step may be repeated, for a
rerun or after lost work, without changing the outcome. Only the logs are appended to.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from layerwise.config import EMPTY_AS_NULL_DATES, STRING_COLUMNS, Settings, brands_from, columns_from
from layerwise.functions.names import iso_date, parse_source_name, slugify
from layerwise.operators import dedup, enrich, incremental, merge, presence, quality, report, schema, transform
from layerwise.operators.rules import check_rules, parse_rules
from layerwise.operators.schema import quoted
from layerwise.session import local_frame
from layerwise.sources import landing as land
from layerwise.sources import layers, versions

REJECT = "src_reject"
NO_DATA, FAILED = "NO_DATA", "FAILED"
RUN_COLUMNS = (
    "process_id string, date_folder string, execution_start timestamp, "
    "execution_end timestamp, steps array<string>"
)
SOURCE_COLUMNS = ("src_brand", *land.POSITION)


@dataclass(frozen=True)
class Layout:
    """Folders of a deployment and the three configuration documents."""

    landing: str
    raw: str
    silver: str
    gold: str
    logs: str
    brands: Mapping
    schemas: Mapping
    rules: Mapping
    target_schema: str = "default"


def _stamped(df: DataFrame, date: str | None = None) -> DataFrame:
    stamped = df.withColumn("process_date", F.current_timestamp())
    return stamped if date is None else stamped.withColumn("date_folder", F.lit(date))


def landing_to_silver(
    spark: SparkSession,
    layout: Layout,
    settings: Settings,
    date: str | None = None,
    paths: Sequence[str] | None = None,
    copy_raw: bool = True,
    log_raw: bool = True,
) -> DataFrame:
    """Convert landing files to silver, copy them to raw, and return the file catalog.

    All files of the landing folder, those of a date, or the ones at ``paths``.

    The catalog, one small row per file, is the only thing the driver collects, as it does for
    any file listing. Files of a table with the same layout are read in one scan, so the number
    of scans follows the number of layouts, not of files. Records that do not fit their header
    are kept in ``landing_rejects``, files that cannot be read in ``file_rejects``. A table's
    silver is staged first; what earlier deliveries of its files left gives way to it in one step,
    so that a file without rows, or one that cannot be read now, leaves none behind, and a run
    that breaks off changes nothing.
    """
    source = layout.landing if paths is None else list(paths)
    catalog = land.landing_catalog(
        spark, source, settings.expected_tables, date, settings.fallback_encoding
    )
    catalog = catalog.drop("modified_at")
    rows = catalog.collect()
    files = local_frame(spark, rows, catalog.schema)
    layouts: dict[tuple[str, str | None, str, bool, str], list[str]] = {}
    for row in rows:
        if row.valid:
            key = (row.table_name, row.delimiter, row.header, row.multi_line, row.encoding)
            layouts.setdefault(key, []).append(row.path)
    by_table: dict[str, list[DataFrame]] = {row.table_name: [] for row in rows}
    for (table, delimiter, header, multi_line, encoding), same in layouts.items():
        frame = land.read_landing(
            spark, same, delimiter, header, multi_line=multi_line, reject_column=REJECT, encoding=encoding
        )
        by_table[table].append(frame)
    for table, frames in by_table.items():
        own = files.filter(F.col("table_name") == table).select(
            F.col("filedate").alias(versions.PART_DATE), F.col("file_name").alias(versions.SOURCE)
        )
        _write_silver(spark, layout, table, schema.harmonized_union(frames) if frames else None, own)
    valid_paths = [path for same in layouts.values() for path in same]
    if copy_raw and valid_paths:
        layers.write_raw(_with_partitions(land.raw_lines(spark, valid_paths)), layout.raw)
    unread = [row for row in rows if not row.valid]
    if unread:
        rejected = local_frame(spark, unread, catalog.schema).select(
            "file_name", "brand", "table_name", "filedate", "file_size"
        )
        layers.append_log(_stamped(rejected), layout.logs, "file_rejects")
    if rows and log_raw:
        log = presence.raw_log(files, settings.expected_tables)
        layers.append_log(_stamped(log.withColumn("reseller", F.lit(""))), layout.logs, "raw_logs")
    return files


def _write_silver(
    spark: SparkSession, layout: Layout, table: str, rows: DataFrame | None, files: DataFrame
) -> None:
    """Records that fit go to silver; the others, if the scan met any, to ``landing_rejects``.
    Both replace at once what is there of ``files``."""
    silver, rejected = f"{layout.silver}/{table}", f"{layout.logs}/landing_rejects/{table}"
    version = versions.new_version()
    any_rejects = False
    if rows is not None:
        met = Observation()
        seen = rows.observe(met, F.count_if(F.col(REJECT).isNotNull()).alias("n"))
        versions.stage(_with_partitions(seen.filter(F.col(REJECT).isNull()).drop(REJECT)), silver, version)
        any_rejects = bool(met.get["n"])
    if any_rejects:
        odd = _with_partitions(rows.filter(F.col(REJECT).isNotNull()))
        fields = [quoted(c) for c in rows.columns if c != REJECT and c not in land.POSITION]
        values = F.size(F.array_compact(F.array(*fields))).alias("n_values")
        own = [F.col(REJECT).alias("record"), values, "src_block", "src_row", *layers.FILE_PARTITIONS]
        versions.stage(odd.select(*own), rejected, version)
    if any_rejects or versions.file_versions(spark, rejected) is not None:
        versions.commit(spark, rejected, version, files)
    versions.commit(spark, silver, version, files)


def _with_partitions(df: DataFrame) -> DataFrame:
    parsed = parse_source_name(F.col("src_file"))
    return df.withColumns(
        {
            "src_brand": parsed["brand"],
            layers.PART_DATE: parsed["filedate"],
            "brand_slug": slugify(parsed["brand"]),
        }
    )


def silver_to_gold(
    spark: SparkSession,
    layout: Layout,
    table: str,
    date: str,
    files: DataFrame | None = None,
) -> int | None:
    """Union a table's silver files of a date into its gold partition and log their quality.

    ``files``, the catalog of the date, lets files without rows appear in the log.
    """
    silver = versions.read_current(spark, f"{layout.silver}/{table}", date)
    if silver is None:
        layers.drop_partition(spark, f"{layout.gold}/{table}", [(layers.PART_DATE, date)])
        return None
    rows = schema.add_lineage(
        silver.drop("brand_slug"),
        if_absent={"BRAND": F.col("src_brand"), "FILEDATE": F.col(layers.PART_DATE)},
        always={},
    )
    # checks see the declared types, the layer keeps the text
    typed = schema.schema_cast(rows, columns_from(layout.schemas, table), valid_flags=False)
    checked = check_rules(
        typed, parse_rules(layout.rules, table), order=land.POSITION, scope=["src_file"]
    )
    labels = {
        "brand": F.col("src_brand"),
        "table_name": F.lit(table),
        "extraction_date": iso_date(F.lit(date)),
    }
    log = report.silver_log(checked, ["src_brand"]).withColumns(labels).drop("src_brand")
    if files is not None:
        same = files.filter((F.col("table_name") == table) & (F.col("filedate") == date))
        groups = same.filter("valid").select(
            "brand", "table_name", iso_date(F.col("filedate")).alias("extraction_date")
        )
        log = report.add_empty_groups(log, groups, list(labels))
    log = log.withColumn("reseller", F.lit(""))
    layers.append_log(_stamped(log, date), layout.logs, "silver_logs")
    return layers.write_partitioned(rows, f"{layout.gold}/{table}", [layers.PART_DATE])


def silver_to_gold_configured(
    spark: SparkSession,
    layout: Layout,
    table: str,
    date: str,
    table_config: Mapping,
) -> dict | None:
    """The filter-and-aggregate variant of the gold step, driven by a table configuration.

    Settings: ``filter_conditions``, ``key_columns`` with ``aggregate_columns``, and
    ``partition_columns`` below the date. Returns what was done.
    """
    silver = versions.read_current(spark, f"{layout.silver}/{table}", date)
    if silver is None:
        return None
    declared = columns_from(layout.schemas, table)
    outcome: dict = {"table_name": table, "date": date}
    rows = schema.schema_cast(silver, declared, valid_flags=False)
    condition = table_config.get("filter_conditions")
    filtered = transform.config_filter(rows, condition)
    if filtered.error:
        outcome["filter_error"] = filtered.error
    outcome["row_count_raw"] = rows.count()
    if condition and not filtered.error:
        outcome["rows_filtered"] = outcome["row_count_raw"] - filtered.df.count()
    keys = table_config.get("key_columns") or []
    aggregates = table_config.get("aggregate_columns") or {}
    result = filtered.df.drop("brand_slug", layers.PART_DATE, *SOURCE_COLUMNS)
    if keys and aggregates:
        try:
            result = transform.config_aggregate(filtered.df, keys, aggregates, land.POSITION)
            outcome["aggregation_applied"] = True
        except (ValueError, AnalysisException) as error:
            outcome["aggregation_error"] = str(error)
    result = result.withColumns(
        {
            "processing_date": F.date_format(F.current_date(), "yyyy-MM-dd"),
            "extraction_date": F.lit(date),
            layers.PART_DATE: F.lit(date),
        }
    )
    partitions = [layers.PART_DATE, *(table_config.get("partition_columns") or [])]
    outcome["row_count"] = layers.write_partitioned(result, f"{layout.gold}/{table}", partitions)
    return outcome


def gold_to_target(
    spark: SparkSession, layout: Layout, settings: Settings, table: str, date: str
) -> int | None:
    """Deduplicate, cast, check and load one gold partition; return the rows loaded.

    Two passes over the partition, whatever the number of brands and rules: the load and the log.
    """
    started = datetime.now(timezone.utc)
    target = f"{layout.target_schema}.{settings.target_of(table)}"
    gold = layers.read_layer(spark, layout.gold, table, date)
    if gold is None:
        layers.clear_table(spark, target, date)
        return None
    declared = columns_from(layout.schemas, table)
    conversions = {
        name: (lambda value: value.cast("string")) for name in STRING_COLUMNS.get(table, ())
    }
    rows = schema.schema_cast(
        gold.drop(layers.PART_DATE), declared, valid_flags=False, conversions=conversions
    )
    rules = parse_rules(layout.rules, table)
    keys = settings.keys_of(table)
    keys = keys if set(keys) <= set(rows.columns) else []
    unique = dedup.keep_first(rows, ["BRAND", *keys], land.POSITION) if keys else rows
    loaded = schema.add_lineage(
        unique,
        if_absent={},
        always={
            "LOADDATE": F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss"),
            "LOADEDBY": F.lit(settings.loaded_by),
        },
    )
    if spark.catalog.tableExists(target):
        wanted = spark.table(target).columns
    elif declared:
        wanted = [*declared, "BRAND", "FILEDATE", "LOADDATE", "LOADEDBY"]
    else:
        wanted = [name for name in loaded.columns if name not in SOURCE_COLUMNS]
    # a Spark target has no reserved column names
    projected = schema.project_to_target(loaded, wanted, reserved=())
    clean = schema.apply_null_policy(projected, date_columns=EMPTY_AS_NULL_DATES)
    loaded_rows, rejects = _load(spark, layout, table, target, date, clean)

    placed, order = land.with_packed_position(rows)
    log = report.gold_log(placed, rules, ["BRAND"], keys, order)
    if rejects is not None:
        log = log.join(rejects, F.col("BRAND").eqNullSafe(F.col("__brand")), "left").drop("__brand")
    log = enrich.enrich_brand(log, brands_from(dict(layout.brands)))
    log = report.gold_record(log.drop("BRAND").withColumnRenamed("BRAND_CODE", "brand"))
    ended = datetime.now(timezone.utc)
    run = {
        "process_id": F.lit(str(uuid.uuid4())),
        "table_name": F.lit(table),
        "execution_start": F.lit(started),
        "execution_end": F.lit(ended),
        "processing_time_ms": F.lit(int((ended - started).total_seconds() * 1000)),
    }
    layers.append_log(_stamped(log.withColumns(run), date), layout.logs, "gold_logs")
    return loaded_rows


def _load(
    spark: SparkSession, layout: Layout, table: str, target: str, date: str, rows: DataFrame
) -> tuple[int, DataFrame | None]:
    """Load the rows whose values fit the target's types; the others are kept in ``load_rejects``.

    Returns the rows loaded and, where any were turned away, their number per brand, which a target
    without a brand cannot tell.
    """
    place = (f"{layout.logs}/load_rejects/{table}", [(layers.PART_DATE, date)])
    layers.drop_partition(spark, *place)
    if not spark.catalog.tableExists(target):
        return layers.load_table(rows, target, date), None
    types = {f.name: f.dataType for f in spark.table(target).schema.fields if f.name != layers.TARGET_DATE}
    load = merge.load_with_rejects(rows, types)
    met = Observation()
    tried = load.tried.observe(met, F.count_if(F.col("reject_columns") != "").alias("n"))
    number = layers.load_table(tried.filter("reject_columns = ''").select(*load.columns), target, date)
    if not met.get["n"]:
        return number, None
    rejected = load.rejected.withColumn(layers.PART_DATE, F.lit(date))
    layers.write_partitioned(rejected, place[0], [layers.PART_DATE])
    if "BRAND" not in load.rejected.columns:
        return number, None
    per_brand = load.rejected.groupBy(F.col("BRAND").alias("__brand"))
    return number, per_brand.agg(F.count(F.lit(1)).alias("rows_rejected"))


def run_pending(
    spark: SparkSession, layout: Layout, settings: Settings, reference: str, force: bool = False
) -> dict[str, str]:
    """Every date in the lookback window that has files and is not done, oldest first.

    A date that breaks off is recorded and does not keep the later ones from running.
    """
    names = land.file_inventory(spark, layout.landing, land.csv_glob()).select("file_name").distinct()
    available = names.select(parse_source_name(F.col("file_name"))["filedate"].alias("filedate"))
    ledger = layers.read_log(spark, layout.logs, "ledger")
    if ledger is None:
        ledger = incremental.ledger_entry(spark, reference, "success").filter("false")
    done = incremental.processed_dates(ledger, settings.expected_tables)
    dates = incremental.pending_dates(available, done, reference, settings.lookback_days, force)
    statuses: dict[str, str] = {}
    for row in dates.collect():  # as many as the window has days
        try:
            statuses[row.filedate] = run_date(spark, layout, settings, row.filedate, force)
        except Exception:
            statuses[row.filedate] = "ERROR"
    return statuses


def run_date(
    spark: SparkSession,
    layout: Layout,
    settings: Settings,
    date: str,
    force: bool = False,
) -> str:
    """All steps for one date, then gate, alerts, ledger and run log; returns the run status.

    A table is recorded as a success when rows of it were loaded, as failed when a file of it
    could not be read, and as without data otherwise. The date is a success when some expected
    table is and none failed. A date without files leaves no entry and can be run later. A step
    that breaks off leaves an ERROR run, a CRITICAL alert and a failed entry.
    """
    ledger = layers.read_log(spark, layout.logs, "ledger")
    if ledger is not None and not force:
        done = incremental.processed_dates(ledger, settings.expected_tables)
        if not done.filter(F.col("filedate") == date).isEmpty():
            return "ALREADY_PROCESSED"
    started = datetime.now(timezone.utc)
    steps: list[str] = []
    try:
        files = landing_to_silver(spark, layout, settings, date)
        steps.append("landing_to_silver")
        readable = files.groupBy("table_name").agg(F.bool_and("valid").alias("valid"))
        tables = {row.table_name: row.valid for row in readable.orderBy("table_name").collect()}
        if not tables:
            return NO_DATA
        for table in tables:
            silver_to_gold(spark, layout, table, date, files)
        steps.append("silver_to_gold")
        outcomes: dict[str, str] = {}
        for table, valid in tables.items():
            number = gold_to_target(spark, layout, settings, table, date)
            outcomes[table] = "failed" if not valid else "no_data" if number is None else "success"
            entry = incremental.ledger_entry(spark, date, outcomes[table], table)
            layers.append_log(entry, layout.logs, "ledger")
        steps.append("gold_to_target")
        counted = {o for t, o in outcomes.items() if t in settings.expected_tables}
        if "failed" in counted:
            bad = ", ".join(t for t, o in outcomes.items() if o == "failed")
            _record_failure(spark, layout, settings, date, started, steps, f"files not readable: {bad}")
            return FAILED
        if "success" not in counted:
            return NO_DATA
        status = _close_run(spark, layout, settings, date, started, steps)
    except Exception as error:
        _record_failure(spark, layout, settings, date, started, steps, f"{type(error).__name__}: {error}")
        raise
    layers.append_log(incremental.ledger_entry(spark, date, "success"), layout.logs, "ledger")
    return status


def _record_failure(
    spark: SparkSession,
    layout: Layout,
    settings: Settings,
    date: str,
    started: datetime,
    steps: Sequence[str],
    message: str,
) -> None:
    run = local_frame(
        spark,
        [(spark.sparkContext.applicationId, date, started, datetime.now(timezone.utc), list(steps), message)],
        f"{RUN_COLUMNS}, error_message string",
    )
    layers.append_log(quality.failed_run_log(run, len(settings.expected_tables)), layout.logs, "run_logs")
    layers.append_log(_stamped(quality.failure_alerts(run)), layout.logs, "data_quality_alerts")
    layers.append_log(incremental.ledger_entry(spark, date, "failed"), layout.logs, "ledger")


def _close_run(
    spark: SparkSession,
    layout: Layout,
    settings: Settings,
    date: str,
    started: datetime,
    steps: Sequence[str],
) -> str:
    logs = layers.read_log(spark, layout.logs, "gold_logs")
    if logs is None:
        return "SUCCESS"
    latest = logs.filter((F.col("date_folder") == date) & (F.col("process_date") >= F.lit(started)))
    gate = quality.dq_gate(
        quality.dq_by_table(latest, date), settings.error_threshold, settings.warning_threshold
    )
    layers.append_log(_stamped(quality.dq_alerts(gate)), layout.logs, "data_quality_alerts")
    run = local_frame(
        spark,
        [(spark.sparkContext.applicationId, date, started, datetime.now(timezone.utc), list(steps))],
        RUN_COLUMNS,
    )
    log = quality.run_log(run, gate, len(settings.expected_tables))
    layers.append_log(log, layout.logs, "run_logs")
    return log.first().status
