"""Landing CSV files through all layers in a fresh folder."""

from __future__ import annotations

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from layerwise.config import Settings, brands_from, columns_from, read_config
from layerwise.operators import incremental
from layerwise.plans.daily import (
    Layout,
    gold_to_target,
    landing_to_silver,
    run_date,
    run_pending,
    silver_to_gold,
    silver_to_gold_configured,
)
from layerwise.sources import landing as land
from layerwise.sources import layers, versions

BRANDS = {
    "brands": [
        {"file_name": "North TV", "brand_code": "NT"},
        {"file_name": "North TV - Resellers", "brand_code": "NTR"},
        {"file_name": "Arts+ West", "brand_code": "AW"},
    ]
}
SCHEMAS = {
    "Device": {
        "columns": {"UserId": "string", "Serial": "string", "Model": "string", "Seen": "date", "SSOID": "string"}
    },
    "Playback": {
        "columns": {
            "PlaySessionID": "string",
            "AssetDuration": "integer",
            "PlayDurationExPause": "integer",
            "Group": "string",
        }
    },
    "Smartcard": {"columns": {"SmartcardId": "string", "Type": "string"}},
}
RULES = {
    "Device": {
        "required_fields": {"columns": ["Model"], "error_type": "missing_model"},
        "date_validation": {"columns": ["Seen"], "error_type": "bad_date"},
    },
    "Playback": {
        "duration_validation": {"error_type": "bad_duration"},
        "duration_consistency": {
            "condition": "PlayDurationExPause <= AssetDuration OR AssetDuration == 0",
            "null_policy": "pass",
            "error_type": "inconsistent",
        },
    },
    "Smartcard": {"uniqueness": {"columns": ["SmartcardId"], "error_type": "duplicate_cards"}},
}
FILES = {
    "North TV_Device_20250416.csv": "UserId,Serial,Model,Seen,SSOID\n"
    "1,A,\"box, large\",2025-04-16,100\n1,A,box,2025-04-15,100\n2,B,,nope,200\n3,C,NA,2025-04-01,300\n",
    "North TV - Resellers_Device_20250416.csv": "UserId;Serial;Model;SSOID;OS\n1;A;café;x-1;tv\n9;Z;box;x-2;tv\n",
    "Arts+ West_Playback_20250416.csv": "PlaySessionID\tAssetDuration\tPlayDurationExPause\tGroup\n"
    "s1\t10\t20\tg\ns2\t0\t20\tg\ns3\t\t5\tg\ns4\tx\t5\tg\n",
    "Arts+ West_Smartcard_20250416.csv": "SmartcardId|Type|Brand\nc1|a|Own\nc1|b|Own\nc2|a|Own\n",
    "Arts+ West_Device_20250416.csv": "UserId,Serial,Model,Seen,SSOID\n",
    "North TV_UserSubscription_20250416.csv": "Userid,Subscription\n1,s\n",
    "North TV_Device_20250417.csv": "UserId,Serial,Model,Seen,SSOID\n5,E,box,2025-04-17,1\n",
    "Device_20250416.csv": "a,b\n1,2\n",
    "North TV_EPG_20250416.csv": "",
    "notes.txt": "not a table",
}


@pytest.fixture
def layout(tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    for name, text in FILES.items():
        (landing / name).write_text(text, encoding="utf-8")
    folders = {n: str(tmp_path / n) for n in ("landing", "raw", "silver", "gold", "logs")}
    return Layout(**folders, brands=BRANDS, schemas=SCHEMAS, rules=RULES)


@pytest.fixture
def settings(spark):
    names = ("Device", "Playback", "Smartcard")
    found = Settings(expected_tables=names, target_names={n: f"T_{n.upper()}" for n in names})
    for name in (*names, "UserSubscription"):
        spark.sql(f"DROP TABLE IF EXISTS {found.target_of(name)}")
    return found


def test_catalog_lists_what_can_be_processed(spark, layout, settings):
    catalog = land.landing_catalog(spark, layout.landing, settings.expected_tables, "20250416")
    found = {r.file_name: r for r in catalog.collect()}
    assert set(found) == {n for n in FILES if n.endswith("20250416.csv") and n.count("_") >= 2}
    assert found["Arts+ West_Playback_20250416.csv"].brand == "Arts+ West"
    assert {n: (r.valid, r.delimiter) for n, r in found.items()} == {
        "North TV_Device_20250416.csv": (True, ","),
        "North TV - Resellers_Device_20250416.csv": (True, ";"),
        "Arts+ West_Playback_20250416.csv": (True, "\t"),
        "Arts+ West_Smartcard_20250416.csv": (True, "|"),
        "Arts+ West_Device_20250416.csv": (True, ","),
        "North TV_UserSubscription_20250416.csv": (True, ","),
        "North TV_EPG_20250416.csv": (False, None),
    }
    assert not found["North TV_UserSubscription_20250416.csv"].expected
    device = found["North TV_Device_20250416.csv"]
    assert (device.n_columns, device.sample_rows, device.has_header) == (5, 4, True)


def test_landing_to_target(spark, layout, settings):
    files = landing_to_silver(spark, layout, settings, "20250416")
    silver = versions.read_current(spark, f"{layout.silver}/Device", "20250416")
    assert silver.count() == 6
    assert rows(silver.filter("src_brand = 'North TV'").select("UserId", "Model", "OS")) == [
        ("1", "box", None),
        ("1", "box, large", None),
        ("2", None, None),
        ("3", None, None),
    ]
    raw = spark.read.text(layout.raw).filter("src_file LIKE '%Playback%'")
    assert [r.value for r in raw.collect()] == FILES["Arts+ West_Playback_20250416.csv"].splitlines()

    assert silver_to_gold(spark, layout, "Device", "20250416", files) == 6
    log = layers.read_log(spark, layout.logs, "silver_logs")
    assert rows(log.select("brand", "rows_total", "rows_ok", "rows_ko", "cols_error", "status")) == [
        ("Arts+ West", 0, 0, 0, "", "OK"),
        ("North TV", 4, 2, 2, "bad_date,missing_model", "KO"),
        ("North TV - Resellers", 2, 2, 0, "", "OK"),
    ]
    assert gold_to_target(spark, layout, settings, "Device", "20250416") == 5
    gold = layers.read_log(spark, layout.logs, "gold_logs")
    columns = ["brand", "records_before_agg", "records_after_agg", "duplicates_removed"]
    columns += ["checks_failed", "records_valid", "records_error", "status"]
    assert rows(gold.select(*columns)) == [
        ("NT", 4, 3, 1, 2, 1, 2, "WARNING"),
        ("NTR", 2, 2, 0, 0, 2, 0, "OK"),
    ]
    target = spark.table("T_DEVICE")
    assert [c for c in target.columns if c != "PART_DATE"] == [
        "USERID", "SERIAL", "MODEL", "SEEN", "SSOID", "BRAND", "FILEDATE", "LOADDATE", "LOADEDBY",
    ]
    # the first row in file order survives
    kept = target.filter("USERID = '1' AND BRAND = 'North TV'").select("MODEL", "SEEN")
    assert rows(kept) == [("box, large", "2025-04-16")]


def test_own_brand_column_and_duration_rules(spark, layout, settings):
    files = landing_to_silver(spark, layout, settings, "20250416", copy_raw=False)
    for table in ("Smartcard", "Playback"):
        silver_to_gold(spark, layout, table, "20250416", files)
        gold_to_target(spark, layout, settings, table, "20250416")
    silver = layers.read_log(spark, layout.logs, "silver_logs")
    assert rows(silver.select("table_name", "brand", "rows_total", "rows_ko", "cols_error")) == [
        ("Playback", "Arts+ West", 4, 1, "bad_duration,inconsistent"),
        ("Smartcard", "Arts+ West", 3, 1, "duplicate_cards"),
    ]
    cards = layers.read_layer(spark, layout.gold, "Smartcard", "20250416")
    assert rows(cards.select("brand_src", "BRAND").distinct()) == [("Own", "Arts+ West")]
    assert spark.table("T_SMARTCARD").count() == 2
    assert spark.table("T_PLAYBACK").filter("`GROUP` = 'g'").count() == 4
    gold = layers.read_log(spark, layout.logs, "gold_logs").filter("table_name = 'Playback'")
    assert rows(gold.select("records_before_agg", "records_error", "checks_failed")) == [(4, 1, 2)]


def test_run_is_idempotent_and_recorded(spark, layout, settings):
    assert run_date(spark, layout, settings, "20250416") == "WARNING"
    counts = {t: spark.table(settings.target_of(t)).count() for t in settings.expected_tables}
    assert counts == {"Device": 5, "Playback": 4, "Smartcard": 2}
    assert run_date(spark, layout, settings, "20250416") == "ALREADY_PROCESSED"
    assert run_date(spark, layout, settings, "20250416", force=True) == "WARNING"
    again = {t: spark.table(settings.target_of(t)).count() for t in settings.expected_tables}
    assert again == counts
    run_date(spark, layout, settings, "20250417")
    assert spark.table("T_DEVICE").count() == 6
    ledger = layers.read_log(spark, layout.logs, "ledger")
    assert rows(incremental.processed_dates(ledger, settings.expected_tables)) == [
        ("20250416",),
        ("20250417",),
    ]
    runs = layers.read_log(spark, layout.logs, "run_logs")
    assert runs.filter("status = 'WARNING' AND tables_warning = 3").count() == 2
    alerts = layers.read_log(spark, layout.logs, "data_quality_alerts")
    assert json.loads(alerts.first().details)["severity"] == "ERROR"
    raw = layers.read_log(spark, layout.logs, "raw_logs").filter("filedate = '20250416'")
    assert ("Arts+ West", 3, "OK", "") in rows(
        raw.select("brand", "file_count", "status", "missing_tables").distinct()
    )
    details = json.loads(raw.filter("brand = 'North TV'").first().details)
    assert details["files_present"] == 3
    assert details["tables"]["Device"] == {"status": "OK", "csv_valid": True}
    gold = layers.read_log(spark, layout.logs, "gold_logs").filter("brand = 'NT' AND table_name = 'Device' AND date_folder = '20250416'")
    record = gold.first()
    assert record.error_message == "2 checks failed with 2 records in error"
    assert json.loads(record.loading_details) == {"rows_inserted": 3, "rows_updated": 0, "rows_rejected": 0}
    assert gold.filter("execution_end >= execution_start AND process_id <> ''").count() == 2


def test_failure_is_recorded(spark, layout, settings):
    broken = Layout(**{**layout.__dict__, "schemas": {"Device": {"columns": {"Model": "colour"}}}})
    with pytest.raises(ValueError, match="colour"):
        run_date(spark, broken, settings, "20250416")
    ledger = layers.read_log(spark, layout.logs, "ledger")
    assert rows(ledger.filter("table_name IS NULL").select("filedate", "status")) == [("20250416", "failed")]
    assert incremental.processed_dates(ledger).isEmpty()
    failed = layers.read_log(spark, layout.logs, "run_logs").first()
    assert failed.status == "ERROR" and "colour" in failed.error_message
    alert = layers.read_log(spark, layout.logs, "data_quality_alerts").first()
    assert alert.alert_type == "CRITICAL" and json.loads(alert.details)["severity"] == "CRITICAL"
    assert run_date(spark, layout, settings, "20250416") == "WARNING"
    ledger = layers.read_log(spark, layout.logs, "ledger")
    assert rows(incremental.processed_dates(ledger)) == [("20250416",)]
    assert incremental.processed_dates(ledger, sticky=True).isEmpty()


def test_configured_gold(spark, layout, settings):
    landing_to_silver(spark, layout, settings, "20250416", copy_raw=False)
    config = {
        "filter_conditions": "AssetDuration >= 0",
        "key_columns": ["Group"],
        "aggregate_columns": {"AssetDuration": "sum", "PlayDurationExPause": ["max", "median"]},
        "partition_columns": ["Group"],
    }
    outcome = silver_to_gold_configured(spark, layout, "Playback", "20250416", config)
    assert outcome["aggregation_applied"] and outcome["row_count"] == 1
    assert (outcome["row_count_raw"], outcome["rows_filtered"]) == (4, 2)
    gold = layers.read_layer(spark, layout.gold, "Playback", "20250416")
    assert rows(gold.select("Group", "AssetDuration", "PlayDurationExPause_median", "extraction_date")) == [
        ("g", 10, 20.0, "20250416")
    ]
    bad = {"filter_conditions": "AssetDuration >", "key_columns": ["Group"], "aggregate_columns": {"Group": "mode"}}
    outcome = silver_to_gold_configured(spark, layout, "Playback", "20250416", bad)
    assert outcome["filter_error"] == "PARSE_SYNTAX_ERROR"
    assert "unknown aggregate" in outcome["aggregation_error"]
    assert outcome["row_count"] == 4


def test_large_file_is_read_in_splits_and_stays_in_order(spark, tmp_path):
    path = tmp_path / "North TV_Device_20250416.csv"
    lines = [f"{i % 50},{i}" for i in range(60_000)]
    path.write_text("UserId,Serial\n" + "\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        df = land.read_landing(spark, [str(path)], ",", "UserId,Serial")
        assert df.rdd.getNumPartitions() > 4
        from layerwise.operators.dedup import keep_first

        kept = keep_first(df, ["UserId"], land.POSITION)
        assert {int(r.Serial) for r in kept.collect()} == set(range(50))
        lined = land.raw_lines(spark, [str(path)]).withColumns(
            {"part_date": F.lit("20250416"), "brand_slug": F.lit("north_tv")}
        )
        layers.write_raw(lined, str(tmp_path / "raw"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    parts = sorted((tmp_path / "raw").rglob("part-*"))
    assert "".join(p.read_text() for p in parts) == path.read_text()


def put(layout, name, text):
    from pathlib import Path

    (Path(layout.landing) / name).write_text(text, encoding="utf-8")


def test_a_date_without_files_stays_open(spark, layout, settings):
    assert run_date(spark, layout, settings, "20990101") == "NO_DATA"
    assert layers.read_log(spark, layout.logs, "raw_logs") is None
    assert layers.read_log(spark, layout.logs, "ledger") is None
    put(layout, "North TV_Device_20990101.csv", "UserId,Serial\n1,A\n")  # the late file
    assert run_date(spark, layout, settings, "20990101") == "SUCCESS"
    assert spark.table("T_DEVICE").count() == 1


def test_a_file_that_cannot_be_read_fails_its_table(spark, layout, settings):
    put(layout, "North TV_Device_20250501.csv", "UserId,Serial\n1,A\n")
    put(layout, "North TV_Playback_20250501.csv", "")
    assert run_date(spark, layout, settings, "20250501") == "FAILED"
    ledger = layers.read_log(spark, layout.logs, "ledger")
    assert rows(ledger.select("table_name", "status")) == [
        ("Device", "success"), ("Playback", "failed"), (None, "failed"),
    ]
    assert incremental.processed_dates(ledger, settings.expected_tables).isEmpty()
    assert rows(layers.read_log(spark, layout.logs, "file_rejects").select("file_name")) == [
        ("North TV_Playback_20250501.csv",)
    ]
    alert = layers.read_log(spark, layout.logs, "data_quality_alerts").first()
    assert (alert.alert_type, alert.message) == ("CRITICAL", "files not readable: Playback")
    assert layers.read_log(spark, layout.logs, "run_logs").first().status == "ERROR"


def test_records_that_do_not_fit_are_kept_as_rejects(spark, layout, settings):
    put(
        layout,
        "North TV_Device_20250502.csv",
        'UserId,Serial\n1,A\n2,B,EXTRA\n3\n4,"D\nd"\n5,E\n',
    )
    put(layout, "Arts+ West_Smartcard_20250502.csv", "SmartcardId\nc1\nc2\n")
    run_date(spark, layout, settings, "20250502")
    silver = versions.read_current(spark, f"{layout.silver}/Device", "20250502")
    assert rows(silver.select("UserId", "Serial")) == [("1", "A"), ("4", "D\nd"), ("5", "E")]
    rejects = spark.read.parquet(f"{layout.logs}/landing_rejects/Device")
    assert rows(rejects.select("record", "src_file")) == [
        ("2,B,EXTRA", "North TV_Device_20250502.csv"), ("3", "North TV_Device_20250502.csv"),
    ]
    cards = versions.read_current(spark, f"{layout.silver}/Smartcard", "20250502")
    assert rows(cards.select("SmartcardId")) == [("c1",), ("c2",)]


def test_a_file_delivered_again_without_rows_clears_its_rows(spark, layout, settings):
    put(layout, "North TV_Device_20250503.csv", "UserId,Serial\n1,A\n2,B\n")
    put(layout, "Arts+ West_Device_20250503.csv", "UserId,Serial\n3,C\n")
    run_date(spark, layout, settings, "20250503")
    assert spark.table("T_DEVICE").count() == 3
    put(layout, "North TV_Device_20250503.csv", "UserId,Serial\n")
    run_date(spark, layout, settings, "20250503", force=True)
    assert rows(spark.table("T_DEVICE").select("USERID")) == [("3",)]
    put(layout, "Arts+ West_Device_20250503.csv", "UserId,Serial\n")
    assert run_date(spark, layout, settings, "20250503", force=True) == "NO_DATA"
    assert spark.table("T_DEVICE").isEmpty()
    assert layers.read_layer(spark, layout.gold, "Device", "20250503") is None


def test_rows_the_target_turns_away(spark, layout, settings):
    spark.sql("CREATE TABLE T_PLAYBACK (PLAYSESSIONID STRING, `GROUP` INT, BRAND STRING) USING parquet")
    put(layout, "North TV_Playback_20250504.csv", "PlaySessionID,Group\ns1,1\ns2,x\ns3,3\n")
    run_date(spark, layout, settings, "20250504")
    assert rows(spark.table("T_PLAYBACK").select("PLAYSESSIONID", "GROUP")) == [("s1", 1), ("s3", 3)]
    record = layers.read_log(spark, layout.logs, "gold_logs").first()
    assert json.loads(record.loading_details) == {"rows_inserted": 2, "rows_updated": 0, "rows_rejected": 1}
    rejected = spark.read.parquet(f"{layout.logs}/load_rejects/Playback")
    assert rows(rejected.select("PLAYSESSIONID", "reject_columns")) == [("s2", "GROUP")]


def test_pending_dates_run_in_order(spark, layout, settings):
    assert run_pending(spark, layout, settings, "20250417") == {"20250416": "WARNING", "20250417": "SUCCESS"}
    assert run_pending(spark, layout, settings, "20250417") == {}
    broken = Layout(**{**layout.__dict__, "schemas": {"Device": {"columns": {"Model": "colour"}}}})
    assert run_pending(spark, broken, settings, "20250417", force=True) == {"20250416": "ERROR", "20250417": "ERROR"}


def test_writes_of_landing_files_need_no_shuffle(spark, layout, settings, tmp_path):
    path = f"{layout.landing}/North TV_Device_20250417.csv"
    lines = land.raw_lines(spark, [path]).withColumns({"part_date": F.lit("x"), "brand_slug": F.lit("y")})
    order = [*layers.FILE_PARTITIONS, "src_block", "src_row"]
    plan = lines.sortWithinPartitions(*order)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_configuration_files(spark, tmp_path):
    path = tmp_path / "rules.json"
    path.write_text(json.dumps(RULES, indent=2))
    assert read_config(spark, str(path)) == RULES
    assert read_config(spark, str(tmp_path / "absent.json")) == {}
    assert brands_from(BRANDS)[0] == ("North TV", "NT") and brands_from({}) == []
    assert columns_from(SCHEMAS, "Smartcard") == {"SmartcardId": "string", "Type": "string"}
    assert columns_from(SCHEMAS, "Other") == {}
    assert Settings().target_of("User") == "AGG_USER"
    assert Settings().target_of("VODCatalog") == "AGG_VOD_CATALOG"


def test_missing_layers_are_skipped(spark, layout, settings):
    assert silver_to_gold(spark, layout, "Device", "20250416") is None
    assert gold_to_target(spark, layout, settings, "Device", "20250416") is None
    assert layers.read_log(spark, layout.logs, "ledger") is None


def test_inferred_types(spark, layout):
    path = f"{layout.landing}/North TV_Device_20250416.csv"
    df = land.read_landing(spark, [path], ",", infer=True)
    assert dict(df.dtypes)["SSOID"] == "int" and dict(df.dtypes)["Model"] == "string"
