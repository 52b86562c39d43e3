from __future__ import annotations

import pytest
from conftest import rows

from layerwise.operators import incremental, presence, quality

DATES = [("20250414",), ("20250415",), ("20250416",), ("20250401",), ("latest",), ("20250416",)]


@pytest.fixture
def dates(spark):
    return spark.createDataFrame(DATES, "filedate string")


def test_windows(spark, dates):
    assert rows(incremental.lookback_dates(spark, "20250301", 3)) == [
        ("20250227",),
        ("20250228",),
        ("20250301",),
    ]
    assert rows(incremental.date_window_intersect(dates, "20250416", 2)) == [("20250415",), ("20250416",)]
    assert rows(incremental.late_files(dates, "20250416", 3)) == [("20250401",)]
    assert [r.filedate for r in incremental.latest_n_dates(dates, 2).collect()] == ["20250415", "20250416"]
    assert incremental.latest_n_dates(dates, 0).count() == 4


def test_pending(spark, dates):
    done = spark.createDataFrame([("20250415",)], "filedate string")
    found = incremental.pending_dates(dates, done, "20250416", 3)
    assert [r.filedate for r in found.collect()] == ["20250414", "20250416"]
    assert incremental.pending_dates(dates, done, "20250416", 3, force=True).count() == 3


LEDGER = [
    ("01", None, "failed", 1), ("01", None, "success", 2),
    ("02", "A", "success", 1), ("02", "B", "failed", 2), ("02", "B", "success", 3),
    ("03", "A", "success", 2), ("03", "B", "failed", 1),
    ("04", "B", "failed", 1), ("04", None, "success", 2),
    ("05", "X", "failed", 1), ("05", "A", "success", 2),
    ("06", "A", "failed", 3), ("06", None, "success", 2),
]


def test_ledger(spark):
    ledger = spark.createDataFrame(LEDGER, "filedate string, table_name string, status string, processed_at int")
    done = incremental.processed_dates(ledger, ["A", "B"])
    assert rows(done) == [("01",), ("02",), ("04",), ("05",)]
    assert rows(incremental.processed_dates(ledger)) == [("01",), ("02",), ("04",)]
    assert incremental.processed_dates(ledger, ["A", "B"], sticky=True).isEmpty()
    assert dict(rows(incremental.ledger_latest(ledger).select("filedate", "status"))) == {
        "01": "success", "02": "success", "03": "success", "04": "success", "05": "success", "06": "failed",
    }
    sticky = dict(rows(incremental.ledger_sticky(ledger).select("filedate", "status")))
    assert sticky == {d: "failed" for d in ("01", "02", "03", "04", "05", "06")}


def test_latest_file_wins(spark):
    data = [("b", "20250416", "T", 1, "one"), ("b", "20250416", "T", 3, "two"), ("c", "20250416", "T", 2, "x")]
    files = spark.createDataFrame(data, "brand string, filedate string, table_name string, at int, path string")
    found = incremental.latest_file_per_group(files, ["brand", "filedate", "table_name"], ["at"])
    assert found.columns == files.columns
    assert [r[4] for r in rows(found)] == ["two", "x"]


def test_retention(spark, dates):
    plan = incremental.retention_plan(dates, "20250416", 2)
    assert rows(plan) == [
        ("20250401", 1, "expire"),
        ("20250414", 1, "keep"),
        ("20250415", 1, "keep"),
        ("20250416", 2, "keep"),
        ("latest", 1, "keep"),
    ]
    assert incremental.retained(dates, "20250416", 2).count() == 5
    assert incremental.retained(dates, "20250416", 0).count() == 6
    assert {r.action for r in incremental.retention_plan(dates, "20250416", 0).collect()} == {"keep"}
    done = spark.createDataFrame([("20250416",), ("20250416",)], "filedate string")
    assert rows(incremental.cleanup_candidates(dates, done)) == [("20250416", 2)]


def test_presence(spark):
    data = [("N", "20250416", "A"), ("N", "20250416", "A"), ("N", "20250416", "B"), ("S", "20250416", "X")]
    files = spark.createDataFrame(data, "brand string, filedate string, table_name string")
    ok, nok = '{"status":"OK"}', '{"status":"NoK"}'
    assert rows(presence.raw_log(files, ["A", "B"])) == [
        ("N", "20250416", 2, 0, "OK", "", '{"files_present":2,"tables":{"A":%s,"B":%s}}' % (ok, ok)),
        ("S", "20250416", 1, 1, "Partial", "A,B", '{"files_present":1,"tables":{"A":%s,"B":%s}}' % (nok, nok)),
    ]
    assert rows(presence.expected_tables(files, ["A", "B"]).select("brand", "table_name", "status")) == [
        ("N", "A", "OK"),
        ("N", "B", "OK"),
        ("S", "A", "NoK"),
        ("S", "B", "NoK"),
    ]
    per_table = presence.files_per_table_date(files)
    assert rows(presence.tables_per_date(per_table)) == [("20250416", 3, 4)]
    assert presence.keep_expected(files, ["A", "B"]).count() == 3


@pytest.mark.parametrize(
    ("errors", "status", "run", "tables"),
    [
        (0, "OK", "SUCCESS", (7, 0)),
        (5, "OK", "SUCCESS", (7, 0)),
        (6, "ERROR", "WARNING", (0, 7)),
        (11, "ERROR", "WARNING", (0, 7)),
    ],
)
def test_gate_at_default_thresholds(spark, errors, status, run, tables):
    log = spark.createDataFrame(
        [("d", "T", 60, errors), ("d", "U", 40, 0)],
        "date_folder string, table_name string, records_before_agg bigint, records_error bigint",
    )
    gate = quality.dq_gate(quality.dq_by_table(log, "d"))
    assert gate.first().status == status
    found = quality.run_status(gate, 7).first()
    assert (found.run_status, (found.tables_success, found.tables_warning)) == (run, tables)
    assert quality.dq_alerts(gate).count() == (status != "OK")


def test_gate_warning_and_no_data(spark):
    kind = "date_folder string, table_name string, records_before_agg bigint, records_error bigint"
    log = spark.createDataFrame([("d", "T", 200, 30), ("d", "E", 0, 0)], kind)
    by_table = quality.dq_by_table(log)
    assert rows(by_table) == [("d", "E", 0, 0, None), ("d", "T", 200, 30, 15.0)]
    gate = quality.dq_gate(by_table, 20.0, 10.0)
    assert rows(gate.select("status", "message")) == [
        ("WARNING", "DATA QUALITY WARNING: Overall error rate is 15.00%, exceeding threshold of 10.0%")
    ]
    found = quality.run_status(gate, 7).first()
    assert (found.run_status, found.tables_success, found.tables_warning) == ("SUCCESS_WITH_WARNINGS", 4, 3)
    nothing = quality.overall_gate(by_table.limit(0)).first()
    assert (nothing.status, nothing.message) == ("OK", "No data quality metrics available")
