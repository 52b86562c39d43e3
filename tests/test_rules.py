"""Each rule kind against NULL, '', valid, invalid and missing column, and the reports."""

from __future__ import annotations

import random

import pytest
from conftest import rows

from layerwise.operators import report
from layerwise.operators.rules import check_rules, parse_rules, rule_frame

SCHEMA = "id int, brand string, kind string, day string, ex int, total int, ref string"
DATA = [
    (1, "A", "x", "2025-04-16", 10, 5, "r"),
    (2, "A", "", "16/04/2025", 10, 0, ""),
    (3, "A", None, None, None, 5, None),
    (4, "B", "bad", "nope", 10, None, "r"),
    (5, "B", "y", "2025-13-01", 1, 5, "r"),
]


@pytest.fixture
def df(spark):
    return spark.createDataFrame(DATA, SCHEMA)


def bad_ids(df, body, **options):
    checked = check_rules(df, parse_rules({"T": body}, "T"), order=["id"], **options)
    assert checked.active
    return [r.id for r in checked.df.filter(checked.any_bad).orderBy("id").collect()]


@pytest.mark.parametrize(
    ("body", "expected"),
    [
        ({"valid_types": {"column": "kind", "allowed_values": ["x", "y"]}}, [2, 4]),
        ({"valid_types": {"column": "ex", "allowed_values": ["10", "other"]}}, [5]),
        ({"valid_types": {"column": "ex", "allowed_values": [1, None]}}, [1, 2, 4]),
        ({"required_fields": {"columns": ["kind"]}}, [2, 3]),
        ({"required_fields": {"columns": ["kind"], "empty_is_missing": False}}, [3]),
        ({"required_fields": {"columns": ["kind", "ref", "absent"]}}, [2, 3]),
        ({"required_fields": {"columns": ["ex"]}}, [3]),
        ({"date_validation": {"columns": ["day"]}}, [2, 4, 5]),
        ({"date_validation": {"columns": ["day"], "formats": ["dd/MM/yyyy"]}}, [4, 5]),
        ({"duration_validation": {"columns": ["ex", "total"]}}, [1]),
        ({"c": {"condition": "ex <= total OR total == 0"}}, [1, 3, 4]),
        ({"c": {"condition": "ex <= total OR total == 0", "null_policy": "pass"}}, [1]),
        ({"c": {"condition": "NOT (kind IS NULL AND id IS NOT NULL)"}}, [3]),
        ({"c": {"condition": "kind == 0", "null_policy": "pass"}}, []),
        ({"c": {"condition": "kind > 5", "null_policy": "fail"}}, [1, 2, 3, 4, 5]),
        ({"c": {"column": "ref", "not_empty": True}}, [2, 3]),
    ],
)
def test_row_rules(df, body, expected):
    assert bad_ids(df, body) == expected


@pytest.mark.parametrize(
    ("body", "reason"),
    [
        ({"valid_types": {"column": "absent", "allowed_values": ["x"]}}, "no column"),
        ({"required_fields": {"columns": ["absent"]}}, "no column"),
        ({"date_validation": {"columns": ["absent"]}}, "no column"),
        ({"uniqueness": {"columns": ["id", "absent"]}}, "no column"),
        ({"duration_validation": {}}, "no column"),
        ({"c": {"condition": "absent > 1"}}, "UNRESOLVED_COLUMN"),
        ({"c": {"condition": "ex >"}}, "PARSE_SYNTAX_ERROR"),
        ({"c": {"condition": "ex + 1"}}, "not boolean"),
        ({"c": {"column": "absent", "not_empty": True}}, "no column"),
        ({"c": {"anything": 1}}, "not known"),
    ],
)
def test_unusable_rules_are_skipped_and_counted(df, body, reason):
    rules = parse_rules({"T": body}, "T")
    checked = check_rules(df, rules)
    assert reason in checked.checks[0].skipped
    assert checked.df.filter(checked.any_bad).isEmpty()
    log = report.gold_log(df, rules, ["brand"], ["id"], ["id"])
    assert rows(log.select("brand", "checks_total", "checks_passed", "checks_skipped", "status")) == [
        ("A", 1, 0, 1, "OK"),
        ("B", 1, 0, 1, "OK"),
    ]
    assert rows(report.rule_status(checked, ["brand"]).select("brand", "status", "n_bad")) == [
        ("A", "SKIPPED", None),
        ("B", "SKIPPED", None),
    ]


def test_uniqueness(spark):
    data = [(1, "a"), (2, "a"), (3, None), (4, None), (5, "b"), (6, "a")]
    df = spark.createDataFrame(data, "id int, k string")
    assert bad_ids(df, {"uniqueness": {"columns": ["k"]}}) == [2, 4, 6]
    assert bad_ids(df, {"uniqueness": {"columns": ["k"], "keep": "none"}}) == [1, 2, 3, 4, 6]
    assert bad_ids(df, {"uniqueness": {"columns": ["k"]}}, unique_keys=["k"]) == []


def test_a_table_without_rules(df):
    checked = check_rules(df, parse_rules({}, "T"))
    assert rows(report.silver_log(checked, ["brand"]).select("brand", "rows_ko", "status")) == [
        ("A", 0, "OK"),
        ("B", 0, "OK"),
    ]
    log = report.gold_log(df, [], ["brand"], [], ["id"])
    assert rows(log.select("brand", "records_valid", "checks_total")) == [("A", 3, 0), ("B", 2, 0)]
    assert checked.with_errors().filter("size(errors) > 0").isEmpty()
    assert report.error_details(checked, ["brand"]).isEmpty()


RULES = {
    "T": {
        "valid_types": {"column": "kind", "allowed_values": ["x", "y"], "error_type": "kinds"},
        "required_fields": {"columns": ["kind", "ref"], "error_type": "missing"},
        "date_validation": {"columns": ["day"], "error_type": "dates"},
        "other": {"condition": "id <> 5", "error_type": "kinds"},
    }
}


def test_reports(df):
    checked = check_rules(df, parse_rules(RULES, "T"))
    assert rows(report.bad_rows(checked, ["id"])) == [
        (2, "kinds,missing,dates"),
        (3, "missing"),
        (4, "kinds,dates"),
        (5, "kinds,dates"),
    ]
    assert rows(report.error_details(checked, ["brand"])) == [
        ("A", "dates", "day", 1),
        ("A", "kinds", "", 1),
        ("A", "missing", "kind", 2),
        ("A", "missing", "ref", 2),
        ("B", "dates", "day", 2),
        ("B", "kinds", "", 2),
    ]
    assert rows(report.silver_log(checked, ["brand"])) == [
        ("A", 3, 1, 2, "dates,kinds,missing", "KO", '{"kinds":1,"missing":{"kind":2,"ref":2},"dates":{"day":1}}'),
        ("B", 2, 0, 2, "dates,kinds", "KO", '{"kinds":2,"dates":{"day":2}}'),
    ]
    top = report.first_bad_rows(checked, ["brand"], ["id"], limit=1)
    assert rows(top) == [("A", 2, 1), ("B", 4, 1)]


def test_gold_log_counts_distinct_bad_rows(spark, df):
    doubled = df.union(df.withColumn("id", df.id + 10))
    log = report.gold_log(doubled, parse_rules(RULES, "T"), ["brand"], ["kind", "day"], ["id"])
    assert rows(log) == [
        ("A", 6, 3, 3, 4, 1, 3, 0, 1, 2, "WARNING"),
        ("B", 4, 2, 2, 4, 2, 2, 0, 0, 2, "ERROR"),
    ]


def test_gold_log_is_the_same_with_and_without_a_join(spark, df):
    """A uniqueness rule the dedup key already satisfies changes only the number of checks."""
    trivial = {**RULES["T"], "uniqueness": {"columns": ["id", "kind"]}}
    plain = report.gold_log(df, parse_rules(RULES, "T"), ["brand"], ["id"], ["id"])
    more = report.gold_log(df, parse_rules({"T": trivial}, "T"), ["brand"], ["id"], ["id"])
    same = ["brand", "records_before_agg", "records_valid", "records_error", "checks_failed", "status"]
    assert rows(plain.select(*same)) == rows(more.select(*same))
    assert rows(more.select("checks_total", "checks_passed")) == [(5, 2), (5, 3)]


def test_more_error_types_than_bits(spark, df):
    body = {f"r{i:03}": {"condition": f"id <> {i % 7}"} for i in range(150)}
    log = report.gold_log(df, parse_rules({"T": body}, "T"), ["brand"], [], ["id"])
    found = rows(log.select("brand", "checks_total", "checks_failed", "records_error"))
    hits = {b: sum(1 for i in range(150) if i % 7 in ids) for b, ids in (("A", {1, 2, 3}), ("B", {4, 5}))}
    assert found == [("A", 150, hits["A"], 3), ("B", 150, hits["B"], 2)]


def test_rule_catalog(spark):
    found = rule_frame(spark, parse_rules(RULES, "T")).orderBy("rule_name").collect()
    assert [(r.rule_name, r.kind, r.columns, r.allowed) for r in found] == [
        ("date_validation", "date_validation", ["day"], []),
        ("other", "condition", [], []),
        ("required_fields", "required_fields", ["kind", "ref"], []),
        ("valid_types", "allowed_values", ["kind"], ["x", "y"]),
    ]


def test_empty_groups(df):
    checked = check_rules(df, parse_rules(RULES, "T"))
    log = report.silver_log(checked, ["brand"])
    groups = df.sparkSession.createDataFrame([("A",), ("C",)], "brand string")
    found = report.add_empty_groups(log, groups, ["brand"])
    assert rows(found.select("brand", "rows_total", "status")) == [("A", 3, "KO"), ("B", 2, "KO"), ("C", 0, "OK")]


def test_absent_columns_among_several_are_reported(df):
    rule = {"t": {"required_fields": {"columns": [df.columns[0], "no_such"], "error_type": "missing"}}}
    checked = check_rules(df, parse_rules(rule, "t"))
    assert [c.skipped for c in checked.checks] == [None, "no column no_such"]
    assert checked.n_skipped == 1 and list(checked.by_error_type()) == ["missing"]


def test_a_condition_replaces_the_duration_columns():
    rule = {"t": {"duration_validation": {"condition": "a <= b", "error_type": "bad"}}}
    assert parse_rules(rule, "t")[0].kind == "condition"


@pytest.mark.parametrize("keep", ["first", "none"])
@pytest.mark.parametrize("shared", [True, False])
def test_gold_log_with_uniqueness_against_plain_python(spark, keep, shared):
    """Keep first per key, then repeats of other columns (NULL ones too) among what is left."""
    pick = random.Random(3)
    data = [(pick.choice("ab"), pick.choice([1, 2, 3, 4, 5, None]), pick.choice(["u", "v", "w", None]), pick.choice([None, 1]), pick.choice("xy"), i) for i in range(60)]
    df = spark.createDataFrame(data, "g string, k int, u string, u2 int, flag string, o int").repartition(3)
    kinds = {"T": {
        "valid_types": {"column": "flag", "allowed_values": ["x"], "error_type": "same" if shared else "flags"},
        "uniqueness": {"columns": ["u", "u2"], "keep": keep, "error_type": "same" if shared else "repeats"},
        "required_fields": {"columns": ["no"], "error_type": "absent"},
    }}
    found = report.gold_log(df, parse_rules(kinds, "T"), ["g"], ["k"], ["o"]).collect()
    for row in found:
        own = sorted((r for r in data if r[0] == row.g), key=lambda r: r[5])
        left = list({r[1]: r for r in reversed(own)}.values())
        left.sort(key=lambda r: r[5])
        alike: dict = {}
        for r in left:
            alike.setdefault(r[2:4], []).append(r)
        repeats = {r[5] for rs in alike.values() if len(rs) > 1 for r in (rs[1:] if keep == "first" else rs)}
        flagged = {r[5] for r in left if r[4] != "x"}
        failed = len({"same"} if shared else ({"flags"} if flagged else set()) | ({"repeats"} if repeats else set()))
        assert (row.records_before_agg, row.records_after_agg, row.records_error) == (len(own), len(left), len(repeats | flagged))
        assert (row.checks_failed, row.checks_total, row.checks_skipped) == (failed, 3, 1)
    assert len(found) == 2
