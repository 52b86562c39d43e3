from __future__ import annotations

import math
import statistics

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from layerwise.operators import selection, transform


@pytest.fixture
def df(spark):
    data = [(1, "a", 1.0, "x"), (2, "a", math.nan, "y"), (3, "b", None, None), (4, None, 5.0, "z"), (5, "a", 4.0, "x")]
    return spark.createDataFrame(data, "id int, k string, v double, s string")


@pytest.mark.parametrize(
    ("text", "ids"),
    [
        ("id > 2 and s == 'x'", [5]),
        ("(id > 2) & ~(s == 'x')", [4]),
        ("id == 1 | id == 2", [1, 2]),
        ("s in ['x', 'y'] & id < 5", [1, 2]),
        ("s not in ['x']", [2, 4]),
        ("s == 'x|[y]&~'", []),
        ("`id` >= 4", [4, 5]),
        ("s > 5", []),
        ("", [1, 2, 3, 4, 5]),
        (None, [1, 2, 3, 4, 5]),
    ],
)
def test_filter_texts(df, text, ids):
    filtered = transform.config_filter(df, text)
    assert filtered.error is None
    assert sorted(r.id for r in filtered.df.collect()) == ids


@pytest.mark.parametrize(
    ("text", "error"),
    [
        ("id >", "PARSE_SYNTAX_ERROR"),
        ("nothing == 1", "UNRESOLVED_COLUMN.WITH_SUGGESTION"),
        ("id + 1", "DATATYPE_MISMATCH.FILTER_NOT_BOOLEAN"),
    ],
)
def test_unusable_filters_keep_all_rows(df, text, error):
    filtered = transform.config_filter(df, text)
    assert filtered.error == error
    assert filtered.df.count() == 5


def test_aggregate_names_and_missing_values(df):
    out = transform.config_aggregate(
        df,
        ["k"],
        {"v": ["sum", "mean", "min", "max", "count", "size", "first", "last", "median", "nunique"], "s": "last"},
        order=["id"],
    )
    assert out.columns == [
        "k", "v_sum", "v_mean", "v_min", "v_max", "v_count", "v_size", "v_first", "v_last", "v_median", "v_nunique", "s",
    ]
    assert rows(out) == [
        ("a", 5.0, 2.5, 1.0, 4.0, 2, 3, 1.0, 4.0, 2.5, 2, "x"),
        ("b", None, None, None, None, 0, 1, None, None, None, 0, None),
    ]
    kept = transform.config_aggregate(df, ["k"], {"v": ["count", "median"]}, dropna=False)
    assert rows(kept) == [("a", 2, 2.5), ("b", 0, None), (None, 1, 5.0)]
    only = transform.config_aggregate(df, ["k"], {"v": "median"})
    assert rows(only) == [("a", 2.5), ("b", None)]


def test_aggregate_settings(df):
    assert transform.config_aggregate(df, [], {"v": "sum"}) is df
    assert transform.config_aggregate(df, ["k"], {}) is df
    with pytest.raises(ValueError, match="mode"):
        transform.config_aggregate(df, ["k"], {"v": "mode"})
    with pytest.raises(ValueError, match="order"):
        transform.config_aggregate(df, ["k"], {"v": "first"})


values = st.lists(
    st.tuples(st.sampled_from(["a", "b"]), st.integers(-5, 5) | st.none()), min_size=1, max_size=40
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=values)
def test_median_against_plain_python(spark, data):
    df = spark.createDataFrame(data, "k string, v int").repartition(3)
    groups: dict = {}
    for key, value in data:
        if value is not None:
            groups.setdefault(key, []).append(value)
    wanted = sorted((key, float(statistics.median(found))) for key, found in groups.items())
    assert rows(transform.exact_median(df, ["k"], "v", "m")) == wanted


@pytest.mark.parametrize("accuracy", [50, 10_000])
def test_median_of_a_hot_group(spark, accuracy):
    """A coarse sketch leaves most values outside the bracket, and the result stays exact."""
    df = spark.range(30_001).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise("cold").alias("k"),
        ((F.col("id") * 7919) % 30_011).alias("v"),
    )
    groups: dict = {}
    for row in df.collect():
        groups.setdefault(row.k, []).append(row.v)
    wanted = sorted((key, float(statistics.median(found))) for key, found in groups.items())
    assert rows(transform.exact_median(df, ["k"], "v", "m", accuracy)) == wanted


def test_non_empty(spark):
    df = spark.createDataFrame([("a",), ("",), (None,)], "s string")
    assert rows(transform.non_empty(df, "s")) == [("a",)]


def _level_of(values, groups):
    ids = ["k", "__c"]
    stacked = values.select("k", F.lit(0).alias("__c"), F.col("v").cast("double").alias("__v"))
    state = selection._start(stacked, ids, 1000)
    return selection.level(stacked, F.broadcast(state) if groups else state, ids)


def test_median_shuffles_counts_only(spark, tmp_path):
    """No exchange lies between the scan of the values and the first aggregate above the join, and
    no level gathers a group in a window."""
    spark.range(1000).selectExpr("id % 7 k", "cast(id * 37 % 101 as double) v").write.parquet(str(tmp_path / "v"))
    plan = _level_of(spark.read.parquet(str(tmp_path / "v")), 1)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    join = next(i for i, line in enumerate(lines) if "BroadcastHashJoin" in line)
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line)
    assert not [line for line in lines[join:scan] if "Exchange hashpartitioning" in line]
    assert "Window" not in plan and "partial_count" in plan
    values = spark.read.parquet(str(tmp_path / "v"))
    few, many = (transform.exact_median(values, ["k"], "v", "m", broadcast_groups=n) for n in (100, 0))
    assert rows(few) == rows(many)


@pytest.mark.parametrize("bins", [4, 512])
def test_medians_of_odd_distributions(spark, bins):
    """Powers over the whole range, infinities, ties, signed zeros and NULL keys; several columns."""
    wide = [math.ldexp(1.0, e) for e in range(-1070, 1020, 90)] + [-math.ldexp(1.0, e) for e in range(-1000, 1000, 200)]
    groups = {
        "wide": wide, "inf": [math.inf, -math.inf, math.inf, 1.7e308], "ends": [-1.7e308, 1.7e308, 1.6e308, -1.6e308],
        "ties": [1.0] * 50 + [2.0] * 50, "near": [1.0, 1.0 + 2**-52, 1.0 + 2**-51, 1.0 + 2**-50],
        "zero": [0.0, -0.0, 5e-324], "one": [7.0], None: [3.0, 4.0],
    }
    data = [(k, v, -v) for k, vs in groups.items() for v in vs] + [("none", None, None)]
    df = spark.createDataFrame(data, "k string, v double, w double").repartition(3)
    found = {r.k: (r.m, r.n) for r in selection.exact_medians(df, ["k"], {"m": F.col("v"), "n": F.col("w")}, bins=bins).collect()}
    for key, vs in groups.items():
        half = sorted(vs)[(len(vs) - 1) // 2] / 2 + sorted(vs)[len(vs) // 2] / 2
        assert found[key] == (pytest.approx(half, rel=1e-12, abs=0), pytest.approx(-half, rel=1e-12, abs=0)), key
    assert set(found) == set(groups)


def test_aggregates_that_cannot_be(spark):
    df = spark.createDataFrame([("a", "1", None), ("a", "x", None), ("b", None, None)], "k string, t string, d date")
    for keys, aggregates, message in (
        (["no"], {"t": "count"}, "no column no"),
        (["k"], {"no": "sum"}, "no column no"),
        (["k"], {"d": "sum"}, "d is date"),
        (["k"], {"t": ["sum", "nunique"]}, "t is text"),
    ):
        with pytest.raises(ValueError, match=message):
            transform.config_aggregate(df, keys, aggregates)
    assert rows(transform.config_aggregate(df, ["k"], {"t": "sum"})) == [("a", 1.0), ("b", None)]
