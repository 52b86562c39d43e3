from __future__ import annotations

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from layerwise.operators import merge


@pytest.fixture
def target(spark):
    data = [(1, "a", 1.0), (1, "b", 2.0), (2, "c", 3.0), (None, "n", 4.0)]
    return spark.createDataFrame(data, "k int, name string, v double")


def test_update_takes_source_values_even_null(spark, target):
    source = spark.createDataFrame([(1, None), (9, 5.0), (None, 6.0)], "k int, v double")
    out = merge.batch_update(target, source, ["k"])
    assert out.columns == target.columns
    assert rows(out) == [(1, "a", None), (1, "b", None), (2, "c", 3.0), (None, "n", 4.0)]


def test_upsert_inserts_and_keeps(spark, target):
    source = spark.createDataFrame([(2, 9.0), (3, 7.0), (None, 6.0), (None, 8.0)], "k int, v double")
    out = merge.upsert_actions(target, source, ["k"])
    assert rows(out) == [
        (1, "a", 1.0, "KEPT"),
        (1, "b", 2.0, "KEPT"),
        (2, "c", 9.0, "UPDATED"),
        (3, None, 7.0, "INSERTED"),
        (None, "n", 4.0, "KEPT"),
        (None, None, 6.0, "INSERTED"),
        (None, None, 8.0, "INSERTED"),
    ]
    assert rows(merge.merge_counts(out)) == [(3, 1, 3)]


def test_upsert_twice_is_upsert_once(spark, target):
    clean = target.filter("k IS NOT NULL")
    source = spark.createDataFrame([(2, "z", 9.0), (3, "y", 7.0)], "k int, name string, v double")
    once = merge.upsert(clean, source, ["k"])
    assert rows(merge.upsert(once, source, ["k"])) == rows(once)


def test_two_key_columns(spark):
    target = spark.createDataFrame([(1, "x", 0), (1, "y", 0)], "a int, b string, v int")
    source = spark.createDataFrame([(1, "x", 5), (2, "y", 6), (1, None, 7)], "a int, b string, v int")
    out = merge.upsert_actions(target, source, ["a", "b"])
    assert rows(out) == [
        (1, "x", 5, "UPDATED"),
        (1, "y", 0, "KEPT"),
        (1, None, 7, "INSERTED"),
        (2, "y", 6, "INSERTED"),
    ]


def test_repeated_source_keys(spark, target):
    source = spark.createDataFrame([(1, 5.0, 1), (1, 6.0, 2)], "k int, v double, at int")
    with pytest.raises(PySparkException, match="repeated source key: 1"):
        merge.batch_update(target, source.drop("at"), ["k"]).collect()
    usable = merge.one_per_key(source, ["k"], latest="at").drop("at")
    assert rows(merge.batch_update(target, usable, ["k"]).filter("k = 1").select("v").distinct()) == [(6.0,)]
    with pytest.raises(ValueError, match="at"):
        merge.batch_update(target, source, ["k"])


def test_load_with_rejects(spark):
    df = spark.createDataFrame(
        [("1", "2025-01-01", "x"), ("y", "2025-01-02", "x"), (None, "nope", "x"), ("z", "z", "x")],
        "n string, d string, extra string",
    )
    load = merge.load_with_rejects(df, {"n": "int", "d": "date", "absent": "int"})
    assert rows(load.counts()) == [(1, 3)]
    assert load.loaded.dtypes == [("n", "int"), ("d", "date")]
    assert load.loaded.count() == 1
    assert rows(load.rejected) == [
        ("y", "2025-01-02", "x", "n"),
        ("z", "z", "x", "n,d"),
        (None, "nope", "x", "d"),
    ]


def test_casts_to_target_type(spark):
    target = spark.createDataFrame([(1, 1)], "k int, v bigint")
    source = spark.createDataFrame([(1, 7)], "k int, v int")
    out = merge.upsert(target, source, ["k"])
    assert out.schema == target.schema or out.dtypes == target.dtypes
    assert out.agg(F.sum("v")).first()[0] == 7
