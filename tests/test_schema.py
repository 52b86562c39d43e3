from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from layerwise.operators import schema


def test_harmonized_union_widens_and_fills(spark):
    a = spark.createDataFrame([(1, 2.5, 7, "x")], "id int, n double, SSOID int, only_a string")
    b = spark.createDataFrame([("k", 3, "s", True)], "ID string, n int, ssoid string, only_b boolean")
    c = spark.createDataFrame([(9, None)], "id bigint, n void")
    out = schema.harmonized_union([a, b, c])
    assert out.dtypes == [
        ("id", "string"),
        ("n", "double"),
        ("SSOID", "string"),
        ("only_a", "string"),
        ("only_b", "boolean"),
    ]
    assert rows(out) == [
        ("1", 2.5, "7", "x", None),
        ("9", None, None, None, None),
        ("k", 3.0, "s", None, True),
    ]


def test_harmonized_union_keeps_every_row_and_any_order(spark):
    frames = [
        spark.range(i * 10, i * 10 + 10).select(F.col("id").alias(name), F.lit(i).alias("part"))
        for i, name in enumerate(["v", "V", "w", "v"])
    ]
    one, other = schema.harmonized_union(frames), schema.harmonized_union(frames[::-1])
    assert one.count() == 40
    assert rows(one.select("v", "w", "part")) == rows(other.select("v", "w", "part"))


def test_integers_widen_to_long_and_structs_to_json(spark):
    a = spark.sql("SELECT 1 AS n, struct(1 AS x) AS s")
    b = spark.sql("SELECT 3000000000L AS n, 'text' AS s")
    out = schema.harmonized_union([a, b])
    assert out.dtypes == [("n", "bigint"), ("s", "string")]
    assert rows(out) == [(1, '{"x":1}'), (3000000000, "text")]


def test_stringify(spark):
    df = spark.sql("SELECT 1 AS userId, 2 AS PlayID, 3 AS n, 4L AS big, array(1, 2) AS a, date'2025-01-02' AS d")
    assert schema.stringify_ids(df).dtypes[:3] == [("userId", "string"), ("PlayID", "string"), ("n", "int")]
    out = schema.stringify_complex(df)
    assert dict(out.dtypes) == {
        "userId": "int", "PlayID": "int", "n": "int", "big": "string", "a": "string", "d": "string",
    }
    assert rows(out.select("big", "a", "d")) == [("4", "[1,2]", "2025-01-02")]


def test_schema_cast(spark):
    df = spark.createDataFrame([("12.0", "x", "nope", 5, "a")], "i string, f string, d string, s int, other string")
    declared = {"I": "integer", "f": "float", "d": "date", "s": "string", "absent": "integer"}
    out = schema.schema_cast(df, declared, conversions={"OTHER": F.upper})
    assert out.columns == ["i", "f", "d", "s", "other", "d_valid"]
    assert rows(out) == [(12, None, "nope", "5", "A", False)]
    assert "d_valid" not in schema.schema_cast(df, declared, valid_flags=False).columns
    with pytest.raises(ValueError, match="decimal"):
        schema.schema_cast(df, {"i": "decimal"})


def test_null_policy(spark):
    df = spark.createDataFrame([("", "", 1), (None, None, 2)], "s string, license_end string, n int")
    out = schema.apply_null_policy(df, "empty_to_null", ["LICENSE_END"])
    assert rows(out) == [(None, None, 1), (None, None, 2)]
    out = schema.apply_null_policy(df, "null_to_empty", ["license_end"])
    assert rows(out) == [("", None, 1), ("", None, 2)]
    with pytest.raises(KeyError):
        schema.apply_null_policy(df, "other")


def test_lineage_keeps_colliding_source_columns(spark):
    df = spark.createDataFrame([("own", "20250101", 1)], "Brand string, FILEDATE string, loaddate int")
    out = schema.add_lineage(
        df,
        {"BRAND": F.lit("file"), "FILEDATE": F.lit("other")},
        {"LOADDATE": F.lit("now")},
    )
    assert out.columns == ["brand_src", "FILEDATE", "loaddate_src", "BRAND", "LOADDATE"]
    assert rows(out) == [("own", "20250101", 1, "file", "now")]


def test_projection_to_target(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "id int, Group int, extra int, `odd name` int")
    assert schema.project_to_target(df, ["ID", "group"]).columns == ["ID"]
    assert schema.project_to_target(df, ["ID", '"GROUP"']).columns == ["ID", "GROUP"]
    assert schema.project_to_target(df, ["GROUP", "odd NAME"], reserved=()).columns == ["GROUP", "ODD NAME"]
    with pytest.raises(ValueError, match="no column"):
        schema.project_to_target(df, ["missing"])
