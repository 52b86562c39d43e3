from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from layerwise.functions import casts, names


def values(spark, texts, *columns):
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    return [tuple(r) for r in df.select(*columns).collect()]


@pytest.mark.parametrize(
    ("name", "brand", "table", "date"),
    [
        ("Star North_Device_20250416.csv", "Star North", "Device", "20250416"),
        ("North - Resellers_Playback_20250416.csv", "North - Resellers", "Playback", "20250416"),
        ("Arts+ West_EPG_20250416.CSV", "Arts+ West", "EPG", "20250416"),
        ("My_Brand_User_20250416.csv", "My_Brand", "User", "20250416"),
        ("Device_20250416.csv", None, None, None),
        ("notes.txt", None, None, None),
        ("csv", None, None, None),
    ],
)
def test_parse_source_name(spark, name, brand, table, date):
    parsed = names.parse_source_name(F.col("x"))
    found = values(spark, [name], parsed["brand"], parsed["table"], parsed["filedate"])
    assert found == [(brand, table, date)]


def test_table_names_from_stems(spark):
    stems = ["North_Device_20250416", "my EPG export", "other", "VOD_Catalog_20250416", "20250416"]
    found = values(
        spark,
        stems,
        names.table_from_stem(F.col("x"), ["Device", "EPG"]),
        names.table_from_gold_stem(F.col("x")),
    )
    assert found == [
        ("Device", "North_Device"),
        ("EPG", None),
        ("other", None),
        ("Catalog", "VOD_Catalog"),
        ("20250416", None),
    ]


def test_slug_and_match_key(spark):
    found = values(
        spark,
        ["Arts+  Plus\tWest", " North TV - Resellers"],
        names.slugify(F.col("x")),
        names.readable_brand(names.slugify(F.col("x"))),
        names.normalise_brand(F.col("x")),
    )
    assert found == [
        ("arts_plus_west", "Arts Plus West", "arts+ plus west"),
        ("_north_tv__resellers", " North Tv  Resellers", "north tv resellers"),
    ]


def test_date_tokens(spark):
    token = names.date_token(F.col("x"), F.lit("today"))
    found = values(
        spark,
        ["in/A_B_20250416.csv", "raw/20250415/x.csv", "x.csv", "v1234567890.csv"],
        token,
        names.iso_date(token),
        names.first_date_digits(F.col("x")),
    )
    assert found == [
        ("20250416", "2025-04-16", "20250416"),
        ("20250415", "2025-04-15", "20250415"),
        ("today", "today", None),
        ("today", "today", "12345678"),
    ]


def test_encoded_names_keep_plus_and_spaces(spark):
    assert values(spark, ["Arts+%20West%C3%A9.csv"], names.decode_file_name(F.col("x"))) == [
        ("Arts+ Westé.csv",)
    ]


def test_casts_never_throw(spark):
    texts = ["12", "12.7", "x", "", None, "9007199254740993", "1e3"]
    found = values(spark, texts, casts.to_integer(F.col("x")), casts.to_float(F.col("x")))
    assert [f[0] for f in found] == [12, 12, None, None, None, 9007199254740993, 1000]
    assert [f[1] for f in found] == [12.0, 12.7, None, None, None, 9007199254740992.0, 1000.0]
    found = values(spark, ["true", "False", "0", "maybe", None], casts.to_boolean(F.col("x")))
    assert [f[0] for f in found] == [True, False, False, None, None]


def test_dates(spark):
    texts = ["2025-04-16", "16/04/2025", "2025-13-01", "nope", None, "2025-04-16 10:11:12"]
    found = values(
        spark,
        texts,
        casts.is_valid_date(F.col("x")),
        casts.is_valid_date(F.col("x"), ["dd/MM/yyyy"]),
    )
    assert found == [
        (True, True),
        (False, True),
        (False, False),
        (False, False),
        (False, False),
        (True, True),
    ]


def test_missing_and_shorten(spark):
    found = values(
        spark,
        ["", None, "ab", "abcdef"],
        casts.is_missing(F.col("x")),
        casts.is_missing(F.col("x"), empty_is_missing=False),
        casts.empty_to_null(F.col("x")),
        casts.null_to_empty(F.col("x")),
        casts.shorten(F.col("x"), 5),
    )
    assert found == [
        (True, False, None, "", ""),
        (True, True, None, "", None),
        (False, False, "ab", "ab", "ab"),
        (False, False, "abcdef", "abcdef", "ab..."),
    ]
