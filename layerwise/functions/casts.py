"""Casts that never throw on untrusted text, and missing-value policies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_integer(value: Column) -> Column:
    """Whole number; decimal text is truncated, anything else is NULL."""
    return F.coalesce(
        value.try_cast("bigint"), value.cast("string").try_cast("double").try_cast("bigint")
    )


def to_float(value: Column) -> Column:
    return value.cast("string").try_cast("double")


def to_boolean(value: Column) -> Column:
    return value.cast("string").try_cast("boolean")


def parse_timestamp(value: Column, formats: Sequence[str] = ()) -> Column:
    """ISO timestamps and dates, then the given patterns in order; NULL when none fits."""
    text = value.cast("string")
    iso = text.try_cast("timestamp_ntz")
    others = [F.try_to_timestamp(text, F.lit(p)).cast("timestamp_ntz") for p in formats]
    return F.coalesce(iso, *others)


def is_valid_date(value: Column, formats: Sequence[str] = ()) -> Column:
    return parse_timestamp(value, formats).isNotNull()


def is_missing(value: Column, empty_is_missing: bool = True) -> Column:
    if empty_is_missing:
        return value.isNull() | (value.cast("string") == "")
    return value.isNull()


def empty_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def null_to_empty(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def shorten(value: Column, limit: int = 4000) -> Column:
    """Text of at most ``limit`` characters, its end replaced by '...' where cut."""
    cut = F.concat(F.substring(value, 1, limit - 3), F.lit("..."))
    return F.when(F.length(value) > limit, cut).otherwise(value)
