"""Brand, table and date from file names and paths."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def slugify(name: Column) -> Column:
    """'My Brand Name' -> 'my_brand_name', keeping a-z, 0-9 and underscore."""
    joined = F.regexp_replace(F.lower(name), r"(?U)\s+", "_")
    return F.regexp_replace(joined, "[^a-z0-9_]", "")


def readable_brand(slug: Column) -> Column:
    return F.initcap(F.replace(slug, F.lit("_"), F.lit(" ")))


def normalise_brand(name: Column) -> Column:
    """Key for tolerant brand matching: case, hyphens and runs of spaces do not count."""
    spaced = F.replace(F.lower(name), F.lit("-"), F.lit(" "))
    return F.trim(F.regexp_replace(spaced, r"(?U)\s+", " "))


def decode_file_name(name: Column) -> Column:
    """Undo the URL encoding of ``_metadata.file_name``; a '+' in the name stays a '+'."""
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def parse_source_name(name: Column) -> Column:
    """``Brand_Table_YYYYMMDD.csv`` -> struct(brand, table, filedate).

    The brand may hold underscores. All three are NULL for other extensions and for
    names of fewer than three parts.
    """
    base = F.substring(name, F.lit(1), F.length(name) - 4)
    parts = F.split(base, "_")
    size = F.size(parts)
    valid = F.lower(name).endswith(".csv") & (size >= 3)
    brand = F.array_join(F.slice(parts, F.lit(1), F.greatest(size - 2, F.lit(0))), "_")
    return F.struct(
        F.when(valid, brand).alias("brand"),
        F.when(valid, F.try_element_at(parts, F.lit(-2))).alias("table"),
        F.when(valid, F.try_element_at(parts, F.lit(-1))).alias("filedate"),
    )


def table_from_stem(stem: Column, known: Sequence[str]) -> Column:
    """Table of ``Brand_Table_YYYYMMDD``; else the first known table it mentions; else itself."""
    parts = F.split(stem, "_")
    dated = (F.size(parts) >= 2) & F.try_element_at(parts, F.lit(-1)).rlike("^[0-9]{8}$")
    mentioned = [F.when(stem.contains(table), F.lit(table)) for table in known]
    return F.when(dated, F.try_element_at(parts, F.lit(-2))).otherwise(F.coalesce(*mentioned, stem))


def table_from_gold_stem(stem: Column) -> Column:
    """``Table_YYYYMMDD`` -> table, NULL when the last part is no date."""
    table = F.regexp_extract(stem, "^(.+)_[0-9]{8}$", 1)
    return F.nullif(table, F.lit(""))


def date_token(key: Column, fallback: Column) -> Column:
    """Date of an object key: ``_YYYYMMDD.csv`` at its end, else a ``/YYYYMMDD/`` folder."""
    at_end = F.nullif(F.regexp_extract(key, r"_(\d{8})\.csv$", 1), F.lit(""))
    folder = F.nullif(F.regexp_extract(key, r"/(\d{8})/", 1), F.lit(""))
    return F.coalesce(at_end, folder, fallback)


def first_date_digits(name: Column) -> Column:
    """First run of eight digits anywhere in a name, NULL without one."""
    return F.nullif(F.regexp_extract(name, r"(\d{8})", 1), F.lit(""))


def iso_date(token: Column) -> Column:
    """YYYYMMDD -> YYYY-MM-DD; tokens of another length stay as they are."""
    dashed = F.concat_ws(
        "-", F.substring(token, 1, 4), F.substring(token, 5, 2), F.substring(token, 7, 2)
    )
    return F.when(F.length(token) == 8, dashed).otherwise(token)
