"""Brand code lookup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwise.functions.names import normalise_brand
from layerwise.operators.dedup import splittable_equal
from layerwise.session import local_frame

# A lookup side is broadcast only when counted to hold at most this many rows and bytes.
BROADCAST_MAX_ROWS = 10_000
BROADCAST_MAX_BYTES = 8 * 1024 * 1024


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """Hint a broadcast if a bounded count proves the frame small, else leave the choice to AQE.

    Beyond the bound the join is a shuffle join whose hot keys adaptive execution splits.
    """
    row_bytes = F.octet_length(F.to_json(F.struct("*")))
    seen = (
        df.limit(BROADCAST_MAX_ROWS + 1)
        .agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes).alias("size"))
        .first()
    )
    if seen.n <= BROADCAST_MAX_ROWS and (seen["size"] or 0) <= BROADCAST_MAX_BYTES:
        return F.broadcast(df)
    return df


def brand_frame(spark: SparkSession, brands: Sequence[tuple[str, str]]) -> DataFrame:
    """(position, file_name, brand_code) rows of the brand configuration."""
    rows = [(i, name, code) for i, (name, code) in enumerate(brands)]
    return local_frame(spark, rows, "position int, file_name string, brand_code string")


def _lookup(spark: SparkSession, dim: DataFrame | Sequence[tuple[str, str]], match: str) -> DataFrame:
    """One code per match key, the last listed for a repeated key, broadcast if known small.

    A configured list is measured here. A frame is measured with a bounded count.
    """
    listed = not isinstance(dim, DataFrame)
    # in one partition the grouping of a list needs no shuffle
    frame = brand_frame(spark, dim).coalesce(1) if listed else dim
    keyed = (
        frame.groupBy(_key(match, F.col("file_name")).alias("__brand_key"))
        .agg(F.max_by("brand_code", "position").alias("__code"))
        .filter(F.col("__brand_key").isNotNull())
    )
    if not listed:
        return broadcast_if_small(keyed)
    size = sum(len(name.encode()) + len(code.encode()) for name, code in dim)
    small = len(dim) <= BROADCAST_MAX_ROWS and size <= BROADCAST_MAX_BYTES
    return F.broadcast(keyed) if small else keyed


def _key(match: str, value: Column) -> Column:
    if match == "normalised":
        return normalise_brand(value)
    if match == "exact":
        return value
    raise ValueError(f"unknown brand match {match!r}")


def enrich_brand(
    df: DataFrame,
    dim: DataFrame | Sequence[tuple[str, str]],
    match: str = "normalised",
    brand: str = "BRAND",
    code: str = "BRAND_CODE",
    fallback: bool = True,
) -> DataFrame:
    """Add the brand code; a brand that is not listed keeps its name unless ``fallback`` is off.

    ``dim`` is the configured (file name, code) list, or a frame as of ``brand_frame``.
    """
    lookup = _lookup(df.sparkSession, dim, match)
    joined = df.join(lookup, splittable_equal(_key(match, F.col(brand)), F.col("__brand_key")), "left")
    value = F.coalesce("__code", brand) if fallback else F.col("__code")
    return joined.withColumn(code, value).drop("__brand_key", "__code")


def unmatched_brands(
    df: DataFrame,
    dim: DataFrame | Sequence[tuple[str, str]],
    match: str = "normalised",
    brand: str = "BRAND",
) -> DataFrame:
    """Distinct brands without an entry. Brands are reduced first, so the join is tiny."""
    names = df.select(brand).distinct()
    lookup = _lookup(df.sparkSession, dim, match)
    return names.join(lookup, _key(match, F.col(brand)) == F.col("__brand_key"), "left_anti")
