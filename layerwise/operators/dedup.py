"""Key-based duplicate handling.

None of these gathers the rows of one key in one task: keep-first leaves at most one row per
key and map task before the shuffle, the marks compare each row with a pre-aggregated table
of repeated keys, and the counts are partial aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def order_value(order: Sequence[str]) -> Column:
    """One comparable value for a total order over rows."""
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def splittable_equal(left: Column, right: Column) -> Column:
    """Key equality for a join with an aggregate on the right, where NULL equals NULL.

    A plain equality would reuse the aggregate's own partitioning, and adaptive execution
    splits a hot key only where a shuffle feeds the join directly. The null-safe form hashes
    differently, which puts that shuffle, of the aggregated side, in.
    """
    return left.eqNullSafe(right)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key in the given total order. NULL keys equal each other."""
    if not set(keys) <= set(df.columns):
        return df
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).filter("__rank = 1").drop("__rank")


def keep_any(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, no matter which."""
    return df.dropDuplicates(list(keys)) if set(keys) <= set(df.columns) else df


def mark_repeats(
    df: DataFrame,
    keys: Sequence[str],
    name: str,
    keep: str = "first",
    order: Sequence[str] = (),
) -> DataFrame:
    """Add a boolean: is this row a repeat (``keep='first'``), or in any repeated group (``'none'``).

    Only keys that repeat reach the join. If those are many, it is a shuffle join with one
    row per key on the small side, whose hot keys adaptive execution splits.
    """
    aggs = [F.count(F.lit(1)).alias("__n")]
    if keep == "first":
        aggs.append(F.min(order_value(order)).alias("__first"))
    elif keep != "none":
        raise ValueError(f"keep must be 'first' or 'none', not {keep!r}")
    renamed = [F.col(key).alias(f"__key{i}") for i, key in enumerate(keys)]
    repeated = df.groupBy(*renamed).agg(*aggs).filter("__n > 1")
    condition = F.lit(True)
    for i, key in enumerate(keys):
        condition = condition & splittable_equal(F.col(key), F.col(f"__key{i}"))
    joined = df.join(repeated, condition, "left")
    flag = F.col("__n").isNotNull()
    if keep == "first":
        flag = flag & (order_value(order) != F.col("__first"))
    return joined.withColumn(name, F.coalesce(flag, F.lit(False))).select(*df.columns, name)


def duplicate_values(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Repeated keys as '-'-joined text, with their number of rows."""
    text = [F.coalesce(F.col(key).cast("string"), F.lit("None")) for key in keys]
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter("n_rows > 1")
        .select(F.concat_ws("-", *text).alias("duplicate_value"), "n_rows")
    )


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys and the difference. Two partial aggregates, no Expand."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
    ).withColumn("n_duplicates", F.col("n_rows") - F.col("n_keys"))


def candidate_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Do these columns identify rows: no NULL, and no key twice."""
    has_null = F.lit(False)
    for key in keys:
        has_null = has_null | F.col(key).isNull()
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.coalesce(F.sum(F.when(has_null, F.col("n"))), F.lit(0)).alias("n_null_rows"),
    ).withColumn("is_key", (F.col("n_rows") == F.col("n_keys")) & (F.col("n_null_rows") == 0))
