"""Exact medians by distributed selection.

Every level counts values into a fixed number of bins per group, with partial counts in the tasks
that hold the values, and goes on in the bin that holds the middle rank, between the least and the
largest value that are really in it. A group takes part as one row of state, whatever its size, so
a group with most of the rows keeps all tasks busy and no task gathers its values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwise.operators.dedup import splittable_equal
from layerwise.session import scratch_path

#: Bins of a level: each level leaves about this part of a group's range.
BINS = 512
_LARGEST = 1.7976931348623157e308


def exact_medians(
    df: DataFrame,
    keys: Sequence[str],
    columns: Mapping[str, Column],
    accuracy: int = 1_000,
    broadcast_groups: int = 100_000,
    bins: int = BINS,
) -> DataFrame:
    """One row per key with the median of each of ``columns`` (name: value), NULL values left out;
    keys of which all values are NULL have no row.

    The first level's bins lie around the middle as a mergeable sketch sees it, with all values
    below and above in two further bins, so that a few levels do whatever the distribution; the
    sketch decides nothing. All columns and groups go through a level in one pass. The state of up
    to ``broadcast_groups`` groups is sent to the values; more are joined, which splits hot keys.
    """
    if bins < 4:
        raise ValueError("bins: four at least")
    ids = [*keys, "__c"]
    items = [F.struct(F.lit(i).alias("c"), v.cast("double").alias("v")) for i, v in enumerate(columns.values())]
    stacked = df.select(*keys, F.explode(F.array(*items)).alias("__i"))
    values = stacked.select(*keys, F.col("__i.c").alias("__c"), F.col("__i.v").alias("__v")).filter("__v IS NOT NULL")
    state, few = _kept(_start(values, ids, accuracy), broadcast_groups)
    settled = []
    while True:
        settled.append(state.filter("v1 IS NOT NULL"))
        state = state.filter("v1 IS NULL")
        if state.isEmpty():
            break
        state, few = _kept(level(values, F.broadcast(state) if few else state, ids, bins), broadcast_groups)
    found = reduce(DataFrame.unionByName, settled)
    middle = F.col("v1") / 2 + F.col("v2") / 2
    exact = F.when(F.col("v1") == F.col("v2"), F.col("v1")).otherwise(
        F.when(F.abs(F.col("v1") + F.col("v2")) <= _LARGEST, (F.col("v1") + F.col("v2")) / 2).otherwise(middle)
    )
    picks = [F.max(F.when(F.col("__c") == i, exact)).alias(name) for i, name in enumerate(columns)]
    return found.groupBy(*keys).agg(*picks)


def _start(values: DataFrame, ids: Sequence[str], accuracy: int) -> DataFrame:
    margin = 2.0 / accuracy
    around = F.percentile_approx("__v", [0.5 - margin, 0.5 + margin], accuracy)
    found = values.groupBy(*ids).agg(
        F.count(F.lit(1)).alias("total"), F.min("__v").alias("lo"), F.max("__v").alias("hi"), around.alias("around")
    )
    one_value = F.when(F.col("lo") == F.col("hi"), F.col("lo"))
    return found.select(
        *ids, "total", F.lit(0).cast("bigint").alias("below"), "lo", "hi",
        F.col("around")[0].alias("a"), F.col("around")[1].alias("b"), one_value.alias("v1"), one_value.alias("v2"),
    )


def _kept(state: DataFrame, most: int) -> tuple[DataFrame, bool]:
    """The state computed once: on the driver while there are few groups, else in the shared folder."""
    spark = state.sparkSession
    found = state.limit(most + 1).toArrow() if most else None
    if found is not None and found.num_rows <= most:
        return spark.createDataFrame(found, state.schema), True
    place = scratch_path(spark, "medians")
    state.write.parquet(place)
    return spark.read.schema(state.schema).parquet(place), False


def _bin(bins: int) -> Column:
    """0 below ``a``, the last above ``b``, and even parts of the range between in between."""

    def half(name: str) -> Column:
        return F.greatest(F.least(F.col(name), F.lit(_LARGEST)), F.lit(-_LARGEST)) / 2

    width = half("b") - half("a")
    part = F.when(width > 0, F.floor((half("__v") - half("a")) / width * (bins - 2))).otherwise(
        F.when(F.col("__v") > F.col("a"), bins).otherwise(0)
    )
    within = F.lit(1) + F.greatest(F.least(part, F.lit(bins - 3)), F.lit(0))
    return F.when(F.col("__v") < F.col("a"), 0).when(F.col("__v") > F.col("b"), bins - 1).otherwise(within).cast("int")


def level(values: DataFrame, state: DataFrame, ids: Sequence[str], bins: int = BINS) -> DataFrame:
    """The next state of groups whose middle is not found yet."""
    renamed = state.withColumnsRenamed({name: f"__r_{name}" for name in ids})
    same = reduce(Column.__and__, [splittable_equal(F.col(name), F.col(f"__r_{name}")) for name in ids])
    placed = values.join(renamed, same).filter((F.col("__v") >= F.col("lo")) & (F.col("__v") <= F.col("hi")))
    counted = placed.groupBy(*ids, "total", "below", _bin(bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.min("__v").alias("lo"), F.max("__v").alias("hi")
    )
    of_group = F.array_sort(F.collect_list(F.struct("bin", "n", "lo", "hi")))  # at most ``bins``
    groups = counted.groupBy(*ids, "total", "below").agg(of_group.alias("all"))
    place = "struct<bin: int, lo: double, hi: double, below: bigint>"

    def next_bin(acc: Column, one: Column) -> Column:
        upto = acc["seen"] + one["n"]

        def at(rank: str, before: Column) -> Column:
            here = F.struct(one["bin"].alias("bin"), one["lo"].alias("lo"), one["hi"].alias("hi"), acc["seen"].alias("below"))
            wanted = F.expr(rank)
            return F.when((acc["seen"] < wanted) & (wanted <= upto), here.cast(place)).otherwise(before)

        return F.struct(
            upto.alias("seen"),
            at("(total + 1) div 2", acc["low"]).alias("low"),
            at("(total + 2) div 2", acc["high"]).alias("high"),
        )

    none = F.lit(None).cast(place)
    start = F.struct(F.col("below").alias("seen"), none.alias("low"), none.alias("high"))
    found = groups.withColumn("found", F.aggregate("all", start, next_bin))
    low, high = F.col("found.low"), F.col("found.high")
    one_bin = low["bin"] == high["bin"]
    one_value = F.when(low["lo"] == low["hi"], low["lo"])
    return found.select(
        *ids,
        "total",
        low["below"].alias("below"),
        low["lo"].alias("lo"),
        low["hi"].alias("hi"),
        low["lo"].alias("a"),
        low["hi"].alias("b"),
        # middle ranks in two bins are the last of the one and the first of the other
        F.when(one_bin, one_value).otherwise(low["hi"]).alias("v1"),
        F.when(one_bin, one_value).otherwise(high["lo"]).alias("v2"),
    )
