"""Update, upsert and load with rejects on tables that have no MERGE.

Keys match by plain equality, so a NULL key matches nothing: it is inserted, never updated.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerwise.operators.dedup import splittable_equal
from layerwise.operators.schema import quoted


def _no_null(keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(key).isNotNull() for key in keys])


def one_per_key(
    source: DataFrame, keys: Sequence[str], latest: str | None = None
) -> DataFrame:
    """Source rows with usable keys, one per key.

    With ``latest`` the row with the greatest value of that column wins. Without, a repeated
    key stops the job, since the update would depend on row order.
    """
    if latest:
        order = Window.partitionBy(*keys).orderBy(F.desc_nulls_last(latest))
        ranked = source.filter(_no_null(keys)).withColumn("__rank", F.row_number().over(order))
        payload = [name for name in source.columns if name not in keys]
        return ranked.filter("__rank = 1").select(*keys, *payload)
    payload = [name for name in source.columns if name not in keys]
    row = F.struct(*payload) if payload else F.struct(F.lit(1).alias("__none"))
    pick = F.any_value(row)
    grouped = (
        source.filter(_no_null(keys))
        .groupBy(*keys)
        .agg(pick.alias("__row"), F.count(F.lit(1)).alias("__n"))
    )
    text = F.concat_ws("-", *[F.col(key).cast("string") for key in keys])
    stop = F.raise_error(F.concat(F.lit("repeated source key: "), text))
    grouped = grouped.withColumn("__row", F.when(F.col("__n") == 1, F.col("__row")).otherwise(stop))
    return grouped.select(*keys, *[F.col("__row")[name].alias(name) for name in payload])


def _updated(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows, matched ones with the source's values, and a ``__matched`` flag."""
    changed = [name for name in source.columns if name not in keys]
    unknown = [name for name in source.columns if name not in target.columns]
    if unknown:
        raise ValueError(f"not in the target: {', '.join(unknown)}")
    side = source.select(
        *[F.col(key).alias(f"__s_{key}") for key in keys],
        *[F.col(name).alias(f"__s_{name}") for name in changed],
    )
    # the source has no NULL keys, so none of the target's matches
    equal = [splittable_equal(F.col(key), F.col(f"__s_{key}")) for key in keys]
    condition = reduce(Column.__and__, equal)
    matched = F.col(f"__s_{keys[0]}").isNotNull()
    columns = []
    for item in target.schema.fields:
        value = quoted(item.name)
        if item.name in changed:
            new = F.col(f"__s_{item.name}").cast(item.dataType)
            value = F.when(matched, new).otherwise(value)
        columns.append(value.alias(item.name))
    return target.join(side, condition, "left").select(*columns, matched.alias("__matched"))


def batch_update(
    target: DataFrame, source: DataFrame, keys: Sequence[str], latest: str | None = None
) -> DataFrame:
    """Every target row; those whose key is in the source take the source's columns."""
    return _updated(target, one_per_key(source, keys, latest), keys).drop("__matched")


def upsert_actions(
    target: DataFrame, source: DataFrame, keys: Sequence[str], latest: str | None = None
) -> DataFrame:
    """The merged table with an ``action`` per row: KEPT, UPDATED or INSERTED.

    Two one-sided joins instead of a full outer join: adaptive execution can split a hot
    target key in the first, and the second sees each target key once.
    """
    usable = one_per_key(source, keys, latest)
    updated = _updated(target, usable, keys)
    kept = updated.withColumn(
        "action", F.when(F.col("__matched"), F.lit("UPDATED")).otherwise(F.lit("KEPT"))
    ).drop("__matched")
    new = usable.join(target.select(*keys).distinct(), list(keys), "left_anti")
    new = new.unionByName(source.filter(~_no_null(keys)))
    added = new.select(
        *[
            (F.col(f.name) if f.name in source.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.schema.fields
        ],
        F.lit("INSERTED").alias("action"),
    )
    return kept.unionByName(added)


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], latest: str | None = None
) -> DataFrame:
    return upsert_actions(target, source, keys, latest).drop("action")


def merge_counts(actions: DataFrame) -> DataFrame:
    """(rows_inserted, rows_updated, rows_kept) of ``upsert_actions``."""
    return actions.agg(
        F.count_if(F.col("action") == "INSERTED").alias("rows_inserted"),
        F.count_if(F.col("action") == "UPDATED").alias("rows_updated"),
        F.count_if(F.col("action") == "KEPT").alias("rows_kept"),
    )


@dataclass(frozen=True)
class Load:
    """``tried`` has the cast columns, the source row as ``source`` and ``reject_columns``."""

    tried: DataFrame
    columns: tuple[str, ...]

    @property
    def loaded(self) -> DataFrame:
        return self.tried.filter("reject_columns = ''").select(*self.columns)

    @property
    def rejected(self) -> DataFrame:
        return self.tried.filter("reject_columns <> ''").select("source.*", "reject_columns")

    def counts(self) -> DataFrame:
        return self.tried.agg(
            F.count_if(F.col("reject_columns") == "").alias("rows_loaded"),
            F.count_if(F.col("reject_columns") != "").alias("rows_rejected"),
        )


def load_with_rejects(df: DataFrame, target_types: Mapping[str, str | T.DataType]) -> Load:
    """Cast to the target's types; a row with a value that does not fit is rejected, not the load."""
    present = {name: kind for name, kind in target_types.items() if name in df.columns}
    casted = {name: quoted(name).try_cast(kind) for name, kind in present.items()}
    failed = [
        F.when(quoted(name).isNotNull() & value.isNull(), F.lit(name))
        for name, value in casted.items()
    ]
    tried = df.select(
        *[value.alias(name) for name, value in casted.items()],
        F.struct(*[quoted(name) for name in df.columns]).alias("source"),
        F.concat_ws(",", *failed).alias("reject_columns"),
    )
    return Load(tried, tuple(casted))
