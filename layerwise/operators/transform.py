"""Configuration-driven filter and aggregation."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerwise.functions.casts import to_float
from layerwise.operators.dedup import order_value, splittable_equal
from layerwise.operators.selection import exact_medians
from layerwise.session import lenient


@dataclass(frozen=True)
class Filtered:
    df: DataFrame
    error: str | None = None


# Spellings a filter text may use next to plain SQL.
_SPELLINGS = {"&": " AND ", "|": " OR ", "~": " NOT ", "[": "(", "]": ")"}


def sql_filter_text(text: str) -> str:
    """``&``, ``|``, ``~`` and ``[..]`` lists outside of quotes in their SQL spelling."""
    pieces = re.split(r"""('[^']*'|"[^"]*"|`[^`]*`)""", text)
    for i in range(0, len(pieces), 2):
        pieces[i] = re.sub(r"[&|~\[\]]", lambda m: _SPELLINGS[m.group()], pieces[i])
    return "".join(pieces)


def config_filter(df: DataFrame, text: str | None) -> Filtered:
    """Rows for which the text holds. Text Spark cannot analyse leaves the frame as it is."""
    if not text:
        return Filtered(df)
    try:
        with lenient(df.sparkSession):
            return Filtered(df.filter(F.expr(sql_filter_text(text))))
    except (AnalysisException, ParseException) as error:
        return Filtered(df, str(error.getCondition()))


def non_empty(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull() & (F.col(column) != ""))


AGGREGATES: dict[str, Callable[[Column], Column]] = {
    "sum": F.sum,
    "mean": F.avg,
    "avg": F.avg,
    "min": F.min,
    "max": F.max,
    "count": F.count,
    "nunique": F.count_distinct,
    "std": F.stddev_samp,
    "var": F.var_samp,
}


def config_aggregate(
    df: DataFrame,
    keys: Sequence[str],
    aggregates: Mapping[str, str | Sequence[str]],
    order: Sequence[str] = (),
    dropna: bool = True,
) -> DataFrame:
    """Group by ``keys`` and apply named aggregates, ``{column: name or names}``.

    A column with one name keeps its own name, one with a list becomes ``column_name`` per
    entry. ``first`` and ``last`` are the non-missing values at the ends of ``order``.
    Missing values never count; ``dropna`` drops rows with a NULL key.
    """
    if not keys or not aggregates:
        return df
    absent = [c for c in (*keys, *aggregates) if c not in df.columns]
    if absent:
        raise ValueError(f"no column {', '.join(absent)}")
    if dropna:
        df = df.dropna(subset=list(keys))
    df = _numeric(df, aggregates)
    plain: list[Column] = []
    ends: list[Column] = []
    medians: list[tuple[str, str]] = []
    outputs: list[str] = []
    for column, names in aggregates.items():
        many = not isinstance(names, str)
        for name in names if many else [names]:
            alias = f"{column}_{name}" if many else column
            outputs.append(alias)
            if name == "median":
                medians.append((column, alias))
            else:
                chosen = ends if name in ("first", "last") else plain
                chosen.append(_aggregate(df, column, name, order).alias(alias))
    # ends sort their input by key, so they are kept out of the hash aggregate of the others
    parts = [df.groupBy(*keys).agg(*group) for group in (plain, ends) if group]
    if medians:
        parts.append(exact_medians(df, keys, {alias: _present(df, column) for column, alias in medians}))
    # every group has a size, while a group of missing values only has no median
    first = parts[0] if plain or ends else df.select(*keys).distinct()
    rest = parts[1:] if plain or ends else parts
    joined = reduce(lambda left, right: _join_on(left, right, keys), rest, first)
    return joined.select(*keys, *outputs)


_NUMERIC = {"sum", "mean", "avg", "std", "var", "median"}


def _numeric(df: DataFrame, aggregates: Mapping[str, str | Sequence[str]]) -> DataFrame:
    """Text columns of numeric aggregates as numbers, NULL where they hold none. A type that
    holds no numbers is an error."""
    changed = {}
    for column, names in aggregates.items():
        wanted = {names} if isinstance(names, str) else set(names)
        kind = df.schema[column].dataType
        if not wanted & _NUMERIC or isinstance(kind, T.NumericType):
            continue
        if not isinstance(kind, T.StringType):
            raise ValueError(f"{column} is {kind.simpleString()}: no {', '.join(sorted(wanted & _NUMERIC))}")
        if wanted <= _NUMERIC:
            changed[column] = to_float(F.col(column))
        else:
            raise ValueError(f"{column} is text: {', '.join(sorted(wanted & _NUMERIC))} cannot go with the others")
    return df.withColumns(changed) if changed else df


def _present(df: DataFrame, column: str) -> Column:
    """The value with NaN as missing, as NULL is."""
    value = F.col(column)
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(value), value)
    return value


def _aggregate(df: DataFrame, column: str, name: str, order: Sequence[str]) -> Column:
    if name == "size":
        return F.count(F.lit(1))
    value = _present(df, column)
    if name in ("first", "last"):
        if not order:
            raise ValueError(f"aggregate {name!r} needs an order")
        pick = F.min_by if name == "first" else F.max_by
        return pick(value, F.when(value.isNotNull(), order_value(order)))
    if name not in AGGREGATES:
        known = ", ".join(sorted([*AGGREGATES, "first", "last", "median", "size"]))
        raise ValueError(f"unknown aggregate {name!r}; known: {known}")
    return AGGREGATES[name](value)


def _join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on keys that may be NULL, keeping the left keys."""
    renamed = right.withColumnsRenamed({key: f"__r_{key}" for key in keys})
    condition = reduce(
        Column.__and__, [splittable_equal(F.col(key), F.col(f"__r_{key}")) for key in keys]
    )
    return left.join(renamed, condition, how).drop(*[f"__r_{key}" for key in keys])


def exact_median(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    alias: str,
    accuracy: int = 1_000,
    broadcast_groups: int = 100_000,
) -> DataFrame:
    """Exact median per key without gathering a group's values in one place (``selection``)."""
    return exact_medians(df, keys, {alias: _present(df, column)}, accuracy, broadcast_groups)
