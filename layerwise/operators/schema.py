"""Type harmonising, declared casts, lineage columns and projection to a target."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerwise.functions import casts

_COMPLEX = (T.ArrayType, T.MapType, T.StructType)
_GOLD_PRIMITIVES = (
    T.StringType,
    T.IntegerType,
    T.FloatType,
    T.BooleanType,
    T.TimestampType,
)


def find_column(df: DataFrame, name: str) -> str | None:
    """The frame's own spelling of a column, looked up without regard to case."""
    wanted = name.lower()
    return next((c for c in df.columns if c.lower() == wanted), None)


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def as_string(value: Column, data_type: T.DataType) -> Column:
    return F.to_json(value) if isinstance(data_type, _COMPLEX) else value.cast("string")


def common_type(types: Sequence[T.DataType]) -> T.DataType:
    """Narrowest type that holds all: same type, wider number, else string."""
    known = [t for t in types if not isinstance(t, T.NullType)]
    if not known:
        return T.StringType()
    if all(t == known[0] for t in known):
        return known[0]
    if all(isinstance(t, T.IntegralType) for t in known):
        return T.LongType()
    if all(isinstance(t, T.NumericType) for t in known):
        return T.DoubleType()
    return T.StringType()


def harmonized_union(
    frames: Sequence[DataFrame], always_string: Sequence[str] = ("SSOID",)
) -> DataFrame:
    """UNION ALL over the union of columns, each widened to a type all frames fit in.

    Columns are matched without regard to case and keep the first spelling seen. One frame
    stands for one file schema, so the plan grows with the number of schemas, not of files.
    """
    spelling: dict[str, str] = {}
    types: dict[str, list[T.DataType]] = {}
    for frame in frames:
        for item in frame.schema.fields:
            spelling.setdefault(item.name.lower(), item.name)
            types.setdefault(item.name.lower(), []).append(item.dataType)
    forced = {name.lower() for name in always_string}
    target = {
        key: T.StringType() if key in forced else common_type(seen) for key, seen in types.items()
    }

    def aligned(frame: DataFrame) -> DataFrame:
        own = {item.name.lower(): item for item in frame.schema.fields}
        columns = []
        for key, data_type in target.items():
            if key not in own:
                value = F.lit(None).cast(data_type)
            elif isinstance(data_type, T.StringType):
                value = as_string(quoted(own[key].name), own[key].dataType)
            else:
                value = quoted(own[key].name).cast(data_type)
            columns.append(value.alias(spelling[key]))
        return frame.select(*columns)

    return reduce(DataFrame.unionByName, [aligned(frame) for frame in frames])


def stringify_ids(df: DataFrame) -> DataFrame:
    """Every identifier-like column (``SSOID``, ``*ID`` or a name containing 'id') as string."""
    return df.select(
        *[
            as_string(quoted(f.name), f.dataType).alias(f.name)
            if f.name == "SSOID" or f.name.endswith("ID") or "id" in f.name.lower()
            else quoted(f.name)
            for f in df.schema.fields
        ]
    )


def stringify_complex(
    df: DataFrame, keep: Sequence[type[T.DataType]] = _GOLD_PRIMITIVES
) -> DataFrame:
    """Every column whose type is not kept as string; arrays, maps and structs as JSON."""
    return df.select(
        *[
            quoted(f.name)
            if isinstance(f.dataType, tuple(keep))
            else as_string(quoted(f.name), f.dataType).alias(f.name)
            for f in df.schema.fields
        ]
    )


def schema_cast(
    df: DataFrame,
    declared: Mapping[str, str],
    date_formats: Sequence[str] = (),
    valid_flags: bool = True,
    conversions: Mapping[str, Callable[[Column], Column]] | None = None,
) -> DataFrame:
    """Cast to the declared types (string, integer, float, boolean, date) in one projection.

    Text that does not fit becomes NULL. A date keeps its text and, with ``valid_flags``,
    gains a ``<column>_valid`` boolean. ``conversions`` are applied last, per column.
    """
    by_name = {name.lower(): kind for name, kind in declared.items()}
    extra = {name.lower(): fn for name, fn in (conversions or {}).items()}
    columns: list[Column] = []
    flags: list[Column] = []
    for item in df.schema.fields:
        kind = by_name.get(item.name.lower())
        value = quoted(item.name)
        if kind == "string":
            value = as_string(value, item.dataType)
        elif kind == "integer":
            value = casts.to_integer(value)
        elif kind == "float":
            value = casts.to_float(value)
        elif kind == "boolean":
            value = casts.to_boolean(value)
        elif kind == "date":
            if valid_flags:
                flag = casts.is_valid_date(value, date_formats)
                flags.append(flag.alias(f"{item.name}_valid"))
        elif kind is not None:
            raise ValueError(f"column {item.name}: unknown declared type {kind!r}")
        if item.name.lower() in extra:
            value = extra[item.name.lower()](value)
        columns.append(value.alias(item.name))
    return df.select(*columns, *flags)


def apply_null_policy(
    df: DataFrame, strings: str = "empty_to_null", date_columns: Sequence[str] = ()
) -> DataFrame:
    """One missing-value form for strings: ``empty_to_null``, ``null_to_empty`` or ``keep``.

    ``date_columns`` always turn '' into NULL, since a target rejects '' as a date.
    """
    policies = {
        "empty_to_null": casts.empty_to_null,
        "null_to_empty": casts.null_to_empty,
        "keep": lambda value: value,
    }
    convert = policies[strings]
    dates = {name.lower() for name in date_columns}
    columns = []
    for item in df.schema.fields:
        value = quoted(item.name)
        if isinstance(item.dataType, T.StringType):
            value = (casts.empty_to_null if item.name.lower() in dates else convert)(value)
        columns.append(value.alias(item.name))
    return df.select(*columns)


def add_lineage(
    df: DataFrame, if_absent: Mapping[str, Column], always: Mapping[str, Column]
) -> DataFrame:
    """Add lineage columns.

    A column of ``if_absent`` is left alone where the data bring it under the same spelling.
    Where they bring it in other case, which Spark could not tell apart, the data's column
    is kept as ``<name>_src``.
    """
    added: dict[str, Column] = {}
    renamed: dict[str, str] = {}
    for name, value in if_absent.items():
        if name in df.columns:
            continue
        clash = find_column(df, name)
        if clash:
            renamed[clash] = f"{clash.lower()}_src"
        added[name] = value
    for name, value in always.items():
        clash = find_column(df, name)
        if clash and clash != name:
            renamed[clash] = f"{clash.lower()}_src"
        added[name] = value
    return df.withColumnsRenamed(renamed).withColumns(added)


def project_to_target(
    df: DataFrame, target_columns: Sequence[str], reserved: Sequence[str] = ("GROUP",)
) -> DataFrame:
    """Keep columns the target has (any case), named in upper case.

    A reserved word is loaded only when the target declares it quoted, as ``"GROUP"``.
    """
    wanted = {name.upper() for name in target_columns}
    columns = []
    for name in df.columns:
        upper = name.upper()
        if upper in reserved:
            if f'"{upper}"' in wanted:
                columns.append(quoted(name).alias(upper))
        elif upper in wanted:
            columns.append(quoted(name).alias(upper))
    if not columns:
        raise ValueError("no column in common with the target")
    return df.select(*columns)
