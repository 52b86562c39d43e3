"""Declarative validation rules compiled to Column expressions.

All rules of a table become boolean expressions over one frame, so any number of rules costs
one pass. Only a uniqueness rule needs a shuffle of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerwise.config import DURATION_COLUMNS
from layerwise.functions import casts
from layerwise.operators.dedup import mark_repeats
from layerwise.operators.schema import quoted
from layerwise.session import lenient, local_frame


@dataclass(frozen=True)
class Rule:
    table: str
    name: str
    kind: str
    error_type: str
    columns: tuple[str, ...] = ()
    allowed: tuple = ()
    condition: str | None = None
    keep: str = "first"
    null_policy: str = "fail"
    empty_is_missing: bool = True
    date_formats: tuple[str, ...] = ()


def parse_rules(config: Mapping[str, Mapping[str, Mapping]], table: str) -> list[Rule]:
    """Rules of one table out of ``{table: {rule name: settings}}``.

    ``null_policy`` says whether a condition that is neither true nor false passes or fails.
    """
    return [_parse(table, name, body) for name, body in config.get(table, {}).items()]


def _parse(table: str, name: str, body: Mapping) -> Rule:
    columns = tuple(body.get("columns", ()))
    single = (body["column"],) if "column" in body else ()
    common = {"table": table, "name": name, "error_type": body.get("error_type", name)}
    if name == "valid_types" and single and "allowed_values" in body:
        return Rule(
            kind="allowed_values", columns=single, allowed=tuple(body["allowed_values"]), **common
        )
    if name == "required_fields" and columns:
        empty = body.get("empty_is_missing", True)
        return Rule(kind="required_fields", columns=columns, empty_is_missing=empty, **common)
    if name == "uniqueness" and columns:
        return Rule(kind="uniqueness", columns=columns, keep=body.get("keep", "first"), **common)
    if name == "date_validation" and columns:
        formats = tuple(body.get("formats", ()))
        return Rule(kind="date_validation", columns=columns, date_formats=formats, **common)
    if name == "duration_validation" and "condition" not in body:
        return Rule(kind="duration", columns=columns or DURATION_COLUMNS, **common)
    if "condition" in body:
        policy = body.get("null_policy", "fail")
        return Rule(kind="condition", condition=body["condition"], null_policy=policy, **common)
    if single and body.get("not_empty"):
        return Rule(kind="not_empty", columns=single, **common)
    return Rule(kind="unknown", columns=columns or single, **common)


@dataclass(frozen=True)
class Check:
    """A rule bound to a frame. ``parts`` maps a column (or '') to its bad-row expression."""

    rule: Rule
    parts: tuple[tuple[str, Column], ...]
    skipped: str | None = None

    @property
    def bad(self) -> Column:
        return reduce(Column.__or__, [expression for _, expression in self.parts])


def _per_column(df: DataFrame, rule: Rule, test: Callable[[Column], Column]) -> Check:
    present = [name for name in rule.columns if name in df.columns]
    if not present:
        return Check(rule, (), f"no column {', '.join(rule.columns)}")
    return Check(rule, tuple((name, test(quoted(name))) for name in present))


def _allowed_values(df: DataFrame, rule: Rule) -> Check:
    allowed = [value for value in rule.allowed if value is not None]
    as_text = all(isinstance(value, str) for value in allowed)

    def bad(column: Column) -> Column:
        # texts are compared as text, so a list of them never casts a numeric column's values
        value = column.cast("string") if as_text else column
        return column.isNotNull() & ~value.isin(allowed)

    return _per_column(df, rule, bad)


def _required_fields(df: DataFrame, rule: Rule) -> Check:
    return _per_column(df, rule, lambda c: casts.is_missing(c, rule.empty_is_missing))


def _date_validation(df: DataFrame, rule: Rule) -> Check:
    return _per_column(
        df, rule, lambda c: c.isNotNull() & ~casts.is_valid_date(c, rule.date_formats)
    )


def _duration(df: DataFrame, rule: Rule) -> Check:
    if not set(rule.columns) <= set(df.columns):
        return Check(rule, (), f"no column {', '.join(rule.columns)}")
    value, limit = (casts.to_float(quoted(name)) for name in rule.columns)
    return Check(rule, (("", F.coalesce((value > limit) & (limit != 0), F.lit(False))),))


def _with_condition(df: DataFrame, rule: Rule, name: str) -> tuple[DataFrame, Check]:
    """Evaluate a condition's text into a column of the frame.

    The text is analysed without ANSI errors, so comparing a number with text that holds none
    gives NULL, which the rule's NULL policy decides on, instead of stopping the job.
    """
    if rule.null_policy not in ("pass", "fail"):
        raise ValueError(f"rule {rule.name}: null_policy must be 'pass' or 'fail'")
    try:
        with lenient(df.sparkSession):
            evaluated = df.withColumn(name, F.expr(rule.condition))
    except (AnalysisException, ParseException) as error:
        return df, Check(rule, (), f"condition not usable: {error.getCondition()}")
    kind = evaluated.schema[name].dataType
    if not isinstance(kind, T.BooleanType):
        return df, Check(rule, (), f"condition is {kind.simpleString()}, not boolean")
    passed = F.coalesce(F.col(name), F.lit(rule.null_policy == "pass"))
    return evaluated, Check(rule, (("", ~passed),))


def _unknown(df: DataFrame, rule: Rule) -> Check:
    return Check(rule, (), "rule kind not known")


COMPILERS: dict[str, Callable[[DataFrame, Rule], Check]] = {
    "allowed_values": _allowed_values,
    "required_fields": _required_fields,
    "date_validation": _date_validation,
    "duration": _duration,
    "not_empty": _required_fields,
    "unknown": _unknown,
}


@dataclass(frozen=True)
class Checked:
    """A frame with its checks. Flags are expressions, evaluated inside whatever reads them."""

    df: DataFrame
    checks: tuple[Check, ...]

    @property
    def active(self) -> list[Check]:
        return [check for check in self.checks if check.skipped is None]

    @property
    def n_skipped(self) -> int:
        return len(self.checks) - len(self.active)

    def by_error_type(self) -> dict[str, Column]:
        """One bad-row expression per error type; rules that share a type are merged."""
        merged: dict[str, Column] = {}
        for check in self.active:
            known = merged.get(check.rule.error_type)
            merged[check.rule.error_type] = check.bad if known is None else known | check.bad
        return merged

    @property
    def any_bad(self) -> Column:
        return reduce(Column.__or__, self.by_error_type().values(), F.lit(False))

    def with_errors(self, name: str = "errors") -> DataFrame:
        """The frame with the array of its rows' error types, in rule order."""
        labels = [F.when(bad, F.lit(kind)) for kind, bad in self.by_error_type().items()]
        errors = F.array_compact(F.array(*labels)) if labels else F.array().cast("array<string>")
        return self.df.withColumn(name, errors)


def check_rules(
    df: DataFrame,
    rules: Sequence[Rule],
    order: Sequence[str] = (),
    scope: Sequence[str] = (),
    unique_keys: Sequence[str] = (),
) -> Checked:
    """Bind rules to a frame.

    Columns a rule names that the frame lacks make a skipped check of their own. ``scope`` is put in front of a uniqueness rule's columns (a brand, a file). ``order`` is
    the total order that tells a first row from its repeats. ``unique_keys`` are columns the
    frame is already unique by, so a uniqueness rule over them needs no work.
    """
    checks: list[Check] = []
    columns = df.columns
    for i, rule in enumerate(rules):
        if rule.kind == "condition":
            df, check = _with_condition(df, rule, f"__condition{i}")
            checks.append(check)
        elif rule.kind != "uniqueness":
            checks.append(COMPILERS[rule.kind](df, rule))
            absent = tuple(name for name in rule.columns if name not in columns)
            if absent and checks[-1].skipped is None:  # the present columns are checked all the same
                checks.append(Check(replace(rule, columns=absent), (), f"no column {', '.join(absent)}"))
        elif not set(rule.columns) <= set(columns):
            checks.append(Check(rule, (), f"no column {', '.join(rule.columns)}"))
        elif unique_keys and set(unique_keys) <= {*rule.columns, *scope}:
            checks.append(Check(rule, (("", F.lit(False)),)))
        else:
            keys = list(dict.fromkeys([*scope, *rule.columns]))
            df = mark_repeats(df, keys, f"__repeat{i}", rule.keep, order)
            checks.append(Check(rule, (("", F.col(f"__repeat{i}")),)))
    return Checked(df, tuple(checks))


def rule_frame(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    """The rules as rows."""
    rows = [
        (
            r.table,
            r.name,
            r.kind,
            list(r.columns),
            [str(v) for v in r.allowed],
            r.condition,
            r.error_type,
        )
        for r in rules
    ]
    return local_frame(
        spark,
        rows,
        "table_name string, rule_name string, kind string, columns array<string>, "
        "allowed array<string>, condition string, error_type string",
    )
