"""Per-row reports and the silver and gold logs.

Counts come from partial aggregates over boolean flags: one row per group and map task is
shuffled, whatever share of the rows a brand holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerwise.operators.dedup import keep_first, order_value
from layerwise.operators.rules import Check, Checked, Rule, check_rules

_MASK_BITS = 62


def bad_rows(checked: Checked, columns: Sequence[str]) -> DataFrame:
    """Rows with at least one error, with their error types as comma-joined text."""
    # filtered by the flags first, so good rows build no array
    bad = Checked(checked.df.filter(checked.any_bad), checked.checks).with_errors("__errors")
    return bad.select(*columns, F.array_join("__errors", ",").alias("errors"))


def first_bad_rows(
    checked: Checked, group: Sequence[str], order: Sequence[str], limit: int = 100
) -> DataFrame:
    """The first ``limit`` bad rows per group; each map task keeps no more than that per group."""
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    bad = checked.df.filter(checked.any_bad).select(*dict.fromkeys([*group, *order]))
    return bad.withColumn("row_rank", rank).filter(F.col("row_rank") <= limit)


def bad_row_counts(checked: Checked, group: Sequence[str], check: Check) -> DataFrame:
    """Rows and bad rows of one check per group."""
    return checked.df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(check.bad).alias("n_bad")
    )


def bad_values(df: DataFrame, check: Check) -> DataFrame:
    """The values an allowed-values check found bad, with their number of rows."""
    column = check.rule.columns[0]
    return df.filter(check.bad).groupBy(column).agg(F.count(F.lit(1)).alias("n_bad"))


def error_details(checked: Checked, group: Sequence[str]) -> DataFrame:
    """(group, error type, column, bad rows) for every count above zero.

    Rules over several columns count per column, others under the column ''.
    """
    labelled: list[tuple[str, str, Column]] = []
    for check in checked.active:
        for column, bad in check.parts:
            named = column if check.rule.kind in _PER_COLUMN else ""
            labelled.append((check.rule.error_type, named, bad))
    if not labelled:
        keys = checked.df.select(*group).limit(0)
        none = {"error_type": F.lit(""), "error_column": F.lit(""), "n_bad": F.lit(0).cast("bigint")}
        return keys.withColumns(none)
    counts = [F.count_if(bad).alias(f"__c{i}") for i, (_, _, bad) in enumerate(labelled)]
    per_group = checked.df.groupBy(*group).agg(*counts)
    entries = F.array(
        *[
            F.struct(
                F.lit(kind).alias("error_type"),
                F.lit(column).alias("error_column"),
                F.col(f"__c{i}").alias("n_bad"),
            )
            for i, (kind, column, _) in enumerate(labelled)
        ]
    )
    return (
        per_group.select(*group, F.inline(entries))
        .groupBy(*group, "error_type", "error_column")
        .agg(F.sum("n_bad").alias("n_bad"))
        .filter("n_bad > 0")
    )


def rule_status(checked: Checked, group: Sequence[str]) -> DataFrame:
    """PASSED, FAILED or SKIPPED per group and rule, with the number of bad rows."""
    counts = [F.count_if(c.bad).alias(f"__c{i}") for i, c in enumerate(checked.active)]
    per_group = checked.df.groupBy(*group).agg(F.count(F.lit(1)).alias("n_rows"), *counts)
    position = {id(c): i for i, c in enumerate(checked.active)}
    entries = []
    for check in checked.checks:
        if check.skipped is None:
            n_bad = F.col(f"__c{position[id(check)]}")
            status = F.when(n_bad > 0, F.lit("FAILED")).otherwise(F.lit("PASSED"))
        else:
            n_bad, status = F.lit(None).cast("bigint"), F.lit("SKIPPED")
        entries.append(
            F.struct(
                F.lit(check.rule.name).alias("rule_name"),
                status.alias("status"),
                n_bad.alias("n_bad"),
            )
        )
    return per_group.select(*group, "n_rows", F.inline(F.array(*entries)))


# Fixed value: the text of a log row without details.
_NO_DETAILS = '{"info":"No additional details"}'
_PER_COLUMN = ("required_fields", "date_validation")


def _detail_fields(checked: Checked) -> tuple[list[Column], list[Column]]:
    """Aggregates of bad rows and, over them, the JSON fields that are not zero."""
    counts: list[Column] = []
    fields: list[Column] = []

    def counted(bad: Column, label: str) -> Column:
        counts.append(F.count_if(bad).alias(f"__d{len(counts)}"))
        return F.nullif(F.col(f"__d{len(counts) - 1}"), F.lit(0)).alias(label)

    for kind, bad in checked.by_error_type().items():
        same = [c for c in checked.active if c.rule.error_type == kind]
        parts = [part for c in same for part in c.parts]
        if len(same) == 1 and same[0].rule.kind in _PER_COLUMN:
            columns = [counted(part, name) for name, part in parts]
            found = F.struct(*columns)
            any_found = F.coalesce(*columns).isNotNull()
            fields.append(F.when(any_found, found).alias(kind))
        else:
            fields.append(counted(bad, kind))
    return counts, fields


def silver_log(checked: Checked, group: Sequence[str]) -> DataFrame:
    """Rows in total, good and bad, error types met, OK / KO and JSON counts per group."""
    kinds = checked.by_error_type()
    hits = [F.max(bad).alias(f"__e{i}") for i, bad in enumerate(kinds.values())]
    counts, fields = _detail_fields(checked)
    log = checked.df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("rows_total"),
        F.count_if(checked.any_bad).alias("rows_ko"),
        *hits,
        *counts,
    )
    met = [F.when(F.col(f"__e{i}"), F.lit(kind)) for i, kind in enumerate(kinds)]
    listed = F.array_join(F.array_sort(F.array_compact(F.array(*met))), ",") if met else F.lit("")
    details = F.to_json(F.struct(*fields)) if fields else F.lit("{}")
    return log.select(
        *group,
        "rows_total",
        (F.col("rows_total") - F.col("rows_ko")).alias("rows_ok"),
        "rows_ko",
        listed.alias("cols_error"),
        F.when(F.col("rows_ko") == 0, "OK").otherwise("KO").alias("status"),
        F.when(F.col("rows_ko") == 0, _NO_DETAILS).otherwise(details).alias("details"),
    )


def add_empty_groups(log: DataFrame, groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Report rows with zero totals for groups that had a file but no rows."""
    zeros = groups.select(*keys).distinct().join(log.select(*keys), list(keys), "left_anti")
    zeros = zeros.select(
        *keys,
        *[F.lit(0).cast("bigint").alias(c) for c in ("rows_total", "rows_ok", "rows_ko")],
        F.lit("").alias("cols_error"),
        F.lit("OK").alias("status"),
        F.lit(_NO_DETAILS).alias("details"),
    )
    return log.unionByName(zeros)


def gold_log(
    df: DataFrame,
    rules: Sequence[Rule],
    group: Sequence[str],
    keys: Sequence[str],
    order: Sequence[str],
) -> DataFrame:
    """Record and check counts per group around a keep-first dedup within the group.

    Without a uniqueness rule of its own the log is two nested partial aggregates: row-local
    rules are packed into a bit mask first, then each key keeps its count and the mask of its
    first row. Only key, order and mask are shuffled, never the payload. A uniqueness rule over other
    columns adds a digest of these to the key's state and a third aggregate over digests.
    """
    dedup = bool(keys) and set(keys) <= set(df.columns)
    unique = list(dict.fromkeys([*group, *keys])) if dedup else []
    left = [r for r in rules if r.kind == "uniqueness" and set(r.columns) <= set(df.columns)]
    left = [r for r in left if not (unique and set(unique) <= {*r.columns, *group})]
    if len(left) == 1 and dedup:
        # scoped to the group alone, uniqueness rules need no work of their own here
        checked = check_rules(df, rules, order, scope=group, unique_keys=group)
        frame, masks = _with_masks(checked)
        totals = _unique_totals(frame, masks, checked, left[0], group, unique, order)
    elif left:
        before = df.groupBy(*group).agg(F.count(F.lit(1)).alias("__before"))
        rows = keep_first(df, unique, order) if dedup else df
        checked = check_rules(rows, rules, order, scope=group, unique_keys=unique)
        frame, masks = _with_masks(checked)
        after = frame.groupBy(*group).agg(F.count(F.lit(1)).alias("__after"), *_mask_totals(masks))
        condition = F.lit(True)
        renamed = after.select(
            *[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)],
            *[c for c in after.columns if c not in group],
        )
        for i, name in enumerate(group):
            condition = condition & F.col(name).eqNullSafe(F.col(f"__g{i}"))
        totals = before.join(renamed, condition)
    else:
        checked = check_rules(df, rules, order, scope=group, unique_keys=unique)
        frame, masks = _with_masks(checked)
        if dedup:
            firsts = [F.min_by(mask, order_value(order)).alias(mask) for mask in masks]
            frame = frame.groupBy(*unique).agg(F.count(F.lit(1)).alias("__n"), *firsts)
            before = F.sum("__n")
        else:
            before = F.count(F.lit(1))
        totals = frame.groupBy(*group).agg(
            before.alias("__before"), F.count(F.lit(1)).alias("__after"), *_mask_totals(masks)
        )
    return _gold_columns(totals, checked, group, len(masks))


def _unique_totals(
    frame: DataFrame,
    masks: Sequence[str],
    checked: Checked,
    rule: Rule,
    group: Sequence[str],
    unique: Sequence[str],
    order: Sequence[str],
) -> DataFrame:
    """Group totals with one uniqueness rule over the rows that a keep-first dedup leaves, in one
    scan: a key's state is its count, the position, mask and digest (of the rule's columns) of its
    first row, and repeats are counted over the states. The digest has 128 bits."""
    marked = [part for name in rule.columns for part in (F.col(name), F.col(name).isNull())]
    digests = {f"__digest{i}": F.xxhash64(*marked, F.lit(i)) for i in range(2)}
    position = order_value(order)
    states = frame.withColumns(digests).groupBy(*unique).agg(
        F.count(F.lit(1)).alias("__n"),
        F.min(position).alias("__first"),
        *[F.min_by(name, position).alias(name) for name in (*masks, *digests)],
    )
    bad = F.lit(False)
    for mask in masks:
        bad = bad | (F.col(mask) != 0)
    alike = states.groupBy(*group, *digests).agg(
        F.sum("__n").alias("__before"),
        F.count(F.lit(1)).alias("__rows"),
        F.count_if(bad).alias("__bad"),
        F.min_by(bad, "__first").alias("__first_bad"),
        *[F.bit_or(mask).alias(mask) for mask in masks],
    )
    repeated = F.col("__rows") > 1
    if rule.keep == "first":
        errors = F.col("__rows") - F.when(F.col("__first_bad"), 0).otherwise(1)
    else:
        errors = F.when(repeated, F.col("__rows")).otherwise(F.col("__bad"))
    place = list(checked.by_error_type()).index(rule.error_type)
    own = F.when(repeated, F.lit(1 << place % _MASK_BITS).cast("bigint")).otherwise(0)
    seen = {mask: F.col(mask).bitwiseOR(own) if i == place // _MASK_BITS else F.col(mask) for i, mask in enumerate(masks)}
    return alike.groupBy(*group).agg(
        F.sum("__before").alias("__before"),
        F.sum("__rows").alias("__after"),
        F.sum(errors).alias("__error"),
        *[F.bit_or(value).alias(f"__seen{i}") for i, value in enumerate(seen.values())],
    )


def gold_record(log: DataFrame) -> DataFrame:
    """A gold log with the load counts, message and JSON details of the monitoring table.

    ``rows_rejected``, where the log has it, are rows the load turned away; the others of those
    left by the dedup were inserted.
    """
    failed, errors = F.col("checks_failed"), F.col("records_error")
    message = F.format_string("%d checks failed with %d records in error", failed, errors)
    zero = F.lit(0).cast("bigint")
    rejected = F.coalesce("rows_rejected", zero) if "rows_rejected" in log.columns else zero
    loaded = {
        "reseller": F.lit(""),
        "brands_aggregated": F.lit(1).cast("bigint"),
        "records_warning": zero,
        "rows_inserted": F.col("records_after_agg") - rejected,
        "rows_updated": zero,
        "rows_rejected": rejected,
        "error_message": F.when(F.col("status") == "OK", "").otherwise(message),
        "business_checks_details": F.to_json(
            F.struct(failed.alias("validation_error_count"), errors.alias("total_error_count"))
        ),
        "aggregation_details": F.to_json(
            F.struct(
                F.col("records_before_agg").alias("records_before"),
                F.col("records_after_agg").alias("records_after"),
                "duplicates_removed",
            )
        ),
    }
    counts = F.struct("rows_inserted", "rows_updated", "rows_rejected")
    return log.withColumns(loaded).withColumn("loading_details", F.to_json(counts))


def _with_masks(checked: Checked) -> tuple[DataFrame, list[str]]:
    """Error-type flags of a row packed into bigint columns."""
    flags = list(checked.by_error_type().values())
    masks = {}
    for start in range(0, len(flags), _MASK_BITS):
        total = F.lit(0).cast("bigint")
        for bit, bad in enumerate(flags[start : start + _MASK_BITS]):
            total = total + F.when(bad, F.lit(1 << bit).cast("bigint")).otherwise(0)
        masks[f"__mask{len(masks)}"] = total
    return checked.df.withColumns(masks), list(masks)


def _mask_totals(masks: Sequence[str]) -> list[Column]:
    bad = F.lit(False)
    for mask in masks:
        bad = bad | (F.col(mask) != 0)
    return [
        F.count_if(bad).alias("__error"),
        *[F.bit_or(mask).alias(f"__seen{i}") for i, mask in enumerate(masks)],
    ]


def _gold_columns(
    totals: DataFrame, checked: Checked, group: Sequence[str], n_masks: int
) -> DataFrame:
    failed = F.lit(0)
    for i in range(n_masks):
        failed = failed + F.bit_count(f"__seen{i}")
    n_total, n_skipped = len(checked.checks), checked.n_skipped
    counted = totals.withColumn("checks_failed", failed.cast("bigint")).withColumn(
        "records_valid", F.col("__after") - F.col("__error")
    )
    status = (
        F.when(F.col("checks_failed") == 0, "OK")
        .when(F.col("records_valid") > 0, "WARNING")
        .otherwise("ERROR")
    )
    return counted.select(
        *group,
        F.col("__before").alias("records_before_agg"),
        F.col("__after").alias("records_after_agg"),
        (F.col("__before") - F.col("__after")).alias("duplicates_removed"),
        F.lit(n_total).cast("bigint").alias("checks_total"),
        (n_total - n_skipped - F.col("checks_failed")).alias("checks_passed"),
        "checks_failed",
        F.lit(n_skipped).cast("bigint").alias("checks_skipped"),
        "records_valid",
        F.col("__error").alias("records_error"),
        status.alias("status"),
    )
