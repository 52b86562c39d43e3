"""Expected against present tables, and file counts, per brand and date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_expected(files: DataFrame, expected: Sequence[str]) -> DataFrame:
    return files.filter(F.col("table_name").isin(list(expected)))


def expected_tables(files: DataFrame, expected: Sequence[str]) -> DataFrame:
    """OK or NoK for every expected table of each brand and date.

    One flag per expected table in a single aggregate, then unfolded: no product of groups
    and tables has to be joined.
    """
    flags = [
        F.bool_or(F.col("table_name") == name).alias(f"__t{i}") for i, name in enumerate(expected)
    ]
    groups = files.groupBy("brand", "filedate").agg(*flags)
    entries = [
        F.struct(
            F.lit(name).alias("table_name"),
            F.when(F.col(f"__t{i}"), "OK").otherwise("NoK").alias("status"),
        )
        for i, name in enumerate(expected)
    ]
    return groups.select("brand", "filedate", F.inline(F.array(*entries)))


def raw_log(files: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Tables delivered per brand and date, OK when all expected are, and JSON details.

    ``valid``, where the files have it, says whether a file's format could be recognised.
    """
    valid = F.bool_or("valid") if "valid" in files.columns else F.lit(None).cast("boolean")
    is_table = [F.col("table_name") == name for name in expected]
    flags = [F.bool_or(same).alias(f"__t{i}") for i, same in enumerate(is_table)]
    formats = [F.bool_or(F.when(same, F.col("__valid"))).alias(f"__v{i}") for i, same in enumerate(is_table)]
    once = files.groupBy("brand", "filedate", "table_name").agg(valid.alias("__valid"))
    groups = once.groupBy("brand", "filedate").agg(
        F.count(F.lit(1)).alias("file_count"),
        F.count_if(~F.col("table_name").isin(list(expected))).alias("unexpected_count"),
        *flags,
        *formats,
    )
    missing = F.array_compact(
        F.array(*[F.when(~F.col(f"__t{i}"), F.lit(name)) for i, name in enumerate(expected)])
    )
    tables = [
        F.struct(
            F.when(F.col(f"__t{i}"), "OK").otherwise("NoK").alias("status"),
            F.col(f"__v{i}").alias("csv_valid"),
        ).alias(name)
        for i, name in enumerate(expected)
    ]
    details = F.to_json(
        F.struct(F.col("file_count").alias("files_present"), F.struct(*tables).alias("tables"))
    )
    return groups.select(
        "brand",
        "filedate",
        "file_count",
        "unexpected_count",
        F.when(F.size(missing) == 0, "OK").otherwise("Partial").alias("status"),
        F.array_join(missing, ",").alias("missing_tables"),
        details.alias("details"),
    )


def files_per_table_date(files: DataFrame) -> DataFrame:
    """Number of files per date and table."""
    return files.groupBy("filedate", "table_name").agg(F.count(F.lit(1)).alias("n_files"))


def tables_per_date(per_table: DataFrame) -> DataFrame:
    """Tables and files per date, from ``files_per_table_date``."""
    return per_table.groupBy("filedate").agg(
        F.count(F.lit(1)).alias("tables_processed"), F.sum("n_files").alias("n_files")
    )
