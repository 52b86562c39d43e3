"""Layer scans and writes.

A layer is one Parquet dataset per table, partitioned by ``part_date`` (many tables bring a
FILEDATE of their own). Raw and silver are partitioned further, by brand slug and source file,
so that a file delivered again replaces exactly its own rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerwise.functions.names import decode_file_name
from layerwise.operators.schema import quoted
from layerwise.session import setting

PART_DATE = "part_date"
TARGET_DATE = "PART_DATE"
FILE_PARTITIONS = (PART_DATE, "brand_slug", "src_file")


def read_layer(
    spark: SparkSession,
    root: str,
    table: str,
    date: str | None = None,
) -> DataFrame | None:
    """Rows of a table, of one date or of all; None when the layer has no such data.

    Layer columns are text or were harmonised before the write, so files differ in the
    columns they have but not in types, and merging their schemas is safe. With a date only
    that partition is listed.
    """
    base = f"{root}/{table}"
    path = f"{base}/{PART_DATE}={date}" if date else base
    try:
        frame = spark.read.option("mergeSchema", True).option("basePath", base).parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    own = [name for name in FILE_PARTITIONS if name in frame.columns]
    return frame.withColumns({name: F.col(name).cast("string") for name in own})


def scan_date_range(df: DataFrame, column: str, start: str, end: str) -> DataFrame:
    """Rows with ``start <= column < end``, a range the Parquet scan can skip row groups by."""
    kind = df.schema[column].dataType.simpleString()
    low, high = (F.lit(bound).cast(kind) for bound in (start, end))
    return df.filter((F.col(column) >= low) & (F.col(column) < high))


def file_row_counts(df: DataFrame) -> DataFrame:
    """Rows per source file of a scan."""
    return df.groupBy(decode_file_name(F.col("_metadata.file_name")).alias("file_name")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def given_file_row_count(df: DataFrame, name: str) -> DataFrame:
    """Rows of one given file, the scan of it whole: a file written as a directory of parts
    counts as one file, and an empty one counts 0."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("file_name"), "n_rows")


def row_count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).alias("table_name"), "n_rows"
    )


def footer_row_count(spark: SparkSession, path: str, name: str, schema: T.StructType | None = None) -> DataFrame:
    """``row_count`` of Parquet files from their footers: no data page is read. The scan takes the
    aggregate over, in a session whose settings allow it. A known ``schema`` saves looking it up."""
    apart = spark.newSession()
    apart.conf.set("spark.sql.sources.useV1SourceList", "csv,json,orc,text,avro,kafka")
    apart.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    reader = apart.read.schema(schema) if schema else apart.read
    return row_count(reader.parquet(path), name)


def table_sample(
    df: DataFrame, columns: Sequence[str], key: Sequence[str], limit: int = 1000
) -> DataFrame:
    """The first ``limit`` rows in key order."""
    return df.orderBy(*key).limit(limit).select(*columns)


def write_partitioned(
    df: DataFrame, path: str, partitions: Sequence[str], rebalance: bool = True
) -> int:
    """Overwrite the partitions the frame has rows for and return the rows written.

    Rows are first rebalanced by the partition columns: small partitions become one file,
    and a partition with a large share of the rows is split over many tasks. Where a task's rows
    are of few partitions anyway, as of a file scan, no shuffle is needed.
    """
    written = Observation()
    # counted above the shuffle, where the count stays in the plan even of an empty frame
    balanced = df.hint("rebalance", *[F.col(p) for p in partitions]) if rebalance else df
    counted = balanced.observe(written, F.count(F.lit(1)).alias("n"))
    (
        counted.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )
    return written.get["n"]


def write_raw(lines: DataFrame, root: str) -> None:
    """Raw copy of landing lines, partitioned by date, brand and file.

    A scan task holds whole files or splits of one in order, so its lines are written without a
    shuffle: the parts of a file read in name order are the file itself.
    """
    order = [*FILE_PARTITIONS, "src_block", "src_row"]
    ordered = lines.sortWithinPartitions(*order)
    (
        ordered.select("value", *FILE_PARTITIONS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*FILE_PARTITIONS)
        .text(root)
    )


def load_table(df: DataFrame, table: str, date: str) -> int:
    """Load the rows of a date into a catalog table and return their number.

    A table created here is partitioned by date, and loading a date again replaces that
    partition. A table of other making, without the partition column, is appended to. Columns
    are matched by name and those the frame lacks are NULL.
    """
    spark = df.sparkSession
    exists = spark.catalog.tableExists(table)
    dated = not exists or TARGET_DATE in spark.table(table).columns
    if dated:
        df = df.withColumn(TARGET_DATE, F.lit(date))
    written = Observation()
    counted = df.observe(written, F.count(F.lit(1)).alias("n"))
    if not exists:
        counted.write.partitionBy(TARGET_DATE).saveAsTable(table)
    else:
        columns = [
            quoted(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in spark.table(table).schema.fields
        ]
        # an overwriting insert replaces only the partitions it has rows for
        with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
            counted.select(*columns).write.insertInto(table, overwrite=dated)
    return written.get["n"]


def drop_partition(spark: SparkSession, path: str, values: Sequence[tuple[str, str]]) -> bool:
    """Remove one partition's folder of a dataset, if it is there."""
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    folder = "/".join([path, *[f"{key}={names.escapePathName(value)}" for key, value in values]])
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(files.delete(target, True))


def clear_table(spark: SparkSession, table: str, date: str) -> None:
    """Leave a target table's partition of a date without rows, if there are any."""
    if not spark.catalog.tableExists(table) or TARGET_DATE not in spark.table(table).columns:
        return
    old = spark.table(table).filter(F.col(TARGET_DATE) == date)
    if old.isEmpty():
        return
    fields = [f for f in spark.table(table).schema.fields if f.name != TARGET_DATE]
    nothing = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in fields)
    spark.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION ({TARGET_DATE} = '{date}') "
        f"SELECT {nothing} WHERE false"
    )


def append_log(df: DataFrame, root: str, name: str) -> None:
    """Append metric rows to a monitoring dataset."""
    df.write.mode("append").parquet(f"{root}/{name}")


def read_log(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    try:
        return spark.read.option("mergeSchema", True).parquet(f"{root}/{name}")
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
