"""Datasets whose files are replaced in one step.

Rows are staged in a folder of a new version, next to what is there. What a version holds of which
source file goes to ``_commits``, and one row to ``_sealed`` makes it visible: that row is a file of
its own, so a job lost at any point leaves either the old rows or the new ones. Of a source file,
readers see the rows of its last sealed version. Spark's scans of the dataset skip both folders.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from layerwise.operators.dedup import splittable_equal
from layerwise.operators.merge import batch_update, one_per_key
from layerwise.session import local_frame, scratch_path

PART_DATE, VERSION, SOURCE = "part_date", "part_version", "src_file"
COMMITS = f"{PART_DATE} string, {SOURCE} string, n_rows bigint, {VERSION} string"
SEALED = f"{VERSION} string, n_files bigint, sealed_at timestamp"


def new_version() -> str:
    """A name that sorts by time."""
    return f"{datetime.now(timezone.utc):%Y%m%d%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def stage(rows: DataFrame, path: str, version: str) -> None:
    """Write rows, which have ``part_date`` and ``src_file``, as a version that nobody reads yet.

    They are written where they are, without a shuffle: one file a task and date.
    """
    rows.withColumn(VERSION, F.lit(version)).write.mode("append").partitionBy(PART_DATE, VERSION).parquet(path)


def commit(spark: SparkSession, path: str, version: str, files: DataFrame) -> None:
    """Make a staged version what readers see of ``files`` (``part_date``, ``src_file``), those
    without a row in it included."""
    staged = _staged(spark, path, version)
    names = files.select(F.col(PART_DATE).cast("string"), F.col(SOURCE).cast("string")).distinct()
    if staged is None:
        counted = names.withColumn("n_rows", F.lit(0).cast("bigint"))
    else:
        counts = staged.groupBy(PART_DATE, SOURCE).agg(F.count(F.lit(1)).alias("n_rows"))
        counted = names.join(counts, [PART_DATE, SOURCE], "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))
    counted.withColumn(VERSION, F.lit(version)).write.mode("append").parquet(f"{path}/_commits")
    seal(spark, path, version)


def seal(spark: SparkSession, path: str, version: str) -> None:
    written = spark.read.schema(COMMITS).parquet(f"{path}/_commits").where(F.col(VERSION) == version).count()
    row = local_frame(spark, [(version, written, datetime.now(timezone.utc))], SEALED)
    row.coalesce(1).write.mode("append").parquet(f"{path}/_sealed")


def _folders(spark: SparkSession, path: str, names: list[str], date: str | None = None) -> DataFrame:
    """Rows of these versions, whose folders alone are listed."""
    base = spark.read.option("mergeSchema", True).option("basePath", path)
    return _texts(base.parquet(*[f"{path}/{PART_DATE}={date or '*'}/{VERSION}={name}" for name in names]))


def _staged(spark: SparkSession, path: str, version: str) -> DataFrame | None:
    try:
        return _folders(spark, path, [version])
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _texts(rows: DataFrame) -> DataFrame:
    return rows.withColumns({name: F.col(name).cast("string") for name in (PART_DATE, VERSION)})


def _log(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(f"{path}/{name}")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def file_versions(spark: SparkSession, path: str, date: str | None = None) -> DataFrame | None:
    """``(part_date, src_file, n_rows, version, current)``: every sealed version of every source
    file, and whether it is the one to read. None where nothing was committed."""
    commits, sealed = _log(spark, path, "_commits", COMMITS), _log(spark, path, "_sealed", SEALED)
    if commits is None or sealed is None:
        return None
    # Two reads of one path in a plan count as the same scan, whatever came between them: the last
    # seal, written into the plan, keeps states of different times apart.
    upto = sealed.agg(F.max("sealed_at")).first()[0]
    sealed = sealed.where(F.col("sealed_at") <= F.lit(upto))
    if date:
        commits = commits.where(F.col(PART_DATE) == date)
    last = Window.partitionBy(PART_DATE, SOURCE)
    known = commits.join(F.broadcast(sealed.select(VERSION)), VERSION, "left_semi")
    return known.withColumn("current", F.col(VERSION) == F.max(VERSION).over(last))


def read_current(spark: SparkSession, path: str, date: str | None = None) -> DataFrame | None:
    """The rows to read of a dataset, of one date or all; None when there are none.

    Only versions with a current file are scanned. Rows of files that a later version replaced are
    left out by a join with the list of these, and only where a scanned version has some.
    """
    versions = file_versions(spark, path, date)
    if versions is None:
        return None
    held = versions.where("n_rows > 0")
    used = held.groupBy(VERSION).agg(F.bool_or("current").alias("used"), F.bool_or(~F.col("current")).alias("stale"))
    used = used.where("used").collect()  # deliveries since versions were last merged
    if not used:
        return None
    names = [row[VERSION] for row in used]
    rows = _folders(spark, path, names, date)
    if any(row["stale"] for row in used):
        stale = held.where(~F.col("current")).select(PART_DATE, VERSION, SOURCE)
        rows = rows.join(stale, [PART_DATE, VERSION, SOURCE], "left_anti")
    return rows.drop(VERSION)


def merge_versions(spark: SparkSession, path: str, date: str) -> str | None:
    """Rewrite what is current of a date as one version with files of the advised size."""
    versions, rows = file_versions(spark, path, date), read_current(spark, path, date)
    if rows is None:
        return None
    version = new_version()
    stage(rows.hint("rebalance"), path, version)
    commit(spark, path, version, versions.select(PART_DATE, SOURCE))
    return version


@dataclass(frozen=True)
class Upserted:
    """What an upsert did: files of the date before it, those of them rewritten, rows that were new."""

    files: int
    rewritten: int
    inserted: int


def upsert_files(
    spark: SparkSession, path: str, date: str, source: DataFrame, keys: Sequence[str], latest: str | None = None
) -> Upserted:
    """Update and insert rows of a date by key, and rewrite only the source files that hold a key
    of ``source``; the others are neither rewritten nor, but for their key columns, read.

    Source rows are looked up among the keys of the date, within the range of their first key,
    which skips row groups and files of data laid out by key. Rows under new keys come as a file of
    their own. Of several source rows of a key the one of the largest ``latest`` counts; rows
    without a key are new.
    """
    versions, target = file_versions(spark, path, date), read_current(spark, path, date)
    if target is None:
        raise ValueError(f"nothing is committed for {date}")
    usable = one_per_key(source, keys, latest)
    if latest and latest not in target.columns:
        usable = usable.drop(latest)
    low, high = usable.agg(F.min(keys[0]), F.max(keys[0])).first()
    near = target.where(F.col(keys[0]).between(F.lit(low), F.lit(high))).select(
        *[F.col(key).alias(f"__t_{key}") for key in keys], F.col(SOURCE).alias("__file")
    )
    same = reduce(Column.__and__, [splittable_equal(F.col(key), F.col(f"__t_{key}")) for key in keys])
    place = scratch_path(spark, "upsert")
    usable.join(near, same, "left").drop(*[f"__t_{key}" for key in keys]).write.parquet(place)
    found = spark.read.parquet(place)
    touched = [row[0] for row in found.where("__file IS NOT NULL").select("__file").distinct().collect()]
    version = new_version()
    no_key = reduce(Column.__or__, [F.col(key).isNull() for key in keys])
    new = found.where("__file IS NULL").drop("__file").unionByName(source.where(no_key).select(usable.columns))
    fields = [
        (F.col(f.name) if f.name in usable.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in target.schema.fields
        if f.name not in (PART_DATE, SOURCE)
    ]
    added = new.select(*fields, F.lit(date).alias(PART_DATE), F.lit(f"added-{version}").alias(SOURCE))
    inserted = added.count()
    rewritten = batch_update(target.where(F.col(SOURCE).isin(touched)), usable, keys)
    stage(rewritten.unionByName(added), path, version)
    names = [(date, name) for name in touched] + ([(date, f"added-{version}")] if inserted else [])
    commit(spark, path, version, local_frame(spark, names, f"{PART_DATE} string, {SOURCE} string"))
    before = versions.where("current AND n_rows > 0").count()
    return Upserted(before, len(touched), inserted)


def drop_replaced(spark: SparkSession, path: str) -> list[str]:
    """Remove the folders of versions of which no file is current any more; those not sealed stay,
    as their job may still run."""
    versions = file_versions(spark, path)
    if versions is None:
        return []
    used = versions.groupBy(PART_DATE, VERSION).agg(F.bool_or(F.col("current") & (F.col("n_rows") > 0)).alias("used"))
    removed = []
    for row in used.where("NOT used").collect():
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{PART_DATE}={row[PART_DATE]}/{VERSION}={row[VERSION]}")
        if folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True):
            removed.append(row[VERSION])
    return sorted(removed)
