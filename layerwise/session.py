"""Session defaults and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Adaptive execution does the skew handling this engine relies on: skewed join sides
# are split, and "rebalance" hints before a write split hot output partitions.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "layerwise", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, which every executor can see.

    A machine-local folder is used only in local mode with that setting unset.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="layerwise-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the length of a block."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def lenient(spark: SparkSession):
    """Expressions analysed in this block give NULL where ANSI mode would stop the job."""
    return setting(spark, "spark.sql.ansi.enabled", "false")


def local_frame(spark: SparkSession, rows: Sequence[Sequence], schema: str | T.StructType) -> DataFrame:
    """A frame of configuration or status rows the driver holds, sent as one Arrow table."""
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = {
        item.name: pa.array([row[i] for row in rows]) for i, item in enumerate(kind.fields)
    }
    return spark.createDataFrame(pa.table(columns), kind)
