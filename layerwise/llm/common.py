"""Shared helpers: table scans, the train split, written intermediate tables, text batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import ExitStack, contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwise.session import scratch_path, setting

FOLDS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    """True where crc32 of the id as text leaves 0 modulo ``FOLDS``; a null id counts as ''."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % FOLDS == 0


def written(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """The frame as a Parquet table in the shared folder: computed once, lineage cut, and still
    there when executors are lost."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1_000, size: str = "4m") -> Iterator[None]:
    """Batches that go to Python are small within a block, so that they follow the rows and not the split."""
    with ExitStack() as stack:
        stack.enter_context(setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(rows)))
        stack.enter_context(setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", size))
        yield


def with_columns(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    """``df`` with these columns; one of the same name (in any case) is replaced."""
    taken = {name.lower() for name in new}
    return df.select(*[df[c] for c in df.columns if c.lower() not in taken], *[c.alias(n) for n, c in new.items()])


def shielded(docs: DataFrame, step: Callable[[DataFrame], DataFrame], known: tuple[str, ...] = ("doc_id", "text")) -> DataFrame:
    """``step`` of ``docs``, during which columns other than the ``known`` ones have names that clash
    with none of its own. The step returns the columns it was given."""
    during = {c: c if c in known else f"own_column_{i}" for i, c in enumerate(docs.columns)}
    done = step(docs.select(*[docs[c].alias(name) for c, name in during.items()]))
    return done.select(*[F.col(name).alias(c) for c, name in during.items()])


def by_size(texts: Iterable[str | None], limit: int = 1 << 23) -> Iterator[list[str]]:
    """Texts (null: empty) in runs of about ``limit`` characters, so that memory follows the
    longest text and not the batch."""
    run: list[str] = []
    held = 0
    for text in texts:
        text = text if isinstance(text, str) else ""
        if run and held + len(text) > limit:
            yield run
            run, held = [], 0
        run.append(text)
        held += len(text)
    if run:
        yield run
