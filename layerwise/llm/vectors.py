"""Embeddings as exact integer vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE = 256
#: Entries from this size on count as not finite: beyond it ``SCALE`` times an entry has no exact
#: whole part in double precision.
LARGEST = float(1 << 44)


def integer_vectors(rows: DataFrame, column: str = "embedding", scale: int = SCALE) -> DataFrame:
    """The rows whose vector can be used, with ``x``: floor(scale * entry) of each entry, as longs.

    Dropped are null and empty vectors, those with null or non-finite entries, and those of
    another length than most rows have (of equally frequent lengths the largest counts): they
    have no place in the same space.
    """
    c = rows[column]
    usable = F.forall(c, lambda e: e.isNotNull() & (F.abs(e.cast("double")) < LARGEST))
    kept = rows.where(c.isNotNull() & (F.size(c) > 0) & F.coalesce(usable, F.lit(False)))
    lengths = kept.groupBy(F.size(c).alias("size")).count()
    most = lengths.orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    if not most:
        kept, size = kept.where("false"), 0
    else:
        size = most[0]["size"]
    others = [kept[name] for name in kept.columns if name.lower() != "x"]
    x = F.transform(c, lambda e: F.floor(e.cast("double") * scale))
    return kept.where(F.size(c) == size).select(*others, x.alias("x"))


def matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """A batch's vectors as a matrix of longs."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
