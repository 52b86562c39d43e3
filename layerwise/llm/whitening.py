"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

The matrix A has a row for each distinct vector of the table, less the mean. From a right vector v
the tasks form p = A v - beta u of the last step block by block and return sums only: first
Uᵀp, then, with those parts taken out of p, |p|² and Aᵀp. So every step is one distributed A v
and one distributed Aᵀu, with both sides orthogonalised against all earlier vectors. Left vectors
are as long as the table: none is stored, shuffled or collected. Each is a combination A c of A's
rows with a short c, and the tasks form those they need from c. The driver holds vectors of the
width of an embedding and a bidiagonal matrix, whose singular vectors give components and
deviations.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written
from .vectors import integer_vectors, matrix

COMPONENTS = 4
#: Deviations below this share of the largest are rounding, not spread.
LEAST_DEVIATION = 1e-11


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A value for each batch of vectors: every step reads them all, and arrays of longs read slowly."""
    for batch in batches:
        if batch.num_rows:
            data = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype("<i8").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["block"])


class CentredRows:
    """The fit list, whose products with short vectors are sums over tasks."""

    def __init__(self, rows: DataFrame):
        self.blocks = written(rows.select("x").mapInArrow(_packed, "block binary"), "whitening-blocks")
        totals = rows.select(F.posexplode("x").alias("at", "value")).groupBy("at").agg(
            F.sum(F.col("value").cast("decimal(38,0)")).alias("total"), F.count(F.lit(1)).alias("n")
        )
        found = sorted(tuple(r) for r in totals.collect())  # as many rows as a vector has entries
        self.width = len(found)
        self.n = found[0][2] if found else 0
        self.sums = [int(r[1]) for r in found]
        self.mean = np.array([s / self.n for s in self.sums])

    def summed(self, length: int, of_block: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The sum over all blocks of centred rows of what ``of_block`` returns, ``length`` numbers."""
        width, mean = self.width, self.mean

        def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(length)
            for batch in batches:
                for block in batch.column(0):
                    x = np.frombuffer(block.as_buffer(), dtype="<i8").reshape(-1, width)
                    total += of_block(x - mean)
            at = pa.array(np.arange(length, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([at, pa.array(total)], names=["at", "part"])

        partial = self.blocks.mapInArrow(parts, "at int, part double")
        out = np.zeros(length)
        for at, total in partial.groupBy("at").agg(F.sum("part")).collect():
            out[at] = total
        return out


@dataclass
class Whitening:
    """What the fit found: of ``n`` distinct vectors with sums ``sums``, unit ``components`` (one a
    row, by falling variance) with their ``deviations`` and shares ``explained``."""

    n: int
    sums: list[int]
    components: np.ndarray
    deviations: np.ndarray
    explained: np.ndarray
    identity_error: float

    def apply(self, rows: DataFrame, id_column: str = "vec_id") -> DataFrame:
        """``(id, deviation, whitened)`` of rows with ``x``. ``deviation`` is the exact sum of
        (n * x - sum)² over the entries, null where it is no long; ``whitened`` has an entry for
        each component."""
        n, sums, width = self.n, self.sums, len(self.sums)
        mean = np.array([s / n for s in sums]) if n else np.zeros(width)
        scaled = self.components.T / self.deviations

        def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = matrix(batch.column(1), width)
                values = (x - mean) @ scaled
                lists = pa.FixedSizeListArray.from_arrays(pa.array(values.ravel()), values.shape[1])
                exact = pa.array(_squares(x, n, sums), pa.int64())
                columns = [batch.column(0), exact, lists.cast(pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(columns, names=[id_column, "deviation", "whitened"])

        schema = T.StructType([
            rows.schema[id_column],
            T.StructField("deviation", T.LongType()),
            T.StructField("whitened", T.ArrayType(T.DoubleType())),
        ])
        if not len(self.deviations):
            return rows.sparkSession.createDataFrame([], schema)
        return rows.select(id_column, "x").mapInArrow(project, schema)


def _squares(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    most = 1 << 63
    largest = n * max(int(np.abs(x).max(initial=0)), 1) + max(map(abs, sums), default=0)
    if largest * largest * x.shape[1] < most:
        apart = n * x - np.array(sums, dtype=np.int64)
        return (apart * apart).sum(axis=1).tolist()
    exact = (sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x.tolist())
    return [value if value < most else None for value in exact]


def _orthogonal(vector: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):  # twice is enough
        for other in basis:
            vector = vector - (other @ vector) * other
    return vector


def bidiagonalise(rows: CentredRows, steps: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Right vectors V (one a column) and upper bidiagonal B with A V = U B.

    Where a step finds nothing new (a repeated or vanished singular value) it goes on from a fresh
    vector orthogonal to all before, so that ``steps`` equal to the width finds every component.
    """
    width = rows.width
    random = np.random.default_rng(seed)
    fresh = random.standard_normal(width)
    v = fresh / np.linalg.norm(fresh)
    right, left = [], np.zeros((width, 0))  # left: the c of each u = A c
    b = np.zeros((steps, steps))
    beta, scale = 0.0, 0.0
    for step in range(steps):
        right.append(v)
        last = left[:, -1] if step else np.zeros(width)
        seed_c = v - beta * last  # p = A seed_c

        def overlaps(a: np.ndarray, c=seed_c, known=left) -> np.ndarray:
            return (a @ known).T @ (a @ c)

        parts = rows.summed(step, overlaps) if step else np.zeros(0)
        c = seed_c - left @ parts

        def products(a: np.ndarray, c=c) -> np.ndarray:
            p = a @ c
            return np.append(a.T @ p, p @ p)

        found = rows.summed(width + 1, products)
        alpha = float(np.sqrt(found[-1]))
        scale = max(scale, alpha, beta)
        if alpha <= LEAST_DEVIATION * scale or not alpha:
            alpha, u, w = 0.0, np.zeros(width), np.zeros(width)
        else:
            u, w = c / alpha, found[:-1] / alpha - alpha * v
        left = np.column_stack([left, u])
        b[step, step] = alpha
        if step + 1 == steps:
            break
        w = _orthogonal(w, right)
        beta = float(np.linalg.norm(w))
        if beta <= LEAST_DEVIATION * scale or not beta:
            beta, w = 0.0, _orthogonal(random.standard_normal(width), right)
        v = w / np.linalg.norm(w)
        b[step, step + 1] = beta
    return np.column_stack(right), b


def fit(vectors: DataFrame, components: int = COMPONENTS, steps: int | None = None, seed: int = 0) -> Whitening:
    """The whitening of the distinct vectors in ``x``, each counted once.

    ``steps`` bounds the bidiagonalisation; the default, one step for each entry of a vector, finds
    all components whatever the spectrum. Fewer components than asked for come back where the
    vectors spread in fewer directions, none for an empty table or a single vector.
    """
    rows = CentredRows(written(vectors.select("x").distinct(), "whitening-fit"))
    steps = min(rows.width, max(1, steps or rows.width))
    none = Whitening(rows.n, rows.sums, np.zeros((0, rows.width)), np.zeros(0), np.zeros(0), 0.0)
    if rows.n < 2:
        return none
    right, b = bidiagonalise(rows, steps, seed)
    _, singular, mix = np.linalg.svd(b)
    kept = min(components, int((singular > LEAST_DEVIATION * singular[0]).sum()))
    if not kept:
        return none
    found = (right @ mix.T)[:, :kept]
    found /= np.linalg.norm(found, axis=0)
    variances = singular[:kept] ** 2 / rows.n
    scaled = found / np.sqrt(variances)

    def spread(a: np.ndarray) -> np.ndarray:
        z = a @ scaled
        return np.append((z.T @ z).ravel(), (a * a).sum())

    sums = rows.summed(kept * kept + 1, spread) / rows.n
    error = np.abs(sums[:-1].reshape(kept, kept) - np.eye(kept)).max()
    return Whitening(rows.n, rows.sums, found.T, np.sqrt(variances), variances / sums[-1], float(error))


def whiten(rows: DataFrame, id_column: str = "vec_id", column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """For each row with a usable vector and each component: ``(id, component, n, deviation,
    whitened, explained, identity_error)``.

    Which vectors are usable says ``integer_vectors``. Null ids are kept; repeated rows come back as
    often as they are there but count once in the fit; ties of variance are numbered as found. An
    empty table, or one whose vectors are all equal, gives no rows. Other columns, whatever their
    names, play no part.
    """
    vectors = integer_vectors(rows.select(rows[id_column], rows[column]), column)
    found = fit(vectors, components)
    whitened = found.apply(vectors, id_column)
    cells = whitened.select(id_column, "deviation", F.posexplode("whitened").alias("at", "whitened"))
    explained = F.array(*[F.lit(float(e)) for e in found.explained]) if len(found.explained) else F.array().cast("array<double>")
    return cells.select(
        id_column,
        (F.col("at") + 1).alias("component"),
        F.lit(found.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(found.identity_error).alias("identity_error"),
    )
