"""Hard negatives by an inverted multi-index.

Vectors are cut in half; a codebook for each half (fitted on a bounded sample, then every row is
coded) puts a row into the cell of its two codes. The upper bound of a half's score is the score of
its centroid plus the query's length times the centroid's radius, the largest distance of a row of
that code. A query visits the cells by falling sum of the two bounds, from a heap over the two
sorted sequences, and stops when its window is certified: the rows it holds all score above every
cell that is left, or what is left lies below the window. So the results are exact.

Rows lie in tiles of neighbouring cells, queries in blocks; a task searches one tile for one block.
Crowded cells and equal vectors spread over tiles, as rows within a cell go by a hash. Each tile
returns at most what a query keeps in the end, so merging moves few rows for a query and tile.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .vectors import integer_vectors, matrix

POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # percent of the positive's score
#: Centroids of each half, rows the codebooks are fitted on, rounds of fitting.
CODES, SAMPLE, ROUNDS = 16, 4096, 12
#: Rows of a tile and queries of a block: what a task holds at once.
TILE_ROWS, BLOCK_QUERIES = 8192, 4096
_GATHER = 256  # rows scored at a time


# --- codebooks ----------------------------------------------------------------------------


def codebook(sample: np.ndarray, codes: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centroids by Lloyd's rounds from rows far apart; fewer where fewer rows differ."""
    if not sample.shape[1]:
        return np.zeros((1, 0))
    rows = np.unique(sample, axis=0).astype(float)
    if len(rows) <= codes:
        return rows
    chosen = [0]
    distance = ((rows - rows[0]) ** 2).sum(axis=1)
    while len(chosen) < codes:
        chosen.append(int(distance.argmax()))
        distance = np.minimum(distance, ((rows - rows[chosen[-1]]) ** 2).sum(axis=1))
    centroids = rows[chosen]
    for _ in range(rounds):
        code = nearest(rows, centroids)
        for k in range(codes):
            if (code == k).any():
                centroids[k] = rows[code == k].mean(axis=0)
    return centroids


def nearest(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return ((centroids * centroids).sum(axis=1) - 2 * (rows @ centroids.T)).argmin(axis=1)


def coded(rows: DataFrame, first: np.ndarray, second: np.ndarray) -> DataFrame:
    """``rows`` with the two codes of ``x`` in ``cell``."""
    half, width, codes = first.shape[1], first.shape[1] + second.shape[1], len(second)
    schema = rows.withColumn("cell", F.lit(0)).schema
    names, at = schema.names, rows.columns.index("x")

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(at), width).astype(float)
            cell = nearest(x[:, :half], first) * codes + nearest(x[:, half:], second)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32))], names=names)

    return rows.mapInArrow(code, schema)


# --- search within a tile -----------------------------------------------------------------


def cells_by_bound(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """``(bound, i, j)`` of all pairs of two falling sequences, by falling sum."""
    heap = [(-(first[0] + second[0]), 0, 0)] if len(first) and len(second) else []
    while heap:
        bound, i, j = heapq.heappop(heap)
        yield -bound, i, j
        if j + 1 < len(second):
            heapq.heappush(heap, (-(first[i] + second[j + 1]), i, j + 1))
        if j == 0 and i + 1 < len(first):
            heapq.heappush(heap, (-(first[i + 1] + second[0]), i + 1, 0))


class Half:
    """The centroids and radii of one half over a tile's rows."""

    def __init__(self, x: np.ndarray, code: np.ndarray):
        self.codes, member = np.unique(code, return_inverse=True)
        size = np.bincount(member)
        sums = [np.bincount(member, c) for c in x.T]
        self.centroids = np.array(sums).reshape(x.shape[1], len(size)).T / size[:, None]
        apart = np.sqrt(((x - self.centroids[member]) ** 2).sum(axis=1))
        self.radii = np.zeros(len(self.codes))
        np.maximum.at(self.radii, member, apart)

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes by falling upper bound, with the upper and lower bounds of their scores."""
        middle = self.centroids @ q
        reach = np.sqrt(q @ q) * self.radii
        slack = 1e-9 * (1 + np.abs(middle) + reach)  # rounding must not cut a cell off
        order = np.argsort(-(middle + reach + slack), kind="stable")
        return self.codes[order], (middle + reach + slack)[order], (middle - reach - slack)[order]


class Tile:
    """An inverted multi-index over the rows of a tile."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, cell: np.ndarray, codes: int):
        order = np.lexsort((ids, cell))
        self.ids, self.labels, self.codes = ids[order], labels[order], codes
        x, cell = x[order], cell[order]
        most = int(np.abs(x).max(initial=0))
        # Products of doubles are exact up to 2^53; beyond it whole numbers of any size.
        self.exact_in_doubles = most * most * x.shape[1] < 1 << 53
        self.x = x.astype(float) if self.exact_in_doubles else x.astype(object)
        self.largest = most
        wide = x.astype(float)
        self.half = (x.shape[1] + 1) // 2
        self.first = Half(wide[:, : self.half], cell // codes)
        self.second = Half(wide[:, self.half :], cell % codes)
        numbers, start = np.unique(cell, return_index=True)
        stop = np.append(start[1:], len(cell))
        self.place = {int(c): (int(a), int(b)) for c, a, b in zip(numbers, start, stop)}

    def scores(self, rows: np.ndarray, q: np.ndarray) -> np.ndarray:
        if self.exact_in_doubles and self.largest * int(np.abs(q).max(initial=0)) * len(q) < 1 << 53:
            return (self.x[rows].astype(float) @ q.astype(float)).astype(np.int64)
        return (self.x[rows].astype(object) @ q.astype(object)).astype(np.int64)

    def search(self, q: np.ndarray, fits, windows: list[tuple[int | None, int | None]], most: int):
        """For each window (low and high score in percent of a unit, None: open), the first ``most``
        rows by falling score, then id, among those that ``fits`` lets through.

        A window is ``(low, high)`` with 100 * score between them.
        """
        floats = q.astype(float)
        codes_1, up_1, low_1 = self.first.bounds(floats[: self.half])
        codes_2, up_2, low_2 = self.second.bounds(floats[self.half :])
        found = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in windows]
        still = set(range(len(windows)))
        waiting: list[np.ndarray] = []
        held = 0

        def settle() -> None:
            nonlocal held
            if not waiting:
                return
            rows = np.concatenate(waiting)
            waiting.clear()
            held = 0
            rows = rows[fits(rows)]
            score, ids = self.scores(rows, q), self.ids[rows]
            for k in still:
                low, high = windows[k]
                inside = np.ones(len(rows), dtype=bool)
                if low is not None:
                    inside &= 100 * score >= low
                if high is not None:
                    inside &= 100 * score <= high
                s, i = np.append(found[k][0], score[inside]), np.append(found[k][1], ids[inside])
                first = np.lexsort((i, -s))[:most]
                found[k] = s[first], i[first]

        for bound, i, j in cells_by_bound(up_1, up_2):
            cell = int(codes_1[i]) * self.codes + int(codes_2[j])
            if cell not in self.place:
                continue
            if held >= _GATHER:
                settle()
            for k in list(still):
                low, _ = windows[k]
                full = len(found[k][0]) == most and found[k][0][-1] > bound
                if full or low is not None and 100 * bound < low:
                    settle() if waiting else None
                    still.discard(k)
            if not still:
                break
            least = 100 * (low_1[i] + low_2[j])
            if all(windows[k][1] is not None and least > windows[k][1] for k in still):
                continue  # every row of the cell scores above the windows
            start, stop = self.place[cell]
            waiting.append(np.arange(start, stop))
            held += stop - start
        settle()
        return found


def _tile(table: pa.Table, width: int, codes: int) -> Tile:
    x = matrix(table["x"].combine_chunks(), width)
    arrays = [table[c].to_numpy() for c in ("vec_id", "label", "cell")]
    return Tile(arrays[0], arrays[1], x, arrays[2], codes)


# --- the whole search ---------------------------------------------------------------------


def _against_tiles(tiles: DataFrame, queries: DataFrame, number: int, blocks: int, task, schema: str) -> DataFrame:
    """Each block of queries against each tile of rows."""
    rows = tiles.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = queries.withColumn("tile", F.explode(F.sequence(F.lit(0), F.lit(number - 1))))
    return rows.groupBy("tile", "block").cogroup(asked.groupBy("tile", "block")).applyInArrow(task, schema)


def mine(
    rows: DataFrame,
    anchors,
    id_column: str = "vec_id",
    label_column: str = "label",
    column: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    codes: int = CODES,
    tile_rows: int = TILE_ROWS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``anchors`` is a condition on the rows (a Column) that picks the anchors. An anchor's positives
    are its first rows of the same label under another id; for each of them come the first rows of
    another label whose score lies between ``low`` and ``high`` percent of the positive's. Order is
    by falling score, then id.

    Rows with a null id, a null label or an unusable vector (see ``integer_vectors``) take no part.
    Repeated rows count once; an id with several labels or vectors stands for each of them. Anchors
    without positives, and positives without rows in their window (always so where their score is
    negative), have no rows. An empty table gives none. Other columns play no part.
    """
    spark = rows.sparkSession
    picked = rows.select(
        F.col(id_column).cast("bigint").alias("vec_id"),
        F.col(label_column).cast("bigint").alias("label"),
        F.col(column).alias("embedding"),
        F.coalesce(anchors, F.lit(False)).alias("is_anchor"),
    ).where(F.col("vec_id").isNotNull() & F.col("label").isNotNull())
    vectors = written(
        integer_vectors(picked).select("vec_id", "label", "x", "is_anchor").distinct(), "negatives-rows"
    )
    total, asked = vectors.agg(F.count(F.lit(1)), F.count_if("is_anchor")).first()
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    if not total or not asked:
        return spark.createDataFrame([], schema)
    sample = vectors.select("x").orderBy(F.xxhash64("x")).limit(SAMPLE).collect()  # bounded
    points = np.array([r["x"] for r in sample], dtype=np.int64)
    width = points.shape[1]
    half = (width + 1) // 2
    books = codebook(points[:, :half], codes), codebook(points[:, half:], codes)
    number, blocks = -(-total // tile_rows), -(-asked // block_queries)
    dealt = coded(vectors, *books).repartitionByRange(number, "cell", F.xxhash64("vec_id", "x"))
    tiles = written(dealt.select("vec_id", "label", "x", "cell", F.spark_partition_id().alias("tile")), "negatives-tiles")
    number = tiles.agg(F.max("tile")).first()[0] + 1
    query = F.xxhash64("label", "x").alias("anchor_key")
    block = F.pmod(F.xxhash64("vec_id", "x"), F.lit(blocks)).cast("int").alias("block")
    queries = written(vectors.where("is_anchor").select("vec_id", "label", "x", query, block), "negatives-queries")
    width_codes = len(books[1])

    def find_positives(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            tile = _tile(left, width, width_codes)
            x = matrix(right["x"].combine_chunks(), width)
            for q, anchor, key, label in zip(x, *(right[c].to_pylist() for c in ("vec_id", "anchor_key", "label"))):
                fits = lambda r, a=anchor, b=label: (tile.labels[r] == b) & (tile.ids[r] != a)
                scores, ids = tile.search(q, fits, [(None, None)], positives)[0]
                out += [(anchor, key, i, s) for i, s in zip(ids.tolist(), scores.tolist())]
        names = ["anchor_id", "anchor_key", "positive_id", "positive_score"]
        return pa.table({n: pa.array([r[k] for r in out], pa.int64()) for k, n in enumerate(names)})

    found = _against_tiles(
        tiles, queries, number, blocks, find_positives,
        "anchor_id bigint, anchor_key bigint, positive_id bigint, positive_score bigint",
    )
    order = Window.partitionBy("anchor_id", "anchor_key").orderBy(F.desc("positive_score"), "positive_id")
    best = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives)
    per_anchor = best.groupBy("anchor_id", "anchor_key").agg(  # at most ``positives`` of each
        F.collect_list("place").alias("places"),
        F.collect_list("positive_id").alias("positive_ids"),
        F.collect_list("positive_score").alias("positive_scores"),
    )
    per_anchor = per_anchor.withColumnRenamed("anchor_id", "vec_id")
    with_windows = written(queries.join(per_anchor, ["vec_id", "anchor_key"]), "negatives-windows")

    def find_negatives(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            tile = _tile(left, width, width_codes)
            x = matrix(right["x"].combine_chunks(), width)
            names = ("vec_id", "anchor_key", "label", "places", "positive_ids", "positive_scores")
            for q, anchor, key, label, places, p_ids, p_scores in zip(x, *(right[c].to_pylist() for c in names)):
                windows = [(low * s, high * s) for s in p_scores]
                fits = lambda r, b=label: tile.labels[r] != b
                hits = tile.search(q, fits, windows, negatives)
                for place, p_id, p_score, (scores, ids) in zip(places, p_ids, p_scores, hits):
                    out += [(anchor, key, place, p_id, p_score, i, s) for i, s in zip(ids.tolist(), scores.tolist())]
        names = ["anchor_id", "anchor_key", "place", "positive_id", "positive_score", "negative_id", "negative_score"]
        return pa.table({n: pa.array([r[k] for r in out], pa.int64()) for k, n in enumerate(names)})

    hits = _against_tiles(
        tiles, with_windows, number, blocks, find_negatives,
        "anchor_id bigint, anchor_key bigint, place bigint, positive_id bigint, positive_score bigint, "
        "negative_id bigint, negative_score bigint",
    )
    order = Window.partitionBy("anchor_id", "anchor_key", "place").orderBy(F.desc("negative_score"), "negative_id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
