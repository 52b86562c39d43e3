"""Hard negatives against a scan of all rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from layerwise.llm.common import table
from layerwise.llm.negatives import Tile, cells_by_bound, mine
from layerwise.llm.queries import op12_hard_negatives

SCHEMA = "vec_id bigint, label int, embedding array<float>, tile string, rank int, x int, cell int, block int"


def plain(ids, labels, x, anchors, positives=5, negatives=10, low=30, high=90):
    out = []
    for a in np.where(anchors)[0]:
        score = x @ x[a]
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != ids[a]]
        for p in [i for i in order if labels[i] == labels[a]][:positives]:
            fits = [i for i in order if labels[i] != labels[a] and low * score[p] <= 100 * score[i] <= high * score[p]]
            out += [(ids[a], ids[p], k + 1, ids[i], score[p], score[i]) for k, i in enumerate(fits[:negatives])]
    return sorted(tuple(map(int, r)) for r in out)


def whole(vectors):
    return np.floor(256 * np.array(vectors, dtype=np.float32).astype(float)).astype(np.int64)


def frame(spark, ids, labels, vectors):
    rows = [(i, l, v, "t", 1, 2, 3, 4) for i, l, v in zip(ids, labels, vectors)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def found(df):
    return sorted(tuple(r) for r in df.collect())


def test_query(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").collect()
    ids = np.array([r["vec_id"] for r in rows])
    labels = np.array([r["label"] for r in rows])
    labels[ids % 7 == 0] = (labels[ids % 7 == 0] + 1) % 10
    want = plain(ids, labels, whole([r["embedding"] for r in rows]), ids % 100 == 0)
    assert want and found(op12_hard_negatives(spark, sf_dir)) == want


@pytest.mark.parametrize("size", [{}, {"tile_rows": 50, "block_queries": 7, "codes": 4}])
def test_clusters_ties_and_copies(spark, size):
    random = np.random.default_rng(5)
    middles = random.standard_normal((6, 7))
    vectors = (middles[random.integers(0, 6, 300)] + 0.3 * random.standard_normal((300, 7))).tolist()
    vectors[200:] = [vectors[0]] * 100  # a third of the rows in one cell, all tied
    ids, labels = np.arange(300), random.integers(0, 4, 300)
    want = plain(ids, labels, whole(vectors), ids % 10 == 0)
    df = frame(spark, ids.tolist(), labels.tolist(), vectors)
    assert found(mine(df, F.col("vec_id") % 10 == 0, **size)) == want
    assert found(mine(df.union(df), F.col("vec_id") % 10 == 0, **size)) == want


def test_rows_without_part(spark):
    random = np.random.default_rng(6)
    good = random.standard_normal((30, 4)).tolist()
    bad = [(None, 1, good[0]), (101, None, good[0]), (102, 1, None), (103, 1, [math.nan] * 4),
           (104, 1, [1.0, None, 1.0, 1.0]), (105, 1, []), (106, 1, [1.0])]
    ids, labels = np.arange(30), random.integers(0, 2, 30)
    df = frame(spark, ids.tolist(), labels.tolist(), good)
    rest = frame(spark, *(list(c) for c in zip(*bad)))
    want = plain(ids, labels, whole(good), ids % 5 == 0)
    assert found(mine(df.union(rest), F.col("vec_id") % 5 == 0)) == want


@pytest.mark.parametrize("width", [1, 2])
def test_narrow_vectors(spark, width):
    random = np.random.default_rng(7)
    vectors = random.standard_normal((40, width)).tolist()
    ids, labels = np.arange(40), random.integers(0, 2, 40)
    df = frame(spark, ids.tolist(), labels.tolist(), vectors)
    assert found(mine(df, F.col("vec_id") % 4 == 0)) == plain(ids, labels, whole(vectors), ids % 4 == 0)


def test_empty_and_without_anchors(spark):
    df = frame(spark, [1, 2], [0, 0], [[1.0], [2.0]])
    assert mine(df.where("false"), F.col("vec_id") % 2 == 0).count() == 0
    assert mine(df, F.lit(None).cast("boolean")).count() == 0


def test_scores_beyond_doubles(spark):
    big = [[float(1 << 20) + 0.5, 3.0], [float(1 << 20), 1.0], [float(1 << 19), 2.0]]
    ids, labels = np.arange(3), np.array([0, 0, 1])
    want = plain(ids, labels, whole(big).astype(object), ids == 0)
    df = frame(spark, ids.tolist(), labels.tolist(), big)
    assert want and found(mine(df, F.col("vec_id") == 0)) == want


def test_cells_come_by_falling_bound():
    first, second = np.array([5.0, 2.0, 2.0]), np.array([3.0, 1.0, -4.0])
    visited = list(cells_by_bound(first, second))
    assert [b for b, _, _ in visited] == sorted((a + b for a in first for b in second), reverse=True)
    assert len({(i, j) for _, i, j in visited}) == 9


def test_search_leaves_cells_unread():
    """With clusters apart, a certified window ends the search before all cells are read."""
    random = np.random.default_rng(8)
    cell = random.integers(0, 16, 2000)
    x = np.rint(np.stack([1000 * (cell // 4), 1000 * (cell % 4)], axis=1) + random.standard_normal((2000, 2)))
    tile = Tile(np.arange(2000), np.zeros(2000, int), x.astype(np.int64), cell, 4)
    read = []
    scores, tile.scores = tile.scores, lambda rows, q: (read.append(len(rows)), scores(rows, q))[1]
    tile.search(np.array([1, 1]), lambda r: np.ones(len(r), bool), [(None, None)], 5)
    assert sum(read) < 1000
