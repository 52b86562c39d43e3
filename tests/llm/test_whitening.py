"""Whitening against the eigenvectors of the dense covariance."""

import math

import numpy as np
import pytest

from layerwise.llm.common import table
from layerwise.llm.queries import op11_whitening
from layerwise.llm.vectors import integer_vectors
from layerwise.llm.whitening import CentredRows, bidiagonalise, fit, whiten

SCHEMA = "vec_id bigint, embedding array<float>, component int, x string"


def frame(spark, vectors, schema=SCHEMA):
    rows = [(i, v, 7, "own") for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, schema).repartition(3)


def plain(vectors, count=4):
    """Vectors as longs, with components by falling variance, from the dense covariance."""
    x = np.floor(256 * np.array(vectors, dtype=np.float32).astype(float)).astype(np.int64)
    unique = np.unique(x, axis=0)
    n, sums = len(unique), unique.sum(axis=0)
    centred = unique - sums / n
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    values, basis = values[::-1], basis[:, ::-1]
    whitened = (x - sums / n) @ basis[:, :count] / np.sqrt(values[:count])
    return n, ((n * x - sums) ** 2).sum(axis=1), whitened, values[:count] / values.sum()


def compare(found, vectors, ids, count=4):
    n, deviation, whitened, explained = plain(vectors, count)
    assert len(found) == len(vectors) * count
    place = {i: k for k, i in enumerate(ids)}
    signs = {}
    for row in found:
        k, c = place[row["vec_id"]], row["component"] - 1
        assert (row["n"], row["deviation"]) == (n, deviation[k])
        if abs(whitened[k, c]) > 1e-3:
            sign = signs.setdefault(c, np.sign(whitened[k, c] * row["whitened"]))
            assert row["whitened"] * sign == pytest.approx(whitened[k, c], rel=1e-8, abs=1e-8)
        assert row["explained"] == pytest.approx(explained[c], rel=1e-9)
        assert row["identity_error"] < 1e-9


def test_query(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").collect()
    compare(op11_whitening(spark, sf_dir).collect(), [r["embedding"] for r in rows], [r["vec_id"] for r in rows])


def test_repeats_count_once_in_the_fit(spark):
    random = np.random.default_rng(1)
    vectors = random.standard_normal((40, 6)).tolist()
    vectors += [vectors[0]] * 30
    compare(whiten(frame(spark, vectors)).collect(), vectors, range(len(vectors)))


def test_unusable_vectors_and_clashing_names(spark):
    random = np.random.default_rng(2)
    good = random.standard_normal((20, 5)).tolist()
    bad = [None, [], [1.0, None, 0.0, 0.0, 0.0], [math.nan] * 5, [math.inf, 0.0, 0.0, 0.0, 0.0], [1.0, 2.0]]
    found = whiten(frame(spark, good + bad))
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    compare(found.collect(), good, range(20))


def test_repeated_and_vanishing_variances(spark):
    """Equal variances end a Lanczos run early; it goes on from a fresh vector."""
    cross = [[s * 2.0 if k == i else 0.0 for k in range(6)] for i in range(5) for s in (1, -1)]
    found = whiten(frame(spark, cross)).collect()
    assert {r["component"] for r in found} == {1, 2, 3, 4}
    assert all(r["explained"] == pytest.approx(0.2) and r["identity_error"] < 1e-9 for r in found)
    flat = [[float(i), 2.0 * i, 0.0] for i in range(6)]
    assert {r["component"] for r in whiten(frame(spark, flat)).collect()} == {1}


@pytest.mark.parametrize("vectors", [[], [[1.0, 2.0]], [[1.0, 2.0]] * 3])
def test_no_spread_no_rows(spark, vectors):
    assert whiten(frame(spark, vectors)).count() == 0


def test_deviation_beyond_a_long_is_null(spark):
    found = whiten(frame(spark, [[1e12, 0.0], [-1e12, 0.0], [0.0, 1e12]]), components=1).collect()
    assert [r["deviation"] for r in found] == [None] * 3


def test_bidiagonal_form(spark):
    """A V = U B with orthonormal V, and B's singular values are those of A."""
    vectors = np.random.default_rng(3).standard_normal((30, 7)).tolist()
    vectors = integer_vectors(frame(spark, vectors)).select("x")
    rows = CentredRows(vectors)
    right, b = bidiagonalise(rows, 7)
    x = np.array([r["x"] for r in vectors.collect()])
    a = x - x.mean(axis=0)
    assert np.allclose(right.T @ right, np.eye(7), atol=1e-12)
    assert np.allclose(np.linalg.svd(b)[1], np.linalg.svd(a)[1][:7], rtol=1e-12)
    assert np.allclose(np.triu(np.tril(b, 1)), b)
    assert fit(vectors, 2, steps=3).components.shape == (2, 7)
