"""Toxicity scores: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A text's features are the distinct n-grams of its lower-cased code points, hashed into
``BUCKETS``. Each is scaled by the log ratio of its (smoothed) shares among the n-grams of toxic
and of other training texts; logistic regression learns the weights on top. The classifier is fit
on a bounded sample of labelled rows (``SAMPLE`` a class, those of the least hashed ids); texts
are counted in Spark tasks, and the driver holds the sample's feature numbers only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_size, held_out

ORDERS = (3, 5, 8)
BUCKETS = 1 << 20
#: Labelled rows of each class that the classifier is fit on, at most.
SAMPLE = 3_000
#: Features that are kept for the fit, by the size of their ratio and how many rows have them.
FEATURES = 3_000
#: Least strength of a feature: its ratio's size times the root of the rows that have it.
STRENGTH = 10.0
_CHUNK = 1 << 20
_FACTORS = {n: np.uint64(0x9E3779B97F4A7C15 * (2 * n + 1) % (1 << 64)) for n in ORDERS}


class Hasher:
    """Distinct buckets of a text's n-grams, without sorting."""

    def __init__(self) -> None:
        self.last = np.zeros(BUCKETS, dtype=np.int32)

    def buckets(self, text: str) -> np.ndarray:
        text = f" {text.lower()} "
        if len(text) <= _CHUNK:
            return self._distinct(self._hashed(text))
        parts = [
            self._distinct(self._hashed(text[at : at + _CHUNK + max(ORDERS) - 1]))
            for at in range(0, len(text), _CHUNK)
        ]
        return np.unique(np.concatenate(parts))

    def _hashed(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le", "replace"), dtype="<u4").astype(np.uint64)
        value, out = points, []
        for n in range(2, max(ORDERS) + 1):
            if len(points) < n:
                break
            value = value[: len(points) - n + 1] * np.uint64(0x100000001B3) ^ points[n - 1 :]
            if n in ORDERS:
                mixed = value * _FACTORS[n]
                out.append((mixed >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int32))
        return np.concatenate(out) if out else np.empty(0, dtype=np.int32)

    def _distinct(self, buckets: np.ndarray) -> np.ndarray:
        place = np.arange(len(buckets), dtype=np.int32)
        self.last[buckets] = place  # the last writer of a bucket stays
        return buckets[self.last[buckets] == place]


@dataclass
class Model:
    kept: np.ndarray  # buckets with a weight
    weights: np.ndarray  # theirs, times the log-count ratio
    bias: float

    def scorer(self):
        kept, weights, bias = self.kept, self.weights, self.bias

        def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            hasher = Hasher()
            every = np.zeros(BUCKETS)
            every[kept] = weights
            for batch in batches:
                found = [every[hasher.buckets(t)].sum() for run in by_size(batch) for t in run]
                margin = np.clip(np.array(found, dtype=np.float64) + bias, -500, 500)
                yield pd.Series(1 / (1 + np.exp(-margin)))

        score.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
        return F.pandas_udf(score, "double")

    def score(self, text: Column) -> Column:
        """0 to 1. Null and empty texts have no features: they get the bias alone."""
        return self.scorer()(text)


def training_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``text`` and ``toxic`` of at most ``sample`` labelled training rows of each class.

    Labels are reduced to one row an id (the higher label) before they are sampled; rows with a
    null id or label, or of the held-out fold, are left out. The sampled ids are few by
    construction, so they are broadcast and the documents need no shuffle.
    """
    known = labels.where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where(~held_out())
    order = F.xxhash64(F.col("doc_id"), F.lit("toxicity"))
    parts = [known.where(F.col("toxic") == c).orderBy(order, "doc_id").limit(sample) for c in (0, 1)]
    chosen = parts[0].unionByName(parts[1])
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, epochs: int = 60) -> Model:
    """The classifier from labelled documents outside the held-out fold. Without rows of both
    classes it scores by the smoothed share of toxic rows alone."""
    shares = labels.where("toxic in (0, 1) and doc_id is not null").where(~held_out())
    shares = shares.agg(F.count(F.lit(1)), F.sum(F.col("toxic").cast("bigint"))).first()
    rate = ((shares[1] or 0) + 1) / (shares[0] + 2)
    rows = training_sample(docs, labels, sample)

    def features(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Hasher()
        for frame in frames:
            at = 0
            for run in by_size(frame["text"]):
                found = [hasher.buckets(t).astype("<i4").tobytes() for t in run]
                yield pd.DataFrame({"toxic": frame["toxic"].iloc[at : at + len(run)].astype("int32"), "features": found})
                at += len(run)

    listed = rows.mapInPandas(features, "toxic int, features binary").persist()
    try:
        counts = np.zeros((2, BUCKETS))
        for toxic, data in _shares(listed):
            counts[toxic] += np.frombuffer(data, dtype="<i8")
        numbers = {r[0]: r[1] for r in listed.groupBy("toxic").count().collect()}
        totals = [numbers.get(c, 0) for c in (0, 1)]
        seen = counts.sum(0)
        ratio = np.log((counts[1] + 1) / (totals[1] + 2)) - np.log((counts[0] + 1) / (totals[0] + 2))
        gain = np.abs(ratio) * np.sqrt(seen)
        gain[gain < STRENGTH] = 0
        few = min(FEATURES, int((gain > 0).sum()))
        kept = np.sort(np.argpartition(-gain, few - 1)[:few]) if few else np.empty(0, dtype=np.int64)
        labels_, lists = _kept_features(listed, kept)
    finally:
        listed.unpersist()
    if not few or len(set(labels_.tolist())) < 2:
        return Model(kept, np.zeros(len(kept)), float(np.log(rate / (1 - rate))))
    w, bias = _logistic(lists, labels_, ratio[kept], rate, epochs)
    return Model(kept, w * ratio[kept], bias)


def _shares(listed: DataFrame) -> list[tuple[int, bytes]]:
    """Rows of each class that have each bucket, summed in the tasks, then in Spark by slices of
    buckets, so that the driver gets one vector a class."""
    slices = 64
    width = BUCKETS // slices

    def tally(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros((2, BUCKETS), dtype="<i8")
        for frame in frames:
            for toxic, data in zip(frame["toxic"], frame["features"]):
                counts[toxic, np.frombuffer(data, dtype="<i4")] += 1
        for toxic in (0, 1):
            if counts[toxic].any():
                for i in range(slices):
                    data = counts[toxic, i * width : (i + 1) * width].tobytes()
                    yield pd.DataFrame({"toxic": [toxic], "slice": [i], "counts": [data]})

    def add(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(d, dtype="<i8") for d in frame["counts"])
        return pd.DataFrame({"toxic": [key[0]], "slice": [key[1]], "counts": [total.tobytes()]})

    schema = "toxic int, slice int, counts binary"
    found = listed.mapInPandas(tally, schema).groupBy("toxic", "slice").applyInPandas(add, schema).collect()
    empty = np.zeros(width, dtype="<i8").tobytes()
    by = {(r["toxic"], r["slice"]): bytes(r["counts"]) for r in found}
    return [(t, b"".join(by.get((t, i), empty) for i in range(slices))) for t in (0, 1)]


def _kept_features(listed: DataFrame, kept: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Labels and kept features (as positions in ``kept``) of the sample's rows."""
    position = np.full(BUCKETS, -1, dtype=np.int32)
    position[kept] = np.arange(len(kept), dtype=np.int32)

    def narrow(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [position[np.frombuffer(d, dtype="<i4")] for d in frame["features"]]
            data = [np.sort(f[f >= 0]).astype("<i4").tobytes() for f in found]
            yield pd.DataFrame({"toxic": frame["toxic"], "features": data})

    rows = listed.mapInPandas(narrow, "toxic int, features binary").collect()
    rows.sort(key=lambda r: (r["toxic"], bytes(r["features"])))  # the same fit in every run
    lists = [np.frombuffer(bytes(r["features"]), dtype="<i4") for r in rows]
    return np.array([r["toxic"] for r in rows], dtype=np.float64), lists


def _logistic(
    lists: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray, rate: float, epochs: int
) -> tuple[np.ndarray, float]:
    """Logistic regression by full-batch Adam with L2, on features scaled by ``ratio``. Rows are
    weighted so that the classes weigh as in all labelled rows."""
    size = np.array([len(x) for x in lists])
    flat = np.concatenate(lists).astype(np.int64)
    edge = np.concatenate([[0], np.cumsum(size)])
    toxic_share = labels.mean()
    weight = np.where(labels == 1, rate / toxic_share, (1 - rate) / (1 - toxic_share))
    weight /= weight.sum()
    w, bias = np.zeros(len(ratio)), float(np.log(rate / (1 - rate)))
    first, second = np.zeros(len(ratio) + 1), np.zeros(len(ratio) + 1)
    for step in range(1, epochs + 1):
        scaled = w * ratio
        sums = np.concatenate([[0.0], np.cumsum(scaled[flat])])
        margin = np.clip(sums[edge[1:]] - sums[edge[:-1]] + bias, -500, 500)
        error = weight * (1 / (1 + np.exp(-margin)) - labels)
        gradient = np.bincount(flat, weights=np.repeat(error, size), minlength=len(ratio)) * ratio
        gradient = np.append(gradient + 1e-5 * w, error.sum())
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        move = 0.02 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        w -= move[:-1]
        bias -= move[-1]
    return w, bias
