"""Language identification by rank-order profiles.

A profile is the list of the most frequent character n-grams of a language's training texts. A
text's own most frequent n-grams are compared with each profile: the distance is the sum of how
far each stands from its place there, ``PROFILE`` where it does not occur. The nearest wins.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import by_size, held_out

ORDERS = 3
PROFILE = 300
UNKNOWN = "und"
RESULT = "struct<lang_pred:string,score:double>"
_CHUNK = 1 << 20
_SPACE = 32
_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1))
    return _letters[0]


def grams(text: str) -> np.ndarray:
    """N-grams of 1 to 3 lower-cased letters, packed into 64 bits; other characters are word
    ends, which only begin or close an n-gram."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), dtype="<u4").astype(np.uint64)
    letter = _is_letter()[points]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[:-1] |= letter[1:] & ~letter[:-1]
    keep &= letter | ~np.concatenate([[False], keep[:-1] & ~letter[:-1]])
    points, letter = np.where(letter, points, np.uint64(_SPACE))[keep], letter[keep]
    if len(points) < 3:
        return np.empty(0, dtype=np.uint64)
    two = points[:-1] << np.uint64(21) | points[1:]
    three = two[:-1] << np.uint64(21) | points[2:]
    return np.concatenate([points[letter], two[letter[:-1] | letter[1:]], three[letter[1:-1]]])


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    if len(text) <= _CHUNK:
        return np.unique(grams(text), return_counts=True)
    return _sum([np.unique(grams(text[at : at + _CHUNK]), return_counts=True) for at in range(0, len(text), _CHUNK)])


def _sum(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return keys, np.bincount(where, np.concatenate([p[1] for p in parts]), len(keys)).astype(np.int64)


def ranked(keys: np.ndarray, counts: np.ndarray, most: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams, most frequent first, ties by value."""
    if len(keys) > most:
        least = np.partition(counts, len(counts) - most)[len(counts) - most]
        held = counts >= least
        keys, counts = keys[held], counts[held]
    return keys[np.argsort(-counts, kind="stable")][:most]  # keys are in order


@dataclass
class Profiles:
    names: list[str]
    keys: np.ndarray  # n-grams of all profiles, sorted
    ranks: np.ndarray  # language x n-gram, PROFILE where it does not occur; a last column for others

    @staticmethod
    def of(ranked_lists: dict[str, list[int]]) -> Profiles:
        names = sorted(ranked_lists)
        keys = np.unique(np.array([g for n in names for g in ranked_lists[n]], dtype=np.uint64))
        ranks = np.full((len(names), len(keys) + 1), PROFILE, dtype=np.int64)
        for row, name in enumerate(names):
            own = np.array(ranked_lists[name], dtype=np.uint64)
            ranks[row, np.searchsorted(keys, own)] = np.arange(len(own))
        return Profiles(names, keys, ranks)

    def nearest(self, text: str) -> tuple[str, float]:
        """The nearest language and 1 minus its distance as a share of the greatest one."""
        own = ranked(*gram_counts(text))
        if not len(own) or not self.names:
            return UNKNOWN, 0.0
        at = np.searchsorted(self.keys, own)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == own[known]
        column = np.where(known, at, len(self.keys))
        found = self.ranks[:, column]
        place = np.arange(len(own))
        away = np.where(found == PROFILE, PROFILE, np.abs(found - place)).sum(axis=1)
        best = int(away.argmin())  # ties: first name
        return self.names[best], float(1 - away[best] / (PROFILE * len(own)))

    def predict(self, text: Column) -> Column:
        """``RESULT`` of a text: ``und`` with score 0 where it is null or has no letter."""

        def many(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                found = [self.nearest(t) for run in by_size(batch) for t in run]
                yield pd.DataFrame(found, columns=["lang_pred", "score"])

        many.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
        return F.pandas_udf(many, RESULT)(text)


def learn(docs: DataFrame) -> Profiles:
    """Profiles from the whole texts of all rows with a ``lang`` outside the held-out fold. Tasks
    count n-grams, Spark adds the counts; the driver gets ``PROFILE`` rows a language."""
    train = docs.where("lang is not null and text is not null").where(~held_out()).select("lang", "text")

    def tally(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        for frame in frames:
            for lang, texts in frame.groupby("lang")["text"]:
                for run in by_size(texts, _CHUNK):
                    parts = held.setdefault(lang, [])
                    parts.append(np.unique(np.concatenate([grams(t) for t in run]), return_counts=True))
                    if len(parts) > 16:
                        held[lang] = [_sum(parts)]
            for lang in [k for k, parts in held.items() if sum(len(p[0]) for p in parts) > 1_000_000]:
                yield emitted(lang, held.pop(lang))
        for lang, parts in held.items():
            yield emitted(lang, parts)

    def emitted(lang: str, parts: list) -> pd.DataFrame:
        keys, counts = _sum(parts)
        return pd.DataFrame({"lang": lang, "gram": keys.astype(np.int64), "n": counts})

    counted = train.mapInPandas(tally, "lang string, gram bigint, n bigint")
    totals = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = totals.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= PROFILE)
    lists: dict[str, list[int]] = {}
    for row in sorted(top.collect(), key=lambda r: (r["lang"], r["rank"])):
        lists.setdefault(row["lang"], []).append(row["gram"])
    return Profiles.of(lists)
