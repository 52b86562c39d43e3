"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is a set of paragraph digests: lines, cut after sentence ends and every ``MOST_WORDS``
words; an equal paragraph counts as another one each time it comes again. Each digest goes into
three cells, which hold how many there are, their sum and the sum of their checks (all modulo a
power of two). Sketches of two versions subtract cell by cell; peeling cells that hold a single
digest recovers the digests that differ. Where that fails, both are sketched anew, four times as
large.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CELLS = 24
HASHES = 3
GROWTH = 4
MOST_WORDS = 8
_SENTENCE = re.compile(r"(?<=[.!?])\s+|[\n\r]+")
#: Documents whose sketches are compared together, and their digests at most.
GROUP, GROUP_DIGESTS = 256, 200_000
#: Documents of one range of ids, and ranges at most.
RANGE_ROWS, RANGES = 2_000, 8_192


def paragraphs(text: str) -> list[str]:
    """White space within a paragraph is single; paragraphs without words do not count."""
    out = []
    for part in _SENTENCE.split(text):
        words = part.split()
        out += [" ".join(words[i : i + MOST_WORDS]) for i in range(0, len(words), MOST_WORDS)]
    return out


def digests(text: str) -> np.ndarray:
    """Distinct 64-bit digests: of each paragraph and of how often it came before."""
    seen: Counter = Counter()
    out = []
    for paragraph in paragraphs(text):
        out.append(xxhash.xxh64_intdigest(paragraph.encode("utf-8", "replace"), seen[paragraph]))
        seen[paragraph] += 1
    return np.unique(np.array(out, dtype=np.uint64))


def _mix(values: np.ndarray, salt: int) -> np.ndarray:
    mixed = values ^ np.uint64((salt + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return mixed ^ (mixed >> np.uint64(31))


def _places(values: np.ndarray, cells: int) -> np.ndarray:
    """The cell of each digest in each of the three parts of a sketch."""
    part = cells // HASHES
    return np.stack([(_mix(values, h) % np.uint64(part)).astype(np.int64) + h * part for h in range(HASHES)])


class Sketches:
    """Sketches of many sets side by side: ``owner`` tells which set a digest is in."""

    def __init__(self, sets: int, cells: int):
        self.cells = cells
        self.count = np.zeros(sets * cells, dtype=np.int64)
        self.total = np.zeros(sets * cells, dtype=np.uint64)
        self.check = np.zeros(sets * cells, dtype=np.uint64)

    def add(self, values: np.ndarray, owner: np.ndarray, sign: np.ndarray | int = 1) -> np.ndarray:
        """Put digests in, or take them out where ``sign`` is -1. Returns the cells."""
        at = (owner * self.cells + _places(values, self.cells)).ravel()
        signs = np.tile(np.broadcast_to(np.asarray(sign, dtype=np.int64), values.shape), HASHES)
        np.add.at(self.count, at, signs)
        wrapped = signs.view(np.uint64)
        np.add.at(self.total, at, np.tile(values, HASHES) * wrapped)
        np.add.at(self.check, at, np.tile(_mix(values, HASHES), HASHES) * wrapped)
        return at

    def minus(self, other: Sketches) -> Sketches:
        out = Sketches(0, self.cells)
        out.count, out.total = self.count - other.count, self.total - other.total
        out.check = self.check - other.check
        return out

    def text(self, row: int) -> str:
        """A sketch as text: 8 bytes of sum, 4 of check and 2 of count a cell."""
        cell = slice(row * self.cells, (row + 1) * self.cells)
        parts = self.total[cell].astype("<u8"), (self.check[cell] & np.uint64(0xFFFFFFFF)).astype("<u4")
        counts = self.count[cell].astype("<u2")
        return base64.b64encode(b"".join(p.tobytes() for p in (*parts, counts))).decode()

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Digests, their sets and their signs, and which sets came apart wholly."""
        sets = len(self.count) // self.cells
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        look = np.flatnonzero(np.abs(self.count) == 1)
        while len(look):
            sign = self.count[look]
            value = self.total[look] * sign.view(np.uint64)
            pure = self.check[look] * sign.view(np.uint64) == _mix(value, HASHES)
            look, sign, value = look[pure], sign[pure], value[pure]
            if not len(look):
                break
            owner = look // self.cells
            _, first = np.unique(np.stack([owner.astype(np.uint64), value]), axis=1, return_index=True)
            owner, value, sign = owner[first], value[first], sign[first]
            found.append((value, owner, sign))
            touched = np.unique(self.add(value, owner, -sign))
            look = touched[np.abs(self.count[touched]) == 1]
        whole = ~(
            self.count.astype(bool) | self.total.astype(bool) | self.check.astype(bool)
        ).reshape(sets, self.cells).any(axis=1)
        values, owners, signs = (
            (np.concatenate([f[i] for f in found]) if found else np.empty(0, dtype=t))
            for i, t in enumerate((np.uint64, np.int64, np.int64))
        )
        return values, owners, signs, whole


def _flat(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    sizes = [len(s) for s in sets]
    values = np.concatenate(sets) if sets else np.empty(0, dtype=np.uint64)
    return values, np.repeat(np.arange(len(sets)), sizes)


def differences(left: list[np.ndarray], right: list[np.ndarray], cells: int = CELLS) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each pair of sets, the digests only the left and only the right one has: recovered
    from the difference of their sketches, larger ones where the smaller did not come apart."""
    out: list = [None] * len(left)
    todo = list(range(len(left)))
    while todo:
        sketches = []
        for side in (left, right):
            sketch = Sketches(len(todo), cells)
            sketch.add(*_flat([side[i] for i in todo]))
            sketches.append(sketch)
        values, owners, signs, whole = sketches[0].minus(sketches[1]).peel()
        order = np.argsort(owners, kind="stable")
        values, owners, signs = values[order], owners[order], signs[order]
        edge = np.searchsorted(owners, np.arange(len(todo) + 1))
        again = []
        for row, i in enumerate(todo):
            if whole[row]:
                own, sign = values[edge[row] : edge[row + 1]], signs[edge[row] : edge[row + 1]]
                out[i] = (own[sign > 0], own[sign < 0])
            else:
                again.append(i)
        todo, cells = again, cells * GROWTH
    return out


def likeness(sizes: tuple[int, int], different: tuple[np.ndarray, np.ndarray]) -> float:
    """Share of paragraphs that both have (twice those in common, by all of both); two texts
    without paragraphs are alike."""
    every = sizes[0] + sizes[1]
    return 1.0 if not every else 1 - (len(different[0]) + len(different[1])) / every


def fingerprint_texts(found: list[np.ndarray]) -> list[str]:
    """Sketches of ``CELLS`` cells as text, after the number of paragraphs."""
    sketch = Sketches(len(found), CELLS)
    sketch.add(*_flat(found))
    return [f"{len(f)}:{sketch.text(i)}" for i, f in enumerate(found)]


# --- versions of documents ----------------------------------------------------------------


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the start of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare_versions(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and how alike it is to that text
    and to the next document, by descending id (after the last: the first).

    Ids are cut into ranges; each range gets a copy of the first row of the next one, and one
    shuffle brings a range together. Null text: empty. A null id comes last; rows of one id are
    next to each other in the order of their text. One document is its own next. Other columns
    are not read. No documents give no rows.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    number = rows.count()
    ranges = max(1, min(RANGES, number // RANGE_ROWS))
    cuts = _cuts(rows, ranges)
    placed = rows.withColumn("range", _range_of(F.col("doc_id"), cuts)).withColumn("peek", F.lit(False))
    heads = placed.groupBy("range").agg(F.max("doc_id").alias("doc_id")).orderBy(F.desc("range")).collect()
    # heads: one id a range. The first row of a range follows the last one of the range above.
    firsts = [(h["doc_id"], heads[i - 1]["range"]) for i, h in enumerate(heads)]
    spark = docs.sparkSession
    peeks = spark.createDataFrame(firsts, "head bigint, above int") if firsts else None
    if peeks is not None:
        copies = rows.join(F.broadcast(peeks), F.col("doc_id").eqNullSafe(F.col("head")))
        copies = copies.groupBy("doc_id", "above").agg(F.min("text").alias("text"))
        placed = placed.unionByName(
            copies.select("doc_id", "text", F.col("above").alias("range"), F.lit(True).alias("peek"))
        )
    schema = (
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string,"
        " edited_fingerprint string, near_edited double, near_next double"
    )
    order = ["range", "peek", F.desc_nulls_last("doc_id"), "text"]
    return placed.repartition(ranges, "range").sortWithinPartitions(*order).mapInPandas(_compare, schema)


def _cuts(rows: DataFrame, ranges: int) -> list[int]:
    """Ids that part the ranges, by quantiles."""
    if ranges < 2:
        return []
    shares = [i / ranges for i in range(1, ranges)]
    found = rows.agg(F.percentile_approx("doc_id", shares, 20 * ranges)).first()[0]
    return sorted(set(found or []))


def _range_of(doc_id, cuts: list[int]):
    """How many cuts an id reaches, by halving steps; a null id is below all."""
    if not cuts:
        return F.lit(0)
    steps = [1 << i for i in range(len(cuts).bit_length() - 1, -1, -1)]
    every = F.lit(cuts)

    def halve(low, step):
        at = low + step
        inside = (at <= len(cuts)) & (F.get(every, at - 1) <= doc_id)
        return F.when(inside, at).otherwise(low)

    return F.aggregate(F.lit(steps), F.lit(0), halve)


def _compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of ranges in order; the peeked row closes its range."""
    held: list[tuple] = []  # doc_id, text, following text
    open_row: tuple | None = None
    size = 0
    for frame in frames:
        for doc_id, text, _, peek in zip(frame["doc_id"], frame["text"], frame["range"], frame["peek"]):
            if open_row is not None:
                held.append((*open_row, text))
                size += len(open_row[1])
            open_row = None if peek else (doc_id, text)
            if len(held) >= GROUP or size > GROUP_DIGESTS * 20:
                yield _compared(held)
                held, size = [], 0
    if held:
        yield _compared(held)


def _compared(rows: list[tuple]) -> pd.DataFrame:
    known: dict[str, np.ndarray] = {}

    def of(text: str) -> np.ndarray:
        if text not in known:
            known[text] = digests(text)
        return known[text]

    own = [of(text) for _, text, _ in rows]
    following = [of(text) for _, _, text in rows]
    changed_texts = [edited(text, after) for _, text, after in rows]
    changed = [digests(t) for t in changed_texts]
    near = []
    for other in (changed, following):
        found = differences(own, other)
        near.append([likeness((len(a), len(b)), d) for a, b, d in zip(own, other, found)])
    return pd.DataFrame(
        {
            "doc_id": pd.array([None if pd.isna(r[0]) else int(r[0]) for r in rows], dtype="Int64"),
            "n_chars": [len(r[1]) for r in rows],
            "edited_sha256": [hashlib.sha256(t.encode("utf-8", "replace")).hexdigest() for t in changed_texts],
            "fingerprint": fingerprint_texts(own),
            "edited_fingerprint": fingerprint_texts(changed),
            "near_edited": near[0],
            "near_next": near[1],
        }
    )
