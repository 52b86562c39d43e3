"""Benchmark decontamination with an FM-index over each shard of training text.

A shard is a run of documents within a task. Its words become numbers in the vocabulary of the
benchmark; words outside it can be in no window, so the index covers the runs of words inside it
that are long enough for the shortest window. Windows are found by backward search through the
ranks of a wavelet tree, places by walking back to sampled suffix positions, and the hit words
merge into spans to remove.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shielded, with_columns, written

WINDOW = 10
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SHARD_WORDS = 1 << 20
#: Benchmark text, in bytes, that is sent to the tasks at once; more is searched in blocks.
BLOCK_BYTES = 32 << 20
HITS = (
    "struct<n_words:bigint,n_hit:bigint,items:array<string>,"
    "spans:array<struct<first_word:bigint,last_word:bigint,start:bigint,stop:bigint>>>"
)


# --- the index ----------------------------------------------------------------------------


class Bits:
    """A bit vector with ranks: 64-bit words and the ones before each."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, dtype=np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(ones)[:-1]])
        self.zeros = len(bits) - int(ones.sum())

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Ones before position ``at``."""
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)


class WaveletTree:
    """Ranks of symbols in a sequence; its levels are stored one after another, highest bit
    first, with the zeros of a level before its ones."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.levels: list[tuple[int, Bits]] = []
        for shift in range(max(1, int(symbols - 1).bit_length()) - 1, -1, -1):
            bit = (sequence >> shift) & 1
            self.levels.append((shift, Bits(bit.astype(np.uint8))))
            sequence = np.concatenate([sequence[bit == 0], sequence[bit == 1]])
        every = np.arange(symbols)
        self.first = self._down(every, np.zeros(symbols, dtype=np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, bits in self.levels:
            ones = bits.ones(at)
            at = np.where((symbol >> shift) & 1, bits.zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often the symbol stands before position ``at``."""
        return self._down(symbol, at) - self.first[symbol]

    def symbol_and_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        symbol = np.zeros(len(at), dtype=np.int64)
        for shift, bits in self.levels:
            one = bits.get(at).astype(np.int64)
            symbol |= one << shift
            ones = bits.ones(at)
            at = np.where(one, bits.zeros + ones, at - ones)
        return symbol, at - self.first[symbol]


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of the suffixes of runs that each end with 0; ends rank by their place.

    Prefix doubling; each round sorts only what is still tied.
    """
    ends = np.flatnonzero(text == 0)
    key = text.astype(np.int64) + len(ends)
    key[ends] = np.arange(len(ends))
    order = np.argsort(key, kind="stable")
    rank = _group_starts(key[order], order, np.empty(len(text), dtype=np.int64))
    tied = _tied(rank, order)
    step = 1
    while len(tied):
        ahead = rank[np.minimum(tied + step, len(text) - 1)]
        by = np.lexsort((ahead, rank[tied]))
        tied, ahead = tied[by], ahead[by]
        own = rank[tied]
        new = np.ones(len(tied), dtype=bool)
        new[1:] = (own[1:] != own[:-1]) | (ahead[1:] != ahead[:-1])
        group = np.ones(len(tied), dtype=bool)
        group[1:] = own[1:] != own[:-1]
        place = np.arange(len(tied))
        start = np.maximum.accumulate(np.where(group, place, 0))
        same = np.maximum.accumulate(np.where(new, place, 0))
        rank[tied] = own + same - start
        lone = new.copy()
        lone[:-1] &= new[1:]
        tied = tied[~lone]
        step *= 2
    array = np.empty(len(text), dtype=np.int64)
    array[rank] = np.arange(len(text))
    return array


def _group_starts(sorted_keys: np.ndarray, order: np.ndarray, rank: np.ndarray) -> np.ndarray:
    new = np.ones(len(order), dtype=bool)
    new[1:] = sorted_keys[1:] != sorted_keys[:-1]
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    return rank


def _tied(rank: np.ndarray, order: np.ndarray) -> np.ndarray:
    sizes = np.bincount(rank, minlength=len(rank))
    return order[sizes[rank[order]] > 1]


class FMIndex:
    """Search in runs of symbols 1 .. symbols-1, each ended by 0; every ``sample``-th position
    of a run keeps its place."""

    def __init__(self, text: np.ndarray, symbols: int, sample: int = 8):
        array = suffix_array(text)
        self.tree = WaveletTree(text[array - 1].astype(np.int64), symbols)
        self.below = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        ends = np.flatnonzero(text == 0)
        starts = np.concatenate([[0], ends[:-1] + 1])
        inside = np.arange(len(text)) - np.repeat(starts, ends - starts + 1)
        sampled = inside[array] % sample == 0
        self.sampled, self.places = Bits(sampled.astype(np.uint8)), array[sampled]

    def count(self, words: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the suffixes that begin with each phrase: a range [low, high). Phrases stand
        at the right of the rows of ``words``."""
        last = words[:, -1]
        low, high = self.below[last].copy(), self.below[last + 1].copy()
        for back in range(2, words.shape[1] + 1):
            on = np.flatnonzero((length >= back) & (low < high))
            if not len(on):
                break
            word = words[on, -back]
            low[on] = self.below[word] + self.tree.rank(word, low[on])
            high[on] = self.below[word] + self.tree.rank(word, high[on])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        place = np.empty(len(rows), dtype=np.int64)
        steps = 0
        active = np.arange(len(rows))
        while len(active):
            found = self.sampled.get(rows).astype(bool)
            place[active[found]] = self.places[self.sampled.ones(rows[found])] + steps
            active, rows = active[~found], rows[~found]
            symbol, rank = self.tree.symbol_and_rank(rows)
            rows = self.below[symbol] + rank
            steps += 1
        return place


# --- phrases ------------------------------------------------------------------------------


class Phrases:
    """The windows of a block of benchmark items, and which items have each."""

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[int]] = {}
        self.names: list[str] = []
        name_at: dict[str, int] = {}
        for name, text in items:
            words = WORD.findall((text or "").encode().lower())
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            if not ids:
                continue
            at = name_at.setdefault(name, len(name_at))
            for i in range(max(1, len(ids) - window + 1)):
                owners.setdefault(tuple(ids[i : i + window]), set()).add(at)
        self.names = list(name_at)
        self.length = np.array([len(w) for w in owners], dtype=np.int64)
        self.words = np.zeros((len(owners), window), dtype=np.int64)
        for row, phrase in enumerate(owners):
            self.words[row, window - len(phrase) :] = phrase
        self.owners = [np.array(sorted(o), dtype=np.int64) for o in owners.values()]
        self.shortest = int(self.length.min(initial=window))


def _runs(ids: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of known words of ``shortest`` or more, each followed by 0, and where each word
    stood. ``ids`` is 0 for other words and after each document."""
    known = np.concatenate([[0], (ids > 0).view(np.int8), [0]])
    change = np.diff(known)
    start, stop = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    long = stop - start >= shortest
    start, size = start[long], (stop - start)[long] + 1
    at = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())
    return ids[at], at


def search_shard(texts: list[str], phrases: Phrases) -> list[tuple]:
    """One ``HITS`` row for each text."""
    data = [t.encode().lower() for t in texts]
    words = [WORD.findall(d) for d in data]
    counts = np.array([len(w) for w in words], dtype=np.int64)
    starts = np.cumsum(counts + 1) - counts - 1
    ids = np.zeros(int((counts + 1).sum()) + 1, dtype=np.int32)
    for at, found in zip(starts.tolist(), words):
        ids[at : at + len(found)] = np.fromiter(
            map(phrases.vocabulary.get, found, repeat(0)), dtype=np.int32, count=len(found)
        )
    text, origin = _runs(ids, phrases.shortest)
    cover = np.zeros(len(ids) + 1, dtype=np.int64)
    pairs: list[np.ndarray] = []  # document * windows + window
    if len(text):
        index = FMIndex(text, len(phrases.vocabulary) + 1)
        low, high = index.count(phrases.words, phrases.length)
        number = np.maximum(high - low, 0)
        found = np.flatnonzero(number)
        ends = np.cumsum(number[found])
        at = 0
        while at < len(found):  # about a million places at a time; a phrase is never cut off
            upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + (1 << 20))))
            chosen = found[at:upto]
            size = number[chosen]
            rows = np.repeat(low[chosen] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            window = np.repeat(chosen, size)
            place = origin[index.locate(rows)]
            np.add.at(cover, place, 1)
            np.add.at(cover, place + phrases.length[window], -1)
            document = np.searchsorted(starts, place, side="right") - 1
            pairs.append(np.unique(document * len(phrases.length) + window))
            at = upto
    hit = np.cumsum(cover)[:-1] > 0
    items: dict[int, set[int]] = {}
    for pair in pairs:
        for document, window in zip(*(x.tolist() for x in np.divmod(pair, len(phrases.length)))):
            items.setdefault(document, set()).update(phrases.owners[window].tolist())
    out = []
    for i, (at, number) in enumerate(zip(starts.tolist(), counts.tolist())):
        if i not in items:
            out.append((number, 0, [], []))
            continue
        spans = _spans(texts[i], data[i], hit[at : at + number])
        names = sorted(phrases.names[k] for k in items[i])
        out.append((number, int(hit[at : at + number].sum()), names, spans))
    return out


def _spans(text: str, data: bytes, hit: np.ndarray) -> list[dict]:
    """Runs of hit words, with their places in the text as code points."""
    edge = np.diff(np.concatenate([[0], hit.view(np.int8), [0]]))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
    at = np.array([m.span() for m in WORD.finditer(data)], dtype=np.int64)
    if len(data) == len(text):
        place = at
    else:
        lead = np.cumsum((np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80)
        lead = np.concatenate([[0], lead])
        place = lead[at]
    return [
        {"first_word": a, "last_word": b, "start": int(place[a, 0]), "stop": int(place[b, 1])}
        for a, b in zip(first.tolist(), last.tolist())
    ]


# --- the operator -------------------------------------------------------------------------


def benchmark_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[str, str | None]]]:
    """Items as ``(id, text)`` in blocks of about ``block_bytes``: one for a usual benchmark."""
    total = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = int(total // block_bytes) + 1
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("id"), "text")
    for block in range(blocks):
        yield [tuple(r) for r in items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block).collect()]


def hits(text: Column, blocks: Iterator[list[tuple[str, str | None]]], window: int = WINDOW) -> Column:
    """The ``HITS`` of each text against all blocks. The index is built once for each block."""
    found = [_searcher(Phrases(items, window))(text) for items in blocks]
    return found[0] if len(found) == 1 else F.udf(_merged, HITS)(*found)


def _searcher(phrases: Phrases):
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch]
            rows: list[tuple] = []
            at = 0
            while at < len(texts):
                stop, room = at, SHARD_WORDS * 6
                while stop < len(texts) and (stop == at or room >= len(texts[stop])):
                    room -= len(texts[stop])
                    stop += 1
                rows += search_shard(texts[at:stop], phrases)
                at = stop
            yield pd.DataFrame(rows, columns=["n_words", "n_hit", "items", "spans"])

    search.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(search, HITS)


def _merged(*found):
    """Spans and items of several blocks as one."""
    spans = sorted(tuple(s) for f in found for s in f["spans"])
    merged: list[list[int]] = []
    for span in spans:
        if merged and span[0] <= merged[-1][1] + 1:
            if span[1] > merged[-1][1]:
                merged[-1][1], merged[-1][3] = span[1], span[3]
        else:
            merged.append(list(span))
    return (
        found[0]["n_words"],
        sum(b - a + 1 for a, b, _, _ in merged),
        sorted({i for f in found for i in f["items"]}),
        [tuple(m) for m in merged],
    )


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``items`` (sorted ids) and ``spans`` (runs of hit
    words: their numbers, and their places in the text as code points).

    Null and empty texts have no words and no hits; so have all texts where the benchmark is
    empty. An item without words has no window; items of one id count as one; a null id is ''.
    Repeated documents are searched each; columns of these names are replaced.
    """
    found = with_columns(docs, {"__hits": hits(docs["text"], benchmark_blocks(benchmark, block_bytes), window)})
    fields = {f: F.col(f"__hits.{f}") for f in ("n_words", "n_hit", "items", "spans")}
    return with_columns(found, fields).drop("__hits")


def remove_contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``docs`` with the spans cut out of ``text`` (a line end in their place) and ``n_chars``,
    where there is one, set anew for the texts that changed. Joining what stood around a span
    can make a window anew, so changed texts are searched again until none is hit; with a benchmark
    of several blocks the texts are written between rounds over all of them, until a round changes
    none. Documents of which no word is left go; documents without hits stay as they are, empty
    ones included. Other columns may have any names.
    """
    cleaners = [_cleaner(Phrases(items, window)) for items in benchmark_blocks(benchmark, block_bytes)]
    return shielded(docs, lambda own: _without_spans(own, cleaners), ("doc_id", "text", "n_chars"))


def _without_spans(docs: DataFrame, cleaners: list) -> DataFrame:
    text = F.col("text")
    if len(cleaners) <= 1:
        out = with_columns(docs, {"__clean": cleaners[0](text) if cleaners else text})
    else:
        out = with_columns(docs, {"__clean": text})
        while True:
            after = F.col("__clean")
            for clean in cleaners:
                after = clean(after)
            out = written(out.withColumn("__after", after), "decontamination-round")
            moved = ~F.col("__after").eqNullSafe(F.col("__clean"))
            done = out.where(moved).isEmpty()
            out = with_columns(out, {"__clean": F.col("__after")}).drop("__after")
            if done:
                break
    changed = ~text.eqNullSafe(F.col("__clean"))
    bare = F.regexp_replace(F.col("__clean"), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "")
    out = out.where(~changed | (bare != ""))
    new = {c: F.col(c) for c in docs.columns}
    new["text"] = F.col("__clean")
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(changed, F.char_length("__clean").cast(kind)).otherwise(F.col("n_chars"))
    return out.select(*[c.alias(n) for n, c in new.items()])


def _cleaner(phrases: Phrases):
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            texts = list(batch)
            at = list(range(len(texts)))
            while at:
                again = []
                some = [texts[i] if isinstance(texts[i], str) else "" for i in at]
                start = 0
                while start < len(some):
                    stop, room = start, SHARD_WORDS * 6
                    while stop < len(some) and (stop == start or room >= len(some[stop])):
                        room -= len(some[stop])
                        stop += 1
                    for i, row in zip(range(start, stop), search_shard(some[start:stop], phrases)):
                        if row[3]:
                            texts[at[i]] = _cut(some[i], row[3])
                            again.append(at[i])
                    start = stop
                at = again
            yield pd.Series(texts, dtype=object)

    clean.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    # A filter on the result must not have it computed again.
    return F.pandas_udf(clean, "string").asNondeterministic()


def _cut(text: str, spans: list[dict]) -> str:
    parts, at = [], 0
    for span in spans:
        parts.append(text[at : span["start"]].rstrip(" "))
        at = span["stop"]
    parts.append(text[at:].lstrip(" "))
    return "\n".join(p for p in parts if p)


def digest(items: Column) -> Column:
    return F.sha2(F.concat_ws(",", items).cast("binary"), 256)
