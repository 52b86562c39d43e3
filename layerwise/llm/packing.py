"""Best-fit packing of token pieces into sequences, by bin completion.

Pieces of one length are alike, so the search works on the histogram of lengths (``capacity``
numbers at most, whatever the corpus): a pattern of lengths that fills a sequence is chosen once
and used as often as its lengths last. Spark then deals the pieces to the patterns by their rank
among the pieces of their length. Nothing else passes through the driver.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import by_size, written
from .tokens import END_OF_DOCUMENT, encoder

CAPACITY = 2048
Pattern = tuple[int, ...]


# --- the search ---------------------------------------------------------------------------


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Sequences needed at least: whole lengths over capacity, and for each small length t the
    large pieces that cannot share a sequence plus what is left of the pieces of t and more."""
    sizes = np.arange(len(counts))
    number = np.concatenate([np.cumsum(counts[::-1])[::-1], [0]])  # of length >= i
    total = np.concatenate([np.cumsum((counts * sizes)[::-1])[::-1], [0]])
    half = capacity // 2
    t = np.arange(half + 1)
    alone = number[np.minimum(capacity - t + 1, len(counts))]
    large = number[half + 1] - alone
    room = large * capacity - (total[half + 1] - total[np.minimum(capacity - t + 1, len(counts))])
    small = total[t] - total[half + 1]
    bound = alone + large + np.maximum(0, -((room - small) // capacity))
    return int(max(bound.max(initial=0), -(-int(total[0]) // capacity)))


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing over the histogram: (pattern, times)."""
    open_bins: dict[int, list[tuple[Pattern, int]]] = {}
    rooms: list[int] = []  # sorted
    done: list[tuple[Pattern, int]] = []

    def put(room: int, pattern: Pattern, times: int) -> None:
        if not room:
            done.append((pattern, times))
            return
        if room not in open_bins:
            open_bins[room] = []
            rooms.insert(bisect_right(rooms, room), room)
        open_bins[room].append((pattern, times))

    for size in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[size])
        while left:
            at = bisect_right(rooms, size - 1)
            if at < len(rooms):
                room = rooms[at]
                pattern, times = open_bins[room].pop()
                if not open_bins[room]:
                    del open_bins[room], rooms[at]
            else:
                room, pattern, times = capacity, (), left
            each = room // size
            used = min(times, left // each)
            if used:
                put(room - each * size, pattern + (size,) * each, used)
                left -= used * each
            elif left:
                put(room - left * size, pattern + (size,) * left, 1)
                used, left = 1, 0
            if room < capacity and times > used:
                put(room, pattern, times - used)
    return done + [b for group in open_bins.values() for b in group]


def fillings(counts: np.ndarray, room: int, most: int, effort: int) -> Iterator[Pattern]:
    """Undominated sets of lengths that fit into ``room``, fullest first.

    A set is dominated if a length outside it could take the place of one or two of its members
    and still fit: then the other set is at least as good. ``most`` sets are returned, and a
    level of waste is left after ``effort`` steps.
    """
    sizes = np.flatnonzero(counts[: room + 1])[::-1].tolist()
    if not sizes:
        yield ()
        return
    rising = sizes[::-1]
    smallest = rising[0]
    budget = [0]

    def search(room: int, limit: int, waste: int, used: Counter) -> Iterator[Pattern]:
        if room <= waste:
            yield ()
            return
        at = bisect_right(rising, min(room, limit)) - 1
        while at >= 0 and budget[0] > 0:
            size = rising[at]
            at -= 1
            budget[0] -= 1
            rest = room - size
            if used[size] >= counts[size] or (rest > waste and rest < smallest):
                continue
            used[size] += 1
            for more in search(rest, size, waste, used):
                yield (size, *more)
            used[size] -= 1

    def dominated(chosen: Pattern, slack: int) -> bool:
        held = Counter(chosen)
        groups = set(chosen)
        groups |= {a + b for i, a in enumerate(chosen) for b in chosen[i + 1 :]}
        for total in groups:
            at = bisect_right(rising, total + slack) - 1
            while at >= 0 and rising[at] >= total:
                new = rising[at]
                at -= 1
                if (new > total or total not in held) and counts[new] > held[new]:
                    return True
        return False

    found = 0
    seen: set[Pattern] = set()
    waste = 0
    while True:
        budget[0] = effort
        for chosen in search(room, room, waste, Counter()):
            slack = room - sum(chosen)
            if chosen in seen:
                continue
            seen.add(chosen)
            if slack and smallest <= slack and any(
                counts[s] > chosen.count(s) for s in rising[: bisect_right(rising, slack)]
            ):
                continue  # not full: something still fits
            if dominated(chosen, slack):
                continue
            found += 1
            yield chosen
            if found >= most:
                return
        if waste >= room:
            break
        waste = min(room, max(1, waste * 4))
    if not found:  # the effort ran out: largest first
        chosen, held = [], Counter()
        for size in sizes:
            while size <= room and held[size] < counts[size]:
                chosen.append(size)
                held[size] += 1
                room -= size
        yield tuple(chosen)


def dive(counts: np.ndarray, capacity: int, effort: int) -> list[tuple[Pattern, int]]:
    """A whole solution by the first filling around the largest piece left, each used as often as
    its lengths last: about as many steps as there are lengths, whatever their counts."""
    left = counts.copy()
    taken: list[tuple[Pattern, int]] = []
    while left.any():
        largest = int(np.flatnonzero(left)[-1])
        left[largest] -= 1
        pattern = (largest, *next(fillings(left, capacity - largest, 1, effort)))
        left[largest] += 1
        need = Counter(pattern)
        times = min(int(left[size]) // number for size, number in need.items())
        for size, number in need.items():
            left[size] -= number * times
        taken.append((pattern, times))
    return taken


def plan_sequences(
    counts: np.ndarray, capacity: int = CAPACITY, nodes: int = 1_500, breadth: int = 3, effort: int = 400
) -> list[tuple[Pattern, int]]:
    """Patterns and how often to use each, for a histogram ``counts[length]``.

    Branch and bound: around the largest piece left, each undominated filling is a branch; a
    branch is cut when the sequences used plus those that its remaining lengths need at least
    are no fewer than the best solution has. The first solutions are best fit and, where that
    misses the lower bound, whole dives of ``effort`` and ten times it, which no number of nodes
    ends; better ones replace them. The search stops when the lower bound is reached or after
    ``nodes`` nodes.
    """
    counts = np.asarray(counts, dtype=np.int64)
    if len(counts) != capacity + 1 or counts[0]:
        raise ValueError("counts needs one number for each length from 1 to the capacity")
    best = best_fit(counts, capacity)
    fewest = sum(times for _, times in best)
    bound = lower_bound(counts, capacity)
    for steps in (effort, 10 * effort):
        if fewest > bound:
            found = dive(counts, capacity, steps)
            used = sum(times for _, times in found)
            if used < fewest:
                fewest, best = used, found
    left = counts.copy()
    sizes = np.arange(capacity + 1)
    remaining, used = int((left * sizes).sum()), 0
    stack: list[dict] = []

    def branch() -> None:
        others = left.copy()
        largest = int(np.flatnonzero(others)[-1])
        others[largest] -= 1
        options = ((largest, *o) for o in fillings(others, capacity - largest, breadth, effort))
        stack.append({"options": options, "taken": None})

    if fewest > bound and remaining:
        branch()
    while stack and nodes > 0 and fewest > bound:
        top = stack[-1]
        if top["taken"]:
            pattern, times = top["taken"]
            for size, number in Counter(pattern).items():
                left[size] += number * times
            remaining += sum(pattern) * times
            used -= times
            top["taken"] = None
        pattern = next(top["options"], None)
        if pattern is None:
            stack.pop()
            continue
        nodes -= 1
        need = Counter(pattern)
        times = min(int(left[size]) // number for size, number in need.items())
        for size, number in need.items():
            left[size] -= number * times
        remaining -= sum(pattern) * times
        used += times
        top["taken"] = (pattern, times)
        if not remaining:
            if used < fewest:
                fewest, best = used, [level["taken"] for level in stack]
        elif used + max(-(-remaining // capacity), int(left[capacity // 2 + 1 :].sum())) < fewest:
            branch()
    return best


# --- the pieces ---------------------------------------------------------------------------


def token_pieces(
    docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, keep_ids: bool = False
) -> DataFrame:
    """Each document's ids and one end id, cut from the end into pieces of ``capacity`` (so only
    the first may be shorter). ``part`` and ``rank`` number the pieces of one length within a
    task. ``ids`` holds four bytes an id where ``keep_ids``."""
    end = np.array([END_OF_DOCUMENT], dtype="<u4").tobytes()
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, rank bigint"

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer).ids
        part = TaskContext.get().partitionId()
        ranks: Counter = Counter()
        for frame in frames:
            at = 0
            for run in by_size(frame["text"]):
                rows = []
                for doc_id, text in zip(frame["doc_id"].iloc[at : at + len(run)], run):
                    ids = encode(text) + end
                    total = len(ids) // 4
                    start, piece = 0, 0
                    stop = total % capacity or min(total, capacity)
                    while start < total:
                        data = ids[4 * start : 4 * stop]
                        size = stop - start
                        row = (doc_id, piece, start, size, zlib.crc32(data), part, ranks[size])
                        rows.append((*row, data) if keep_ids else row)
                        ranks[size] += 1
                        start, stop, piece = stop, stop + capacity, piece + 1
                at += len(run)
                out = pd.DataFrame(rows, columns=[c.split(" ")[0] for c in (schema + ", ids binary" * keep_ids).split(", ")])
                out["doc_id"] = out["doc_id"].astype("Int64")
                yield out

    return docs.select("doc_id", "text").mapInPandas(cut, schema + ", ids binary" * keep_ids)


def pack(
    docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, keep_ids: bool = False, nodes: int = 1_500
) -> DataFrame:
    """Pieces of all documents with ``sequence_id`` and ``offset``; sequences hold ``capacity``
    tokens at most and have no gaps.

    A null or empty text is one piece, the end id. Repeated rows are packed once each; a null
    ``doc_id`` stays null. Columns other than ``doc_id`` and ``text`` are not read. No documents
    give no rows.
    """
    pieces = written(token_pieces(docs, capacity, tokenizer, keep_ids), "pieces")
    tallies = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("here"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = tallies.select(
        "length", "part", F.coalesce(F.sum("here").over(before), F.lit(0)).alias("first")
    )
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, number in tallies.groupBy("length").agg(F.sum("here")).collect():
        counts[length] = number  # at most ``capacity`` rows
    segments = segments_of(plan_sequences(counts, capacity, nodes), capacity)
    ranked = pieces.join(firsts, ["length", "part"])
    place = F.pandas_udf(_placer(segments), "sequence_id bigint, offset bigint")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
    return ranked.withColumn("__place", place("length", F.col("first") + F.col("rank"))).select(
        *columns, "__place.sequence_id", "__place.offset"
    )


def segments_of(plan: list[tuple[Pattern, int]], capacity: int) -> dict[str, np.ndarray]:
    """The plan as ranges of ranks per length: ranks from ``start`` on go to ``sequence``, then
    the next, ``copies`` to each, from ``offset`` on."""
    starts: Counter = Counter()
    rows, sequence = [], 0
    for pattern, times in plan:
        offset = 0
        for size, copies in sorted(Counter(pattern).items(), reverse=True):
            rows.append((size, starts[size], sequence, copies, offset))
            starts[size] += copies * times
            offset += size * copies
        sequence += times
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
    return dict(zip(("size", "start", "sequence", "copies", "offset"), table.T))


def _placer(segments: dict[str, np.ndarray]):
    shift = np.int64(1) << 48
    keys = segments["size"] * shift + segments["start"]

    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        length, rank = length.to_numpy(), rank.to_numpy()
        at = np.searchsorted(keys, length * shift + rank, side="right") - 1
        inside = rank - segments["start"][at]
        copies = segments["copies"][at]
        return pd.DataFrame(
            {
                "sequence_id": segments["sequence"][at] + inside // copies,
                "offset": segments["offset"][at] + inside % copies * length,
            }
        )

    return place
