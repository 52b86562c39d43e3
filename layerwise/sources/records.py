"""CSV records that span lines and splits, read in parallel.

A line takes the reader from one of two states, outside of quotes or inside, to one of them. A
first pass over the lines composes that of each split and keeps what its first and last records
may leave over; a prefix scan over a file's splits, a few values each, gives the state in which
every split starts. With it a second pass cuts the records that lie within a split, task by task
and without a shuffle, and the rest, one record for a split at most, is put together from what the
first pass kept. A quote opens a field only at its start, so a quote within a field opens nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from layerwise.functions.names import decode_file_name
from layerwise.session import scratch_path

#: Splits whose states are broadcast; with more of them the lines are joined by a shuffle.
BROADCAST_SPLITS = 200_000
_SPLIT = ("file_path", "block")
_PIECES = (
    "file_path string, block bigint, from_outside boolean, from_inside boolean, head string, "
    "all_head boolean, tail_outside string, row_outside bigint, tail_inside string, row_inside bigint"
)


def split_lines(spark: SparkSession, paths: Sequence[str], encoding: str = "UTF-8") -> DataFrame:
    """Lines of files, ended by a line feed alone, with the split they lie in."""
    value = F.col("value")
    if encoding.upper() != "UTF-8":
        value = F.decode(value.cast("binary"), encoding)
    return (
        spark.read.option("lineSep", "\n")
        .text(list(paths))
        .select(
            value.alias("value"),
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_block_start").alias("block"),
        )
    )


class QuoteStates:
    """State after each line, for both states before it."""

    def __init__(self, delimiter: str):
        field = f"(^|{re.escape(delimiter)})"
        self.closed = re.compile(f'{field}"[^"]*(?:""[^"]*)*"(?!")')
        self.open = re.compile(f'{field}"')

    def opens(self, line: str) -> bool:
        """Whether a line that starts outside of quotes ends inside."""
        return self.open.search(self.closed.sub(r"\1", line)) is not None

    def after(self, lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """States (True: inside) after lines that start outside, and after lines that start inside."""
        outside, inside = np.zeros(len(lines), dtype=bool), np.ones(len(lines), dtype=bool)
        quoted = np.flatnonzero(pc.fill_null(pc.match_substring(lines, '"'), False).to_numpy(zero_copy_only=False))
        for at, line in zip(quoted.tolist(), lines.take(pa.array(quoted)).to_pylist()):
            outside[at], inside[at] = self.opens(line), self.opens('"' + line)
        return outside, inside


def states_after(start: bool, outside: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """State after each of the lines in turn. Lines either fix the state, turn it or leave it."""
    at = np.arange(len(outside))
    fixed = np.maximum.accumulate(np.where(outside == inside, at, -1))
    turns = np.cumsum(outside & ~inside)
    before = np.where(fixed >= 0, turns[fixed], 0)
    base = np.where(fixed >= 0, outside[fixed], start)
    return base ^ ((turns - before) % 2 == 1)


class _Track:
    """What one starting state makes of a split: its end state, head and open tail."""

    def __init__(self, inside: bool):
        self.state, self.in_head = inside, inside
        self.head: list[str] = []
        self.tail: list[str] = []
        self.row = 0

    def feed(self, lines: pa.Array, outside: np.ndarray, inside: np.ndarray, first_row: int) -> None:
        after = states_after(self.state, outside, inside)
        closed = np.flatnonzero(~after)
        begin = 0
        if self.in_head:
            stop = int(closed[0]) + 1 if len(closed) else len(lines)
            self.head += lines.slice(0, stop).to_pylist()
            self.in_head, begin = not len(closed), stop
        if len(closed):
            self.tail, begin = [], max(begin, int(closed[-1]) + 1)
            self.row = first_row + begin
        elif not self.tail:
            self.row = first_row + begin
        if after[-1]:
            self.tail += lines.slice(begin).to_pylist()
        self.state = bool(after[-1])


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.Array, int]]:
    """Stretches of a batch within one split: file, block, lines and where they begin."""
    files, blocks = batch.column("file_path").dictionary_encode(), batch.column("block").to_numpy()
    codes = files.indices.to_numpy(zero_copy_only=False)
    new = np.flatnonzero((codes[1:] != codes[:-1]) | (blocks[1:] != blocks[:-1])) + 1
    edges = [0, *new.tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:]):
        if a < b:
            yield files.dictionary[int(codes[a])].as_py(), int(blocks[a]), batch.column("value").slice(a, b - a), a


def split_pieces(lines: DataFrame, delimiter: str) -> DataFrame:
    """For each split: the state it ends in from either start, and from either start the text of the
    record that is open at its end, and of the one that goes on from before it."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states = QuoteStates(delimiter)
        split, row, tracks = None, 0, None

        def done() -> pa.RecordBatch:
            outside, inside = tracks
            return pa.RecordBatch.from_pylist([{
                "file_path": split[0], "block": split[1],
                "from_outside": outside.state, "from_inside": inside.state,
                # nothing ends in the split: its text is not copied
                "head": None if inside.in_head else "\n".join(inside.head), "all_head": inside.in_head,
                "tail_outside": "\n".join(outside.tail) if outside.state else None, "row_outside": outside.row,
                "tail_inside": "\n".join(inside.tail) if inside.state and not inside.in_head else None,
                "row_inside": inside.row,
            }], schema)

        for batch in batches:
            for file, block, values, _ in _runs(batch):
                if split != (file, block):
                    if split:
                        yield done()
                    split, row, tracks = (file, block), 0, (_Track(False), _Track(True))
                values = pc.fill_null(values, "")
                after = states.after(values)
                for track in tracks:
                    track.feed(values, *after, row)
                row += len(values)
        if split:
            yield done()

    texts = {"file_path", "head", "tail_outside", "tail_inside"}
    flags = {"from_outside", "from_inside", "all_head"}
    names = [part.split()[0] for part in _PIECES.split(", ")]
    schema = pa.schema([(n, pa.string() if n in texts else pa.bool_() if n in flags else pa.int64()) for n in names])
    return lines.mapInArrow(scan, _PIECES)


def starting_states(pieces: DataFrame) -> DataFrame:
    """``pieces`` with ``inside``: the state in which each split starts, by a prefix scan over the
    splits of its file. A split's effect is to fix the state, to turn it or to leave it."""
    order = Window.partitionBy("file_path").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    fixes = F.col("from_outside") == F.col("from_inside")
    turns = F.col("from_outside") & ~F.col("from_inside")
    turned = F.coalesce(F.sum(turns.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))
    counted = pieces.withColumn("turned", turned)
    last = F.last(F.when(fixes, F.struct(F.col("from_outside").alias("state"), "turned")), ignorenulls=True).over(before)
    since = F.coalesce(F.max("turned").over(before), F.lit(0)) - F.coalesce(F.col("last.turned"), F.lit(0))
    state = F.coalesce(F.col("last.state"), F.lit(False)).cast("int") + since
    return counted.withColumn("last", last).withColumn("inside", state % 2 == 1).drop("last", "turned")


def _within_splits(lines: DataFrame, delimiter: str) -> DataFrame:
    """``(record, file_path, block, src_row, first)`` of the records that begin and end within a
    split; ``first`` marks a file's first one that is not blank. ``lines`` carry ``inside``, the state in which their split starts."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states = QuoteStates(delimiter)
        split, row, state, held, held_row, skip, headed = None, 0, False, None, 0, False, True
        for batch in batches:
            starts = batch.column("inside")
            for file, block, values, at in _runs(batch):
                if split != (file, block):
                    start = starts[at].as_py()
                    if start is None:
                        raise RuntimeError("the splits of the files changed between two passes")
                    split, row, state, held, skip, headed = (file, block), 0, start, None, start, block > 0
                values = pc.fill_null(values, "")
                after = states_after(state, *states.after(values))
                ends = np.flatnonzero(~after)
                first = 0
                if skip:  # the rest of a record of an earlier split
                    first = int(ends[0]) + 1 if len(ends) else len(values)
                    skip, ends = not len(ends), ends[1:]
                begins = np.append(first, ends[:-1] + 1) if len(ends) else np.empty(0, dtype=np.int64)
                last = int(ends[-1]) + 1 if len(ends) else first
                if len(ends):
                    whole = pa.ListArray.from_arrays(
                        pa.array(np.append(begins, last).astype(np.int32)), values.cast(pa.string())
                    )
                    records = pc.binary_join(whole, "\n")
                    rows = row + begins
                    if held is not None:
                        records = pa.concat_arrays([pa.array([held + "\n" + records[0].as_py()]), records.slice(1)])
                        rows[0], held = held_row, None
                    first_one = np.zeros(len(records), dtype=bool)
                    if not headed:
                        text = np.flatnonzero(pc.not_equal(pc.ascii_trim_whitespace(records), "").to_numpy(zero_copy_only=False))
                        first_one[text[:1]], headed = True, len(text) > 0
                    same = [pa.repeat(file, len(records)), pa.repeat(pa.scalar(block, pa.int64()), len(records))]
                    yield pa.RecordBatch.from_arrays(
                        [records, *same, pa.array(rows, pa.int64()), pa.array(first_one)],
                        names=["record", "file_path", "block", "src_row", "first"],
                    )
                if not skip and last < len(values):
                    rest = "\n".join(values.slice(last).to_pylist())
                    if held is None:
                        held, held_row = rest, row + last
                    else:
                        held += "\n" + rest
                row, state = row + len(values), bool(after[-1])

    return lines.mapInArrow(cut, "record string, file_path string, block bigint, src_row bigint, first boolean")


def _across_splits(states: DataFrame, lines: DataFrame) -> DataFrame:
    """The records that begin in one split and end in a later one, or that the file's end cuts off."""
    inside = F.col("inside")
    tail = F.when(inside, F.col("tail_inside")).otherwise(F.col("tail_outside"))
    row = F.when(inside, F.col("row_inside")).otherwise(F.col("row_outside"))
    # a split in which nothing ends, within a record: its text is all of its lines, read for it alone
    bare = states.where(inside & F.col("all_head")).select(*_SPLIT)
    if bare.isEmpty():
        lines = lines.limit(0)
    numbered = lines.withColumn("at", F.monotonically_increasing_id())
    texts = numbered.join(bare, list(_SPLIT), "left_semi").groupBy(*_SPLIT).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "value"))), lambda s: s["value"]), "\n").alias("bare")
    )
    with_bare = states.join(texts, list(_SPLIT), "left")
    head = F.when(inside, F.coalesce("head", "bare"))
    pieces = with_bare.select(
        *_SPLIT,
        F.explode(F.array(
            F.struct(F.lit(0).alias("place"), head.alias("text"), F.lit(0).cast("bigint").alias("src_row")),
            F.struct(F.lit(1).alias("place"), tail.alias("text"), row.alias("src_row")),
        )).alias("piece"),
    ).select(*_SPLIT, "piece.*").where("text IS NOT NULL")
    order = Window.partitionBy("file_path").orderBy("block", "place")
    number = F.sum(F.col("place")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    parts = F.array_sort(F.collect_list(F.struct("block", "place", "text", "src_row")))
    whole = pieces.withColumn("number", number).groupBy("file_path", "number").agg(parts.alias("parts"))
    return whole.select(
        F.array_join(F.col("parts.text"), "\n").alias("record"),
        "file_path",
        F.col("parts")[0]["block"].alias("block"),
        F.col("parts")[0]["src_row"].alias("src_row"),
        ((F.col("parts")[0]["block"] == 0) & (F.col("parts")[0]["src_row"] == 0)).alias("first"),
    )


def read_records(spark: SparkSession, paths: Sequence[str], delimiter: str, encoding: str = "UTF-8") -> DataFrame:
    """``(record, src_file, src_block, src_row, first)`` of CSV files whose quoted fields may hold
    line ends; ``first`` marks the first record of a file.

    Files are read in splits however long their records are. A record keeps its line ends but for
    a carriage return at its end; a quote left open makes the rest of its file one record. Blank
    records are left out. The three position columns order the records as they stand in the files.
    """
    lines = split_lines(spark, paths, encoding)
    place = scratch_path(spark, "splits")
    split_pieces(lines, delimiter).write.parquet(place)
    pieces = spark.read.schema(_PIECES).parquet(place)
    states = starting_states(pieces)
    starts = states.select(*_SPLIT, "inside")
    if pieces.count() <= BROADCAST_SPLITS:
        begun = lines.join(F.broadcast(starts), list(_SPLIT), "left")
    else:
        numbered = lines.withColumn("at", F.monotonically_increasing_id())
        begun = numbered.join(starts, list(_SPLIT), "left").repartition(*_SPLIT).sortWithinPartitions(*_SPLIT, "at").drop("at")
    records = _within_splits(begun, delimiter).unionByName(_across_splits(states, lines))
    return records.where(F.trim("record") != "").select(
        F.regexp_replace("record", "\r$", "").alias("record"),
        decode_file_name(F.element_at(F.split("file_path", "/"), -1)).alias("src_file"),
        F.col("block").alias("src_block"),
        "src_row",
        "first",
    )
