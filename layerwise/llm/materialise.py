"""Training order and fixed-stride token shards.

Every sequence of token ids gets a global slot by a keyed permutation: a Feistel network over the
least number of bits that holds all numbers, walked until the number is in range. Range
partitions of slots are written as one flat file each, all records of one stride, so a reader
goes on from any slot by a seek, and a shuffle is done again by the same key.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerwise.session import scratch_path

from .common import by_size, written
from .tokens import END_OF_DOCUMENT, encoder

LENGTH = 1024
KEY = 20_240_607
ROUNDS = 4
#: Sequences of one shard, written by one task: 64 MiB of two-byte ids.
SHARD_ROWS = 1 << 15
#: Sequences that are compressed together, and ids a task holds while it deals them to shards.
BLOCK_ROWS = 128
HELD_IDS = 1 << 25
#: Characters of text encoded together.
RUN = 1 << 21
#: Steps of cycle walking.
WALK = 64
#: Two bytes of zeros end each record: the end-of-document id.
RECORD_END = "\0\0"


# --- the permutation ----------------------------------------------------------------------


def feistel(number: Column, size: int, key: int = KEY, rounds: int = ROUNDS) -> Column:
    """A keyed permutation of 0 .. size-1, as a Column.

    The two parts of a number change in turn by a hash of the other one. Numbers out of range are
    permuted again. At least half of the domain is in range (for sizes over 2), so a walk of
    ``WALK`` steps that stays outside has a chance of 2 to the -64; it would show as a slot that
    is not below ``size``.
    """
    bits = max(2, (size - 1).bit_length())
    low = bits // 2
    low_mask, high_mask = (1 << low) - 1, (1 << (bits - low)) - 1

    def once(value: Column) -> Column:
        left, right = F.shiftrightunsigned(value, low), value.bitwiseAND(F.lit(low_mask))
        for turn in range(rounds):
            if turn % 2:
                right = right.bitwiseXOR(F.xxhash64(left, F.lit(key), F.lit(turn)).bitwiseAND(F.lit(low_mask)))
            else:
                left = left.bitwiseXOR(F.xxhash64(right, F.lit(key), F.lit(turn)).bitwiseAND(F.lit(high_mask)))
        return F.shiftleft(left, low).bitwiseOR(right)

    steps = F.lit(list(range(WALK)))
    return F.aggregate(steps, once(number.cast("bigint")), lambda v, _: F.when(v >= size, once(v)).otherwise(v))


# --- sequences ----------------------------------------------------------------------------


def token_blocks(docs: DataFrame, length: int = LENGTH, tokenizer: str | None = None) -> DataFrame:
    """Documents' ids as flat files hold them (``Encoder.flat_ids``), each document ended by the
    end id, which no text has then, one after another in a task and cut every ``length`` ids; what
    is left at the end of a task is a shorter sequence.

    A row is a block of up to ``BLOCK_ROWS`` sequences, the ``row``-th of task ``part`` and on:
    for each its ids' number and CRC and the documents it begins and ends in, and the ids of all,
    two bytes little-endian, compressed together.
    """
    schema = (
        "part int, row bigint, n_ids array<int>, ids_crc32 array<bigint>, first_doc array<bigint>,"
        " last_doc array<bigint>, ids binary"
    )

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer).flat_batch
        squeeze = zstandard.ZstdCompressor(level=3).compress
        part = TaskContext.get().partitionId()
        open_ids, first, last, row = np.empty(0, dtype="<u2"), None, None, 0
        end = np.full(1, END_OF_DOCUMENT, dtype="<u2")
        held: list[tuple] = []

        def block() -> pd.DataFrame:
            nonlocal held, row
            sizes, crcs, firsts, lasts, data = (list(c) for c in zip(*held))
            out = pd.DataFrame(
                {
                    "part": [part],
                    "row": [row],
                    "n_ids": [sizes],
                    "ids_crc32": [crcs],
                    "first_doc": [firsts],
                    "last_doc": [lasts],
                    "ids": [squeeze(b"".join(data))],
                }
            )
            row += len(held)
            held = []
            return out

        def hold(ids: np.ndarray) -> None:
            raw = ids.tobytes()
            held.append((len(ids), zlib.crc32(raw), first, last, raw))

        for frame in frames:
            texts = (ids for run in by_size(frame["text"], RUN) for ids in encode(run))
            for doc_id, ids in zip(frame["doc_id"], texts):
                doc_id = None if pd.isna(doc_id) else int(doc_id)
                first = doc_id if not len(open_ids) else first
                last = doc_id
                ids = np.concatenate([open_ids, ids, end])
                whole = len(ids) // length * length
                for start in range(0, whole, length):
                    hold(ids[start : start + length])
                    first = doc_id
                    if len(held) == BLOCK_ROWS:
                        yield block()
                open_ids = ids[whole:]
        if len(open_ids):
            hold(open_ids)
        if held:
            yield block()

    return docs.select("doc_id", "text").mapInPandas(cut, schema)


def numbered(blocks: DataFrame) -> DataFrame:
    """Blocks with ``number``, that of their first sequence among all, by task and row."""
    tallies = blocks.groupBy("part").agg(F.sum(F.size("n_ids")).alias("here"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row a task of the scan: few enough for one window and a broadcast.
    firsts = tallies.select("part", F.coalesce(F.sum("here").over(before), F.lit(0)).alias("first"))
    return blocks.join(F.broadcast(firsts), "part").withColumn("number", F.col("first") + F.col("row"))


def _dealt(length: int, shard_rows: int):
    """Sequences of blocks dealt to shards: blocks of their records, compressed again."""

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        restore, squeeze = zstandard.ZstdDecompressor().decompress, zstandard.ZstdCompressor(level=3).compress
        held: dict[int, list[tuple[int, np.ndarray]]] = {}
        size = 0

        def emit(shards: list[int]) -> pd.DataFrame:
            nonlocal size
            rows = []
            for shard in shards:
                own = held.pop(shard)
                size -= len(own)
                for at in range(0, len(own), BLOCK_ROWS):
                    some = own[at : at + BLOCK_ROWS]
                    records = np.array([r for r, _ in some], dtype="<i4").tobytes()
                    rows.append((shard, records, squeeze(np.stack([d for _, d in some]).tobytes())))
            return pd.DataFrame(rows, columns=["shard", "records", "ids"])

        for frame in frames:
            for sizes, slots, data in zip(frame["n_ids"], frame["slots"], frame["ids"]):
                flat = np.frombuffer(restore(bytes(data)), dtype="<u2")
                ends = np.cumsum(sizes)
                for n, end, slot in zip(sizes, ends, slots):
                    record = np.zeros(length, dtype="<u2")
                    record[:n] = flat[end - n : end]
                    held.setdefault(int(slot) // shard_rows, []).append((int(slot) % shard_rows, record))
                    size += 1
                full = [shard for shard, own in held.items() if len(own) >= BLOCK_ROWS]
                if full:
                    yield emit(full)
                if size * length > HELD_IDS:
                    yield emit(list(held))
        if held:
            yield emit(list(held))

    return deal


def _in_order(length: int, piece: int = 256):
    """All records of one shard, put in their places; the last end id of a piece is left to the
    writer's line end."""

    def gather(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        restore = zstandard.ZstdDecompressor().decompress
        held = [
            (np.frombuffer(bytes(r), dtype="<i4"), bytes(d))
            for frame in frames
            for r, d in zip(frame["records"], frame["ids"])
        ]
        if not held:
            return
        shard = np.zeros((sum(len(r) for r, _ in held), length + 1), dtype="<u2")
        for records, data in held:
            shard[records, :length] = np.frombuffer(restore(data), dtype="<u2").reshape(-1, length)
        for at in range(0, len(shard), piece):
            yield pd.DataFrame({"value": [shard[at : at + piece].tobytes()[: -len(RECORD_END)]]})

    return gather


def materialise(
    docs: DataFrame,
    path: str,
    length: int = LENGTH,
    key: int = KEY,
    shard_rows: int = SHARD_ROWS,
    tokenizer: str | None = None,
) -> DataFrame:
    """Write the shards under ``path``, one flat file each, named by its number, and return the
    index: one row a sequence, without its ids.

    A record is ``length`` ids, padded with the end id, and one more end id: ``2 * length + 2``
    bytes. An end id that a further id follows ends a document there and nothing else, as id 0 of
    a text is stored as another value (``Encoder.flat_ids``); ``n_ids`` tells the padding. So record r of shard s begins at byte ``r * (2 * length + 2)`` of its file, in the
    order of slots. A task writes a shard, which it holds in memory: ``shard_rows`` bounds it.
    Null and empty texts are an end id. Repeated rows are written each. Columns other than
    ``doc_id`` and ``text`` are not read. No documents write no record.
    """
    blocks = written(token_blocks(docs, length, tokenizer), "sequences", "none")
    size = blocks.agg(F.coalesce(F.sum(F.size("n_ids")), F.lit(0))).first()[0]
    placed = numbered(blocks).withColumn(
        "slots",
        F.transform(F.sequence(F.lit(0), F.size("n_ids") - 1), lambda i: feistel(F.col("number") + i, max(1, size), key)),
    )
    out_of_range = F.exists("slots", lambda slot: slot >= size)
    if placed.where(out_of_range).limit(1).count():
        raise RuntimeError("a walk did not come in range; choose another key")
    shards = max(1, -(-size // shard_rows))
    # Partition i holds the slots of shard i, and becomes the file part-0000i. A binary value goes
    # to a text file as it is; the end of a record is the end of a line.
    flat = (
        placed.select("n_ids", "slots", "ids")
        .mapInPandas(_dealt(length, shard_rows), "shard int, records binary, ids binary")
        .repartitionById(shards, F.col("shard"))
        .mapInPandas(_in_order(length), "value binary")
    )
    flat.select(F.col("value").cast("string").alias("value")).write.option("lineSep", RECORD_END).text(path)
    columns = ["slots", "n_ids", "ids_crc32", "first_doc", "last_doc"]
    each = placed.select("number", F.posexplode(F.arrays_zip(*columns)).alias("at", "s"))
    slot = F.col("s.slots")
    return each.select(
        slot.alias("slot"),
        F.floor(slot / shard_rows).cast("int").alias("shard"),
        (slot % shard_rows * (2 * length + len(RECORD_END))).alias("offset"),
        (F.col("number") + F.col("at")).alias("number"),
        "s.first_doc",
        "s.last_doc",
        "s.n_ids",
        "s.ids_crc32",
    )


def training_order(docs: DataFrame, name: str = "token-shards", **options) -> DataFrame:
    """``materialise`` into a new place in the shared folder."""
    return materialise(docs, scratch_path(docs.sparkSession, name), **options)
