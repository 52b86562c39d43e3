"""Token counts of flat token files, which hold ids and nothing else.

Files are read in blocks. In each block the end-of-document ids are found by one vectorised
comparison; a prefix scan over the blocks of a file then tells each block how many documents
ended before it and where the last one did, so documents that cross blocks are counted once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from layerwise.session import scratch_path, setting

from .common import by_size, small_batches, written
from .tokens import END_OF_DOCUMENT, encoder

#: Bytes of a block. Blocks hold whole ids.
BLOCK_BYTES = 1 << 18
WIDTH = 2
#: Ids are written in records of about so many bytes, whole documents each, and a file takes so many
#: records: a file is read as one value, so a task that writes more goes on in another piece.
RECORD_BYTES, RECORDS = 1 << 20, 4
_END = END_OF_DOCUMENT.to_bytes(WIDTH, "little")


def _records(texts: Iterator[str], ids) -> Iterator[bytes]:
    """The ids of texts in records of whole documents: an end between two, none after the last."""
    held: list[bytes] = []
    size = 0
    for text in texts:
        data = ids(text).tobytes()
        if held and size + len(data) > RECORD_BYTES:
            yield _END.join(held)
            held, size = [], 0
        held.append(data)
        size += len(data) + WIDTH
    if held:
        yield _END.join(held)


def write_token_files(docs: DataFrame, path: str, tokenizer: str | None = None) -> None:
    """Ids of each text, two bytes each, and the end id after it; flat files with no index, one a
    task or, of a task with many ids, its pieces in order. The end id stands for nothing else
    (``Encoder.flat_ids``). Null and empty texts are an end id alone."""

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        texts = (t for frame in frames for run in by_size(frame["text"], 1 << 20) for t in run)
        for record in _records(texts, encoder(tokenizer).flat_ids):
            yield pd.DataFrame({"value": [record]})

    with small_batches(docs.sparkSession):
        _written_flat(docs.select("text").mapInPandas(encode, "value binary"), path)


def write_named_files(docs: DataFrame, path: str, tokenizer: str | None = None) -> None:
    """As ``write_token_files``, under ``kind=ids``; the task that writes a file also writes one
    of the same part number under ``kind=names``, with a line for each document: its number in
    the task's files and, unless null, its ``doc_id``."""

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lines: list[str] = []
        number = 0

        def texts() -> Iterator[str]:
            nonlocal number
            for frame in frames:
                at = 0
                for run in by_size(frame["text"], 1 << 20):
                    names = frame["doc_id"].iloc[at : at + len(run)]
                    lines.extend(f"{i}\n" if n is None else f"{i} {n}\n" for i, n in enumerate(names, number))
                    at, number = at + len(run), number + len(run)
                    yield from run

        for record in _records(texts(), encoder(tokenizer).flat_ids):
            yield pd.DataFrame({"kind": ["ids", "names"], "value": [record, "".join(lines).encode()]})
            lines.clear()

    # As text: a column of numbers with nulls would reach pandas as floats.
    both = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    # Both files of a task are open at once, so its rows are not sorted by kind.
    with setting(docs.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", "2"), small_batches(docs.sparkSession):
        _written_flat(both.mapInPandas(encode, "kind string, value binary"), path, "kind")


def _written_flat(flat: DataFrame, path: str, *kinds: str) -> None:
    # A binary value goes to a text file as it is; the end id is the end of the line.
    rows = flat.select(*kinds, F.col("value").cast("string").alias("value"))
    writer = rows.write.partitionBy(*kinds).option("lineSep", _END.decode("latin-1"))
    writer.option("maxRecordsPerFile", RECORDS).text(path)


def read_names(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``document`` and ``doc_id`` (text) of ``write_named_files``."""
    lines = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(path)
    # The end id after a run of lines stands before the next line.
    line = F.translate("value", "\0", "").alias("line")
    found = lines.where(F.col("_metadata.file_path").contains("/kind=names/"))
    found = found.select(F.col("_metadata.file_name").alias("file"), line).where("line != ''")
    parts = F.split("line", " ", 2)
    return found.select("file", F.get(parts, 0).cast("bigint").alias("document"), F.get(parts, 1).alias("doc_id"))


def read_blocks(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES, within: str = "") -> DataFrame:
    """``file``, ``block`` and ``ids`` (bytes) of the flat files under ``path`` whose path has
    ``within``. A file is one value of one task; its bytes are cut there, before they reach Python."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where("length > 0")
    files = files.where(F.col("_metadata.file_path").contains(within))
    last = F.floor((F.col("length") - 1) / block_bytes).cast("int")
    cut = F.transform(
        F.sequence(F.lit(0), last), lambda b: F.substring(F.col("content"), b * block_bytes + 1, F.lit(block_bytes))
    )
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(name.alias("file"), F.posexplode(cut).alias("block", "ids"))


def count_tokens(blocks: DataFrame, end: int = END_OF_DOCUMENT, width: int = WIDTH) -> DataFrame:
    """One row a document: ``file``, ``document`` (its number there), ``start`` (ids before it)
    and ``n_tokens`` (its ids, without the end id).

    What follows the last end id of a file is a document without an end (``ended`` false) if it
    has any ids. Files without ids give no rows.
    """
    kind = np.dtype(f"<u{width}")

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [np.flatnonzero(np.frombuffer(bytes(d), dtype=kind) == end) for d in frame["ids"]]
            yield pd.DataFrame(
                {
                    "file": frame["file"],
                    "block": frame["block"],
                    "n_ids": [len(d) // width for d in frame["ids"]],
                    "ends": [f.astype(np.int64) for f in found],
                }
            )

    scanned = blocks.mapInPandas(scan, "file string, block bigint, n_ids bigint, ends array<bigint>")
    with small_batches(blocks.sparkSession, 16):  # else a batch holds the blocks of a whole split
        scanned = written(scanned, "token-ends")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("n_ids").over(before), F.lit(0))
    based = scanned.withColumn("base", base)
    last = F.when(F.size("ends") > 0, F.col("base") + F.element_at("ends", -1) + 1)
    stitched = based.withColumn("last", last).select(
        "file",
        "base",
        "ends",
        F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0)).alias("documents"),
        F.coalesce(F.last("last", ignorenulls=True).over(before), F.lit(0)).alias("open"),
        (F.lead("block").over(Window.partitionBy("file").orderBy("block")).isNull()).alias("closing"),
        (F.col("base") + F.col("n_ids")).alias("upto"),
    )
    ended = F.transform(
        "ends",
        lambda at, i: F.struct(
            (F.col("documents") + i).alias("document"),
            F.when(i == 0, F.col("open")).otherwise(F.col("base") + F.get("ends", i - 1) + 1).alias("start"),
            (F.col("base") + at).alias("stop"),
            F.lit(True).alias("ended"),
        ),
    )
    rest = F.when(F.size("ends") > 0, F.col("base") + F.element_at("ends", -1) + 1).otherwise(F.col("open"))
    tail = F.when(
        F.col("closing") & (rest < F.col("upto")),
        F.array(
            F.struct(
                (F.col("documents") + F.size("ends")).alias("document"),
                rest.alias("start"),
                F.col("upto").alias("stop"),
                F.lit(False).alias("ended"),
            )
        ),
    ).otherwise(F.array().cast("array<struct<document:bigint,start:bigint,stop:bigint,ended:boolean>>"))
    rows = stitched.select("file", F.explode(F.concat(ended, tail)).alias("d"))
    return rows.select(
        "file", "d.document", "d.start", (F.col("d.stop") - F.col("d.start")).alias("n_tokens"), "d.ended"
    )


def document_tokens(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Flat token files of the documents, written to the shared folder, and their counts, each
    with the document's ``doc_id``. Files are numbered by the task that wrote them; the pieces of
    a task count as one file."""
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "token-files")
    write_named_files(docs, path, tokenizer)
    part = F.regexp_extract("file", r"part-(\d+)", 1)
    piece = F.regexp_extract("file", r"[.-]c(\d+)(\.|$)", 1).cast("bigint")
    blocks = read_blocks(spark, path, within="/kind=ids/")
    blocks = blocks.select(part.alias("file"), (F.shiftleft(piece, 32) + F.col("block")).alias("block"), "ids")
    found = count_tokens(blocks).withColumn("file", F.col("file").cast("int"))
    names = read_names(spark, path).withColumn("file", part.cast("int"))
    names = names.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))
    return found.join(names, ["file", "document"], "left").select("doc_id", *found.columns)
