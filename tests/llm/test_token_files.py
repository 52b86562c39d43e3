import glob

import numpy as np
import pytest
from helpers_llm import LONG, ODD_TEXTS, no_documents, odd_documents
from pyspark.sql import functions as F

from layerwise.llm import materialise, token_files
from layerwise.llm.queries import QUERIES
from layerwise.llm.tokens import encoder


def ids_of(text):
    return encoder().tokenizer.encode(text or "", add_special_tokens=False).ids


def flat(path):
    return [open(f, "rb").read() for f in sorted(glob.glob(f"{path}/part-*"))]


# --- token counts -------------------------------------------------------------------------


def test_files_hold_ids_alone(spark, tmp_path):
    docs = odd_documents(spark, 1)
    token_files.write_token_files(docs, str(tmp_path / "flat"))
    expected = [i for r in docs.collect() for i in [*ids_of(r["text"]), 0]]
    (data,) = [d for d in flat(tmp_path / "flat") if d]
    assert np.frombuffer(data, dtype="<u2").tolist() == expected


@pytest.mark.parametrize("block", [2, 6, 10, 64, 1 << 18])
def test_documents_across_blocks(spark, tmp_path, block):
    files = {
        "part-0": [5, 6, 0, 0, 7, 8, 9, 1, 2, 0, 256, 3],  # an open end; zero bytes within ids
        "part-1": [0],
        "part-2": [4, 4, 4, 4],
        "part-3": [256, 0, 512, 0],
        "part-4": [],
    }
    for name, ids in files.items():
        (tmp_path / name).write_bytes(np.array(ids, dtype="<u2").tobytes())
    got = token_files.count_tokens(token_files.read_blocks(spark, str(tmp_path), block)).collect()
    expected = []
    for name, ids in files.items():
        start, number = 0, 0
        for at, i in enumerate(ids):
            if i == 0:
                expected.append((name, number, start, at - start, True))
                start, number = at + 1, number + 1
        if start < len(ids):
            expected.append((name, number, start, len(ids) - start, False))
    assert sorted(map(tuple, got)) == sorted(expected)


def test_counts_of_odd_documents(spark):
    rows = token_files.document_tokens(odd_documents(spark)).collect()
    # id 0 within a text would end it; no text here has one
    assert sorted(r["n_tokens"] for r in rows) == sorted(len(ids_of(t)) for _, t in ODD_TEXTS)
    assert token_files.document_tokens(no_documents(spark)).collect() == []


def test_count_query(spark, sf_dir):
    rows = QUERIES["op5_token_counts"](spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()
    ids = [[*ids_of(r["text"]), 0] for r in docs]
    counts = [len(part) for doc in ids for part in _split(doc)]
    assert sorted(r["n_tokens"] for r in rows) == sorted(counts) and all(r["ended"] for r in rows)


def _split(doc):
    part = []
    for i in doc:
        if i == 0:
            yield part
            part = []
        else:
            part.append(i)


MARKS = [(11, "Hello world! Fine! ok"), (12, "!"), (None, "a! b"), (13, "!"), (2**53 + 1, "none"), (14, None), (15, "! !\n!")]


def marked_documents(spark, parts=1):
    docs = spark.createDataFrame(MARKS, "doc_id bigint, text string")
    return docs.repartition(parts) if parts > 1 else docs.coalesce(1)


@pytest.mark.parametrize("parts", [1, 3])
def test_an_ordinary_id_zero_ends_no_document(spark, parts):
    assert ids_of("a! b")[1] == 0
    rows = token_files.document_tokens(marked_documents(spark, parts)).collect()
    assert all(r["ended"] for r in rows)
    expected = sorted((str(i), len(ids_of(t))) for i, t in MARKS)
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in rows) == expected
    if parts == 1:
        starts = np.cumsum([0] + [len(ids_of(t)) + 1 for _, t in MARKS])[:-1].tolist()
        assert sorted(r["start"] for r in rows) == starts


def test_doc_ids_of_odd_documents(spark):
    rows = token_files.document_tokens(odd_documents(spark)).collect()
    expected = sorted((str(i), len(ids_of(t))) for i, t in ODD_TEXTS)
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in rows) == expected


def test_flat_ids_are_restored():
    flat_ids = encoder().flat_ids("Hello world! Fine! ok")
    assert 0 not in flat_ids and encoder().restored(flat_ids).tolist() == ids_of("Hello world! Fine! ok")


def test_a_large_task_writes_pieces_that_count_as_one_file(spark, tmp_path, monkeypatch):
    """A token file is read as one value, so none grows with its task's split."""
    monkeypatch.setattr(token_files, "RECORDS", 1)
    monkeypatch.setattr(token_files, "scratch_path", lambda _, name: str(tmp_path / name))
    texts = [t for k in range(12) for t in (LONG + str(k), "", None, f"one {k} more!")]
    docs = spark.createDataFrame([(k if k % 5 else None, t) for k, t in enumerate(texts)], "doc_id int, text string").coalesce(1)
    rows = token_files.document_tokens(docs).orderBy("document").collect()
    sizes = [len(ids_of(t)) for t in texts]
    pieces = [len(open(f, "rb").read()) for f in glob.glob(f"{tmp_path}/token-files/kind=ids/part-*")]
    assert len(pieces) > 2 and max(pieces) <= token_files.RECORD_BYTES and sum(pieces) == 2 * (sum(sizes) + len(sizes))
    starts = np.cumsum([0, *(n + 1 for n in sizes)])[:-1].tolist()
    expected = [(k if k % 5 else None, 0, k, starts[k], sizes[k], True) for k in range(len(texts))]
    assert [tuple(r) for r in rows] == expected


def test_batches_are_small_within_a_block_alone(spark):
    frame = spark.range(100, numPartitions=1).mapInPandas(lambda fs: (f.assign(id=len(f)).head(1) for f in fs), "id bigint")
    with token_files.small_batches(spark, 16):
        within = [r[0] for r in frame.collect()]
    assert max(within) == 16 and sum(within) == 100
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") != "16"


# --- training order -----------------------------------------------------------------------


@pytest.mark.parametrize("size", [1, 2, 3, 5, 64, 1000, 4097])
def test_slots_are_a_permutation(spark, size):
    frame = spark.range(size)
    slots = [r[0] for r in frame.select(materialise.feistel(F.col("id"), size)).collect()]
    assert sorted(slots) == list(range(size))
    other = [r[0] for r in frame.select(materialise.feistel(F.col("id"), size, key=9)).collect()]
    assert size < 64 or (slots != other and slots != list(range(size)))


def check_shards(path, index, length, shard_rows):
    files = flat(path)
    stride = 2 * length + 2
    records = {}
    for shard, data in enumerate(files):
        assert len(data) % stride == 0
        for r in range(len(data) // stride):
            records[(shard, r * stride)] = np.frombuffer(data[r * stride : (r + 1) * stride], dtype="<u2")
    assert set(records) == {(r["shard"], r["offset"]) for r in index}
    assert sorted(r["slot"] for r in index) == list(range(len(index)))
    stream = {}
    for r in index:
        record = records[(r["shard"], r["offset"])]
        assert r["slot"] == r["shard"] * shard_rows + r["offset"] // stride
        assert not record[r["n_ids"] :].any()
        stream[r["number"]] = record[: r["n_ids"]].tolist()
    return [i for n in sorted(stream) for i in stream[n]]


def test_shards_hold_every_id(spark, tmp_path):
    docs = odd_documents(spark, 1)
    path = str(tmp_path / "shards")
    index = materialise.materialise(docs, path, length=64, shard_rows=50).collect()
    assert check_shards(path, index, 64, 50) == [i for r in docs.collect() for i in [*ids_of(r["text"]), 0]]
    assert sum(r["n_ids"] for r in index) == sum(len(ids_of(t)) + 1 for _, t in ODD_TEXTS)


def test_shards_tell_where_documents_end(spark, tmp_path):
    docs = marked_documents(spark)
    path = str(tmp_path / "marks")
    index = materialise.materialise(docs, path, length=4, shard_rows=3).collect()
    stream = check_shards(path, index, 4, 3)
    texts = [encoder().restored(np.array(part, dtype=int)).tolist() for part in _split(stream)]
    assert texts == [ids_of(t) for _, t in MARKS]


def test_no_documents_write_no_record(spark, tmp_path):
    assert materialise.materialise(no_documents(spark), str(tmp_path / "none")).collect() == []
    assert not b"".join(flat(tmp_path / "none"))


def test_order_query(spark, sf_dir):
    index = QUERIES["op8_training_order"](spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()
    assert sum(r["n_ids"] for r in index) == sum(len(ids_of(r["text"])) + 1 for r in docs)
    assert sorted(r["slot"] for r in index) == list(range(len(index)))


def test_texts_encoded_in_one_run():
    texts = ["", "a", "  two", "x\n\ny", "tab\tb", "e  b", "  x", "a 　b", "\0 q", "new\nline end\n", "\n", " ",
             "ü ß. the, end.", "日本 語", "! a ! b", "don't we'll", "x" * 3000]
    coder = encoder()
    for k in range(len(texts)):
        turned = texts[k:] + texts[:k]
        for text, ids in zip(turned, coder.flat_batch(turned)):
            assert np.array_equal(ids, coder.flat_ids(text)), text
    assert coder.flat_batch([]) == []
