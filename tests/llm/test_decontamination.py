import hashlib
import random
import re

import numpy as np
import pytest
from helpers_llm import ODD_TEXTS, no_documents, odd_documents
from pyspark.sql import functions as F

from layerwise.llm import decontamination as D
from layerwise.llm.queries import QUERIES


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain(texts, items, window=10):
    windows = {}
    for name, text in items:
        found = words(text)
        for i in range(max(1, len(found) - window + 1) if found else 0):
            windows.setdefault(tuple(found[i : i + window]), set()).add(name)
    sizes = {len(w) for w in windows}
    out = []
    for text in texts:
        found = words(text)
        hit, names = set(), set()
        for size in sizes:
            for i in range(len(found) - size + 1):
                if (owners := windows.get(tuple(found[i : i + size]))) is not None:
                    names |= owners
                    hit |= set(range(i, i + size))
        out.append((len(found), len(hit), sorted(names)))
    return out


def frame(spark, items):
    return spark.createDataFrame(items, "item_id string, text string")


def random_case(seed):
    rng = random.Random(seed)
    few = ["a", "b", "É", "d1", "x"][: rng.randint(1, 5)]
    texts = [" ".join(rng.choices(few + ["zz"] * rng.randint(0, 2), k=rng.randint(0, 80))) for _ in range(30)]
    items = [(str(i), " ".join(rng.choices(few, k=rng.randint(0, 16)))) for i in range(8)]
    return texts, items


@pytest.mark.parametrize("seed", range(25))
def test_shards_equal_brute_force(seed):
    texts, items = random_case(seed)
    found = D.search_shard(texts, D.Phrases(items, 10))
    assert [f[:3] for f in found] == plain(texts, items)
    for text, (_, n_hit, _, spans) in zip(texts, found):
        assert sum(len(words(text[s["start"] : s["stop"]])) for s in spans) == n_hit


def test_suffix_order_ranks_and_places():
    rng = np.random.default_rng(0)
    text = rng.integers(0, 4, 500)
    text[-1] = 0
    array = D.suffix_array(text)
    ends = np.flatnonzero(text == 0)
    unique = text.astype(int) + len(ends)
    unique[ends] = np.arange(len(ends))
    assert array.tolist() == sorted(range(len(text)), key=lambda i: unique[i:].tolist())
    tree = D.WaveletTree(text.astype(np.int64), 4)
    at = np.arange(501)
    for symbol in range(4):
        ranks = tree.rank(np.full(501, symbol), at)
        assert ranks.tolist() == [int((text[:i] == symbol).sum()) for i in at]
    index = D.FMIndex(text, 4)
    inside = np.flatnonzero(text[array] > 0)
    assert index.locate(inside).tolist() == array[inside].tolist()


def test_blocks_of_a_large_benchmark_add_up(spark):
    texts, items = random_case(3)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    whole = D.find_contamination(docs, frame(spark, items)).orderBy("doc_id").collect()
    cut = D.find_contamination(docs, frame(spark, items), block_bytes=20).orderBy("doc_id").collect()
    assert whole == cut


def test_odd_documents(spark):
    items = [
        ("b", "the cat is on the mat and it was in the house of"),
        (None, "12345"),
        ("a", "漢字"),
        ("e", None),
        ("f", "..."),
        ("b", "avec des mots"),
    ]
    docs = odd_documents(spark)
    found = D.find_contamination(docs, frame(spark, items))
    assert set(docs.columns) <= set(found.columns)
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["items"]) for r in found.collect())
    named = [(n or "", t) for n, t in items]
    expected = plain([t for _, t in ODD_TEXTS], named)
    assert got == sorted((str(i), *e) for (i, _), e in zip(ODD_TEXTS, expected))
    assert {r["n_hit"] for r in D.find_contamination(docs, frame(spark, items).where("false")).collect()} == {0}
    assert D.find_contamination(no_documents(spark), frame(spark, items)).collect() == []


def test_removal_leaves_no_hit(spark):
    passage = " ".join(f"w{i}" for i in range(14))
    texts = [
        (1, f"Before, it was. {passage} After é that."),
        (2, "clean text stays"),
        (3, passage),
        (4, None),
        (5, f"w0 w1 w2 w3 w4 {passage} w5 w6 w7 w8 w9 tail"),  # cutting makes a window anew
    ]
    docs = spark.createDataFrame([(i, t, len(t or "")) for i, t in texts], "doc_id bigint, text string, n_chars int")
    items = frame(spark, [("q", passage)])
    out = D.remove_contamination(docs, items)
    assert out.schema == docs.schema
    rows = {r["doc_id"]: r for r in out.collect()}
    assert set(rows) == {1, 2, 4, 5}
    assert rows[1]["text"] == "Before, it was.\nAfter é that." and rows[1]["n_chars"] == 29
    assert rows[2]["text"] == "clean text stays" and rows[4]["text"] is None and rows[5]["text"] == "tail"
    assert {r["n_hit"] for r in D.find_contamination(out, items).collect()} == {0}


def test_query(spark, sf_dir):
    rows = QUERIES["op4_decontamination"](spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    items = [(str(i), t) for i, t in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    expected = [
        (i, n, hit, len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), hit > 0)
        for (i, _), (n, hit, names) in zip(docs, plain([t for _, t in docs], items))
    ]
    assert sorted(map(tuple, rows)) == sorted(expected)
    assert any(e[5] for e in expected)


@pytest.mark.parametrize("block_bytes", [20, 1 << 20])
def test_windows_within_windows_go_whatever_the_blocks(spark, block_bytes):
    """Cutting an inner window joins an outer one, whose item may lie in another block."""
    words = {k: [f"{k}{i}x" for i in range(10)] for k in "ab"}
    text = list(words["b"])
    for level in range(5):
        outer = words["ab"[level % 2]]
        text = outer[:5] + text + outer[5:]
    rows = [(1, " ".join(text)), (2, "left as it is"), (3, "kept " + " ".join(text) + " too")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    items = frame(spark, [(k, " ".join(w)) for k, w in words.items()])
    found = D.remove_contamination(docs.withColumn("__clean", F.lit("own")).withColumn("__after", F.lit(1)), items, block_bytes=block_bytes)
    assert sorted((r["doc_id"], r["text"].split(), r["__clean"], r["__after"]) for r in found.collect()) == [
        (2, "left as it is".split(), "own", 1), (3, ["kept", "too"], "own", 1),
    ]
