import random

import numpy as np
import pytest
import xxhash
from helpers_llm import ODD_TEXTS, no_documents, odd_documents
from pyspark.sql import functions as F

from layerwise.llm import simhash
from layerwise.llm.queries import QUERIES
from layerwise.session import local_frame


def plain_fingerprint(text, words=4):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    tokens = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in lowered).split(" ") if w]
    if not tokens:
        return 0
    size = min(words, len(tokens))
    hashes = [
        xxhash.xxh64(" ".join(tokens[i : i + size]).encode(), seed=42).intdigest()
        for i in range(len(tokens) - size + 1)
    ]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, radius=4):
    """Least id reachable for each row of (id, fingerprint)."""
    values = sorted({f for _, f in rows})
    group = {f: f for f in values}

    def root(f):
        while group[f] != f:
            f = group[f]
        return f

    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if (a ^ b).bit_count() <= radius:
                group[root(a)] = root(b)
    least = {}
    for i, f in rows:
        if i is not None:
            least[root(f)] = min(least.get(root(f), i), i)
    return {f: least.get(root(f)) for f in values}


def unsigned(value):
    return value % (1 << 64)


def test_fingerprints(spark):
    texts = [t for _, t in ODD_TEXTS[:5]] + ["A b\tC", "é É Z", "a b c d e f g a b c d", " \n "]
    for text in texts:
        assert simhash.fingerprint(text or "") == plain_fingerprint(text)
    frame = spark.createDataFrame([("a b c d",), ("É x y zz",)], "text string")
    for text, native in frame.select("text", F.xxhash64("text")).collect():
        assert simhash.fingerprint(text) == unsigned(native)  # one shingle: its hash


def test_long_texts_go_in_blocks(monkeypatch):
    text = " ".join(random.Random(1).choices("abcdefgh", k=3_000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "_BLOCK", 100)
    assert simhash.fingerprint(text) == whole == plain_fingerprint(text)


@pytest.mark.parametrize("seed", range(5))
def test_trees_find_every_pair(seed):
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 1 << 63, 20, dtype=np.uint64)
    values = np.unique(np.concatenate([c ^ (np.uint64(1) << rng.integers(0, 64, 12).astype(np.uint64)) for c in centres]))
    shards = rng.integers(0, 3, len(values))
    forest = simhash.Forest(shards, values)
    pairs = set()
    for a, b in forest.near(np.arange(len(values)), 3):
        pairs |= set(zip(forest.values[a].tolist(), forest.values[b].tolist()))
    every = [(int(v), int(s)) for v, s in zip(values, shards)]
    assert pairs == {(a, b) for a, s in every for b, t in every if s == t and (a ^ b).bit_count() <= 3}


def clustered_values(count, seed=7):
    rng = random.Random(seed)
    values, centres = set(), [rng.getrandbits(64) for _ in range(6)]
    while len(values) < count:
        value = rng.choice(centres)
        for bit in rng.sample(range(64), rng.randint(0, 7)):
            value ^= 1 << bit
        values.add(value)
    return sorted(values)


@pytest.mark.parametrize("most", [4096, 20])
def test_links_join_all_components(spark, most):
    """Also where crowded shards have to be cut again and again."""
    values = clustered_values(300)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    links = simhash.shard_links(local_frame(spark, signed, "fp bigint"), 4, most)
    roots = {unsigned(n): unsigned(r) for n, r in simhash.connected(links).collect()}
    expected = plain_components([(v, v) for v in values])
    groups, expected_groups = {}, {}
    for v in values:
        groups.setdefault(roots.get(v, v), set()).add(v)
        expected_groups.setdefault(expected[v], set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected_groups.values()))


def test_finer_masks_for_more_values():
    for number in (0, 10, 10**6, 10**8, 10**11):
        masks = simhash.first_masks(number, 4)
        blocks = [m % (1 << 64) for m in masks]
        rng = random.Random(number)
        for _ in range(200):
            difference = sum(1 << b for b in rng.sample(range(64), 4))
            assert any(not difference & m for m in blocks)


def test_odd_documents(spark):
    rows = simhash.near_duplicates(odd_documents(spark)).collect()
    got = sorted((str(r["doc_id"]), unsigned(r["fp"]), str(r["component_id"])) for r in rows)
    prints = [(i, plain_fingerprint(t)) for i, t in ODD_TEXTS]
    least = plain_components(prints)
    assert got == sorted((str(i), f, str(least[f])) for i, f in prints)
    assert simhash.near_duplicates(no_documents(spark)).collect() == []


def test_keep_one(spark):
    docs = odd_documents(spark)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    least = plain_components([(i, plain_fingerprint(t)) for i, t in ODD_TEXTS])
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(
        {f: str(i) for f, i in least.items()}.values()
    )
    bare = spark.createDataFrame(
        [(None, "a b c d e"), (None, "v w x y z"), (None, "v w x y z"), (3, "v w x y z q")], "doc_id bigint, text string"
    )
    assert {tuple(r) for r in simhash.keep_one(bare, radius=0).collect()} == {tuple(r) for r in bare.collect()}
    reused = spark.createDataFrame([(2, "v w x y z"), (2, "a b c d e"), (1, "a b c d e")], "doc_id bigint, text string")
    assert sorted(tuple(r) for r in simhash.keep_one(reused).collect()) == [(1, "a b c d e"), (2, "v w x y z")]
    twins = spark.createDataFrame([(1, "a b c d e"), (1, "a b c d e"), (9, "a b c d e")], "doc_id bigint, text string")
    assert [tuple(r) for r in simhash.keep_one(twins).collect()] == [(1, "a b c d e")]


def test_query(spark, sf_dir):
    rows = QUERIES["op7_simhash"](spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    prints = [(i, simhash.fingerprint(t)) for i, t in docs]
    assert all(f == plain_fingerprint(t) for (_, f), (_, t) in list(zip(prints, docs))[:40])
    least = plain_components(prints)
    assert sorted(map(tuple, rows)) == sorted((i, f"{f:016x}", least[f]) for i, f in prints)
