"""SimHash near-duplicates, searched in BK-trees.

Fingerprints that differ in ``radius`` bits or fewer agree on some of the blocks into which the
64 bits are cut. For each choice of agreeing blocks, fingerprints with the same value there form
a shard; each shard is searched in a BK-tree: children are keyed by their Hamming distance to the
parent, and a query follows only edges within the radius of its own distance. Trees live in the
tasks of their shards. They are not broadcast: no size bound holds for them. A shard of more than
``most`` fingerprints is cut again by blocks of its other bits, which keeps every link.

Trees return links as components (each fingerprint with the least one it reaches in its shard),
so copies are never spelled out in pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwise.session import local_frame

from .common import by_size, shielded, with_columns, written

WORDS, RADIUS, SEED, BITS = 4, 4, 42, 64
_BIT = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_BLOCK = 1 << 18  # shingles held at a time


# --- fingerprints -------------------------------------------------------------------------


def fingerprint(text: str, words: int = WORDS) -> int:
    """64 majority bits over the shingles' hashes; 0 for a text without words."""
    tokens = text.encode().lower().split()  # on bytes: A-Z only, and the six ASCII spaces
    if not tokens:
        return 0
    joined = memoryview(b" ".join(tokens))
    length = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
    stop = np.cumsum(length + 1) - 1
    start = stop - length
    size = min(words, len(tokens))
    shingles = len(tokens) - size + 1
    tally = np.zeros((8, 256), dtype=np.int64)
    column = np.arange(8, dtype=np.int64) * 256
    digest = xxhash.xxh64_intdigest
    for at in range(0, shingles, _BLOCK):
        first = start[at : min(at + _BLOCK, shingles)].tolist()
        last = stop[at + size - 1 : at + size - 1 + len(first)].tolist()
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(first, last)], dtype="<u8")
        octets = hashes.view(np.uint8).reshape(-1, 8)
        tally += np.bincount((octets + column).ravel(), minlength=2048).reshape(8, 256)
    ones = (tally @ _BIT).ravel()  # of each bit, lowest first
    set_bits = np.packbits(2 * ones > shingles, bitorder="little")
    return int(set_bits.view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``docs`` with ``fp``, the fingerprint as a signed long. Null text: no words, 0."""

    def many(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in texts:
            found = [fingerprint(t, words) for run in by_size(series) for t in run]
            yield pd.Series(np.array(found, dtype=np.uint64).view(np.int64))

    many.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return with_columns(docs, {"fp": F.pandas_udf(many, "bigint")(docs["text"])})


# --- BK-trees -----------------------------------------------------------------------------


class Forest:
    """BK-trees of distinct 64-bit values, one for each shard number, built level by level."""

    def __init__(self, shards: np.ndarray, values: np.ndarray):
        order = np.argsort(shards, kind="stable")
        self.values, self.shards = values[order], shards[order]
        self.order = order
        members = np.arange(len(values))
        groups = self.shards.astype(np.int64)
        keys, nodes = [], []
        _, root = np.unique(groups, return_index=True)
        self.roots = dict(zip(groups[root].tolist(), root.tolist()))
        self.root_of = np.empty(len(values), dtype=np.int64)
        at_root = np.zeros(len(values), dtype=bool)
        at_root[root] = True
        self.root_of[:] = root[np.searchsorted(groups[root], groups)] if len(values) else 0
        parents = self.root_of.copy()
        rest = members[~at_root]
        while len(rest):
            edge = np.bitwise_count(self.values[rest] ^ self.values[parents[rest]]).astype(np.int64)
            key = parents[rest] * (BITS + 1) + edge
            by_key = np.argsort(key, kind="stable")
            rest, key = rest[by_key], key[by_key]
            first = np.ones(len(key), dtype=bool)
            first[1:] = key[1:] != key[:-1]
            child = rest[first]
            keys.append(key[first])
            nodes.append(child)
            parents[rest] = child[np.cumsum(first) - 1]
            rest = rest[~first]
        key = np.concatenate(keys) if keys else np.empty(0, np.int64)
        node = np.concatenate(nodes) if nodes else np.empty(0, np.int64)
        by_key = np.argsort(key, kind="stable")
        self.child_key, self.child = key[by_key], node[by_key]

    def near(self, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, node) within the radius, for queries given as positions in ``values``."""
        query, node = queries, self.root_of[queries]
        while len(query):
            distance = np.bitwise_count(self.values[query] ^ self.values[node]).astype(np.int64)
            hit = distance <= radius
            yield query[hit], node[hit]
            base = node * (BITS + 1)
            low = np.searchsorted(self.child_key, base + np.maximum(distance - radius, 0))
            high = np.searchsorted(self.child_key, base + np.minimum(distance + radius, BITS), "right")
            number = high - low
            some = number > 0
            query, low, number = query[some], low[some], number[some]
            query = np.repeat(query, number)
            step = np.arange(len(query)) - np.repeat(np.cumsum(number) - number, number)
            node = self.child[np.repeat(low, number) + step]

    def components(self, radius: int, block: int = 4096) -> np.ndarray:
        """For each value (in the order given), the position of its component's first one."""
        label = np.arange(len(self.values))
        for at in range(0, len(label), block):
            for query, node in self.near(np.arange(at, min(at + block, len(label))), radius):
                _join(label, query, node)
        out = np.empty(len(label), dtype=np.int64)
        out[self.order] = self.order[label]
        return out


def _join(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Put the two ends of each pair into one component, named by its least position."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


# --- shards -------------------------------------------------------------------------------


def _blocks(bits: list[int], number: int) -> list[list[int]]:
    cut = [round(i * len(bits) / number) for i in range(number + 1)]
    return [bits[a:b] for a, b in zip(cut, cut[1:])]


def _mask(bits: list[int]) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << 64) if value >> 63 else value


def agreeing_masks(bits: list[int], radius: int, blocks: int) -> list[int]:
    """Bit masks of which two values within ``radius`` agree on at least one."""
    cut = _blocks(bits, blocks)
    return [_mask(sorted(sum(chosen, []))) for chosen in combinations(cut, blocks - radius)]


def first_masks(values: int, radius: int, aim: int = 128) -> list[int]:
    """Masks on so many bits that a shard of random values holds about ``aim``, five blocks at
    least."""
    blocks = radius + 1
    while blocks < radius + 4 and values >> int(BITS * (blocks - radius) / blocks) > aim:
        blocks += 1
    return agreeing_masks(list(range(BITS)), radius, blocks)


def _free_bits(mask: int) -> list[int]:
    return [b for b in range(BITS) if not mask >> b & 1]


def shard_links(values: DataFrame, radius: int = RADIUS, most: int = 4096) -> DataFrame:
    """Links ``(fp, low)`` that join the components of distinct values ``fp``."""
    spark = values.sparkSession
    masks = first_masks(values.count(), radius)
    keyed = values.select("fp", F.explode(F.lit(masks)).alias("mask"))
    keyed = keyed.withColumn("value", F.col("fp").bitwiseAND(F.col("mask")))
    settled: list[DataFrame] = []
    while True:
        keyed = written(keyed, "simhash-shards")
        sizes = keyed.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("size"))
        large = written(sizes.where(F.col("size") > most), "simhash-large")
        masks = [r[0] for r in large.select("mask").distinct().collect()]  # of a few given ones
        finer = {m: agreeing_masks(_free_bits(m), radius, radius + 1) for m in masks if len(_free_bits(m)) > radius}
        if not finer:
            settled.append(keyed)
            break
        large = large.where(F.col("mask").isin(list(finer)))
        settled.append(keyed.join(large, ["mask", "value"], "left_anti"))
        rows = [(m, m | s) for m, subs in finer.items() for s in subs]
        table = F.broadcast(local_frame(spark, rows, "mask bigint, next bigint"))  # five a mask
        keyed = (
            keyed.join(large.select("mask", "value"), ["mask", "value"])
            .join(table, "mask")
            .select("fp", F.col("next").alias("mask"), F.col("fp").bitwiseAND(F.col("next")).alias("value"))
            .distinct()
        )
    links = None
    for part in settled:
        found = part.repartition("mask", "value").sortWithinPartitions("mask", "value").mapInPandas(
            _tree_links(radius), "fp bigint, low bigint"
        )
        links = found if links is None else links.unionByName(found)
    return links.distinct()


def _tree_links(radius: int, room: int = 200_000):
    """Whole shards are gathered up to ``room`` values, then searched together."""

    def search(frame: pd.DataFrame) -> pd.DataFrame:
        shards = frame.groupby(["mask", "value"], sort=False).ngroup().to_numpy()
        values = frame["fp"].to_numpy()
        first = Forest(shards, values.view(np.uint64)).components(radius)
        linked = first != np.arange(len(first))
        return pd.DataFrame({"fp": values[linked], "low": values[first[linked]]})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0
        for frame in frames:
            held.append(frame)
            size += len(frame)
            if size < room:
                continue
            every = pd.concat(held, ignore_index=True)
            last = every.iloc[-1]
            open_shard = (every["mask"] == last["mask"]) & (every["value"] == last["value"])
            if not open_shard.all():
                yield search(every[~open_shard].reset_index(drop=True))
                every = every[open_shard]
            held, size = [every], len(every)
        if size:
            yield search(pd.concat(held, ignore_index=True))

    return run


# --- components ---------------------------------------------------------------------------


def connected(links: DataFrame, a: str = "fp", b: str = "low") -> DataFrame:
    """``(node, root)`` for every node of the links: the least node it reaches.

    Alternating star contraction; each round is written, and rounds grow with the logarithm of
    the longest path. Joins are against one row a node; their other side can be split.
    """
    edges = written(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges"
    )
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = _to_least(both, least).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _to_least(large, lower).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(lower.select("u", F.col("m").alias("v")))
        edges = written(small.where("u <> v").distinct(), "edges")
        now = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if now == state:
            break
        state = now
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _to_least(edges: DataFrame, least: DataFrame) -> DataFrame:
    # Null-safe equality keeps the join from reusing the aggregate's partitioning, so that
    # adaptive execution can split a hot node.
    key = least.select(F.col("u").alias("__k"), "m")
    return edges.join(key, F.col("u").eqNullSafe(F.col("__k"))).drop("__k")


def components(docs: DataFrame, radius: int = RADIUS, words: int = WORDS) -> DataFrame:
    """``doc_id``, ``fp``, ``root`` (the least fingerprint of the component) and
    ``component_id`` (its least ``doc_id``) of every row."""
    prints = written(fingerprints(docs.select("doc_id", "text"), words).select("doc_id", "fp"), "fingerprints")
    classes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    roots = connected(shard_links(classes.select("fp"), radius))
    rooted = classes.join(roots, classes["fp"].eqNullSafe(roots["node"]), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    rooted = written(rooted, "rooted")
    low = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    low = low.withColumnRenamed("root", "__r")
    named = written(
        rooted.join(low, F.col("root").eqNullSafe(F.col("__r"))).select(
            F.col("fp").alias("__fp"), "root", "component_id"
        ),
        "components",
    )
    return prints.join(named, prints["fp"].eqNullSafe(named["__fp"])).drop("__fp")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, words: int = WORDS) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id``, the least ``doc_id`` reachable over links.

    Null and empty texts have fingerprint 0 and link like others. Null ids are passed over when
    the least is taken. Equal rows come back once each; other columns are not read. No documents
    give no rows.
    """
    return components(docs, radius, words).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, radius: int = RADIUS, words: int = WORDS) -> DataFrame:
    """``docs`` without all but one document of each component: the one of the least id (null
    ids last), then of the least fingerprint. Where several rows have that id, their fingerprints
    tell which is meant, and of rows alike in both the one of the least hash stays. Other columns
    may have any names.
    """
    return shielded(docs, lambda own: _keep_one(own, radius, words))


def _keep_one(docs: DataFrame, radius: int, words: int) -> DataFrame:
    found = written(components(docs, radius, words), "found")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp"))
    picked = found.groupBy("root").agg(least.alias("p")).select("root", "p.doc_id", "p.fp")
    rows = found.groupBy(F.col("doc_id").alias("__id")).agg(F.count(F.lit(1)).alias("__rows"))
    kept = picked.join(rows, picked["doc_id"].eqNullSafe(rows["__id"])).select(
        F.col("root").alias("__root"), "__id", F.col("fp").alias("__fp"), "__rows"
    )
    kept = written(kept, "kept")
    one = docs.join(kept.where("__rows = 1"), docs["doc_id"].eqNullSafe(F.col("__id"))).select(docs.columns)
    several = kept.where("__rows > 1")
    if several.isEmpty():
        return one
    whole = F.struct(*docs.columns).alias("__row")
    again = docs.select("doc_id", "text", whole).join(
        several.select("__id").distinct(), docs["doc_id"].eqNullSafe(F.col("__id")), "left_semi"
    )
    again = fingerprints(again, words).withColumnRenamed("doc_id", "__doc")
    same = F.col("__doc").eqNullSafe(F.col("__id")) & F.col("fp").eqNullSafe(F.col("__fp"))
    first = again.join(several, same).groupBy("__root").agg(F.min_by("__row", F.xxhash64("__row")).alias("__row"))
    return one.unionByName(first.select("__row.*"))
