import itertools
import zlib

import numpy as np
import pytest
from helpers_llm import ODD_TEXTS, no_documents, odd_documents

from layerwise.llm.packing import best_fit, fillings, lower_bound, pack, plan_sequences
from layerwise.llm.queries import QUERIES
from layerwise.llm.tokens import encoder


def used(plan):
    return sum(times for _, times in plan)


def check_plan(counts, capacity):
    plan = plan_sequences(counts, capacity)
    placed = np.zeros_like(counts)
    for pattern, times in plan:
        assert sum(pattern) <= capacity and times > 0
        for size in pattern:
            placed[size] += times
    assert (placed == counts).all()
    assert lower_bound(counts, capacity) <= used(plan) <= used(best_fit(counts, capacity))
    return plan


def fewest(sizes, capacity):
    """Bins needed, by trying every assignment in order."""
    best = len(sizes)

    def go(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(sizes):
            best = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= sizes[i] and rooms[k] not in rooms[:k]:
                go(i + 1, rooms[:k] + [rooms[k] - sizes[i]] + rooms[k + 1 :])
        go(i + 1, rooms + [capacity - sizes[i]])

    go(0, [])
    return best


@pytest.mark.parametrize("seed", range(12))
def test_plan_reaches_the_optimum_of_small_cases(seed):
    rng = np.random.default_rng(seed)
    sizes = sorted(rng.integers(3, 16, 11).tolist(), reverse=True)
    plan = check_plan(np.bincount(sizes, minlength=21), 20)
    assert used(plan) == fewest(sizes, 20)


def test_plan_improves_on_best_fit():
    sizes = [6, 6, 6, 5, 5, 5, 4, 4, 4]  # best fit leaves gaps around 6 + 6
    counts = np.bincount(sizes * 7, minlength=16)
    assert used(check_plan(counts, 15)) == 21


@pytest.mark.parametrize("low,high", [(1, 2049), (600, 1000), (1000, 1100), (2048, 2049), (1, 40)])
def test_plan_holds_large_histograms(low, high):
    sizes = np.random.default_rng(3).integers(low, high, 2_000)
    check_plan(np.bincount(sizes, minlength=2049), 2048)
    check_plan(np.bincount(sizes, minlength=2049) * 1_000_000, 2048)


def test_search_is_whole_with_many_lengths():
    sizes = np.random.default_rng(0).lognormal(6.5, 0.7, 300_000).astype(int)
    counts = np.bincount(sizes[(sizes >= 160) & (sizes <= 2048)], minlength=2049)
    assert np.count_nonzero(counts) > 1_500
    assert used(check_plan(counts, 2048)) < used(best_fit(counts, 2048))


def test_plan_of_nothing():
    assert plan_sequences(np.zeros(2049, dtype=int)) == []


def test_fillings_are_undominated():
    counts = np.bincount([3, 3, 4, 5, 7, 9], minlength=11)
    found = list(fillings(counts, 10, 10, 1000))
    assert found[0] in {(7, 3)} and all(sum(f) <= 10 for f in found)
    for chosen in found:  # no length outside fits in the place of a member
        slack = 10 - sum(chosen)
        for size in set(chosen):
            assert not any(counts[new] > chosen.count(new) for new in range(size + 1, size + slack + 1))


def expected_pieces(text, capacity=2048):
    tokenizer = encoder().tokenizer
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
    head = len(ids) % capacity or min(capacity, len(ids))
    cuts = [0, *range(head, len(ids) + 1, capacity)]
    return [
        (k, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes()))
        for k, (a, b) in enumerate(itertools.pairwise(cuts))
    ]


def check_sequences(rows, capacity=2048):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_odd_documents(spark):
    rows = pack(odd_documents(spark)).collect()
    check_sequences(rows)
    got = sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    assert got == sorted((str(i), *p) for i, t in ODD_TEXTS for p in expected_pieces(t))
    assert pack(no_documents(spark)).collect() == []


def test_ids_are_kept_on_request(spark):
    for r in pack(odd_documents(spark), keep_ids=True).collect():
        assert zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]


def test_query_packs_every_document(spark, sf_dir):
    rows = QUERIES["op3_best_fit_packing"](spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    assert got == sorted((i, *p) for i, t in docs for p in expected_pieces(t))
    counts = np.bincount([r["length"] for r in rows], minlength=2049)
    assert check_sequences(rows) <= 1.01 * lower_bound(counts, 2048) + 1


def test_cached_ids_equal_the_tokenizer(spark):
    texts = ["a  b", "a\nb c", " x ", "a\n", "don't  say", "x \n y", "é, è. ,,", "a\0b", "\n\n", "I'll we've", "x　y z"]
    for text in [*texts, *[t for _, t in ODD_TEXTS if t]]:
        ids = np.frombuffer(encoder().ids(text), dtype="<u4").tolist()
        assert ids == encoder().tokenizer.encode(text, add_special_tokens=False).ids
