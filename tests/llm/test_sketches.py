import hashlib
import math

import numpy as np
import pytest
from helpers_llm import ODD_TEXTS, no_documents, odd_documents

from layerwise.llm import sketches
from layerwise.llm.queries import QUERIES


def plain_likeness(a, b):
    one, two = set(sketches.digests(a).tolist()), set(sketches.digests(b).tolist())
    every = len(one) + len(two)
    return 1.0 if not every else 1 - len(one ^ two) / every


def plain_rows(docs):
    """Brute force: the next document, the edited text and set differences."""
    docs = sorted(docs, key=lambda d: (d[0] is None, -(d[0] or 0), d[1] or ""))
    texts = [t or "" for _, t in docs]
    out = []
    for k, (doc_id, _) in enumerate(docs):
        text, after = texts[k], texts[(k + 1) % len(texts)]
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        out.append(
            (str(doc_id), len(text), hashlib.sha256(changed.encode()).hexdigest(), plain_likeness(text, changed), plain_likeness(text, after))
        )
    return sorted(out)


def check(rows, docs):
    got = sorted((str(r["doc_id"]), r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"]) for r in rows)
    expected = plain_rows(docs)
    assert [g[:3] for g in got] == [e[:3] for e in expected]
    for g, e in zip(got, expected):
        assert math.isclose(g[3], e[3], abs_tol=1e-9) and math.isclose(g[4], e[4], abs_tol=1e-9)


@pytest.mark.parametrize("different", [0, 1, 3, 40, 3000])
def test_differences_are_recovered(different):
    rng = np.random.default_rng(different)
    common = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
    left = [np.unique(np.concatenate([common, rng.integers(0, 1 << 63, different, dtype=np.uint64)])) for _ in range(3)]
    right = [np.unique(np.concatenate([common, rng.integers(0, 1 << 63, different // 2, dtype=np.uint64)])) for _ in range(3)]
    for a, b, (only_a, only_b) in zip(left, right, sketches.differences(left, right)):
        assert sorted(only_a.tolist()) == sorted(set(a.tolist()) - set(b.tolist()))
        assert sorted(only_b.tolist()) == sorted(set(b.tolist()) - set(a.tolist()))


def test_empty_sets():
    none = np.empty(0, dtype=np.uint64)
    assert [tuple(map(len, d)) for d in sketches.differences([none], [none])] == [(0, 0)]
    assert sketches.likeness((0, 0), (none, none)) == 1.0
    assert sketches.differences([], []) == []


def test_repeated_paragraphs_count():
    assert len(sketches.digests("same line\nsame line\nsame line")) == 3
    assert plain_likeness("a\na\na", "a") == 0.5


def test_odd_documents(spark):
    rows = sketches.compare_versions(odd_documents(spark)).collect()
    check(rows, ODD_TEXTS)
    by_text = {}
    for r in rows:
        by_text.setdefault((r["n_chars"], r["fingerprint"]), r)
    same = [r["fingerprint"] for r in rows if r["doc_id"] in (1, 2)]
    assert len(set(same)) == 1 and len({r["fingerprint"] for r in rows}) >= 5
    assert sketches.compare_versions(no_documents(spark)).collect() == []


def test_one_document_is_its_own_next(spark):
    docs = [(4, "abc def")]
    check(sketches.compare_versions(spark.createDataFrame(docs, "doc_id bigint, text string")).collect(), docs)


def test_many_ranges(spark, monkeypatch):
    """Ranges meet: each last row is compared with the first one of the next range."""
    monkeypatch.setattr(sketches, "RANGE_ROWS", 7)
    docs = [(i * i % 1009, f"line {i}\nother {i % 5}. more words here {i % 3}") for i in range(150)]
    check(sketches.compare_versions(spark.createDataFrame(docs, "doc_id bigint, text string")).collect(), docs)


def test_query(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    check(QUERIES["op9_fingerprints"](spark, sf_dir).collect(), docs)
