import math
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers_llm import LONG, ODD_TEXTS, no_documents, odd_documents
from pyspark.sql import functions as F

from layerwise.llm import language, toxicity
from layerwise.llm.queries import QUERIES


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 0


# --- language -----------------------------------------------------------------------------


def plain_grams(text):
    """N-grams of 1 to 3 letters of words with a space at each end."""
    words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    counts = Counter()
    padded = f" {' '.join(words)} " if words else ""
    for n in (1, 2, 3):
        for i in range(len(padded) - n + 1):
            gram = padded[i : i + n]
            if n == 3 and gram[1] == " " or not gram.strip():
                continue
            key = 0
            for c in gram:
                key = key << 21 | ord(c)
            counts[key] += 1
    return counts


def plain_ranked(counts, most=language.PROFILE):
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:most]]


def plain_nearest(text, profiles):
    own = plain_ranked(plain_grams(text))
    if not own or not profiles:
        return "und", 0.0
    away = {}
    for name, profile in profiles.items():
        rank = {g: i for i, g in enumerate(profile)}
        away[name] = sum(abs(rank[g] - i) if g in rank else language.PROFILE for i, g in enumerate(own))
    best = min(sorted(away), key=away.get)
    return best, 1 - away[best] / (language.PROFILE * len(own))


def plain_profiles(rows):
    totals = {}
    for doc_id, text, lang in rows:
        if lang is not None and text is not None and not held(doc_id):
            totals.setdefault(lang, Counter()).update(plain_grams(text))
    return {lang: plain_ranked(c) for lang, c in totals.items()}


@pytest.mark.parametrize("text", [t for _, t in ODD_TEXTS if t] + ["a", " a ", "Éa1b", "a-b c", "..a"])
def test_grams(text):
    keys, counts = language.gram_counts(text)
    assert dict(zip(keys.tolist(), counts.tolist())) == dict(plain_grams(text))


def test_language_query(spark, sf_dir):
    """Against a brute-force version, and by its accuracy on the held-out fold."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang").collect()
    got = {r["doc_id"]: tuple(r) for r in QUERIES["op2_language"](spark, sf_dir).collect()}
    profiles = plain_profiles(rows)
    assert len(got) == len(rows)
    for doc_id, text, _ in rows[:80]:
        name, score = plain_nearest(text, profiles)
        assert got[doc_id][:3] == (doc_id, held(doc_id), name) and math.isclose(got[doc_id][3], score, abs_tol=1e-12)
    checked = [(lang, got[i][2]) for i, _, lang in rows if held(i) and lang is not None]
    assert sum(a == b for a, b in checked) >= 0.97 * len(checked)


def test_language_of_odd_documents(spark):
    docs = odd_documents(spark)
    profiles = language.learn(docs)
    rows = docs.select("doc_id", "text", profiles.predict(docs["text"]).alias("p")).select("*", "p.*").collect()
    expected = plain_profiles([(i, t, "x") for i, t in ODD_TEXTS])
    for r in rows:
        name, score = plain_nearest(r["text"], expected)
        assert r["lang_pred"] == name and math.isclose(r["score"], score, abs_tol=1e-12)
    assert {r["lang_pred"] for r in rows if not r["text"] or r["text"].startswith("12345")} == {"und"}
    untaught = language.learn(no_documents(spark))
    found = docs.select(untaught.predict(docs["text"]).alias("p")).select("p.*").distinct().collect()
    assert [tuple(r) for r in found] == [("und", 0.0)]
    assert no_documents(spark).select(profiles.predict(F.col("text"))).collect() == []


def test_long_text_is_read_whole(monkeypatch):
    profiles = language.Profiles.of({"a": plain_ranked(plain_grams("wort und satz")), "b": plain_ranked(plain_grams("zzz"))})
    mixed = LONG + "zzz " * 400_000
    assert profiles.nearest(mixed)[0] == plain_nearest(mixed, {n: plain_ranked(plain_grams(t)) for n, t in (("a", "wort und satz"), ("b", "zzz"))})[0]


# --- toxicity -----------------------------------------------------------------------------


def plain_buckets(text):
    text = f" {text.lower()} "
    out = set()
    for n in toxicity.ORDERS:
        for i in range(len(text) - n + 1):
            value = ord(text[i])
            for c in text[i + 1 : i + n]:
                value = value * 0x100000001B3 % 2**64 ^ ord(c)
            mixed = value * int(toxicity._FACTORS[n]) % 2**64
            out.add(mixed >> (64 - toxicity.BUCKETS.bit_length() + 1))
    return out


def test_features(monkeypatch):
    hasher = toxicity.Hasher()
    for text in ["", "a", "A b", "idiot idiot", "漢字 é", "x" * 50]:
        found = hasher.buckets(text)
        assert set(found.tolist()) == plain_buckets(text) and len(found) == len(set(found.tolist()))
    text = "some words in a row " * 30
    whole = set(hasher.buckets(text).tolist())
    monkeypatch.setattr(toxicity, "_CHUNK", 64)
    assert set(hasher.buckets(text).tolist()) == whole


def test_toxicity_query(spark, sf_dir):
    rows = QUERIES["op1_toxicity"](spark, sf_dir).collect()
    ids = [r["doc_id"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id").collect()]
    assert sorted(r["doc_id"] for r in rows) == sorted(ids)
    for r in rows:
        assert r["held_out"] == held(r["doc_id"]) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)


def toxic_case(spark):
    rng = np.random.default_rng(5)
    plain = ["river", "stone", "cloud", "table", "green", "seven", "window", "paper"]
    rows, labels = [], []
    for i in range(400):
        words = rng.choice(plain, 30).tolist()
        bad = i % 4 == 0
        if bad:
            words[int(rng.integers(30))] = "Grubnak" if i % 8 else "vilzom"
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    return docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"), dict(labels)


def test_toxicity_generalises_to_the_held_out_fold(spark):
    docs, labels, truth = toxic_case(spark)
    model = toxicity.fit(docs, labels)
    scored = docs.select("doc_id", model.score(docs["text"]).alias("s")).collect()
    wrong = [r["doc_id"] for r in scored if held(r["doc_id"]) and (r["s"] >= 0.5) != bool(truth[r["doc_id"]])]
    assert not wrong


def test_held_out_labels_are_never_read(spark):
    docs, labels, _ = toxic_case(spark)
    flipped = labels.withColumn(
        "toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic"))
    )
    a, b = toxicity.fit(docs, labels), toxicity.fit(docs, flipped)
    assert (a.weights == b.weights).all() and a.bias == b.bias


def test_toxicity_of_odd_documents(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame(
        [(1, 1), (1, 0), (2, 0), (None, 1), (5, None), (77, 1)], "doc_id bigint, toxic int"
    )
    for case in (labels, labels.where("false")):
        model = toxicity.fit(docs, case)
        rows = docs.select("text", model.score(docs["text"]).alias("s")).collect()
        assert len(rows) == len(ODD_TEXTS) and all(0 <= r["s"] <= 1 for r in rows)
    assert no_documents(spark).select(model.score(F.col("text"))).collect() == []
    assert toxicity.fit(no_documents(spark), labels).weights.sum() == 0
