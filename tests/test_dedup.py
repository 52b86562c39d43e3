"""Duplicate handling, brute-force checks, and hot keys under forced shuffle joins."""

from __future__ import annotations

from collections import Counter

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from layerwise.operators import dedup, enrich, merge, selection, transform

pairs = st.lists(
    st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from([1, 2, None])), max_size=25
)
few = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


def frame(spark, data):
    numbered = [(i, a, b) for i, (a, b) in enumerate(data)]
    return spark.createDataFrame(numbered, "i int, a string, b int").repartition(4)


@few
@given(data=pairs)
def test_against_plain_python(spark, data):
    df = frame(spark, data)
    counts = Counter(data)
    seen: set = set()
    first = []
    for i, key in enumerate(data):
        if key not in seen:
            first.append(i)
        seen.add(key)
    keys = ["a", "b"]
    kept = dedup.keep_first(df, keys, ["i"])
    assert sorted(r.i for r in kept.collect()) == first
    assert rows(dedup.keep_first(kept, keys, ["i"])) == rows(kept)
    assert dedup.keep_any(df, keys).count() == len(counts)
    repeats = dedup.mark_repeats(df, keys, "r", "first", ["i"]).filter("r")
    assert sorted(r.i for r in repeats.collect()) == [i for i in range(len(data)) if i not in first]
    every = dedup.mark_repeats(df, keys, "r", "none").filter("r")
    assert sorted(r.i for r in every.collect()) == [i for i, k in enumerate(data) if counts[k] > 1]
    total = dedup.duplicate_count(df, keys).first()
    assert tuple(total) == (len(data), len(counts), len(data) - len(counts))
    key = dedup.candidate_key(df, keys).first()
    nulls = sum(None in k for k in data)
    assert (key.n_null_rows, key.is_key) == (nulls, len(data) == len(counts) and not nulls)
    listed = dedup.duplicate_values(df, keys)
    assert rows(listed) == sorted(("-".join(map(str, k)), n) for k, n in counts.items() if n > 1)


def test_missing_key_column_skips_dedup(spark):
    df = spark.createDataFrame([(1,), (1,)], "a int")
    assert dedup.keep_first(df, ["a", "absent"], ["a"]).count() == 2
    assert dedup.keep_any(df, ["a", "absent"]).count() == 2
    with pytest.raises(ValueError, match="keep"):
        dedup.mark_repeats(df, ["a"], "r", "last", ["a"])


@pytest.fixture
def shuffle_joins(spark):
    """Shuffle joins only, and a skew threshold that small test data can pass."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    }
    before = {key: spark.conf.get(key, None) for key in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def hot_frame(spark, n=60_000):
    """A third of the rows share one key, the others have two rows each."""
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.expr("id div 4")))
    key = F.nullif(key, F.lit(""))  # nullable, as columns of files are
    return spark.range(n).repartition(8).select("id", key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))


def test_hot_key_is_split_when_marking_repeats(spark, shuffle_joins):
    marked = dedup.mark_repeats(hot_frame(spark), ["k"], "r", "first", ["id"])
    assert "skew=true" in final_plan(marked)
    found = Counter((r.k == "hot", r.r) for r in marked.select("k", "r").collect())
    assert found[True, False] == 1 and found[True, True] == 19_999
    assert sum(found.values()) == 60_000


def test_hot_key_is_reduced_before_the_shuffle(spark):
    plan = final_plan(dedup.keep_first(hot_frame(spark), ["k"], ["id"]))
    assert plan.index("row_number(), 1, Final") < plan.index("Exchange") < plan.index("row_number(), 1, Partial")


def test_hot_brand_is_split_beyond_the_broadcast_bound(spark, shuffle_joins, monkeypatch):
    monkeypatch.setattr(enrich, "BROADCAST_MAX_ROWS", 1)
    brands = [("hot", "H"), ("k1", "K"), ("HOT", "H2")]
    out = enrich.enrich_brand(hot_frame(spark), brands, brand="k", code="c")
    plan = final_plan(out)
    assert "BroadcastHashJoin" not in plan
    assert "skew=true" in plan
    assert out.filter("c = 'H2'").count() == 20_000
    assert out.count() == 60_000


def test_brand_lookup_forms(spark):
    data = [("North TV",), ("north-tv",), (" north  tv ",), ("South",), (None,)]
    df = spark.createDataFrame(data, "BRAND string")
    brands = [("North TV", "OLD"), ("north tv", "NT")]
    listed = enrich.enrich_brand(df, brands)
    framed = enrich.enrich_brand(df, enrich.brand_frame(spark, brands))
    assert rows(listed) == rows(framed)
    assert {r.BRAND: r.BRAND_CODE for r in listed.collect()} == {
        "North TV": "NT", "north-tv": "NT", " north  tv ": "NT", "South": "South", None: None,
    }
    exact = enrich.enrich_brand(df, brands, match="exact", fallback=False)
    assert {r.BRAND: r.BRAND_CODE for r in exact.collect()} == {
        "North TV": "OLD", "north-tv": None, " north  tv ": None, "South": None, None: None,
    }
    assert rows(enrich.unmatched_brands(df, brands)) == [("South",), (None,)]
    with pytest.raises(ValueError, match="match"):
        enrich.enrich_brand(df, brands, match="fuzzy")


def test_hot_key_is_split_in_an_update(spark, shuffle_joins):
    target = hot_frame(spark)
    source = target.select("k").distinct().select("k", F.upper("k").alias("pad"))
    out = merge.batch_update(target, source, ["k"])
    assert "skew=true" in final_plan(out)
    assert out.filter("pad = 'HOT'").count() == 20_000 and out.count() == 60_000


def test_hot_key_is_split_in_a_median(spark, shuffle_joins):
    values = hot_frame(spark).select("k", F.col("id").alias("v"), "pad")
    stacked = values.select("k", F.lit(0).alias("__c"), F.col("v").cast("double").alias("__v"), "pad")
    state = selection._start(stacked, ["k", "__c"], 1000)
    assert "skew=true" in final_plan(selection.level(stacked, state, ["k", "__c"]).select("k", "lo", "hi"))
    out = transform.exact_median(values, ["k"], "v", "m", broadcast_groups=0)
    assert out.filter("k = 'hot'").first().m == 29_998.5
