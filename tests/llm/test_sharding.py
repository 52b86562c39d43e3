import zlib

from helpers_llm import ODD_TEXTS, no_documents, odd_documents
from pyspark.sql import functions as F

from layerwise.llm.queries import QUERIES
from layerwise.llm.sharding import looked_up, range_of, shard_by_bytes, write_shards


def check_law(rows, shards):
    total = sum(r["size"] for r in rows)
    largest = max(r["size"] for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r)
    assert set(by) <= set(range(shards))
    for held in by.values():
        assert sorted(r["slot"] for r in held) == list(range(len(held)))
    for shard in range(shards):
        held = sum(r["size"] for r in by.get(shard, []))
        assert abs(held - total / shards) <= largest


def test_query(spark, sf_dir):
    frame = QUERIES["op6_sharding"](spark, sf_dir)
    plan = frame._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    rows = frame.collect()
    check_law(rows, 40)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = sorted((r["doc_id"], r["size"], r["text_crc32"], r["law"], r["grown_shard"]) for r in rows)
    assert got == sorted((i, len(t.encode()) + 16, zlib.crc32(t.encode()), "bytes", None) for i, t in docs)


def test_hot_key_is_parted(spark):
    """A third of all rows have one text: they are spread, and stand together."""
    docs = spark.range(6_000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "the same text again").otherwise(F.concat(F.lit("t"), F.col("id"))).alias("text"),
    )
    rows = shard_by_bytes(docs, 12).collect()
    check_law(rows, 12)
    hot = {r["shard"] for r in rows if r["doc_id"] % 3 == 0}
    assert 4 <= len(hot) <= 9 and max(hot) - min(hot) == len(hot) - 1
    cold = [r["shard"] for r in shard_by_bytes(docs.where("doc_id % 3 = 1 or doc_id < 30"), 12).collect() if r["doc_id"] % 3 == 0]
    assert len(set(cold)) <= 2


def test_odd_documents(spark):
    docs = odd_documents(spark)
    out = shard_by_bytes(docs, 3)
    assert [c for c in out.columns if c.lower() == "shard"] == ["shard"]
    rows = out.collect()
    check_law(rows, 3)
    assert sorted(r["size"] for r in rows) == sorted(len((t or "").encode()) + 16 for _, t in ODD_TEXTS)
    assert sorted(str(r["text"]) for r in rows) == sorted(str(t) for _, t in ODD_TEXTS)
    assert shard_by_bytes(no_documents(spark)).collect() == []


def test_one_shard_and_more_shards_than_rows(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id bigint, text string")
    assert {r["shard"] for r in shard_by_bytes(docs, 1).collect()} == {0}
    assert sorted(r["slot"] for r in shard_by_bytes(docs, 50).collect()) == [0, 0]


def test_lookups(spark):
    cuts = [-5, 0, 7, 7 << 40]
    values = {k: k * 3 for k in cuts}
    probe = spark.createDataFrame([(v,) for v in (-6, -5, -1, 0, 6, 7, 8, 7 << 40, 1 << 60)], "v bigint")
    for v, at, found in probe.select("v", range_of(F.col("v"), cuts), looked_up(values, F.col("v"))).collect():
        assert at == sum(c <= v for c in cuts) and found == values.get(v)


def test_written_shards(spark, tmp_path):
    write_shards(odd_documents(spark), str(tmp_path / "out"), 3)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(ODD_TEXTS) and {r[0] for r in back.select("shard").distinct().collect()} <= {0, 1, 2}
