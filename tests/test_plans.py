"""Physical plans: pruning, pushdown, partial aggregation, and no Python workers."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from layerwise import testbed as tb
from layerwise.operators import dedup, report
from layerwise.operators.rules import parse_rules
from layerwise.queries import QUERIES
from layerwise.session import build_session, scratch_path
from layerwise.sources import landing, layers


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_workers_and_no_products(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for word in ("Python", "Pandas", "ExistingRDD", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan


def test_gold_log_is_two_hash_aggregates(spark, sf_dir):
    plan = plan_of(QUERIES["gold_log"](spark, sf_dir))
    body = plan[: plan.index("BroadcastExchange")]
    assert body.count("HashAggregate") == 4 and "Sort" not in body and "Window" not in body
    assert body.count("Exchange hashpartitioning") == 2
    assert "min_by" in body and "user_ref" not in body


def test_gold_log_in_the_order_of_the_flow_does_not_sort(spark, sf_dir):
    rows = tb.dirty_events(spark, sf_dir).select(
        "*", F.concat(F.lit("f "), F.col("event_id") % 7).alias("src_file"),
        (F.col("event_id") % 3 * 1000).cast("bigint").alias("src_block"), F.col("event_id").cast("bigint").alias("src_row"),
    )
    placed, order = landing.with_packed_position(rows)
    rules = parse_rules(tb.RULES, "Events")
    packed, plain = (report.gold_log(df, rules, ["brand"], ["user_id"], by) for df, by in ((placed, order), (rows, landing.POSITION)))
    assert "SortAggregate" in plan_of(plain) and "SortAggregate" not in plan_of(packed)
    assert sorted(packed.collect()) == sorted(plain.collect())
    kept = placed.orderBy(order).select("event_id").limit(500).collect()
    assert kept == rows.orderBy(*landing.POSITION).select("event_id").limit(500).collect()
    assert landing.with_packed_position(rows, most_files=3) == (rows, list(landing.POSITION))


def test_uniqueness_in_the_log_scans_once(spark, sf_dir):
    plan = plan_of(QUERIES["gold_log_uniqueness"](spark, sf_dir))
    assert plan.count("FileScan") == 1 and "Join" not in plan and "Window" not in plan


def test_row_counts_come_from_footers(spark, sf_dir):
    plan = plan_of(QUERIES["row_counts"](spark, sf_dir))
    assert plan.count("PushedAggregation: [COUNT(*)]") == len(tb.TABLES)


def test_date_range_is_pushed_down(spark, sf_dir):
    scan = plan_of(QUERIES["scan_date_partition"](spark, sf_dir))
    assert "IsNotNull(event_type), GreaterThanOrEqual(ts" in scan
    assert "props" not in scan


def test_partitions_are_pruned(spark, sf_dir):
    root = scratch_path(spark, "pruning")
    df = tb.dirty_events(spark, sf_dir).withColumn(layers.PART_DATE, F.col("filedate"))
    assert layers.write_partitioned(df, f"{root}/Events", [layers.PART_DATE]) == df.count()
    pruned = layers.read_layer(spark, root, "Events").filter("part_date = '20240105'")
    assert "PartitionFilters: [isnotnull(part_date" in plan_of(pruned)
    one = layers.read_layer(spark, root, "Events", "20240105")
    assert one.select("event_id").exceptAll(pruned.select("event_id")).isEmpty()
    assert one.count() == pruned.count() > 0


def test_rewriting_a_partition_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "T")
    data = spark.createDataFrame([("1", 1), ("2", 2), ("2", 3)], "part_date string, v int")
    layers.write_partitioned(data, path, ["part_date"])
    assert layers.write_partitioned(data.filter("v = 2"), path, ["part_date"]) == 1
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 2]


def test_empty_writes_return_zero(spark, tmp_path):
    empty = spark.range(10).select(F.lit("1").alias("part_date"), "id").filter("id > 100")
    assert layers.write_partitioned(empty, str(tmp_path / "T"), ["part_date"]) == 0
    spark.sql("DROP TABLE IF EXISTS empty_target")
    assert layers.load_table(empty.drop("part_date"), "empty_target", "20250416") == 0
    assert layers.load_table(empty.drop("part_date").limit(0), "empty_target", "20250416") == 0
    assert layers.load_table(spark.range(3), "empty_target", "20250416") == 3
    assert layers.load_table(spark.range(4), "empty_target", "20250417") == 4
    assert layers.load_table(spark.range(2), "empty_target", "20250416") == 2
    assert spark.table("empty_target").count() == 6
    spark.sql("DROP TABLE IF EXISTS plain_target")
    spark.range(1).write.saveAsTable("plain_target")
    assert layers.load_table(spark.range(2), "plain_target", "20250416") == 2
    assert spark.table("plain_target").count() == 3


def test_rebalance_before_the_write(spark):
    df = spark.range(10).withColumn("part_date", F.lit("x")).hint("rebalance", F.col("part_date"))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan_of(df)


def test_limits_are_kept_in_map_tasks(spark, sf_dir):
    plan = plan_of(QUERIES["error_rows_top100"](spark, sf_dir))
    assert "row_number(), 100, Partial" in plan and "row_number(), 100, Final" in plan


def test_dedup_reads_only_what_it_returns(spark, sf_dir):
    df = dedup.keep_first(tb.load(spark, sf_dir, "orders"), ["o_orderkey"], ["o_orderdate"])
    plan = plan_of(df.select("o_orderkey", "o_orderdate"))
    assert "o_totalprice" not in plan


def test_file_inventory_does_not_read_contents(spark, sf_dir):
    from layerwise.sources.landing import file_inventory

    df = file_inventory(spark, sf_dir, "*.parquet")
    assert df.filter("file_size > 0").count() == len(tb.TABLES)
    assert "content" not in plan_of(df).replace("binaryFile", "")


def test_scratch_needs_a_shared_folder_on_a_cluster(spark):
    path = scratch_path(spark, "x")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir", path))
    assert build_session() is spark or build_session().sparkContext is spark.sparkContext


def test_file_row_counts_name_each_given_file_once(spark, sf_dir, tmp_path):
    # documents as a directory of two parts, labels empty: one row each, as the SQL counts them
    for t in tb.TABLES:
        os.symlink(f"{sf_dir}/{t}.parquet", tmp_path / f"{t}.parquet")
    os.unlink(tmp_path / "documents.parquet")
    os.unlink(tmp_path / "labels.parquet")
    docs = tb.load(spark, sf_dir, "documents")
    docs.repartition(2).write.parquet(str(tmp_path / "documents.parquet"))
    tb.load(spark, sf_dir, "labels").limit(0).write.parquet(str(tmp_path / "labels.parquet"))
    got = dict(QUERIES["file_row_counts"](spark, str(tmp_path)).collect())
    assert len(got) == len(tb.TABLES)
    assert got["documents.parquet"] == docs.count() and got["labels.parquet"] == 0
