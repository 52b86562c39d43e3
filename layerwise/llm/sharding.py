"""Shards of near-equal bytes by sampled splitters, in DataFrame operations only.

Keys are sampled with a chance that grows with the size of their record; quantiles of the sample
bound the ranges. What a range really holds is then counted, and ranges over their share are
subdivided by a second hash, so that equal keys in any number never meet in one task. Records in
order of range and part are cut into shards at equal sums of bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARDS = 40
#: Sampled keys, and ranges for each shard. Both bound what passes through the driver.
SAMPLE = 8_192
RANGES_A_SHARD = 8
OVERHEAD = 16


def record_size(text: str = "text") -> Column:
    """UTF-8 bytes of a text (null: none) and a fixed overhead."""
    return F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("bigint") + OVERHEAD


def content_key(text: str = "text") -> Column:
    """The same for equal texts, so that they stand next to each other."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def splitters(records: DataFrame, ranges: int, sample: int = SAMPLE) -> list[int]:
    """Boundaries of ``__key`` from a sample weighted by ``__size``: of each record a uniform
    number u is drawn by hash, and those of the greatest log(u)/size are taken."""
    draw = F.log((F.pmod(F.xxhash64("__key", "__spread"), F.lit(1 << 40)) + 1) / float(1 << 40)) / F.col("__size")
    drawn = records.select("__key", draw.alias("draw")).orderBy(F.desc("draw"), "__key").limit(sample)
    keys = F.sort_array(F.collect_list("__key"))  # of ``sample`` rows at most
    places = [i / ranges for i in range(1, ranges)]
    picked = F.transform(
        F.lit(places), lambda p: F.get(F.col("keys"), F.floor(p * F.size("keys")).cast("int"))
    )
    row = drawn.agg(keys.alias("keys")).select(picked.alias("cut")).first()
    return sorted({k for k in (row["cut"] or []) if k is not None}) if places else []


def range_of(key: Column, cuts: list[int]) -> Column:
    """How many cuts a key reaches, by halving steps in an array of them."""
    if not cuts:
        return F.lit(0)
    steps = [1 << i for i in range(len(cuts).bit_length() - 1, -1, -1)]

    def halve(low: Column, step: Column) -> Column:
        at = low + step
        reached = (at <= len(cuts)) & (F.get(F.lit(cuts), at - 1) <= key)
        return F.when(reached, at).otherwise(low)

    return F.aggregate(F.lit(steps), F.lit(0), halve)


def looked_up(values: dict[int, int], at: Column) -> Column:
    """A value of a small table the driver holds; null where it has none. Keys are looked up by
    halving steps, values by place."""
    keys = sorted(values)
    place = range_of(at, keys)
    found = F.get(F.lit(keys), place - 1) == at
    return F.when(found, F.get(F.lit([int(values[k]) for k in keys]).cast("array<bigint>"), place - 1))


def shard_by_bytes(
    docs: DataFrame, shards: int = SHARDS, text: str = "text", key: str = "doc_id", sample: int = SAMPLE
) -> DataFrame:
    """``docs`` with ``size``, ``shard`` and ``slot`` (its place there, gapless from 0).

    Shards hold sums of ``size`` that differ by about one record. Equal texts stand together, and
    are parted only where a shard is full. The order, and so the result, depends on keys, texts
    and ``shards`` alone. Null and empty texts have the overhead's size; null keys are one key;
    equal rows get slots of their own. Columns of these names are replaced; columns that begin
    with two underscores are dropped. No documents give no rows.
    """
    kept = [c for c in docs.columns if not c.startswith("__") and c.lower() not in ("size", "shard", "slot")]
    records = docs.select(
        *kept,
        record_size(text).alias("__size"),
        content_key(text).alias("__key"),
        F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit(""))).alias("__spread"),
    )
    cuts = splitters(records, shards * RANGES_A_SHARD, sample)
    ranged = records.withColumn("__range", range_of(F.col("__key"), cuts))

    counted = ranged.groupBy("__range").agg(F.sum("__size").alias("bytes")).collect()  # bounded: ranges
    total = sum(r["bytes"] for r in counted)
    share = max(1, total // (shards * RANGES_A_SHARD))
    parts = {r["__range"]: -(-r["bytes"] // share) for r in counted if r["bytes"] > 2 * share}
    part = F.lit(0)
    if parts:
        of_range = F.coalesce(looked_up(parts, F.col("__range")), F.lit(1))
        part = F.pmod(F.col("__spread"), of_range).cast("int")
    celled = ranged.withColumn("__part", part)

    cells = celled.groupBy("__range", "__part").agg(F.sum("__size").alias("bytes")).collect()  # bounded: parts
    start, starts = 0, {}
    for cell in sorted(cells, key=lambda c: (c["__range"], c["__part"])):
        starts[(cell["__range"], cell["__part"])] = start
        start += cell["bytes"]
    if not starts:
        starts[(0, 0)] = 0
    width = 1 + max(p for _, p in starts)
    cell_number = F.col("__range") * width + F.col("__part")
    first = looked_up({r * width + p: at for (r, p), at in starts.items()}, cell_number)
    order = ["__key", "__spread", key]  # ties are rows of one text and key, so of one size
    cell = Window.partitionBy("__range", "__part").orderBy(*order)
    upto = F.sum("__size").over(cell.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__size")
    middle = first + upto + F.floor(F.col("__size") / 2)
    placed = celled.withColumn(
        "__shard", F.least(F.floor(middle * shards / F.lit(max(1, total))), F.lit(shards - 1)).cast("int")
    )
    tallies = placed.groupBy("__range", "__part", "__shard").agg(F.count(F.lit(1)).alias("rows")).collect()
    before: dict[tuple[int, int, int], int] = {}
    filled = [0] * shards
    for t in sorted(tallies, key=lambda t: (t["__range"], t["__part"], t["__shard"])):
        before[(t["__range"], t["__part"], t["__shard"])] = filled[t["__shard"]]
        filled[t["__shard"]] += t["rows"]
    if not before:
        before[(0, 0, 0)] = 0
    offset = looked_up(
        {(r * width + p) * shards + s: at for (r, p, s), at in before.items()}, cell_number * shards + F.col("__shard")
    )
    in_shard = Window.partitionBy("__range", "__part", "__shard").orderBy(*order)
    return placed.select(
        *kept,
        F.col("__size").alias("size"),
        F.col("__shard").alias("shard"),
        (offset + F.row_number().over(in_shard) - 1).cast("bigint").alias("slot"),
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """The records of each shard in a directory of its own, in order of slot within files."""
    placed = shard_by_bytes(docs, shards)
    placed.repartition(shards, "shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
