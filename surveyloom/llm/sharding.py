"""Sharding by sampled splitters, with DataFrame functions only.

A size-weighted sample of the sort keys gives quantile boundaries of many narrow ranges. Rows are
dealt into the ranges; ranges that got far more than their share are cut into slices. Sums over
ranges then place every row on one line of all bytes, which is cut into shards of equal length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyloom.llm.common import stage

# Ranges that the splitters make; a range is the unit of one sort.
RANGES = 1024
# Expected number of sampled keys, an upper bound of what is sorted to find the splitters.
SAMPLE = 16_384
# A range with more than this many times the mean of rows or bytes is cut into slices.
OVERFULL = 4
# Rows over 1 / (shards * HEAVY) of all bytes are dealt out first; there are at most shards * HEAVY.
HEAVY = 256


def _splitters(rows: DataFrame, total: int, ranges: int, sample: int) -> list[tuple[int, int]]:
    """At most ``ranges - 1`` keys (hash, row) at the quantiles of a size-weighted sample."""
    rate = F.col("size") * F.lit(sample / max(1, total))
    draw = F.pmod(F.xxhash64("row", F.lit("splitter")), F.lit(1 << 40)) / F.lit(float(1 << 40))
    drawn = rows.where(draw < rate).select("hash", "row", F.greatest(rate, F.lit(1.0)).alias("weight"))
    line = Window.orderBy("hash", "row")
    before = F.coalesce(F.sum("weight").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    placed = drawn.select(
        "hash", "row", "weight", before.alias("before"), F.sum("weight").over(Window.partitionBy()).alias("all")
    ).select(
        "hash", "row", F.floor(F.col("before") * ranges / F.col("all")).alias("cell"),
        F.floor((F.col("before") + F.col("weight")) * ranges / F.col("all")).alias("next"),
    )
    return [tuple(r) for r in placed.where("next > cell").orderBy("hash", "row").limit(ranges - 1).select("hash", "row").collect()]


def _range_of(splitters: list[tuple[int, int]]) -> Column:
    """Number of splitters at or below the row's key, by binary search."""
    if not splitters:
        return F.lit(0)
    hashes = F.lit([h for h, _ in splitters]).cast("array<bigint>")
    numbers = F.lit([n for _, n in splitters]).cast("array<bigint>")
    steps = [1 << k for k in reversed(range(len(splitters).bit_length()))]

    def forward(found: Column, step: Column) -> Column:
        at = found + step - 1
        h, n = F.get(hashes, at), F.get(numbers, at)
        passed = (h < F.col("hash")) | ((h == F.col("hash")) & (n <= F.col("row")))
        return found + F.when(passed, step).otherwise(F.lit(0))

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), forward)


def shard(
    docs: DataFrame, shards: int = 16, key: str = "doc_id", text: str = "text",
    ranges: int = RANGES, sample: int = SAMPLE,
) -> DataFrame:
    """Shard and slot of every row: ``key``, ``size``, ``text_crc32``, ``shard``, ``slot``.

    Rows of equal texts lie next to each other on the line of keys. The size of a row is the UTF-8
    bytes of its text plus one, a null text having none, so empty rows count too. Shards have nearly
    equal bytes: a cut is off by at most half of a row under 1 / (shards * HEAVY) of all bytes, and
    the rows above that are dealt out beforehand, largest first, back and forth over the shards.
    Slots count from 0 without gaps. The key of a range holds a row number, so copies of one text
    fill as many ranges as they need. Repeated rows are rows of their own; ``docs`` without rows
    gives none. Only counts of ranges (at most about twice ``ranges``), the splitters and numbers
    of shards are sent to all tasks.
    """
    rows = stage(
        docs.select(
            F.col(key).alias("key"), (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("hash"), F.monotonically_increasing_id().alias("row"),
        ), "sizes",
    )
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    heavy = F.col("size") * (shards * HEAVY) > total
    back = Window.orderBy(F.desc("size"), "hash", "row")
    rank = F.row_number().over(back) - 1
    turn = F.pmod(rank, F.lit(2 * shards))
    dealt = stage(
        rows.where(heavy).withColumn("turn", turn)
        .withColumn("shard", F.when(F.col("turn") < shards, F.col("turn")).otherwise(2 * shards - 1 - F.col("turn")).cast("int"))
        .withColumn("slot", (F.row_number().over(Window.partitionBy("shard").orderBy(F.desc("size"), "hash", "row")) - 1).cast("long"))
        .drop("turn"), "heavy",
    )
    loads = {r["shard"]: (r["n"], r["b"]) for r in dealt.groupBy("shard").agg(F.count("*").alias("n"), F.sum("size").alias("b")).collect()}
    light_total = total - sum(b for _, b in loads.values())
    rooms = [max(0.0, total / shards - loads.get(s, (0, 0))[1]) for s in range(shards)]
    scale = light_total / sum(rooms) if sum(rooms) else 0.0
    cuts = [sum(rooms[: s + 1]) * scale for s in range(shards - 1)]

    light = rows.where(~heavy)
    light = light.withColumn("cell", _range_of(_splitters(light, light_total, ranges, sample)))
    sums = F.count("*").alias("n"), F.sum("size").alias("b")
    mean = light.groupBy("cell").agg(*sums).agg(F.avg("n").alias("mean_n"), F.avg("b").alias("mean_b")).first()
    share = F.greatest(F.col("n") / F.lit(mean[0] or 1.0), F.col("b") / F.lit(mean[1] or 1.0)) / OVERFULL
    slices = light.groupBy("cell").agg(*sums).select("cell", F.greatest(F.ceil(share), F.lit(1)).alias("slices"))
    light = light.join(F.broadcast(slices), "cell").withColumn("slice", F.pmod(F.xxhash64("row"), F.col("slices"))).drop("slices")
    line = Window.orderBy("cell", "slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = light.groupBy("cell", "slice").agg(*sums).select(
        "cell", "slice", F.coalesce(F.sum("n").over(line), F.lit(0)).alias("n_before"),
        F.coalesce(F.sum("b").over(line), F.lit(0)).alias("b_before"),
    )
    inside = Window.partitionBy("cell", "slice").orderBy("hash", "row")
    placed = (
        light.withColumns({"_n": F.row_number().over(inside), "_b": F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))})
        .join(F.broadcast(starts), ["cell", "slice"])
        .withColumn("at", F.col("n_before") + F.col("_n") - 1)
        .withColumn("middle", F.col("b_before") + F.col("_b") - F.col("size") / 2)
        .withColumn("shard", sum((F.when(F.col("middle") >= F.lit(c), 1).otherwise(0) for c in cuts), F.lit(0)).cast("int"))
    )
    placed = stage(placed.select("key", "size", "text_crc32", "shard", "at"), "placed")
    firsts = placed.groupBy("shard").agg(F.min("at").alias("first"))
    slot = F.col("at") - F.col("first") + sum(
        (F.when(F.col("shard") == s, F.lit(n)).otherwise(0) for s, (n, _) in loads.items()), F.lit(0)
    )
    return dealt.select(F.col("key").alias(key), "size", "text_crc32", "shard", "slot").union(
        placed.join(F.broadcast(firsts), "shard").select(F.col("key").alias(key), "size", "text_crc32", "shard", slot.cast("long"))
    )
