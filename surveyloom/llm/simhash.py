"""SimHash near-duplicates by multi-index hashing.

Equal fingerprints are one node. A fingerprint has two 32-bit segments; of two fingerprints that
differ in at most three bits, one segment differs in at most one. So every fingerprint is entered
in a table under both segments and looks up the Hamming ball of radius one around each. Of a pair
whose segments differ in one bit, the side that has the bit clear finds the other, so only cleared
bits are flipped. What a lookup fetches is verified on all 64 bits.

A segment value that many fingerprints share is indexed again, by the two 16-bit halves of the other
segment in the same way, and only a forest of links leaves such a group, not all of its pairs.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.common import components, map_batches, stage, union_find

# Bits in which linked fingerprints may differ.
DISTANCE = 3
# Entries of one segment value beyond which it is indexed again.
CROWDED = 256
# Shingles whose bits are counted at a time, and rows of a comparison block.
BLOCK = 1 << 16
ROWS = 1024


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """Fingerprint of a text as a signed 64-bit number: majority of each bit over shingle hashes.

    ASCII letters are lower-cased and ASCII white space splits words. Fewer words than a shingle
    are hashed together; a null text or one without words has fingerprint zero.
    """
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    line, lengths = b" ".join(parts), np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    count = max(1, len(parts) - words + 1)
    last = ends[words - 1:] if len(parts) >= words else ends[-1:]
    digest, set_bits = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for k in range(0, count, BLOCK):
        bounds = zip(starts[k:k + BLOCK].tolist(), last[k:k + BLOCK].tolist())
        hashes = np.array([digest(line[a:b], seed) for a, b in bounds], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += np.add.reduce(bits, axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > count, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """Columns ``key`` (long) and ``fp`` (long) per row."""
    return map_batches(
        docs.select(F.col(key).cast("long"), text), lambda c: [c[0], [fingerprint(t, words) for t in c[1]]],
        f"`{key}` long, fp long", text,
    )


def _entries(prints: DataFrame) -> DataFrame:
    """Both segments of every fingerprint: ``fp``, ``seg``, ``value``."""
    low, high = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("fp", 32)
    return prints.select(
        "fp", F.explode(F.array(F.struct(F.lit(0).alias("seg"), low.alias("value")), F.struct(F.lit(1).alias("seg"), high.alias("value")))).alias("e")
    ).select("fp", "e.*")


def _ball(value: Column, bits: int) -> Column:
    """The value itself, and the value with one of its clear bits set."""
    flips = F.transform(F.sequence(F.lit(0), F.lit(bits - 1)), lambda b: F.call_function("shiftleft", F.lit(1).cast("long"), b))
    return F.concat(F.array(value), F.transform(F.filter(flips, lambda m: value.bitwiseAND(m) == 0), lambda m: value.bitwiseOR(m)))


def _linked(frame: pd.DataFrame, distance: int = DISTANCE) -> pd.DataFrame:
    """Forest of the links between the fingerprints of one group, compared block by block."""
    fp = np.unique(frame["fp"].to_numpy()).view(np.uint64)
    a, b = [], []
    for i in range(0, len(fp), ROWS):
        for j in range(i, len(fp), ROWS):
            x, y = np.nonzero(np.bitwise_count(fp[i:i + ROWS, None] ^ fp[None, j:j + ROWS]) <= distance)
            ends, root = union_find(fp[i + x].view(np.int64), fp[j + y].view(np.int64))
            a.append(ends[ends != root])
            b.append(root[ends != root])
    return pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)})


def links(prints: DataFrame, crowded: int = CROWDED, distance: int = DISTANCE) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints that connect all that differ in at most ``distance`` bits.

    Balls of radius one around two segments reach three bits, so ``distance`` is at most that.
    """
    if not 0 <= distance <= DISTANCE:
        raise ValueError(f"two segments reach {DISTANCE} bits, not {distance}")
    entries = stage(_entries(prints), "segments")
    hot = stage(entries.groupBy("seg", "value").count().where(F.col("count") > crowded).select("seg", "value"), "crowded")
    probes = entries.select("fp", "seg", F.explode(_ball(F.col("value"), 32)).alias("value"), F.col("value").alias("own"))
    table = entries.withColumnRenamed("fp", "other")
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= distance
    once = (F.col("value") != F.col("own")) | (F.col("fp") < F.col("other"))
    if not hot.take(1):
        return probes.join(table, ["seg", "value"]).where(near & once).select(F.col("fp").alias("a"), F.col("other").alias("b"))
    calm = probes.join(table.join(hot, ["seg", "value"], "left_anti"), ["seg", "value"]).where(near & once)
    # The other segment of every entry or probe of a crowded value, indexed by its halves.
    rest = F.when(F.col("seg") == 0, F.shiftrightunsigned("fp", 32)).otherwise(F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)))
    halves = F.array(
        F.struct(F.lit(0).alias("half"), F.col("rest").bitwiseAND(F.lit(0xFFFF)).alias("piece")),
        F.struct(F.lit(1).alias("half"), F.shiftrightunsigned("rest", 16).alias("piece")),
    )
    inner = (
        probes.join(hot, ["seg", "value"]).withColumn("rest", rest).select("fp", "seg", "value", F.explode(halves).alias("h"))
        .select("fp", "seg", "value", "h.half", F.explode(_ball(F.col("h.piece"), 16)).alias("piece"))
    )
    found = inner.groupBy("seg", "value", "half", "piece").applyInPandas(lambda frame: _linked(frame, distance), "a long, b long")
    return calm.select(F.col("fp").alias("a"), F.col("other").alias("b")).union(found)


def _groups(unique: DataFrame, crowded: int, distance: int) -> DataFrame:
    """``unique`` (one row for each ``fp``) with ``group``, one value for all fingerprints that links connect; written."""
    found = components(links(unique.select("fp"), crowded, distance))
    joined = unique.join(found, unique["fp"] == found["node"], "left")
    return stage(joined.select(*unique.columns, F.coalesce("component_id", "fp").alias("group")), "groups")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", crowded: int = CROWDED, words: int = 3, distance: int = DISTANCE,
) -> DataFrame:
    """Columns ``key`` (long), ``fp`` (long) and ``component_id`` (long) per row.

    ``component_id`` is the smallest key reached over links, rows of equal fingerprints included; it
    is null where all keys reached are null. Repeated rows get equal answers. An empty table gives
    no rows.
    """
    prints = stage(fingerprints(docs, key, text, words), "fingerprints")
    grouped = _groups(prints.groupBy("fp").agg(F.min(key).alias("least")), crowded, distance)
    least = grouped.groupBy("group").agg(F.min("least").alias("component_id"))
    named = grouped.join(least, "group").select("fp", "component_id")
    return prints.join(named, "fp").select(key, "fp", "component_id")


def one_of_each(
    docs: DataFrame, key: str = "doc_id", text: str = "text", crowded: int = CROWDED, words: int = 3, distance: int = DISTANCE,
) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: one of every group that ``near_duplicates`` makes.

    The row with the smallest key stays; of rows that repeat this key, the one whose columns hash
    smallest. Rows without a key stay only where their group has no other. Rows are written once with
    their fingerprint, so that each is known by its place in the written table.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    own, mark = f"_row_{uuid.uuid4().hex}", f"_print_{uuid.uuid4().hex}"
    types, at = [f.type for f in to_arrow_schema(docs.schema)], docs.columns.index(text)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def work(columns: list[list]) -> list:
        return [*(pa.array(c, t) for c, t in zip(columns, types)), [fingerprint(t, words) for t in columns[at]]]

    printed = map_batches(docs, work, f"{kinds}, `{mark}` long", text).withColumn(own, F.monotonically_increasing_id())
    printed = stage(printed, "fingerprints")
    order = F.struct(
        F.col(f"`{key}`").isNull().alias("unnamed"), F.col(f"`{key}`").alias("key"),
        F.xxhash64(*[f"`{c}`" for c in docs.columns]).alias("hash"), F.col(own).alias("row"),
    )
    grouped = _groups(printed.groupBy(F.col(mark).alias("fp")).agg(F.min(order).alias("first")), crowded, distance)
    firsts = grouped.groupBy("group").agg(F.min("first")["row"].alias(own))
    return printed.join(firsts.select(own), own, "left_semi").drop(own, mark)
