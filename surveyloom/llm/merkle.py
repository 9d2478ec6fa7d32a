"""Merkle manifest of a dataset by a roll-up of nested structs.

Rows are leaves, ranked inside their group. The octal digits of a rank are columns; in every block of
``8 ** DIGITS`` consecutive leaves they are grouped away one after the other, each node being a struct of
its hash and the array of its children. All these groups lie in one shuffle by block, and a block's
tree is a row of bounded size. The roots of blocks are the leaves of the next tree, until one is left in
every group; the groups' roots are one more tree. On the way back a tree's nodes hand their own path down
to the blocks below by grouping, and transform and explode unfold the children, each with the hashes of
its siblings in front. No proof needs a join.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyloom.llm.common import stage

# Fixed value: children of a node. Digits of a block, so 4096 leaves.
FAN = 8
DIGITS = 4


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the texts laid end to end."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the byte count, a colon and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    return digest(*map(field, values))


def fold(start: Column, path: Column) -> Column:
    """Root that a leaf hash and the siblings on its path give."""
    return F.aggregate(path, start, lambda h, step: digest(step["before"], h, step["after"]))


def proof(path: Column) -> Column:
    """Hash of all siblings on a path, level by level."""
    return digest(F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), ""))


def _ranked(nodes: DataFrame, *order: str) -> DataFrame:
    """``nodes`` with ``rank`` from 0 inside ``g`` (null is a group, and first) and the group's size ``n``.

    Rows are dealt into ranges and numbered in them; one count for each group and range shifts the
    ranges. Equal rows are told apart by their place in the written table, so any number of them splits.
    """
    by = [F.col(c).asc_nulls_first() for c in ("g", *order)]
    placed = nodes.withColumn("line", F.monotonically_increasing_id())
    placed = placed.repartitionByRange(*by, F.col("line")).sortWithinPartitions(*by, F.col("line"))
    placed = stage(
        placed.withColumn("line", F.monotonically_increasing_id()).withColumn("range", F.spark_partition_id()), "ranked"
    )
    shifts = placed.groupBy(F.col("g").alias("of"), F.col("range").alias("part")).agg(F.min("line").alias("first"), F.count("*").alias("held"))
    before = Window.partitionBy("of").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = shifts.select(
        "of", "part", "first", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("shift"),
        F.sum("held").over(Window.partitionBy("of")).alias("n"),
    )
    same = (F.col("range") == F.col("part")) & F.col("g").eqNullSafe(F.col("of"))
    return placed.join(shifts, same).select(*nodes.columns, (F.col("line") - F.col("first") + F.col("shift")).alias("rank"), "n")


def _rolled(nodes: DataFrame) -> DataFrame:
    """One row for each block: ``g``, ``b``, ``n``, and ``node``, a tree of (hash, kids) over its leaves.

    ``nodes`` has ``g``, ``rank``, ``n``, ``hash`` and ``data``. A level that would hash a lone node of its
    group passes it on.
    """
    digits = [f"d{k}" for k in range(DIGITS)]
    level = nodes.select(
        "g", F.floor(F.col("rank") / FAN**DIGITS).cast("long").alias("b"), "n",
        *[F.pmod(F.floor(F.col("rank") / FAN**k), F.lit(FAN)).cast("int").alias(d) for k, d in enumerate(digits)],
        F.struct("hash", "data").alias("node"),
    ).repartition("g", "b")
    for k, digit in enumerate(digits):
        kids = level.groupBy("g", "b", "n", *digits[k + 1:]).agg(
            F.array_sort(F.collect_list(F.struct(F.col(digit).alias("at"), "node")), lambda x, y: x["at"] - y["at"]).alias("kids")
        )
        below = F.col("kids.node.hash")
        kids = kids.withColumn("hash", F.when(F.col("n") > FAN**k, digest(F.array_join(below, ""))).otherwise(below[0]))
        level = kids.select("g", "b", "n", *digits[k + 1:], F.struct("hash", F.col("kids.node").alias("kids")).alias("node"))
    return level


def _unrolled(blocks: DataFrame, *carried: str) -> DataFrame:
    """Leaves of all blocks: ``g``, ``rank``, ``hash``, ``data``, the ``carried`` columns and the grown ``path``."""
    def child(k: int) -> Callable[[Column, Column], Column]:
        def build(kid: Column, at: Column) -> Column:
            hashes = F.col("node.kids.hash")
            step = F.struct(
                F.array_join(F.slice(hashes, F.lit(1), at), "").alias("before"),
                F.array_join(F.slice(hashes, at + 2, F.lit(FAN)), "").alias("after"),
            )
            own = F.when(F.col("n") > FAN**k, F.concat(F.array(step), F.col("path"))).otherwise(F.col("path"))
            return F.struct((F.col("rank") * FAN + at).alias("rank"), own.alias("path"), kid.alias("node"))

        return build

    level = blocks.select("g", "n", F.col("b").alias("rank"), "path", "node", *carried)
    for k in reversed(range(DIGITS)):
        kids = F.explode(F.transform("node.kids", child(k))).alias("e")
        level = level.select("g", "n", *carried, kids).select("g", "n", *carried, "e.*")
    return level.select("g", "rank", "node.hash", "node.data", "path", *carried)


def _grown(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Written blocks of all rounds from below, and the root of each group (``g``, ``hash``)."""
    rounds = []
    while True:
        blocks = stage(_rolled(nodes), "blocks")
        rounds.append(blocks)
        roots = blocks.select("g", F.col("b").alias("rank"), F.ceil(F.col("n") / FAN**DIGITS).cast("long").alias("n"), "node.hash")
        if (roots.agg(F.max("n")).first()[0] or 0) <= 1:
            return rounds, roots.select("g", "hash")
        nodes = roots.withColumn("data", F.lit(0))


def _handed(rounds: list[DataFrame], given: DataFrame, *carried: str) -> DataFrame:
    """Leaves of the lowest round with their paths, where ``given`` has ``g``, ``path`` and ``carried`` of each root."""
    given = given.withColumn("b", F.lit(0).cast("long"))
    for blocks in reversed(rounds):
        sides = blocks.select("g", "b", "n", "node"), given.select("g", "b", "path", *carried)
        met = sides[0].unionByName(sides[1], allowMissingColumns=True).groupBy("g", "b")
        whole = met.agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("n", "node", "path", *carried)])
        leaves = _unrolled(whole, *carried)
        given = leaves.withColumnRenamed("rank", "b")
    return leaves


def manifest(docs: DataFrame, values: list[Column], group: str = "lang", key: str = "doc_id", claim: Column | None = None) -> DataFrame:
    """Leaf, roots and path of every row: ``key`` (long), ``leaf``, ``claim``, ``subroot``, ``root``, ``path``.

    A leaf hashes ``values``. Leaves ascend by ``key`` in each ``group`` (null keys first, equal keys by
    leaf; a null group is the first group); eight consecutive nodes make the next one until a group has
    its subroot, and the subroots by group the root. ``path`` lists the siblings of a leaf from below as
    (before, after), each laid end to end. ``claim`` is the hash that another version of the row would
    have, null where there is none. Repeated rows are leaves of their own. An empty table gives no rows;
    columns that are not named are not read.
    """
    hashes = docs.select(F.col(group).alias("g"), F.col(key).cast("long").alias("id"), leaf(*values).alias("hash"), (F.lit(None).cast("string") if claim is None else claim).alias("claim"))
    ranked = _ranked(stage(hashes, "leaves"), "id", "hash")
    low, subroots = _grown(ranked.select("g", "rank", "n", "hash", F.struct("id", "claim").alias("data")))
    named = stage(subroots.select(F.lit(0).alias("g"), F.col("g").alias("name"), "hash"), "subroots")
    high, roots = _grown(_ranked(named, "name").select("g", "rank", "n", "hash", F.struct("name").alias("data")))
    no_path = F.expr("cast(array() AS array<struct<before: string, after: string>>)")
    tops = _handed(high, roots.select("g", no_path.alias("path"), F.col("hash").alias("root")), "root")
    tops = stage(tops.select(F.col("data.name").alias("g"), "path", F.col("hash").alias("subroot"), "root"), "tops")
    leaves = _handed(low, tops, "subroot", "root")
    return leaves.select(F.col("data.id").alias(key), F.col("hash").alias("leaf"), "data.claim", "subroot", "root", "path")


def sql(leaves: str, claims: str, levels: int = 7, top_levels: int = 3) -> str:
    """DuckDB SQL of the same rows with every level written out: ``leaves`` and ``claims`` are expressions over documents."""
    def tree(name: str, count: int) -> list[str]:
        parts = []
        for k in range(count):
            run = f"PARTITION BY g, r // {FAN} ORDER BY r"
            parts.append(
                f"{name}_steps{k} AS (SELECT g, r, coalesce(string_agg(hash, '') OVER ({run} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,"
                f" coalesce(string_agg(hash, '') OVER ({run} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after FROM {name}{k})"
            )
            parts.append(
                f"{name}{k + 1} AS (SELECT g, r // {FAN} AS r, max(n) AS n, CASE WHEN max(n) > {FAN**k} THEN sha256(string_agg(hash, '' ORDER BY r))"
                f" ELSE max(hash) END AS hash FROM {name}{k} GROUP BY g, r // {FAN})"
            )
        return parts

    def climb(source: str, name: str, group: str, rank: str, size: str, count: int) -> list[str]:
        parts = []
        for k in range(count):
            met = f"{size} > {FAN**k}"
            parts.append(
                f"{name}{k} AS (SELECT w.* EXCLUDE (h, proof), CASE WHEN {met} THEN sha256(s.before || h || s.after) ELSE h END AS h,"
                f" CASE WHEN {met} THEN proof || s.before || s.after ELSE proof END AS proof"
                f" FROM {source if k == 0 else name + str(k - 1)} w JOIN {name}_steps{k} s ON s.g = w.{group} AND s.r = w.{rank} // {FAN**k})"
            )
        return parts

    def renamed(parts: list[str], old: str, new: str) -> list[str]:
        return [p.replace(f"{new}_steps", f"{old}_steps") for p in parts]

    chain = [
        f"hashed AS (SELECT doc_id, dense_rank() OVER (ORDER BY lang NULLS FIRST) AS g, {leaves} AS leaf, {claims} AS claim FROM documents)",
        "ranked AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank, count(*) OVER (PARTITION BY g) AS size FROM hashed)",
        "low0 AS (SELECT g, rank AS r, size AS n, leaf AS hash FROM ranked)", *tree("low", levels),
        f"high0 AS (SELECT 0 AS g, g - 1 AS r, count(*) OVER () AS n, hash FROM low{levels})", *tree("high", top_levels),
        "begun AS (SELECT *, 0 AS top, g - 1 AS place, max(g) OVER () AS groups, claim AS h, '' AS proof FROM ranked)",
        *renamed(climb("begun", "up", "g", "rank", "size", levels), "low", "up"),
        *renamed(climb(f"up{levels - 1}", "over", "top", "place", "groups", top_levels), "high", "over"),
    ]
    return (
        "WITH " + ",\n".join(chain) + f"\nSELECT doc_id, leaf, l.hash AS subroot, t.hash AS root, sha256(proof) AS proof_sha256, h AS folded_root, h = t.hash AS verified\n"
        f"FROM over{top_levels - 1} w JOIN low{levels} l ON l.g = w.g CROSS JOIN high{top_levels} t"
    )
