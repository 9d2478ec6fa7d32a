"""Embedding near-duplicates by a forest of random-projection trees.

Equal vectors of one label are one class. Every tree splits the classes of a label recursively by
random directions near the median, and classes within a margin of a split go to both sides, so close
pairs rarely part. Nodes are split in rounds, each on a bounded sample of the node; a node whose
sample consists of close pairs is left whole. Inside the leaves all pairs are verified. A pair found
in several leaves counts in the smallest leaf the two share, so no pair leaves its task: what leaves
is a number of links for each class and a forest of links.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from surveyloom.llm.common import components, stage, union_find

TREES = 6
# Classes in a leaf, and sampled rows that a node's splits are fitted on.
LEAF = 768
SAMPLE = 2048
# Splits below each other in one round, and rounds at most (leaves are then compared as they are).
LEVELS = 5
ROUNDS = 12
# Spill margin, in standard deviations of the projected difference of a pair at the threshold.
MARGIN = 0.75
# A node is left whole if this share of sampled pairs is close.
CLOSE = 0.5
# Classes compared with each other in one block.
BLOCK = 1024


def _matrix(column: pd.Series) -> np.ndarray:
    x = np.array(column.tolist(), np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _direction(node: int, path: int, size: int) -> np.ndarray:
    v = np.random.default_rng([node & (1 << 63) - 1, path]).standard_normal(size)
    return v / np.linalg.norm(v)


def _margin(threshold: float, size: int) -> float:
    return MARGIN * (2 - 2 * threshold) ** 0.5 / size**0.5 / 2


def _fit_node(threshold: float):
    """Thresholds of a node's splits, breadth first (NaN: no split); no thresholds: left whole."""

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        node, size = int(frame["node"].iloc[0]), int(frame["size"].iloc[0])
        x = _matrix(frame["embedding"])
        some = x[:512]
        close = ((some @ some.T >= threshold).sum() - len(some)) / max(1, len(some) * (len(some) - 1))
        cuts = np.full((1 << LEVELS) - 1, np.nan)
        if close < CLOSE:
            margin, scale, held = _margin(threshold, x.shape[1]), size / len(x), {0: np.arange(len(x))}
            for path in range(len(cuts)):
                rows = held.pop(path, None)
                if rows is None or len(rows) * scale <= LEAF or len(rows) < 16:
                    continue
                place = x[rows] @ _direction(node, path, x.shape[1])
                cuts[path] = np.quantile(place, np.random.default_rng([node & (1 << 63) - 1, path, 1]).uniform(0.4, 0.6))
                left, right = rows[place < cuts[path] + margin], rows[place >= cuts[path] - margin]
                if max(len(left), len(right)) > 0.9 * len(rows):  # splitting gains nothing
                    cuts[path] = np.nan
                    continue
                held[2 * path + 1], held[2 * path + 2] = left, right
        return pd.DataFrame({"node": [node], "cuts": [cuts.tolist() if not np.isnan(cuts[0]) else []]})

    return fit


def _stacked(column: pa.ListArray) -> np.ndarray:
    """Lists of one length as the rows of a matrix of doubles, of length one each."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _route(threshold: float):
    """Children of every row's node by the node's splits.

    Rows come ordered by node, as a node's directions are drawn once for each run of its rows.
    """

    def route(batches):
        drawn = None, {}
        for batch in batches:
            nodes, own = (batch.column(name).to_numpy() for name in ("node", "class"))
            starts = np.flatnonzero(np.r_[True, nodes[1:] != nodes[:-1]]) if len(nodes) else []
            parts = []
            for start, end in zip(starts, [*starts[1:], len(nodes)]):
                node, run = int(nodes[start]), batch.slice(start, end - start)
                if drawn[0] != node:
                    drawn = node, {}
                directions, cuts = drawn[1], run.column("cuts")[0].values.to_numpy(zero_copy_only=False)
                x = _stacked(run.column("embedding"))
                margin, held = _margin(threshold, x.shape[1]), {0: np.arange(len(x))}
                for path in np.flatnonzero(~np.isnan(cuts)).tolist():
                    rows = held.pop(path, None)
                    if rows is None:
                        continue
                    if path not in directions:
                        directions[path] = _direction(node, path, x.shape[1])
                    place, cut = x[rows] @ directions[path], cuts[path]
                    held[2 * path + 1], held[2 * path + 2] = rows[place < cut + margin], rows[place >= cut - margin]
                for path, rows in held.items():
                    parts.append((own[start + rows], np.full(len(rows), node), np.full(len(rows), path, np.int32)))
            if parts:
                columns = [pa.array(np.concatenate(c)) for c in zip(*parts)]
                yield pa.RecordBatch.from_arrays(columns, names=["class", "parent", "path"])

    return route


def _smaller_leaves(lists: list[pa.ListArray], node: int) -> list[np.ndarray]:
    """For each row of both sides, the leaves below ``node`` that several rows hold, as bits."""
    rows = [np.repeat(np.arange(len(column)), np.diff(column.offsets.to_numpy())) for column in lists]
    leaves = [column.flatten().to_numpy() for column in lists]
    found, code, count = np.unique(np.concatenate(leaves), return_inverse=True, return_counts=True)
    shared = (found < node) & (count > 1)
    bit = np.cumsum(shared) - 1
    out = []
    for column, row, own in zip(lists, rows, np.split(code, [len(leaves[0])])):
        row, own = row[shared[own]], bit[own[shared[own]]]
        table = np.zeros((len(column), max(1, -(-int(shared.sum()) // 64))), np.uint64)
        np.bitwise_or.at(table, (row, own // 64), np.uint64(1) << (own % 64).astype(np.uint64))
        out.append(table)
    return out


LINKS = pa.schema([("class", pa.int64()), ("n", pa.int64()), ("root", pa.int64())])


def _verify(threshold: float):
    """Links and forest of one block pair of a leaf; leaves hold each class's leaves."""

    def verify(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        node, first, second = (table[name][0].as_py() for name in ("node", "first", "second"))
        block = table["block"].to_numpy()
        sides = [table.filter(pa.array(block == k)).combine_chunks() for k in (first, second)]
        if not all(side.num_rows for side in sides):
            return LINKS.empty_table()
        x, y = (_stacked(side["embedding"].combine_chunks()) for side in sides)
        near = x @ y.T >= threshold
        i, j = np.nonzero(np.triu(near, 1) if first == second else near)
        held = _smaller_leaves([side["leaves"].combine_chunks() for side in sides], node)
        mine = np.zeros(len(i), bool)
        for k in range(0, len(i), 1 << 16):
            part = slice(k, k + (1 << 16))
            mine[part] = ~(held[0][i[part]] & held[1][j[part]]).any(1)
        i, j = i[mine], j[mine]
        (ca, wa), (cb, wb) = ([side[name].to_numpy() for name in ("class", "copies")] for side in sides)
        nodes, root = union_find(ca[i], cb[j])
        n = np.zeros(len(nodes), np.int64)
        np.add.at(n, np.searchsorted(nodes, ca[i]), wb[j])
        np.add.at(n, np.searchsorted(nodes, cb[j]), wa[i])
        return pa.Table.from_arrays([pa.array(v, pa.int64()) for v in (nodes, n, root)], schema=LINKS)

    return verify


def near_duplicates(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = 0.93,
    trees: int = TREES, leaf: int = LEAF,
) -> DataFrame:
    """Columns ``key`` (long), ``n_links`` (long), ``component_id`` (long) and ``kept`` per row.

    Vectors are compared by cosine in double precision where labels and lengths are equal. Rows
    with a null label or vector, a zero vector, or null or non-finite components link with nothing:
    no links, their own key as component. Repeated rows are vectors of their own and link as equal
    vectors do. An empty table gives no rows.
    """
    # Floats move as they are and become doubles where they are compared.
    kind = "array<float>" if dict(vectors.dtypes)[vector] == "array<float>" else "array<double>"
    rows = vectors.select(F.col(key).cast("long").alias("key"), F.col(label).alias("label"), F.col(vector).cast(kind).alias("embedding"))
    whole = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = F.coalesce(F.col("label").isNotNull() & whole & F.exists("embedding", lambda v: v != 0), F.lit(False))
    keyed = rows.withColumn("usable", usable).withColumn("hash", F.xxhash64("label", "embedding"))
    classes = stage(
        keyed.where("usable").groupBy("hash", "label", "embedding").agg(F.count("*").alias("copies"), F.min("key").alias("least"))
        .withColumn("class", F.monotonically_increasing_id()), "classes",
    )
    held = classes.select("class", "embedding")
    state = classes.select("class", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), "label", F.size("embedding").alias("d"))
    state = stage(state.select("class", F.xxhash64("tree", "label", "d").alias("node")), "nodes")
    leaves, by_node = None, Window.partitionBy("node")
    for _ in range(ROUNDS):
        sizes = state.groupBy("node").agg(F.count("*").alias("size"))
        large = stage(sizes.where(F.col("size") > leaf), "large")
        small = state.join(sizes.where(F.col("size") <= leaf), "node", "left_semi").select("class", "node")
        leaves = small if leaves is None else leaves.union(small)
        if not large.take(1):
            break
        open_ = state.join(large, "node")
        drawn = open_.withColumn("_rank", F.row_number().over(by_node.orderBy(F.xxhash64("class", "node"), "class")))
        drawn = drawn.where(F.col("_rank") <= SAMPLE).join(held, "class")
        cuts = stage(drawn.groupBy("node").applyInPandas(_fit_node(threshold), "node long, cuts array<double>"), "cuts")
        leaves = leaves.union(open_.join(cuts.where("size(cuts) = 0"), "node", "left_semi").select("class", "node"))
        routed = open_.join(cuts.where("size(cuts) > 0"), "node").join(held, "class").select("class", "node", "cuts", "embedding")
        routed = routed.sortWithinPartitions("node").mapInArrow(_route(threshold), "class long, parent long, path int")
        state = stage(routed.select("class", F.xxhash64("parent", "path").alias("node")), "nodes")
    else:
        leaves = leaves.union(state)

    leaves = stage(leaves, "leaves")
    sizes = leaves.groupBy("node").agg(F.count("*").alias("size")).where("size > 1")
    own = leaves.groupBy("class").agg(F.sort_array(F.collect_list("node")).alias("leaves"))  # of one class: trees times spills
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    entries = leaves.join(sizes, "node").withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda o: F.struct(F.least("block", o).alias("first"), F.greatest("block", o).alias("second")),
    )
    entries = (
        entries.withColumn("pair", F.explode(pairs)).join(own, "class").join(classes.select("class", "copies", "embedding"), "class")
        .select("node", "class", "block", "pair.first", "pair.second", "leaves", "copies", "embedding")
    )
    found = stage(
        entries.groupBy("node", "first", "second").applyInArrow(_verify(threshold), "class long, n long, root long"), "links"
    )
    links = found.groupBy("class").agg(F.sum("n").alias("n"))
    reached = components(found.select(F.col("class").alias("a"), F.col("root").alias("b")))
    grouped = stage(
        classes.join(reached, classes["class"] == reached["node"], "left").join(links, "class", "left").select(
            "hash", "label", "embedding", "least", F.coalesce("component_id", "class").alias("group"),
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        ), "grouped",
    )
    least = grouped.groupBy("group").agg(F.min("least").alias("component_id"))
    named = grouped.join(least, "group").select("hash", "label", "embedding", "n_links", "component_id")
    linked = keyed.where("usable").join(named, ["hash", "label", "embedding"]).select("key", "n_links", "component_id")
    alone = keyed.where(~F.col("usable")).select("key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"))
    return linked.union(alone).select(
        F.col("key").alias(key), "n_links", "component_id", F.coalesce(F.col("key") == F.col("component_id"), F.lit(True)).alias("kept")
    )
