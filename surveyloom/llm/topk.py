"""Exact top-k inner products by a three-phase uniform threshold.

The components of the vectors are dealt into m groups, and a task holds one group of a block of queries
and a block of candidates; a score is the sum of its m partial scores. Phase one gathers the best entries
of every group's own list of partial scores and resolves those few; the k-th best of them is a cutoff
that no answer lies below (longer lists only raise it). Phase two sends the cutoff to the groups: an entry with a total of at least
the cutoff has a partial score of at least cutoff / m in some group, so the entries that reach this in
their own group are sufficient. Phase three adds up the partial scores that came and computes only the
missing ones, of these entries alone.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from surveyloom.llm.common import stage

# Groups of components (at most 8), and rows of a block of queries and of candidates.
GROUPS = 2
QUERY_BLOCK, CANDIDATE_BLOCK = 1024, 4096
# A list holds this many times k entries of a query, of each block k at most.
LISTS = 4
# Entries whose missing parts are computed at a time.
RESOLVED_AT_ONCE = 1 << 16

LISTED = "d int, qb int, cb int, query long, g int, class long, part double"
SUFFICIENT = "d int, qb int, cb int, query long, g int, classes array<long>, parts array<double>"
TOTALS = "query long, class long, score long, named boolean, first long, first_row long"


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.concatenate(vectors.tolist()).astype(np.float64).reshape(len(vectors), -1)


def _none(schema: str) -> pd.DataFrame:
    return pd.DataFrame({field.split()[0]: pd.Series([], dtype=object) for field in schema.split(", ")})


def _listed(k: int):
    """Of one group and block, the entries with the k best partial scores of each query."""

    def best(key: tuple, queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(candidates):
            return _none(LISTED)
        partial, top = _matrix(queries["part"]) @ _matrix(candidates["part"]).T, min(k, len(candidates))
        chosen = np.argpartition(-partial, top - 1, axis=1)[:, :top]
        return pd.DataFrame({
            "d": key[0], "qb": key[2], "cb": key[3], "query": np.repeat(queries["class"].to_numpy(), top), "g": key[1],
            "class": candidates["class"].to_numpy()[chosen.ravel()], "part": np.take_along_axis(partial, chosen, axis=1).ravel(),
        })

    return best


def _reaching(key: tuple, queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
    """Of one group and block, the entries with a partial score of at least cutoff / m, a list for each query."""
    d, g, qb, cb = key
    names = [f.split()[0] for f in SUFFICIENT.split(", ")]
    if not len(queries) or not len(candidates):
        return _none(SUFFICIENT)
    partial, classes = _matrix(queries["part"]) @ _matrix(candidates["part"]).T, candidates["class"].to_numpy()
    least = queries["cutoff"].to_numpy(np.float64) / GROUPS
    rows = []
    for query, bound, own in zip(queries["class"], least, partial):
        hit = np.flatnonzero(own >= bound)
        if len(hit):
            rows.append((d, qb, cb, query, g, classes[hit], own[hit]))
    return pd.DataFrame(rows, columns=names) if rows else _none(SUFFICIENT)


def _resolved(k: int):
    """Totals of the entries of one block that reach the cutoff, the k best of each query.

    Equal scores are taken by the smallest row of the class, as the answers are.
    """

    def resolve(vectors: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        if not len(entries):
            return _none(TOTALS)
        queries = vectors[vectors["asked"]].sort_values("class", ignore_index=True)
        candidates = vectors[~vectors["asked"]].sort_values("class", ignore_index=True)
        at, of = queries["class"].to_numpy(), candidates["class"].to_numpy()
        sizes = entries["classes"].map(len).to_numpy()
        i = np.searchsorted(at, np.repeat(entries["query"].to_numpy(), sizes))
        j = np.searchsorted(of, np.concatenate(entries["classes"].tolist()))
        parts, group = np.concatenate(entries["parts"].tolist()), np.repeat(entries["g"].to_numpy(), sizes)
        known = np.zeros((len(at), len(of)))
        came = np.zeros(known.shape, np.uint8)
        for g in range(GROUPS):  # a group names an entry once
            own = group == g
            known[i[own], j[own]] += parts[own]
            came[i[own], j[own]] |= 1 << g
        i, j = np.nonzero(came)
        total, came = known[i, j], came[i, j]
        del known
        q, x = _matrix(queries["vector"]), _matrix(candidates["vector"])
        ends = [q.shape[1] * g // GROUPS for g in range(GROUPS + 1)]
        for g, (start, end) in enumerate(zip(ends, ends[1:])):
            missing = np.flatnonzero((came & (1 << g)) == 0)
            for part in np.array_split(missing, -(-len(missing) // RESOLVED_AT_ONCE) or 1):
                total[part] += np.einsum("ij,ij->i", q[i[part], start:end], x[j[part], start:end])
        reach = total >= queries["cutoff"].to_numpy(np.float64)[i]
        found = candidates.loc[j[reach], ["class", "named", "first", "first_row"]].reset_index(drop=True)
        found.insert(0, "query", at[i[reach]])
        found.insert(2, "score", np.rint(total[reach]).astype(np.int64))
        ranked = found.sort_values(["query", "score", "named", "first", "first_row"], ascending=[True, False, True, True, True])
        return ranked[ranked.groupby("query").cumcount() < k]

    return resolve


class Blocks:
    """Queries and candidates in blocks: every block of the one meets every block of the other of equal length."""

    def __init__(self, queries: DataFrame, candidates: DataFrame):
        self.queries = max(1, -(-queries.count() // QUERY_BLOCK))
        self.candidates = max(1, -(-candidates.count() // CANDIDATE_BLOCK))

    def _spread(self, df: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        block = F.pmod(F.xxhash64("class"), F.lit(n)).cast("int")
        return df.withColumn(own, block).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(m - 1))))

    def of_queries(self, df: DataFrame) -> DataFrame:
        return self._spread(df, "qb", self.queries, "cb", self.candidates)

    def of_candidates(self, df: DataFrame) -> DataFrame:
        return self._spread(df, "cb", self.candidates, "qb", self.queries)

    def by_group(self, queries: DataFrame, candidates: DataFrame, work, schema: str) -> DataFrame:
        """Each group of components of each pair of blocks in a task of its own, which sees no other group."""
        keys = "d", "g", "qb", "cb"
        left, right = self.of_queries(_grouped(queries)), self.of_candidates(_grouped(candidates))
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(work, schema)


def _grouped(df: DataFrame) -> DataFrame:
    """A row for each group of components, with this group's part of the vector only."""
    start, end = (F.floor(F.col("d") * g / GROUPS).cast("int") for g in (F.col("g"), F.col("g") + 1))
    dealt = df.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(GROUPS - 1))))
    return dealt.withColumn("part", F.slice("vector", start + 1, end - start)).drop("vector")


def cutoffs(blocks: Blocks, queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """Phase one: the queries with a ``cutoff`` that their k-th best score reaches; very low where there are fewer.

    The best entries of each group's list are resolved as in phase three, and the k-th best of any
    entries is safe.
    """
    lowest = F.lit(float(-(1 << 100)))
    best = Window.partitionBy("query", "g").orderBy(F.desc("part"), "class")
    listed = blocks.by_group(queries, candidates, _listed(k), LISTED).withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= LISTS * k)
    entries = listed.groupBy("d", "qb", "cb", "query", "g").agg(F.collect_list(F.struct("class", "part")).alias("_e")).select(
        "d", "qb", "cb", "query", "g", F.col("_e.class").alias("classes"), F.col("_e.part").alias("parts")
    )
    known = resolved(blocks, queries.withColumn("cutoff", lowest), candidates, stage(entries, "lists"), k)
    ranked = Window.partitionBy("query").orderBy(F.desc("score"))
    kth = known.withColumn("_n", F.row_number().over(ranked)).where(F.col("_n") == k)
    found = stage(kth.select(F.col("query").alias("class"), F.col("score").cast("double").alias("cutoff")), "cutoffs")
    return queries.join(found, "class", "left").withColumn("cutoff", F.coalesce("cutoff", lowest))


def sufficient(blocks: Blocks, asked: DataFrame, candidates: DataFrame) -> DataFrame:
    """Phase two: for every query and group, the candidates with a partial score of at least cutoff / m, by block."""
    return blocks.by_group(asked, candidates, _reaching, SUFFICIENT)


def resolved(blocks: Blocks, asked: DataFrame, candidates: DataFrame, entries: DataFrame, k: int) -> DataFrame:
    """Phase three: exact scores of the sufficient entries that reach the cutoff, of each block the k best of a query."""
    columns = "class", "d", "vector", "named", "first", "first_row"
    left = blocks.of_queries(asked.select(*columns, "cutoff", F.lit(True).alias("asked"))).unionByName(
        blocks.of_candidates(candidates.select(*columns, F.lit(0.0).alias("cutoff"), F.lit(False).alias("asked")))
    )
    keys = "d", "qb", "cb"
    return left.groupBy(*keys).cogroup(entries.groupBy(*keys)).applyInPandas(_resolved(k), TOTALS)


def top_k(vectors: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = 20, scale: int = 64) -> DataFrame:
    """Columns ``query_id``, ``rank`` (from 1), ``key`` and ``score``: each query's k best other rows.

    Components become ``floor(scale * x)``, x as a double, and the score is the integer inner
    product, exact while sums stay below 2^53; ties go to the smaller key. Only vectors of equal length are compared. Null vectors and
    those with null or non-finite components take no part. A query's own row is left out, other rows
    of the same key are not. Equal integer vectors are scored once: the k + 1 smallest rows of such a
    class are enough to fill any answer. An empty table gives no rows.
    """
    source = vectors.select(
        F.col(key).cast("long").alias("key"), F.coalesce(is_query, F.lit(False)).alias("asked"), F.col(vector).cast("array<double>").alias("x"),
        F.monotonically_increasing_id().alias("row"),
    )
    usable = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = source.where(F.col("x").isNotNull() & usable & (F.size("x") > 0)).select(
        "key", "row", "asked", F.transform("x", lambda v: F.floor(v * scale)).alias("vector")
    ).withColumn("hash", F.xxhash64("vector"))
    rows = stage(rows, "rows")
    # The smallest row of a class decides between equal scores.
    first = F.min(F.struct(F.col("key").isNotNull().alias("named"), F.coalesce("key", F.lit(0)).alias("first"), F.col("row").alias("first_row")))
    classes = stage(
        rows.groupBy("hash", "vector").agg(F.max("asked").alias("asked"), first.alias("_first"))
        .select("hash", "vector", "asked", "_first.*", F.size("vector").alias("d"), F.monotonically_increasing_id().alias("class")), "classes",
    )
    members = stage(rows.join(classes.select("hash", "vector", "class"), ["hash", "vector"]).select("class", "key", "row", "asked"), "members")
    order = Window.partitionBy("class").orderBy("key", "row")
    few = members.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k + 1).select("class", "key", "row")
    few = stage(few, "few")

    columns = "class", "d", "vector", "named", "first", "first_row"
    queries, candidates = classes.where("asked").select(*columns), classes.select(*columns)
    blocks = Blocks(queries, candidates)
    # The query's class counts too but for the query itself, so one entry more is taken.
    asked = stage(cutoffs(blocks, queries, candidates, k + 1), "asked")
    totals = resolved(blocks, asked, candidates, sufficient(blocks, asked, candidates), k + 1)
    best = Window.partitionBy("query").orderBy(F.desc("score"), "named", "first", "first_row")
    entries = totals.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k + 1).select("query", "class", "score")
    entries = stage(entries, "entries")

    # Answers per class of queries: the k + 1 best rows, then each query without its own row.
    ranked = Window.partitionBy("query").orderBy(F.desc("score"), "key", "row")
    answers = stage(
        entries.join(few, "class").withColumn("_n", F.row_number().over(ranked)).where(F.col("_n") <= k + 1).drop("_n", "class"), "answers"
    )
    each = members.where("asked").select(F.col("class").alias("query"), F.col("key").alias("query_id"), F.col("row").alias("own"))
    left = each.join(answers, "query").where("row <> own")
    final = Window.partitionBy("own").orderBy(F.desc("score"), "key", "row")
    return left.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k).select(
        "query_id", "rank", F.col("key").alias(key), "score"
    )
