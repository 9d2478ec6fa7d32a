"""Joins, set operations and reshaping."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.operators.order import row_ids
from surveyloom.schemas import RANKS, SAMPLE_KEY
from surveyloom.session import join_lookup, stage


def null_safe_join(left: DataFrame, right: DataFrame, keys: Iterable[str], how: str = "inner") -> DataFrame:
    """Join that matches NULL keys to NULL and keeps one copy of the keys."""
    keys = list(keys)
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = [F.col(f"`{k}`").eqNullSafe(F.col(f"`_r_{k}`")) for k in keys]
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def with_samples(catch: DataFrame, env: DataFrame) -> DataFrame:
    """Catch rows with their sample columns; rows without a sample stay."""
    extra = [c for c in env.columns if c in SAMPLE_KEY or c not in catch.columns]
    return catch.join(env.select(*extra), list(SAMPLE_KEY), "left")


def totals_before_after(after: DataFrame, before: DataFrame, key: str = "SampleID") -> DataFrame:
    """Full outer join of two per-sample tables."""
    return after.join(before, key, "full")


def without_listed(df: DataFrame, listed: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Rows whose key is not in a (small, counted) list; missing keys match missing keys."""
    keys = list(keys)
    return join_lookup(df, listed.select(*keys).distinct(), keys, "left_anti", keys)


def keep_ids(df: DataFrame, ids: DataFrame, column: str, id_column: str) -> DataFrame:
    """Rows whose id occurs in another result; an id that occurs there often is moved once."""
    return df.join(ids.select(F.col(id_column).alias("_id")).distinct(), F.col(column) == F.col("_id"), "left_semi")


def present_in_both(df: DataFrame, key: str, a: str, b: str, by: str = "SizeClass") -> DataFrame:
    """Keys that occur in both groups, found with one combinable aggregate."""
    found = df.groupBy(key).agg(F.bool_or(F.col(by) == a).alias("_a"), F.bool_or(F.col(by) == b).alias("_b"))
    return found.filter("_a AND _b").select(key)


def union_ragged(*frames: DataFrame) -> DataFrame:
    """Stack frames by column name; absent columns are NULL, duplicates stay."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first


def shared_columns(a: DataFrame, b: DataFrame) -> list[str]:
    """Columns of ``a`` that ``b`` has too, in the order of ``a``."""
    return [c for c in a.columns if c in b.columns]


def explode_report(report: DataFrame, column: str = "message") -> DataFrame:
    """Split ``"reason: name (Size), name (Size)"`` texts into one row per taxon and size class."""
    text = F.col(column)
    tail = F.substr(text, F.instr(text, F.lit(": ")) + 2)  # names may hold the separator themselves
    items = report.select(F.explode(F.split(tail, ", ")).alias("_item"))
    return items.select(
        F.regexp_replace("_item", r"\s*\([^)]+\)", "").alias("Taxlifestage"),
        F.regexp_extract("_item", r"\(([^)]+)\)", 1).alias("SizeClass"),
    )


def rank_table(lineage: DataFrame, skip: Iterable[str] = ("Gnathostomata",)) -> DataFrame:
    """One row per query with a column per rank from (query, rank, name) rows."""
    named = lineage.filter(~F.col("name").isin(list(skip)) & F.col("rank").isin(list(RANKS)))
    return named.groupBy("query").pivot("rank", list(RANKS)).agg(F.min("name"))


def list_chunks(df: DataFrame, group: str, values: Iterable[str], size: int = 1024) -> DataFrame:
    """Sorted distinct values per group as lists of at most ``size``: ``group``, ``Chunk`` from 0, ``Items``.

    Rows are numbered by ranges of group and values, so neither a task nor a row holds a whole group.
    ``Items`` are structs of the values in order; missing groups and values come last.
    """
    values = list(values)
    numbered = row_ids(df.select(group, *values).distinct(), [group, *values], "_id")
    numbered = stage(numbered, "numbered")
    first = numbered.groupBy(group).agg(F.min("_id").alias("_first"))
    placed = join_lookup(numbered, first, [group], "left", [group])
    chunk = F.floor((F.col("_id") - F.col("_first")) / size).cast("long").alias("Chunk")
    listed = placed.groupBy(group, chunk).agg(F.sort_array(F.collect_list(F.struct("_id", *values))).alias("_items"))
    return listed.select(group, "Chunk", F.transform("_items", lambda i: F.struct(*[i[v].alias(v) for v in values])).alias("Items"))


def set_per_group(df: DataFrame, group: str, value: str) -> DataFrame:
    """Sorted distinct values per group as a list; for values from a bounded vocabulary."""
    return df.select(group, value).distinct().groupBy(group).agg(
        F.sort_array(F.collect_list(value)).alias(value)
    )
