"""Sorting, row numbers and level order without a single-task global window."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyloom.functions.missing import level_order
from surveyloom.session import stage


def arrange(df: DataFrame, *columns: str | Column) -> DataFrame:
    """Ascending sort with missing values last."""
    return df.orderBy(*[F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in columns])


def arrange_by_level(df: DataFrame, column: str, levels: Iterable[str], *then: str) -> DataFrame:
    """Descending by position in the level list; values outside the levels last."""
    return df.orderBy(level_order(column, levels).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in then])


def row_ids(df: DataFrame, keys: Iterable[str], name: str = "ID") -> DataFrame:
    """Row numbers 1..n in the order of ``keys``, missing values last; keys should order the rows fully.

    Rows are dealt into ranges of the keys and numbered inside each; only one count per range passes
    through the running total that shifts the ranges.
    """
    ascending = [F.col(k).asc_nulls_last() for k in keys]
    ranged = stage(df.repartitionByRange(*ascending).withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select(
        "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift")
    )
    inside = Window.partitionBy("_range").orderBy(*ascending)
    return (
        ranged.withColumn("_row", F.row_number().over(inside))
        .join(F.broadcast(shifts), "_range")  # one row per range
        .withColumn(name, F.col("_row") + F.col("_shift"))
        .drop("_row", "_shift", "_range")
    )


def level_index(df: DataFrame, label: str, sort_keys: Iterable[str]) -> DataFrame:
    """Levels of ``label`` numbered by first appearance after sorting on ``sort_keys``."""
    sort_keys = list(sort_keys)
    first = df.groupBy(label).agg(
        F.min(F.struct(*[part for k in sort_keys for part in (F.col(k).isNull().alias(f"_null_{k}"), F.col(k))])).alias("_o")
    ).select(label, *[F.col(f"_o.{k}").alias(f"_s_{k}") for k in sort_keys])
    ordered = [f"_s_{k}" for k in sort_keys] + [label]
    return row_ids(first, ordered, "Level").select(label, "Level")


def first_choice(df: DataFrame, column: str, levels: Iterable[str] | None = None) -> DataFrame:
    """First available value: smallest in the declared order, or in natural order without one."""
    if levels is None:
        return df.agg(F.min(column).alias(column))
    return df.agg(F.min_by(F.col(column), level_order(column, levels)).alias(column))
