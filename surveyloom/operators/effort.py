"""Sampling effort per survey, month and year."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.functions.missing import level
from surveyloom.schemas import SOURCES


def complete_grid(df: DataFrame, levels: dict[str, Iterable], observed: str) -> DataFrame:
    """Every combination of the declared levels with every observed value of one column.

    The levels are unrolled next to each observed value, so no product of tables is planned.
    """
    grid = df.select(observed).distinct()
    for column, values in levels.items():
        grid = grid.withColumn(column, F.explode(F.array(*[F.lit(v) for v in values])))
    return grid.join(df, [observed, *levels], "left")


def effort_grid(env: DataFrame, sources: Iterable[str] = SOURCES) -> DataFrame:
    """Mean number of samples per station for every survey, month and year; NULL where none was taken."""
    sources = list(sources)
    known = env.withColumns({"Source": level("Source", sources), "Month": F.month("Date")}).filter(
        "Source IS NOT NULL"
    )
    per_station = known.groupBy("Source", "Month", "Year", "Station").agg(F.count(F.lit(1)).alias("N"))
    per_month = per_station.groupBy("Source", "Month", "Year").agg(F.avg("N").alias("N"))
    return complete_grid(per_month, {"Source": sources, "Month": range(1, 13)}, "Year")


def effort_by_year(grid: DataFrame) -> DataFrame:
    return grid.groupBy("Source", "Year").agg(F.avg("N").alias("N")).filter("N IS NOT NULL")


def first_years(start_dates: DataFrame) -> DataFrame:
    return start_dates.groupBy("Source").agg(F.year(F.min("Startdate")).alias("StartYear"))


def effort_by_month(grid: DataFrame, start_dates: DataFrame) -> DataFrame:
    """Mean monthly effort since the survey began, months without samples counting as 0."""
    since = grid.join(first_years(start_dates), "Source", "left").filter("Year >= StartYear")
    return (
        since.groupBy("Source", "Month").agg(F.avg(F.coalesce("N", F.lit(0.0))).alias("N")).filter("N > 0")
    )
