"""Row selection with the reference semantics of missing values."""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.functions.missing import in_set, not_in
from surveyloom.schemas import RANKS
from surveyloom.session import join_lookup


def between(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    """Inclusive range; an open bound is None, and missing values drop only when a bound is set."""
    for bound, test in ((low, F.col(column).__ge__), (high, F.col(column).__le__)):
        if bound is not None:
            df = df.filter(test(bound))
    return df


def date_between(df: DataFrame, column: str, start=None, end=None) -> DataFrame:
    """Inclusive date range given as dates or ISO texts."""
    as_date = lambda d: None if d is None else F.lit(str(d)).cast("date")
    return between(df, column, as_date(start), as_date(end))


def taxon_in(taxa: Iterable[str]) -> Column:
    """A name or any rank value is among ``taxa``."""
    taxa = list(taxa)
    test = in_set("Taxname", taxa)
    for rank in RANKS:
        test = test | in_set(rank, taxa)
    return test


@dataclass(frozen=True)
class SampleFilter:
    """Filters on the sample side; None leaves a filter off."""

    dates: tuple | None = None
    months: tuple[int, ...] | None = None
    sal_surf: tuple | None = None
    latitude: tuple | None = None
    longitude: tuple | None = None

    @property
    def active(self) -> bool:
        return any(v is not None for v in (self.dates, self.months, self.sal_surf, self.latitude, self.longitude))

    def bounded(self, stored: DataFrame) -> DataFrame:
        """Two-sided limits on stored columns, before NaN is read as missing, so that a scan can skip by them.

        NaN is above every number and so outside of any two limits.
        """
        for column, limits in (("SalSurf", self.sal_surf), ("Latitude", self.latitude), ("Longitude", self.longitude)):
            if limits and any(limit is not None for limit in limits):
                low, high = (limit if limit is not None else end for limit, end in zip(limits, (-math.inf, math.inf)))
                stored = stored.filter((F.col(column) >= F.lit(float(low))) & (F.col(column) <= F.lit(float(high))))
        return date_between(stored, "Date", *self.dates) if self.dates else stored

    def apply(self, env: DataFrame) -> DataFrame:
        if self.dates:
            env = date_between(env, "Date", *self.dates)
        if self.months is not None:
            env = env.filter(F.month("Date").isin(list(self.months)))
        for column, limits in (("SalSurf", self.sal_surf), ("Latitude", self.latitude), ("Longitude", self.longitude)):
            if limits:
                env = between(env, column, *limits)
        return env


def select_catch(
    catch: DataFrame,
    sources: Iterable[str] | None = None,
    size_classes: Iterable[str] | None = None,
    taxa: Iterable[str] | None = None,
) -> DataFrame:
    """Filters on the catch side, all pushed to the scan."""
    if sources is not None:
        catch = catch.filter(F.col("Source").isin(list(sources)))
    if size_classes is not None:
        catch = catch.filter(F.col("SizeClass").isin(list(size_classes)))
    return catch if taxa is None else catch.filter(taxon_in(taxa))


def with_coordinates(df: DataFrame) -> DataFrame:
    return df.filter(F.col("Latitude").isNotNull() & F.col("Longitude").isNotNull())


def without(df: DataFrame, column: str, values: Iterable[str]) -> DataFrame:
    """NOT IN that keeps rows whose value is missing."""
    return df.filter(not_in(column, values))


def drop_undersampled(df: DataFrame, on: bool = True) -> DataFrame:
    return df.filter(~F.col("Undersampled")) if on else df


def select_or_all(df: DataFrame, column: str, wanted: Iterable[str], values: DataFrame | None = None) -> DataFrame:
    """Rows with the wanted values, or every row when a wanted value does not occur in the data.

    The test is a scalar subquery: at most one row per wanted value is counted. It reads ``values``, a
    table of all values such as the labels of a summary, where there is one.
    """
    wanted = sorted(set(wanted))
    if not wanted:
        return df
    found = (df if values is None else values).filter(F.col(column).isin(wanted)).agg(F.count_distinct(column)).scalar()
    return df.filter((found < len(wanted)) | F.col(column).isin(wanted))


def drop_missing(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    return df.dropna(how="any", subset=None if columns is None else list(columns))


def drop_blank(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.dropna(how="all", subset=list(columns))


def groups_with_data(df: DataFrame, keys: Iterable[str], value: str) -> DataFrame:
    """Rows of the groups whose values do not sum to zero."""
    keys = list(keys)
    filled = df.groupBy(*keys).agg(F.sum(value).alias("_total")).filter("_total <> 0").select(*keys)
    return df.join(filled, keys, "left_semi")


def flag_undersampled(df: DataFrame, undersampled: DataFrame) -> DataFrame:
    """Add ``Undersampled`` from the list of size class, taxon and life stage."""
    listed = undersampled.distinct().withColumn("_listed", F.lit(True))
    joined = join_lookup(df, listed, ["SizeClass", "Taxname", "Lifestage"], null_safe=["SizeClass", "Taxname", "Lifestage"])
    return joined.withColumn("Undersampled", F.coalesce("_listed", F.lit(False))).drop("_listed")
