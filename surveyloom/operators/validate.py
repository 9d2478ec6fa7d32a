"""Conservation of total catch through the community roll-up."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.functions.missing import near, not_in, sum_strict
from surveyloom.operators.combine import totals_before_after, without_listed
from surveyloom.operators.models import lm_global


def sample_totals(df: DataFrame, name: str) -> DataFrame:
    """Total CPUE per sample, missing if any catch is missing."""
    return df.groupBy("SampleID").agg(sum_strict("CPUE").alias(name))


def compare_totals(after: DataFrame, before: DataFrame, exclude_samples: Iterable = ()) -> DataFrame:
    """Per-sample totals after and before, side by side."""
    paired = totals_before_after(sample_totals(after, "CPUE_com"), sample_totals(before, "CPUE_base"))
    exclude_samples = list(exclude_samples)
    return paired.filter(not_in("SampleID", exclude_samples)) if exclude_samples else paired


def verdict(totals: DataFrame) -> DataFrame:
    """One row: number of samples, how many totals differ, and whether all agree."""
    same = F.coalesce(near("CPUE_com", "CPUE_base"), F.lit(False))
    return totals.agg(
        F.count(F.lit(1)).alias("N_samples"), F.count_if(~same).alias("N_differ"),
        F.coalesce(F.bool_and(same), F.lit(True)).alias("Conserved"),
    )


def totals_fit(totals: DataFrame) -> DataFrame:
    """Least squares of the totals after on those before: slope 1 and intercept 0 where nothing is lost.

    Samples without one of the totals are left out.
    """
    return lm_global(totals, "CPUE_com", "CPUE_base")


def offending(totals: DataFrame) -> DataFrame:
    return totals.filter(~F.coalesce(near("CPUE_com", "CPUE_base"), F.lit(False)))


def without_removed(catch: DataFrame, removed: DataFrame) -> DataFrame:
    """Catch rows whose size class and taxon label were not reported as removed."""
    return without_listed(catch, removed, ["SizeClass", "Taxlifestage"])
