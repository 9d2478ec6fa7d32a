"""Conservation check: nothing is lost or counted twice outside the taxa reported as removed."""

from __future__ import annotations

from pyspark.sql import DataFrame

from surveyloom.functions.classes import taxlifestage
from surveyloom.operators.synth import Synth, synthesize
from surveyloom.operators.validate import compare_totals, without_removed


def labelled(catch: DataFrame) -> DataFrame:
    return catch.withColumn("Taxlifestage", taxlifestage())


def plain_run(catch: DataFrame, env: DataFrame, **options) -> Synth:
    return synthesize(catch, env, "Community", env_columns=(), **options)


def check_unfiltered(catch: DataFrame, env: DataFrame, **options) -> DataFrame:
    """Totals of the plain run, before and after."""
    return compare_totals(plain_run(catch, env, **options).data, labelled(catch))


def check_filtered(catch: DataFrame, env: DataFrame, **options) -> DataFrame:
    """Totals of a run on the catch without the taxa that a first run reports as removed."""
    removed = plain_run(catch, env, **options).caveats.filter("kind = 'removed'").select("SizeClass", "Taxlifestage")
    kept = without_removed(labelled(catch), removed)
    return compare_totals(plain_run(kept, env, **options).data, kept)
