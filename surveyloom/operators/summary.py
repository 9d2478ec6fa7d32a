"""Lineage summaries: a small table kept beside the catches, which menus, counts and caveats read instead.

A row is a lineage of a survey with its years as bits of 64-year blocks, its catches and its
detections. All of these can be merged, so new samples are summarised alone, as a batch of their own,
and readers merge the batches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.operators import synth
from surveyloom.schemas import LINEAGE_KEY, RANKS
from surveyloom.session import stage

KEY = ("Source", *LINEAGE_KEY, "_block")
SUMMARY = ", ".join(f"`{c}` string" for c in ("Source", *LINEAGE_KEY)) + ", _block int, _years long, N_rows long, N_detect long"


def summarize(catch: DataFrame, batch: Column | None = None) -> DataFrame:
    """Summary of catch rows with their ``Year``, one for each value of ``batch``; map-side sums come first."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("Year", F.lit(synth.YEARS)))
    block = F.floor(F.col("Year") / synth.YEARS).cast("int").alias("_block")
    own = [] if batch is None else [F.coalesce(batch.cast("string"), F.lit("none")).alias("batch")]
    return catch.groupBy(*own, *KEY[:-1], block).agg(
        F.bit_or(bit).alias("_years"), F.count(F.lit(1)).alias("N_rows"), F.count_if(F.col("CPUE") > 0).alias("N_detect")
    )


def merge(summaries: DataFrame) -> DataFrame:
    """One summary of the rows of several."""
    return summaries.groupBy(*KEY).agg(
        F.bit_or("_years").alias("_years"), F.sum("N_rows").alias("N_rows"), F.sum("N_detect").alias("N_detect")
    )


def write_batches(catch: DataFrame, folder: str, batch: Column) -> None:
    """Summarise the catches of new or changed batches into ``folder``, in one pass over them.

    A batch must come whole. It replaces what the folder holds of it and leaves the others alone, so a
    repeated run counts nothing twice.
    """
    summarize(catch, batch).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(folder)


def read_summary(spark: SparkSession, folder: str) -> DataFrame:
    """The merged summary of all batches; missing names and years stay missing."""
    return merge(spark.read.schema(SUMMARY + ", batch string").parquet(folder))


def taxa_labels(summary: DataFrame) -> DataFrame:
    """Every taxon and group that Taxa mode gives, with lineage, type and label, without reading a catch."""
    cover = synth.coverage(summary)
    targets = stage(synth.with_target_lineages(synth.group_map(summary, cover).unionByName(synth.own_map(summary))), "targets")
    lead = targets.filter("_lead").select(*synth.TARGET_KEY, *[F.col(f"_t_{r}").alias(r) for r in RANKS])
    return synth.named_targets(lead).select("SizeClass", "Lifestage", *RANKS, "Taxname", "Taxatype", "Taxlifestage")


def community_caveats(summary: DataFrame, timing: synth.Timing | None = None) -> DataFrame:
    """The caveats of Community mode over all samples of the summary."""
    mapping = stage(synth.community_map(summary, synth.coverage(summary, timing)), "targets")
    return synth.community_caveats(summary, mapping, timing)


def detections(summary: DataFrame) -> DataFrame:
    """Positive catches per taxon and life stage label."""
    return summary.groupBy(synth.taxlifestage().alias("Taxlifestage")).agg(F.sum("N_detect").alias("N_detect"))
