"""The questions asked of a synthesis: sample counts, CPUE by year, maps, menus and legends."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.functions.classes import group_or_name, lump_other, major_group, menu_group, salinity_zone
from surveyloom.functions.missing import round_even, signif, sum_na_rm
from surveyloom.functions.text import thousands, tooltip_table
from surveyloom.operators.filters import drop_undersampled, with_coordinates
from surveyloom.operators.order import row_ids
from surveyloom.schemas import LOW_SALINITY_ZONE, MAJOR_GROUPS, RANKS
from surveyloom.session import stage

PLACE = ("Latitude", "Longitude")
LARGEST_RADIUS = 22


def of_sizes(data: DataFrame, size_classes: Iterable[str] | None) -> DataFrame:
    return data if size_classes is None else data.filter(F.col("SizeClass").isin(list(size_classes)))


def mean_cpue(data: DataFrame, keys: Iterable[str]) -> DataFrame:
    return data.groupBy(*keys).agg(F.avg("CPUE").alias("CPUE"))


def taxa_map(
    data: DataFrame, size_classes: Iterable[str] | None = None, hide_undersampled: bool = True
) -> DataFrame:
    """Mean CPUE per taxon, year and place."""
    shown = drop_undersampled(of_sizes(with_coordinates(data), size_classes), hide_undersampled)
    return mean_cpue(shown, ["Taxlifestage", "Year", *PLACE])


def community_map(
    data: DataFrame,
    lifestages: Iterable[str],
    groups: Iterable[str] = MAJOR_GROUPS,
    size_classes: Iterable[str] | None = None,
    hide_undersampled: bool = True,
) -> DataFrame:
    """CPUE per major group, year and place: summed within a sample, then averaged over samples."""
    shown = drop_undersampled(of_sizes(with_coordinates(data), size_classes), hide_undersampled)
    shown = shown.filter(F.col("Lifestage").isin(list(lifestages)))
    spots = ["Year", *PLACE, "SampleID"]
    # The choice of groups or names needs the groups first, so the sums both need are written once.
    sums = stage(
        shown.groupBy(lump_other(major_group(), groups).alias("Group"), "Taxname", *spots)
        .agg(sum_na_rm("CPUE").alias("CPUE")), "community-map",
    )
    keys = ["Taxa", "Year", *PLACE]
    per_sample = group_or_name(sums).groupBy(*keys, "SampleID").agg(F.sum("CPUE").alias("CPUE"))
    return mean_cpue(per_sample, keys).withColumn("CPUE", round_even("CPUE"))


def zoned(data: DataFrame, zones: tuple[float, float] | None) -> DataFrame:
    """Add the salinity zone to rows with a salinity."""
    return data if zones is None else data.filter("SalSurf IS NOT NULL").withColumn(
        "Salinity_zone", salinity_zone("SalSurf", min(zones), max(zones))
    )


def cpue_by_taxon_year(
    data: DataFrame, size_classes: Iterable[str] | None = None, zones: tuple[float, float] | None = None
) -> DataFrame:
    """Mean CPUE per taxon and year (and zone). Undersampled rows stay in this view."""
    keys = ["Taxlifestage", "Year", *(["Salinity_zone"] if zones else [])]
    return mean_cpue(zoned(of_sizes(data, size_classes), zones), keys)


def cpue_by_lineage_year(
    data: DataFrame,
    size_classes: Iterable[str] | None = None,
    zones: tuple[float, float] | None = LOW_SALINITY_ZONE,
    hide_undersampled: bool = True,
) -> DataFrame:
    """Mean CPUE per year, full lineage and life stage (and zone)."""
    shown = drop_undersampled(of_sizes(data, size_classes), hide_undersampled)
    keys = ["Year", *RANKS, "Lifestage", "Taxlifestage", *(["Salinity_zone"] if zones else [])]
    return mean_cpue(zoned(shown, zones), keys)


def sample_counts(data: DataFrame, month: Column | None = None) -> DataFrame:
    """Samples with a positive catch per survey, year and month."""
    month = F.month("Date") if month is None else month
    caught = data.filter("CPUE > 0").select("Source", "Year", month.alias("Month"), "SampleID").distinct()
    return caught.groupBy("Source", "Year", "Month").agg(F.count(F.lit(1)).alias("N_samples"))


def n_taxa(data: DataFrame, hide_undersampled: bool = False) -> DataFrame:
    """Number of distinct taxon and life stage labels, whatever the size class."""
    return drop_undersampled(data, hide_undersampled).agg(F.count_distinct("Taxlifestage").alias("N_taxa"))


def menu_tree(data: DataFrame) -> DataFrame:
    """Menu entries per group, numbered in order within the group. Only distinct labels are ordered."""
    entries = data.withColumn("Group", menu_group()).select(
        "Group", "Taxatype", "Taxname", "Lifestage", "Taxlifestage"
    ).distinct()
    first = entries.groupBy("Group", "Taxlifestage").agg(
        F.min(F.struct("Taxatype", "Taxname", "Lifestage")).alias("_o")
    )
    numbered = row_ids(
        first.select("Group", "Taxlifestage", "_o.*"),
        ["Group", "Taxatype", "Taxname", "Lifestage", "Taxlifestage"], name="_id",
    )
    start = numbered.groupBy("Group").agg(F.min("_id").alias("_first"))
    renamed = start.withColumnRenamed("Group", "_g")
    return numbered.join(renamed, F.col("Group").eqNullSafe(F.col("_g")), "left").select(
        "Group", (F.col("_id") - F.col("_first") + 1).alias("Position"), "Taxlifestage"
    )


def size_breaks(mapped: DataFrame) -> DataFrame:
    """Legend of the taxa map: a third, two thirds and all of the largest CPUE, to two digits."""
    largest = mapped.agg(F.max("CPUE").alias("Largest")).filter("Largest IS NOT NULL")
    thirds = F.explode(F.array(*[F.lit(f) for f in (1 / 3, 2 / 3, 1.0)]))
    return largest.select("Largest", thirds.alias("_f")).select(
        signif(F.col("Largest") * F.col("_f"), 2).alias("Break"), "Largest"
    ).select(
        "Break", (F.sqrt("Break") / F.sqrt("Largest") * LARGEST_RADIUS).alias("Radius")
    )


def legend_labels(breaks: DataFrame) -> DataFrame:
    """Text of every legend entry: whole numbers get thousands separators."""
    whole = F.col("Break") == F.floor("Break")
    return breaks.withColumn("Label", F.when(whole, thousands("Break")).otherwise(F.col("Break").cast("string")))


def with_tooltips(view: DataFrame, shown: dict[str, Column | str], keys: Iterable[str]) -> DataFrame:
    """Add ``ID``, the row's number in the order of ``keys`` as text, and ``tooltip``, a table of labelled values."""
    numbered = row_ids(view.withColumn("tooltip", tooltip_table(shown)), keys)
    return numbered.withColumn("ID", F.col("ID").cast("string"))


def marker_radius(mapped: DataFrame) -> DataFrame:
    """Marker radius of every map point, square-root scaled to the largest CPUE."""
    largest = mapped.agg(F.max("CPUE")).scalar()
    return mapped.withColumn("Radius", F.try_divide(F.sqrt("CPUE"), F.sqrt(largest)) * LARGEST_RADIUS)


def pivot_groups(mapped: DataFrame, groups: Iterable[str] = MAJOR_GROUPS) -> DataFrame:
    """One row per year and place with a column per group; absent cells are NULL."""
    return mapped.groupBy("Year", *PLACE).pivot("Taxa", list(groups)).agg(F.sum("CPUE"))
