"""Paired-gear comparison: shared taxa and samples, shares, wide tables, standardised columns."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyloom.functions.missing import paste, row_sum, sum_na_rm
from surveyloom.functions.text import italic
from surveyloom.operators.combine import null_safe_join
from surveyloom.schemas import SAMPLE_KEY
from surveyloom.session import join_lookup, stage

# Taxon names set in italics on the comparison labels.
ITALIC_TAXA = (
    "Asplanchna", "Keratella", "Limnoithona", "Limnoithona sinensis", "Limnoithona tetraspina",
    "Oithona", "Oithona davisae", "Oithona similis", "Polyarthra", "Synchaeta",
    "Synchaeta bicornis", "Trichocerca", "Eurytemora affinis", "Pseudodiaptomus",
    "Sinocalanus doerrii",
)


NARROW = (*SAMPLE_KEY, "SizeClass", "Taxname", "Lifestage", "Taxlifestage", "CPUE")


def _in_both(rows: DataFrame, key: str, a: str) -> DataFrame:
    """Values of ``key`` that both gears have: a bit for each gear, merged before the shuffle."""
    bit = F.when(F.col("SizeClass") == a, F.lit(1)).otherwise(F.lit(2))
    return rows.groupBy(key).agg(F.bit_or(bit).alias("_gears")).filter("_gears = 3").select(key)


def comparable_rows(catch: DataFrame, a: str = "Micro", b: str = "Meso") -> DataFrame:
    """Rows of two gears: first the taxa both caught, then the samples both took of those.

    The catches are read once, into a written table of the two gears' rows on which both are decided.
    """
    both = catch.filter(F.col("SizeClass").isin(a, b)).select(*[c for c in NARROW if c in catch.columns])
    both = stage(both, "gears")
    taxa = join_lookup(both, _in_both(both, "Taxlifestage", a), ["Taxlifestage"], "left_semi")
    return taxa.join(_in_both(taxa, "SampleID", a), "SampleID", "left_semi")


def gear_proportion(rows: DataFrame) -> DataFrame:
    """Each gear's share of the total CPUE per taxon and life stage, with the detections."""
    keys = ["Taxname", "Lifestage", "Taxname_label"]
    labelled = rows.withColumn("Taxname_label", italic("Taxname", ITALIC_TAXA))
    sums = labelled.groupBy("SizeClass", *keys).agg(
        F.count_if(F.col("CPUE") > 0).alias("_n"), sum_na_rm("CPUE").alias("CPUE")
    )
    # At most one row per gear and taxon reaches the window.
    taxon = Window.partitionBy(*keys)
    return sums.withColumns({
        "Total": F.sum("CPUE").over(taxon), "N_detect": F.sum("_n").over(taxon)
    }).withColumn("Proportion", F.try_divide("CPUE", "Total")).drop("_n")


def pivot_gear(rows: DataFrame, a: str = "Meso", b: str = "Micro") -> DataFrame:
    """Log CPUE of both gears side by side per sample and taxon."""
    # One aggregate of two sums; a pivot would aggregate by size class first and hold both.
    wide = rows.groupBy(*SAMPLE_KEY, "Taxlifestage").agg(*[F.sum(F.when(F.col("SizeClass") == g, F.col("CPUE"))).alias(g) for g in (a, b)])
    return wide.select(*SAMPLE_KEY, "Taxlifestage", F.log1p(a).alias(f"{a}_l"), F.log1p(b).alias(f"{b}_l"))


def log1p_block(df: DataFrame, columns: Iterable[str], suffix: str = "_l") -> DataFrame:
    return df.withColumns({f"{c}{suffix}": F.log1p(F.col(f"`{c}`")) for c in columns})


def standardize(df: DataFrame, columns: dict[str, str], strict: Iterable[str] = ()) -> DataFrame:
    """Add (x − mean) / sd for every ``{column: new name}``; the moments come from one aggregate.

    Missing values are left out of the moments, except in ``strict`` columns: there one missing value
    leaves the whole column without a result.
    """
    strict = set(strict)

    def moment(function, column: str) -> Column:
        value = function(f"`{column}`")
        return F.when(F.count(f"`{column}`") == F.count(F.lit(1)), value) if column in strict else value

    moments = df.agg(F.struct(*[
        part for i, c in enumerate(columns)
        for part in (moment(F.avg, c).alias(f"m{i}"), moment(F.stddev_samp, c).alias(f"s{i}"))
    ]).alias("moments")).scalar()
    return df.withColumns({
        new: F.try_divide(F.col(f"`{c}`") - moments[f"m{i}"], moments[f"s{i}"])
        for i, (c, new) in enumerate(columns.items())
    })


def prepare_gear(
    matrix: DataFrame, taxa: list[str], gear: str, total_of: list[str] | None = None, standardized: bool = True
) -> DataFrame:
    """One gear's matrix with an id per tow and suffixed, logged and standardised taxon columns.

    With ``total_of`` the total catch over those taxa (CPUE × volume) is added, also standardised.
    """
    named = matrix.withColumn("SampleID", paste("Date", "Station"))
    total = f"Catch_total_{gear}"
    if total_of:
        named = named.withColumn(total, row_sum(total_of) * F.col("Volume"))
    suffixed = named.withColumnsRenamed({t: f"{t}_{gear}" for t in taxa}).drop("Volume")
    logged = log1p_block(suffixed, [f"{t}_{gear}" for t in taxa])
    if not standardized:
        return logged
    scaled = {f"{t}_{gear}_l": f"{t}_{gear}_l_s" for t in taxa}
    return standardize(logged, scaled | ({total: f"{total}_s"} if total_of else {}), strict=scaled)


def pair_gears(a: DataFrame, b: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Tows made with both gears; missing conditions match each other."""
    return null_safe_join(a, b, keys, "inner")


def tow_matrix(rows: DataFrame, ids: Iterable[str], gears: dict[str, str], name: str, values: list[str]) -> DataFrame:
    """One row per tow for all gears together, written once: a column per gear and value of ``name``.

    ``gears`` maps a suffix to a size class. Columns are ``{value}_{gear}`` (0 where not caught),
    ``Volume_{gear}`` and ``_has_{gear}``, whether the gear was towed. Missing ids are ids too.
    """
    sums = []
    for gear, size in gears.items():
        own = F.col("SizeClass") == size
        cells = [F.coalesce(F.sum(F.when(own & (F.col(name) == v), F.col("CPUE"))), F.lit(0.0)).alias(f"{v}_{gear}") for v in values]
        sums += [*cells, F.sum(F.when(own, F.col("Volume"))).alias(f"Volume_{gear}"), F.coalesce(F.bool_or(own), F.lit(False)).alias(f"_has_{gear}")]
    kept = rows.filter(F.col("SizeClass").isin(list(gears.values())))
    return stage(kept.groupBy(*ids).agg(*sums), "tows")


def paired_tows(tows: DataFrame, gears: Iterable[str], values: list[str], total_gear: str | None = None) -> DataFrame:
    """Tows made with all gears, with ids, logged catches and the total catch of one gear, standardised.

    As all gears of a tow are one row, pairing them is a filter. The moments of the total are those of
    all tows of that gear, paired or not.
    """
    gears = list(gears)
    wide = tows.withColumn("SampleID", paste("Date", "Station"))
    if total_gear:
        total = f"Catch_total_{total_gear}"
        wide = wide.withColumn(total, row_sum([f"{v}_{total_gear}" for v in values]) * F.col(f"Volume_{total_gear}"))
        towed = F.when(F.col(f"_has_{total_gear}"), F.col(total))
        moments = wide.agg(F.struct(F.avg(towed).alias("m"), F.stddev_samp(towed).alias("s")).alias("moments")).scalar()
        wide = wide.withColumn(f"{total}_s", F.try_divide(F.col(total) - moments["m"], moments["s"]))
    both = reduce(lambda x, y: x & y, [F.col(f"_has_{g}") for g in gears])
    logged = log1p_block(wide.filter(both), [f"{v}_{g}" for g in gears for v in values])
    return logged.drop(*[f"{c}_{g}" for g in gears for c in ("Volume", "_has")])


def gear_matrix(rows: DataFrame, name: str, values: list[str], ids: list[str]) -> DataFrame:
    """Wide tow table: a column per declared taxon, 0 where it was not caught."""
    wide = rows.groupBy(*ids).pivot(name, values).agg(F.sum("CPUE"))
    return wide.fillna(0.0, subset=values)
