"""Least-common-denominator synthesis of surveys with unequal taxonomic resolution.

All decisions are made on the table of distinct lineages, which one narrow pass over the catch
rows yields (with their years as bits, merged before the shuffle) and which is staged once. The
catch rows then become numbers of lineages, move once by sample and are summed there into their
targets; sample columns join the sums where they are, and names last.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from surveyloom.functions.classes import taxlifestage
from surveyloom.functions.missing import paste
from surveyloom.operators.filters import SampleFilter, select_catch
from surveyloom.schemas import INTRO_LAG_YEARS, LINEAGE_KEY, RANKS, SAMPLE_KEY
from surveyloom.session import join_lookup, stage, stage_counted

NULLABLE = LINEAGE_KEY
# A rank value is the same taxon in two lineages if its rank, name and path agree (see ``with_paths``).
VALUE_KEY = ("SizeClass", "Lifestage", "rank", "value", "path")
TARGET_KEY = ("SizeClass", "Lifestage", "Target", "Target_rank", "Target_path")
# Years of one block of bits, and the rank of a lineage that is its own target.
YEARS, OWN = 64, 7
# Rows a task of the sums holds at most, spread by sample: about 250 MB of its hash table.
SUM_ROWS = 1_000_000
BRIEF_ENV = ("Date", "Year", "Station", "Latitude", "Longitude", "SalSurf")


@dataclass(frozen=True)
class Synth:
    """Result of a synthesis; ``mode`` is ``Community`` or ``Taxa``."""

    data: DataFrame
    caveats: DataFrame
    mode: str


@dataclass(frozen=True)
class Lineages:
    """Staged distinct lineages per survey (with their years), and bounds of their number and of the catches."""

    table: DataFrame
    rows: int
    catches: int


@dataclass(frozen=True)
class Timing:
    """What time consistency expects: first years of surveys, introductions of taxa and their lag."""

    start_dates: DataFrame | None = None
    introductions: DataFrame | None = None
    intro_lag: int = INTRO_LAG_YEARS


def packed(catch: DataFrame) -> DataFrame:
    """Catches with their lineage as one text: one column to move instead of nine, each with its offset and padding."""
    return catch.select(*SAMPLE_KEY, F.to_json(F.struct(*LINEAGE_KEY)).alias("_lineage"))


def unpacked() -> list[Column]:
    """The columns of a lineage from its text; those that it leaves out are missing."""
    lineage = F.from_json("_lineage", ", ".join(f"`{c}` string" for c in LINEAGE_KEY))
    return [lineage[c].alias(c) for c in LINEAGE_KEY]


def filtered_base(catch: DataFrame, env: DataFrame, samples: SampleFilter, with_year: bool) -> DataFrame:
    """Catch rows of the selected samples; samples join early only if a filter or the year needs them."""
    if not samples.active and not with_year:
        return catch
    kept = samples.apply(env).select(*SAMPLE_KEY, *(["Year"] if with_year else []))
    if not with_year:
        return catch.join(kept, list(SAMPLE_KEY), "left_semi")
    return catch.drop("Year").join(kept, list(SAMPLE_KEY), "inner" if samples.active else "left")


def stage_lineages(base: DataFrame, with_year: bool = False) -> Lineages:
    """One pass over the catches: lineages by survey, their years as bits of 64-year blocks; catches are counted.

    With years the catches are ``packed`` ones that have met their samples, to which they move.
    """
    keys, seen = ["Source", *LINEAGE_KEY], Observation()
    base = base.observe(seen, F.count(F.lit(1)).alias("n"))
    if with_year:
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("Year", F.lit(YEARS)))
        lines = base.groupBy("Source", "_lineage", F.floor(F.col("Year") / YEARS).cast("int").alias("_block")).agg(F.bit_or(bit).alias("_years"))
        lines = lines.select("Source", *unpacked(), "_block", "_years")
    else:
        lines = base.select(*keys).distinct()
    return Lineages(*stage_counted(lines, "lineages"), seen.get["n"])


def rank_values(lines: DataFrame, keep: Iterable[str], named_only: bool = True) -> DataFrame:
    """One row per lineage and named rank: ``keep``, rank, value and path. Species is rank 6.

    A name stands for one taxon as long as no rank above it bears two names among its lineages, gaps
    aside; its path is then empty. A homonym, whose lineages disagree above, is kept apart by the
    path of names above it, where a gap makes a path of its own.
    """
    ranks = F.array(*[
        F.struct(F.lit(i).alias("rank"), F.col(r).alias("value"), F.array(*map(F.col, RANKS[:i - 1])).cast("array<string>").alias("higher"))
        for i, r in enumerate(RANKS, 1)
    ])
    named = lines.select(*RANKS).distinct().select(F.explode(ranks).alias("n")).select("n.*").filter("value IS NOT NULL AND rank > 1")
    differ = [
        F.coalesce(F.min(F.get("higher", F.lit(i))) != F.max(F.get("higher", F.lit(i))), F.lit(False))
        for i in range(len(RANKS) - 1)
    ]
    homonyms = named.groupBy(F.col("rank").alias("_r"), F.col("value").alias("_v")).agg(
        reduce(lambda a, b: a | b, differ).alias("_differ")
    ).filter("_differ")
    keep = list(keep)
    values = lines.select(*keep, F.explode(ranks).alias("_n")).select(*keep, "_n.*")
    if named_only:
        values = values.filter("value IS NOT NULL")
    above = F.concat_ws("\x1f", F.transform("higher", lambda r: F.coalesce(r, F.lit(""))))
    return values.join(homonyms, (F.col("rank") == F.col("_r")) & (F.col("value") == F.col("_v")), "left").select(
        *keep, "rank", "value", F.when(F.col("_differ"), above).otherwise("").alias("path")
    )


def null_safe(left: DataFrame, right: DataFrame, keys: Iterable[str], how: str = "inner") -> DataFrame:
    """Join where missing keys match each other; the keys of ``left`` stay."""
    keys = list(keys)
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    joined = left.join(renamed, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys], how)
    return joined.drop(*[f"_r_{k}" for k in keys])


def survey_values(lines: DataFrame, timing: Timing | None = None) -> DataFrame:
    """One row per survey and rank value it counted, with ``_steady``: in every year expected of it.

    Expected are the years the survey sampled the size class, from the survey's first year on and,
    for introduced taxa, from introduction plus lag on. Years are bits: those of all lineages of a
    value are merged, and the expected ones are tested against them block by block.
    """
    keys = ["Source", *VALUE_KEY]
    if timing is None:
        return rank_values(lines, ["Source", "SizeClass", "Lifestage"]).select(*keys).distinct().withColumn("_steady", F.lit(True))

    def blocks(df: DataFrame, by: list[str]) -> DataFrame:
        merged = df.groupBy(*by, "_block").agg(F.bit_or("_years").alias("_years"))
        known = F.when(F.col("_block").isNotNull(), F.struct("_block", "_years"))
        return merged.groupBy(*by).agg(F.collect_list(known).alias("_blocks"))

    sampled = blocks(lines, ["Source", "SizeClass"]).withColumnRenamed("_blocks", "_sampled")
    if timing.start_dates is None:
        sampled = sampled.withColumn("_start", F.lit(None).cast("int"))
    else:
        first = timing.start_dates.groupBy("Source").agg(F.year(F.min("Startdate")).alias("_start"))
        sampled = null_safe(sampled, first, ["Source"], "left")
    counted = null_safe(
        blocks(rank_values(lines, ["Source", "SizeClass", "Lifestage", "_block", "_years"]), keys), sampled, ["Source", "SizeClass"]
    )
    if timing.introductions is None:
        counted = counted.withColumn("_intro", F.lit(None).cast("int"))
    else:
        since = timing.introductions.groupBy(F.col("Taxname").alias("value")).agg(F.min("Intro_year").alias("_intro"))
        counted = counted.join(since, "value", "left")
    floor = F.greatest(F.col("_start"), F.col("_intro") + timing.intro_lag)

    def expected(block: Column) -> Column:
        """Bits of a block's years from the floor on."""
        skipped = floor - block * YEARS
        return (
            F.when(floor.isNull() | (skipped <= 0), F.lit(-1).cast("long")).when(skipped >= YEARS, F.lit(0).cast("long"))
            .otherwise(F.call_function("shiftleft", F.lit(-1).cast("long"), skipped.cast("int")))
        )

    def missing(sample: Column) -> Column:
        own = F.aggregate("_blocks", F.lit(0).cast("long"), lambda bits, b: F.when(b["_block"] == sample["_block"], b["_years"]).otherwise(bits))
        return sample["_years"].bitwiseAND(expected(sample["_block"])).bitwiseAND(F.bitwise_not(own)) != 0

    return counted.select(*keys, (~F.exists("_sampled", missing)).alias("_steady"))


def inconsistent_values(lines: DataFrame, timing: Timing) -> DataFrame:
    """(Source, SizeClass, Lifestage, rank, value, path) not counted in every expected year."""
    return survey_values(lines, timing).filter("NOT _steady").drop("_steady")


def n_surveys() -> Column:
    """Number of surveys in a group; the set holds one entry per survey, so one exchange does."""
    return F.size(F.collect_set("Source"))


def coverage(lines: DataFrame, timing: Timing | None = None) -> DataFrame:
    """Rank values counted by every survey that used the size class (zero catches count)."""
    surveys = lines.groupBy("SizeClass").agg(n_surveys().alias("_all"))
    steady = survey_values(lines, timing).groupBy(*VALUE_KEY).agg(F.count_if("_steady").alias("_n"))
    return null_safe(steady, surveys, ["SizeClass"]).filter("_n = _all").select(*VALUE_KEY)


def covered_values(lines: DataFrame, cover: DataFrame) -> DataFrame:
    """Rank values of every lineage, ``_hit`` where the value is covered."""
    values = rank_values(lines, LINEAGE_KEY, named_only=False).distinct()
    return null_safe(values, cover.withColumn("_covered", F.lit(True)), VALUE_KEY, "left").withColumn(
        "_hit", F.when(F.col("_covered"), F.struct("rank", "value", "path"))
    )


def community_map(lines: DataFrame, cover: DataFrame) -> DataFrame:
    """Lineage → finest covered rank value; NULL target where no rank is covered."""
    finest = covered_values(lines, cover).groupBy(*LINEAGE_KEY).agg(F.max("_hit").alias("_finest"))
    return finest.select(
        *LINEAGE_KEY, F.col("_finest.value").alias("Target"), F.col("_finest.rank").alias("Target_rank"), F.col("_finest.path").alias("Target_path")
    )


def group_map(lines: DataFrame, cover: DataFrame) -> DataFrame:
    """Lineage → covered groups above species that hold at least two distinct taxa."""
    members = (
        rank_values(lines, ["SizeClass", "Lifestage", "Taxname"])
        .filter("rank < 6").groupBy(*VALUE_KEY)
        .agg(F.count_distinct("Taxname").alias("_n")).filter("_n >= 2").drop("_n")
    )
    groups = null_safe(cover, members, VALUE_KEY, "left_semi")
    return covered_values(lines, groups).filter("_hit IS NOT NULL").select(
        *LINEAGE_KEY, F.col("value").alias("Target"), F.col("rank").alias("Target_rank"), F.col("path").alias("Target_path")
    )


def own_map(lines: DataFrame) -> DataFrame:
    """Lineage → itself, as one more target of rank ``OWN`` whose path is the whole lineage."""
    whole = F.concat_ws("\x1f", *[F.coalesce(F.col(r), F.lit("\x1e")) for r in RANKS])
    return lines.select(*LINEAGE_KEY).distinct().select(
        *LINEAGE_KEY, F.col("Taxname").alias("Target"), F.lit(OWN).alias("Target_rank"), whole.alias("Target_path")
    )


def with_target_lineages(mapping: DataFrame) -> DataFrame:
    """Add the ranks of every target, finer ranks blank; a gap of some members is filled from the others.

    The members of a target agree above it by its path, so the filled ranks are those of one taxon.
    One member of each target is marked ``_lead``, so that the marked rows list every target once.
    """
    shown = {
        f"_t_{r}": F.max(F.when(F.col("Target_rank") >= i, F.col(r))).alias(f"_t_{r}") for i, r in enumerate(RANKS, 1)
    }
    own = F.struct(*LINEAGE_KEY)
    targets = mapping.filter("Target_rank IS NOT NULL").groupBy(*TARGET_KEY).agg(*shown.values(), F.min(own).alias("_first"))
    joined = null_safe(mapping, targets, TARGET_KEY, "left")
    return joined.withColumn("_lead", F.col("_first").eqNullSafe(own)).drop("_first")


def flagged(taxa: DataFrame, undersampled: DataFrame | None) -> DataFrame:
    """Flag a table of taxa; both sides hold taxa, not catches, so the join is left to the planner."""
    if undersampled is None:
        return taxa.withColumn("Undersampled", F.lit(False))
    keys = ("SizeClass", "Taxname", "Lifestage")
    listed = undersampled.select(*keys).distinct().withColumn("_listed", F.lit(True))
    return null_safe(taxa, listed, keys, "left").withColumn("Undersampled", F.coalesce("_listed", F.lit(False))).drop("_listed")


def numbered(mapping: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Written tables of lineages and targets, each with a number that stands for it in the sums.

    ``mapping`` is a written table of flagged lineages with their targets. A lineage (``_line``) has the
    numbers of its targets and its flag, a target (``_target``) its key and ranks.
    """
    number = F.monotonically_increasing_id()
    shown = mapping.filter("_lead").select(*TARGET_KEY, *[F.col(f"_t_{r}").alias(r) for r in RANKS])
    targets = stage(shown.withColumn("_target", number), "target-numbers")
    lines = null_safe(mapping.filter("Target_rank IS NOT NULL"), targets.select(*TARGET_KEY, "_target"), TARGET_KEY).groupBy(*LINEAGE_KEY).agg(
        F.collect_list("_target").alias("_targets"), F.bool_or("Undersampled").alias("Undersampled")
    )
    return stage(lines.withColumn("_line", number), "line-numbers"), targets


def roll_up(
    base: DataFrame, mapping: DataFrame, rows: int, sums: int, env: DataFrame, columns: Iterable[str]
) -> DataFrame:
    """Sum every catch row into its targets, per sample, size class and life stage, with sample ``columns``.

    ``mapping`` has ``rows`` at most, and the catches with their targets are ``sums`` rows at most. Catches move
    once, by sample and as numbers; they meet their targets where their sample is, so neither the sums nor the
    sample columns need them to move again. Names join last. Numbers are small and their sums are not, so the
    count of rows says how many tasks there are, and not the bytes that move.
    """
    parts = max(base.sparkSession.sparkContext.defaultParallelism, -(-sums // SUM_ROWS))
    lines, targets = numbered(mapping)
    narrow = join_lookup(
        base.select(*SAMPLE_KEY, *LINEAGE_KEY, "CPUE"), lines.select(*LINEAGE_KEY, "_line"), LINEAGE_KEY, "inner", NULLABLE, rows
    ).select(*SAMPLE_KEY, "_line", "CPUE").repartition(parts, *SAMPLE_KEY)
    mapped = join_lookup(narrow, lines.select("_line", "_targets", "Undersampled"), ["_line"], "inner", rows=rows)
    summed = mapped.select(*SAMPLE_KEY, F.explode("_targets").alias("_target"), "CPUE", "Undersampled").groupBy(*SAMPLE_KEY, "_target").agg(
        F.sum("CPUE").alias("CPUE"), F.bool_or("Undersampled").alias("Undersampled")
    )
    return join_lookup(attach_env(summed, env, columns), targets, ["_target"], "inner", rows=rows).drop("_target")


def attach_env(data: DataFrame, env: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Join sample columns onto the summed rows."""
    if not columns:
        return data
    return data.join(env.select(*SAMPLE_KEY, *columns), list(SAMPLE_KEY), "left")


def message(kind: str, text: Column, rows: DataFrame) -> DataFrame:
    return rows.select(F.lit(kind).alias("kind"), "Taxlifestage", "SizeClass", text.alias("message")).distinct()


def caveat_text(reason: str) -> Column:
    return F.concat(F.lit(f"{reason}: "), F.col("Taxlifestage"), F.lit(" ("), F.col("SizeClass"), F.lit(")"))


def removed_taxa(mapping: DataFrame) -> DataFrame:
    """Taxon and life stage pairs without any covered rank, per size class."""
    return mapping.filter("Target_rank IS NULL").select(
        taxlifestage().alias("Taxlifestage"), "SizeClass"
    ).distinct()


def comparable_taxa(lines: DataFrame) -> DataFrame:
    """Per size class, taxon and life stage: number of surveys counting it, and whether all do."""
    surveys = lines.groupBy("SizeClass").agg(n_surveys().alias("_all"))
    return (
        lines.groupBy("SizeClass", "Taxname", "Lifestage").agg(n_surveys().alias("N_sources"))
        .transform(lambda counted: null_safe(counted, surveys, ["SizeClass"]))
        .select("SizeClass", "Taxname", "Lifestage", "N_sources", (F.col("N_sources") == F.col("_all")).alias("Comparable"))
    )


def timed_out(lines: DataFrame, timing: Timing) -> DataFrame:
    """Taxon and life stage pairs whose own (finest) name misses an expected year in some survey."""
    own = rank_values(lines, ["Source", *LINEAGE_KEY]).groupBy("Source", *LINEAGE_KEY).agg(
        F.max(F.struct("rank", "value", "path")).alias("_o")
    ).select("Source", "SizeClass", "Lifestage", "Taxname", "_o.rank", "_o.value", "_o.path")
    return null_safe(own, inconsistent_values(lines, timing), ("Source", *VALUE_KEY), "left_semi").select(
        taxlifestage().alias("Taxlifestage"), "SizeClass"
    ).distinct()


def community_caveats(lines: DataFrame, mapping: DataFrame, timing: Timing | None = None) -> DataFrame:
    """Taxa that Community mode removes and, with ``timing``, those it sums up for missing years."""
    notes = message("removed", caveat_text("Not shared by all surveys, removed"), removed_taxa(mapping))
    if timing is None:
        return notes
    return notes.unionByName(message(
        "time", caveat_text("Not counted every year, summed to a higher taxon"), timed_out(lines, timing)
    ))


def taxa_caveats(lines: DataFrame) -> DataFrame:
    """Taxa of Taxa mode that some survey does not count."""
    alone = comparable_taxa(lines).filter("NOT Comparable").withColumn("Taxlifestage", taxlifestage())
    return message("not comparable", caveat_text("Not counted by all surveys"), alone)


def named_targets(df: DataFrame) -> DataFrame:
    """Add name, type and label to targets of Taxa mode: single taxa and summed groups."""
    single = F.col("Target_rank") == OWN
    named = df.withColumns({
        "Taxname": F.when(single, F.col("Target")).otherwise(F.concat("Target", F.lit("_all"))),
        "Taxatype": F.when(single, F.lit("Taxon")).otherwise(F.lit("Summed group")),
    })
    grouped = F.concat(paste("Taxname", "Lifestage"), F.lit(" ("), F.col("SizeClass"), F.lit(")"))
    return named.withColumn("Taxlifestage", F.when(single, taxlifestage()).otherwise(grouped))


def synthesize(
    catch: DataFrame,
    env: DataFrame,
    mode: str = "Community",
    sources: Iterable[str] | None = None,
    size_classes: Iterable[str] | None = None,
    taxa: Iterable[str] | None = None,
    samples: SampleFilter = SampleFilter(),
    time_consistency: bool = False,
    intro_lag: int = INTRO_LAG_YEARS,
    undersampled: DataFrame | Callable[[DataFrame], DataFrame] | None = None,
    start_dates: DataFrame | None = None,
    introductions: DataFrame | None = None,
    all_env: bool = False,
    env_columns: Iterable[str] = BRIEF_ENV,
) -> Synth:
    """Combine surveys on taxa they share (Community) or on all taxa plus shared groups (Taxa).

    ``taxa`` applies in Taxa mode and ``time_consistency`` in Community mode only. ``env_columns``
    are the sample columns joined to the result, all of them with ``all_env``, no join when empty.
    ``undersampled`` lists size class, taxon and life stage, or makes such a list from the lineages.
    The catches are read once for the lineages and once for the sums.
    """
    if mode not in ("Community", "Taxa"):
        raise ValueError(f"unknown mode {mode!r}")
    timed = time_consistency and mode == "Community"
    kept = select_catch(catch, sources, size_classes, taxa if mode == "Taxa" else None)
    staged = stage_lineages(filtered_base(packed(kept) if timed else kept, env, samples, timed), timed)
    base = filtered_base(kept, env, samples, False)
    lines = staged.table
    timing = Timing(start_dates, introductions, intro_lag) if timed else None
    cover = coverage(lines, timing)
    listed = undersampled(lines) if callable(undersampled) else undersampled

    # Sample columns that the result has anyway are left out.
    if mode == "Community":
        shown = [*SAMPLE_KEY, "SizeClass", "Lifestage", "Taxname", "CPUE", "Undersampled", *RANKS, "Taxlifestage"]
    else:
        shown = [*SAMPLE_KEY, "SizeClass", "Lifestage", "CPUE", "Undersampled", *RANKS, "Taxname", "Taxatype", "Taxlifestage"]
    columns = [c for c in (env.columns if all_env else env_columns) if c in env.columns and c not in shown]

    if mode == "Community":
        mapping = stage(with_target_lineages(flagged(community_map(lines, cover), listed)), "targets")
        summed = roll_up(base, mapping, staged.rows, staged.catches, env, columns).withColumnRenamed("Target", "Taxname")
        data = summed.withColumn("Taxlifestage", taxlifestage()).select(*shown, *columns)
        return Synth(data, community_caveats(lines, mapping, timing), mode)

    # A lineage maps to itself and to at most one group per rank above species, hence the factors 6.
    targets = stage(with_target_lineages(flagged(group_map(lines, cover).unionByName(own_map(lines)), listed)), "targets")
    data = named_targets(roll_up(base, targets, staged.rows * 6, staged.catches * 6, env, columns)).select(*shown, *columns)
    return Synth(data, taxa_caveats(lines), mode)
