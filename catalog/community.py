"""Queries of the synthesis: roll-ups, flags, caveats, conservation."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from catalog.registry import ROLL_UP, fixed, register, roll_up_sql
from surveyloom.functions.missing import paste
from surveyloom.operators import effort
from surveyloom.operators import synth as S
from surveyloom.operators.combine import with_samples
from surveyloom.operators.filters import SampleFilter, flag_undersampled, select_catch
from surveyloom.operators.validate import totals_fit, verdict
from surveyloom.plans.conservation import check_filtered, check_unfiltered
from surveyloom.schemas import RANKS
from surveyloom.session import join_lookup
from surveyloom.sources.tables import taxa_list

SUMMED = ["Source", "SampleID", "SizeClass", "Taxname", "Lifestage", "Taxlifestage", "CPUE", "Undersampled"]
ENV_SHOWN = ["Date", "Year", "Station", "Latitude", "Longitude", "SalSurf"]
RANKS_SQL = 'Phylum, Class, "Order", Family, Genus, Species'
COM_SQL = f"SELECT Source, SampleID, SizeClass, Taxname, Lifestage, Taxlifestage, CPUE, Undersampled, {RANKS_SQL} FROM com"


@register("scan_catch", f"SELECT Source, SampleID, SizeClass, Lifestage, Taxname, {RANKS_SQL}, CPUE, Volume FROM fx_catch")
def scan_catch(t):
    return t.catch.select("Source", "SampleID", "SizeClass", "Lifestage", "Taxname", *RANKS, "CPUE", "Volume")


@register("scan_env", "SELECT * FROM fx_env")
def scan_env(t):
    return t.env


@register("taxa_list", 'SELECT DISTINCT Taxon FROM (SELECT unnest([Taxname, Phylum, Class, "Order", Family, Genus, Species]) AS Taxon FROM fx_catch) WHERE Taxon IS NOT NULL')
def list_taxa(t):
    return taxa_list(t.catch)


@register("start_dates", "SELECT Source, CAST(year(min(Startdate)) AS INT) AS StartYear FROM fx_start GROUP BY Source")
def first_years(t):
    return effort.first_years(t.start)


@register("synth_base", """SELECT c.Source, c.SampleID, SizeClass, Taxname, Lifestage, CPUE, Date, e.Year, Station, Latitude, Longitude, SalSurf
 FROM fx_catch c JOIN fx_env e ON c.SampleID = e.SampleID AND c.Source = e.Source
 WHERE c.Source IN ('AUTOMOBILE', 'BUILDING') AND SizeClass IN ('Meso', 'Micro') AND Date BETWEEN DATE '1994-01-01' AND DATE '1997-12-31'""")
def synth_base(t):
    kept = select_catch(t.catch, ["AUTOMOBILE", "BUILDING"], ["Meso", "Micro"])
    env = SampleFilter(dates=("1994-01-01", "1997-12-31")).apply(t.env)
    return kept.join(env.select("Source", "SampleID", *ENV_SHOWN), ["Source", "SampleID"]).select(
        "Source", "SampleID", "SizeClass", "Taxname", "Lifestage", "CPUE", *ENV_SHOWN
    )


@register("community", ROLL_UP + COM_SQL)
def community(t):
    return t.community(undersampled=t.listed, env_columns=()).data.select(*SUMMED, *RANKS)


FILTERED = """SELECT c.* FROM fx_catch c JOIN fx_env e ON e.SampleID = c.SampleID AND e.Source = c.Source
 WHERE c.Source IN ('BUILDING', 'FURNITURE', 'MACHINERY') AND c.SizeClass IN ('Micro', 'Macro')
 AND e.Date BETWEEN DATE '1994-03-01' AND DATE '1998-10-31' AND e.Month IN (3, 4, 5, 6, 7, 8, 9, 10)
 AND e.SalSurf BETWEEN 0 AND 25 AND e.Latitude >= 37.85 AND e.Longitude BETWEEN -122.4 AND -121.4"""


@register("community_filtered", roll_up_sql(FILTERED) + COM_SQL)
def community_filtered(t):
    return t.community(
        sources=["BUILDING", "FURNITURE", "MACHINERY"], size_classes=["Micro", "Macro"],
        samples=SampleFilter(
            dates=("1994-03-01", "1998-10-31"), months=(3, 4, 5, 6, 7, 8, 9, 10), sal_surf=(0, 25),
            latitude=(37.85, None), longitude=(-122.4, -121.4),
        ),
        undersampled=t.listed, env_columns=(),
    ).data.select(*SUMMED, *RANKS)


@register("community_removed", ROLL_UP + """SELECT concat(Taxname, ' ', Lifestage) AS Taxlifestage, SizeClass, count(*) AS N_rows, sum(CPUE) AS CPUE
 FROM tgt WHERE target IS NULL GROUP BY 1, 2""")
def community_removed(t):
    lines = S.stage_lineages(t.catch)
    gone = S.removed_taxa(S.community_map(lines.table, S.coverage(lines.table)))
    lost = join_lookup(t.labelled, gone, ["Taxlifestage", "SizeClass"], "left_semi", rows=lines.rows)
    return lost.groupBy("Taxlifestage", "SizeClass").agg(F.count("*").alias("N_rows"), F.sum("CPUE").alias("CPUE"))


@register("taxa", ROLL_UP + f"SELECT Source, SampleID, SizeClass, Taxname, Lifestage, Taxlifestage, Taxatype, CPUE, Undersampled, {RANKS_SQL} FROM tax")
def taxa(t):
    return t.taxa(undersampled=t.listed, env_columns=()).data.select(*SUMMED, "Taxatype", *RANKS)


TAXA_ONLY = "SELECT * FROM fx_catch WHERE 'Calanoida' IN (Taxname, \"Order\") OR Species = 'hot plate'"


@register("taxa_selected", roll_up_sql(TAXA_ONLY) + "SELECT Source, SampleID, SizeClass, Taxlifestage, Taxatype, CPUE FROM tax")
def taxa_selected(t):
    chosen = t.taxa(taxa=["Calanoida", "hot plate"], env_columns=()).data
    return chosen.select("Source", "SampleID", "SizeClass", "Taxlifestage", "Taxatype", "CPUE")




@register("taxa_comparable", """, nall AS (SELECT SizeClass, count(DISTINCT Source) AS n FROM fx_catch GROUP BY 1)
SELECT c.SizeClass, Taxname, Lifestage, count(DISTINCT Source) AS N_sources, count(DISTINCT Source) = any_value(n) AS Comparable
 FROM fx_catch c JOIN nall ON nall.SizeClass = c.SizeClass GROUP BY c.SizeClass, Taxname, Lifestage""")
def taxa_comparable(t):
    return S.comparable_taxa(S.stage_lineages(t.catch).table)


@register("undersampled_flag", """SELECT c.Source, c.SampleID, c.SizeClass, c.Taxname, c.Lifestage, c.CPUE, u.Taxname IS NOT NULL AS Undersampled
 FROM fx_catch c LEFT JOIN fx_under u ON u.SizeClass = c.SizeClass AND u.Taxname = c.Taxname AND u.Lifestage = c.Lifestage""")
def undersampled_flag(t):
    return flag_undersampled(
        t.catch.select("Source", "SampleID", "SizeClass", "Taxname", "Lifestage", "CPUE"), t.under
    )


YEARLY = "SELECT c.*, e.Year FROM fx_catch c LEFT JOIN fx_env e ON e.SampleID = c.SampleID AND e.Source = c.Source"


@register("time_consistent", roll_up_sql(YEARLY, consistent=True) + COM_SQL)
def time_consistent(t):
    return t.community(
        time_consistency=True, undersampled=t.listed, start_dates=t.start, introductions=t.intro, env_columns=()
    ).data.select(*SUMMED, *RANKS)


@register("caveats", roll_up_sql(YEARLY, consistent=True) + """,
own AS (SELECT DISTINCT Source, SizeClass, Lifestage, Taxname,
  CASE WHEN Species IS NOT NULL THEN 6 WHEN Genus IS NOT NULL THEN 5 WHEN Family IS NOT NULL THEN 4 WHEN "Order" IS NOT NULL THEN 3 WHEN Class IS NOT NULL THEN 2 ELSE 1 END AS r,
  coalesce(Species, Genus, Family, "Order", Class, Phylum) AS v FROM base)
SELECT DISTINCT 'removed' AS kind, concat(Taxname, ' ', Lifestage) AS Taxlifestage, SizeClass,
  concat('Not shared by all surveys, removed: ', Taxname, ' ', Lifestage, ' (', SizeClass, ')') AS message
 FROM tgt WHERE target IS NULL
UNION ALL
SELECT DISTINCT 'time', concat(o.Taxname, ' ', o.Lifestage), o.SizeClass,
  concat('Not counted every year, summed to a higher taxon: ', o.Taxname, ' ', o.Lifestage, ' (', o.SizeClass, ')')
 FROM own o JOIN bad b ON b.Source = o.Source AND b.SizeClass = o.SizeClass AND b.Lifestage = o.Lifestage AND b.r = o.r AND b.v = o.v""")
def caveats(t):
    return t.community(time_consistency=True, start_dates=t.start, introductions=t.intro).caveats


@register("taxa_caveats", """, nall AS (SELECT SizeClass, count(DISTINCT Source) AS n FROM fx_catch GROUP BY 1)
SELECT 'not comparable' AS kind, concat(Taxname, ' ', Lifestage) AS Taxlifestage, c.SizeClass,
  concat('Not counted by all surveys: ', Taxname, ' ', Lifestage, ' (', c.SizeClass, ')') AS message
 FROM fx_catch c JOIN nall ON nall.SizeClass = c.SizeClass GROUP BY Taxname, Lifestage, c.SizeClass, n HAVING count(DISTINCT Source) < n""")
def taxa_caveats(t):
    return t.taxa().caveats


@register("taxlifestage", "SELECT Source, SampleID, SizeClass, Taxlifestage, CPUE FROM fx_label")
def label(t):
    return t.catch.select("Source", "SampleID", "SizeClass", paste("Taxname", "Lifestage").alias("Taxlifestage"), "CPUE")


@register("conservation", ROLL_UP + """,
after AS (SELECT SampleID, sum(CPUE) AS CPUE_com FROM com GROUP BY SampleID),
before AS (SELECT SampleID, sum(CPUE) AS CPUE_base FROM fx_catch GROUP BY SampleID),
both_ AS (SELECT coalesce(abs(CPUE_com - CPUE_base) < greatest(1.5e-8, 1e-9 * greatest(abs(CPUE_com), abs(CPUE_base))), FALSE) AS same
 FROM after FULL JOIN before ON after.SampleID = before.SampleID)
SELECT count(*) AS N_samples, count(*) FILTER (NOT same) AS N_differ, bool_and(same) AS Conserved FROM both_""")
def conservation(t):
    return verdict(check_unfiltered(t.written_catch(), t.env))


KEPT = """SELECT c.* FROM fx_catch c ANTI JOIN (SELECT DISTINCT SizeClass, Taxname, Lifestage FROM tgt0 WHERE target IS NULL) g
 ON g.SizeClass = c.SizeClass AND g.Taxname = c.Taxname AND g.Lifestage = c.Lifestage"""


def nested_roll_up() -> str:
    """The roll-up of the rows left after removing the taxa a first roll-up reports."""
    tables = r"\b(base|vals|marked|nsrc|cov|tgt|com|memb|grp|grows|tax)\b"
    return re.sub(tables, r"\g<1>0", ROLL_UP).rstrip() + roll_up_sql(KEPT)


@register("conservation_filtered", nested_roll_up() + f""",
kept AS ({KEPT}),
after AS (SELECT SampleID, sum(CPUE) AS CPUE_com FROM com GROUP BY SampleID),
before AS (SELECT SampleID, sum(CPUE) AS CPUE_base FROM kept GROUP BY SampleID)
SELECT coalesce(after.SampleID, before.SampleID) AS SampleID, CPUE_com, CPUE_base
 FROM after FULL JOIN before ON after.SampleID = before.SampleID""")
def conservation_filtered(t):
    return check_filtered(t.written_catch(), t.env)


FIT_SQL = """SELECT regr_count(CPUE_com, CPUE_base) AS N, round(regr_intercept(CPUE_com, CPUE_base), 6) + 0.0 AS Intercept,
 round(regr_slope(CPUE_com, CPUE_base), 6) AS Slope, round(regr_r2(CPUE_com, CPUE_base), 6) AS R2 FROM after FULL JOIN before ON after.SampleID = before.SampleID"""


def fitted(totals):
    return totals_fit(totals).select("N", (F.round("Intercept", 6) + 0.0).alias("Intercept"), fixed("Slope"), fixed("R2"))


@register("conservation_fit", ROLL_UP + """,
after AS (SELECT SampleID, sum(CPUE) AS CPUE_com FROM com GROUP BY SampleID),
before AS (SELECT SampleID, sum(CPUE) AS CPUE_base FROM fx_catch GROUP BY SampleID)
""" + FIT_SQL)
def conservation_fit(t):
    return fitted(check_unfiltered(t.written_catch(), t.env))


@register("conservation_filtered_fit", nested_roll_up() + f""",
kept AS ({KEPT}),
after AS (SELECT SampleID, sum(CPUE) AS CPUE_com FROM com GROUP BY SampleID),
before AS (SELECT SampleID, sum(CPUE) AS CPUE_base FROM kept GROUP BY SampleID)
""" + FIT_SQL)
def conservation_filtered_fit(t):
    return fitted(check_filtered(t.written_catch(), t.env))


@register("join_left", """SELECT c.Source, c.SampleID, SizeClass, Taxname, CPUE, Date, Station, Secchi, Tide
 FROM fx_catch c LEFT JOIN fx_env e ON c.SampleID = e.SampleID AND c.Source = e.Source""")
def join_left(t):
    return with_samples(t.catch, t.env).select(
        "Source", "SampleID", "SizeClass", "Taxname", "CPUE", "Date", "Station", "Secchi", "Tide"
    )
