"""Queries of the paired-gear comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import fixed, register
from surveyloom.functions.text import thousands
from surveyloom.operators import gear as A

BOTH_SQL = """, g AS (SELECT * FROM fx_label WHERE SizeClass IN ('Micro', 'Meso')),
tx AS (SELECT Taxlifestage FROM g GROUP BY 1 HAVING count(DISTINCT SizeClass) = 2),
gt AS (SELECT * FROM g WHERE Taxlifestage IN (SELECT Taxlifestage FROM tx)),
sm AS (SELECT SampleID FROM gt GROUP BY 1 HAVING count(DISTINCT SizeClass) = 2),
gb AS (SELECT * FROM gt WHERE SampleID IN (SELECT SampleID FROM sm))
"""
GENERA = ["anvil", "bolt", "gear", "gizmo", "plate", "ring", "rod", "widget"]
IDS = ["Date", "Station", "Source", "Secchi", "Chl", "Temperature"]
IDS_SQL = ", ".join(IDS)


def matrix_sql(size: str) -> str:
    cells = ", ".join(f"coalesce(sum(CPUE) FILTER (Genus = '{g}'), 0) AS {g}" for g in GENERA)
    return f"SELECT {IDS_SQL}, sum(Volume) AS Volume, {cells} FROM fx_catch c JOIN fx_env e USING (SampleID, Source) WHERE SizeClass = '{size}' GROUP BY {IDS_SQL}"


MATRIX_SQL = f", cb AS ({matrix_sql('Meso')}), pump AS ({matrix_sql('Micro')})\n"


@register("present_in_both", BOTH_SQL + "SELECT Source, SampleID, SizeClass, Taxlifestage, CPUE FROM gb")
def present_in_both(t):
    return A.comparable_rows(t.labelled).select("Source", "SampleID", "SizeClass", "Taxlifestage", "CPUE")


@register("gear_proportion", BOTH_SQL + """SELECT SizeClass, Taxname, Lifestage, Taxname AS Taxname_label, sum(CPUE) AS CPUE,
 sum(sum(CPUE)) OVER (PARTITION BY Taxname, Lifestage) AS Total, CAST(sum(count(*) FILTER (CPUE > 0)) OVER (PARTITION BY Taxname, Lifestage) AS BIGINT) AS N_detect,
 round(sum(CPUE) / nullif(sum(sum(CPUE)) OVER (PARTITION BY Taxname, Lifestage), 0), 6) AS Proportion
 FROM gb GROUP BY SizeClass, Taxname, Lifestage""")
def gear_proportion(t):
    return A.gear_proportion(A.comparable_rows(t.labelled)).withColumn("Proportion", fixed("Proportion"))


@register("pivot_gear", BOTH_SQL + """SELECT Source, SampleID, Taxlifestage, round(ln(1 + sum(CPUE) FILTER (SizeClass = 'Meso')), 6) AS Meso_l,
 round(ln(1 + sum(CPUE) FILTER (SizeClass = 'Micro')), 6) AS Micro_l FROM gb GROUP BY 1, 2, 3""")
def pivot_gear(t):
    wide = A.pivot_gear(A.comparable_rows(t.labelled))
    return wide.withColumns({c: fixed(c) for c in ("Meso_l", "Micro_l")})


@register("standardize", """SELECT SampleID, round((Secchi - avg(Secchi) OVER ()) / stddev_samp(Secchi) OVER (), 6) AS Secchi_s,
 round((Temperature - avg(Temperature) OVER ()) / stddev_samp(Temperature) OVER (), 6) AS Temperature_s FROM fx_env""")
def standardize(t):
    scaled = A.standardize(t.env, {"Secchi": "Secchi_s", "Temperature": "Temperature_s"})
    return scaled.select("SampleID", fixed("Secchi_s"), fixed("Temperature_s"))


GEARS = {"CB": "Meso", "Pump": "Micro"}


def tows(t):
    """All tows with the catches of both gears, by genus."""
    return A.tow_matrix(t.catch.join(t.env, ["Source", "SampleID"]), IDS, GEARS, "Genus", GENERA)


@register("gear_matrix", f"SELECT SampleID, {', '.join(f'coalesce(sum(CPUE) FILTER (Genus = {chr(39)}{g}{chr(39)}), 0) AS {g}' for g in GENERA)} FROM fx_catch WHERE SizeClass = 'Meso' GROUP BY 1")
def gear_matrix(t):
    return A.gear_matrix(t.catch.filter("SizeClass = 'Meso'"), "Genus", GENERA, ["SampleID"])


JOIN_KEYS = " AND ".join(f"a.{c} IS NOT DISTINCT FROM b.{c}" for c in IDS)


@register("join_paired_gear", MATRIX_SQL + f""", a AS (SELECT *, ({" + ".join(GENERA)}) * Volume AS ct FROM cb)
SELECT {', '.join(f'a.{c}' for c in IDS)}, concat(CAST(a.Date AS VARCHAR), ' ', a.Station) AS SampleID, {', '.join(f'a.{g} AS {g}_CB, b.{g} AS {g}_Pump, round(ln(1 + a.{g}), 6) AS {g}_CB_l' for g in GENERA)},
 a.ct AS Catch_total_CB, round((a.ct - (SELECT avg(ct) FROM a)) / (SELECT stddev_samp(ct) FROM a), 6) AS Catch_total_CB_s FROM a JOIN pump b ON {JOIN_KEYS}""")
def join_paired_gear(t):
    both = A.paired_tows(tows(t), GEARS, GENERA, total_gear="CB")
    return both.select(
        *IDS, "SampleID", *[f"{g}_CB" for g in GENERA], *[f"{g}_Pump" for g in GENERA],
        *[fixed(f"{g}_CB_l") for g in GENERA], "Catch_total_CB", fixed("Catch_total_CB_s"),
    )


@register("export_labels", BOTH_SQL + "SELECT Taxname, Lifestage, format('{:,}', count(*) FILTER (CPUE > 0)) AS N_detect FROM gb GROUP BY 1, 2")
def export_labels(t):
    rows = A.comparable_rows(t.labelled)
    counts = rows.groupBy("Taxname", "Lifestage").agg(F.count_if(F.col("CPUE") > 0).alias("n"))
    return counts.select("Taxname", "Lifestage", thousands(F.col("n").cast("double")).alias("N_detect"))
