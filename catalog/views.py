"""Queries of the views on a synthesis, sorting, reshaping and sampling effort."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.projections import GROUP_SQL, ZONE_SQL
from catalog.registry import VIEWS, fixed, register
from surveyloom.functions.classes import salinity_zone
from surveyloom.functions.missing import level, level_order, sum_na_rm, sum_strict
from surveyloom.operators import combine as B
from surveyloom.operators import effort as E
from surveyloom.operators import order as O
from surveyloom.operators import views as V
from surveyloom.plans.matching import distinct_samples
from surveyloom.schemas import MAJOR_GROUPS, RANKS, SALINITY_ZONES

SPOT = ["Date", "Year", "Latitude", "Longitude", "SalSurf"]
RANKS_SQL = 'Phylum, Class, "Order", Family, Genus, Species'


@register("taxa_map", VIEWS + """SELECT Taxlifestage, Year, Latitude, Longitude, round(avg(CPUE), 6) AS CPUE FROM taxv
 WHERE Latitude IS NOT NULL AND Longitude IS NOT NULL AND SizeClass IN ('Micro', 'Meso') AND NOT Undersampled GROUP BY 1, 2, 3, 4""")
def taxa_map(t):
    data = t.taxa(undersampled=t.listed, env_columns=SPOT).data
    return V.taxa_map(data, ["Micro", "Meso"]).withColumn("CPUE", fixed("CPUE"))


COM_MAP_SQL = f""",
spots AS (SELECT {GROUP_SQL} AS Taxa, Year, Latitude, Longitude, SampleID, sum(CPUE) AS CPUE FROM comv
 WHERE Latitude IS NOT NULL AND Longitude IS NOT NULL AND Lifestage = 'Adult' AND NOT Undersampled GROUP BY 1, 2, 3, 4, 5),
cmap AS (SELECT Taxa, Year, Latitude, Longitude, round_even(avg(CPUE), 0) AS CPUE FROM spots GROUP BY 1, 2, 3, 4)
"""


def mapped_community(t):
    return V.community_map(t.community(undersampled=t.listed, env_columns=SPOT).data, ["Adult"])


@register("community_map", VIEWS + COM_MAP_SQL + "SELECT * FROM cmap")
def community_map(t):
    return mapped_community(t)


GROUPS = list(MAJOR_GROUPS)
LEVEL_SQL = "list_position([" + ", ".join(f"'{g}'" for g in GROUPS) + "], Taxa)"


@register("community_map_sorted", VIEWS + COM_MAP_SQL + f"""SELECT row_number() OVER (ORDER BY {LEVEL_SQL} NULLS LAST, Year NULLS LAST, Latitude NULLS LAST, Longitude NULLS LAST) AS Position,
 Taxa, Year, Latitude, Longitude, CPUE FROM cmap""")
def community_map_sorted(t):
    keys = ["_level", "Year", "Latitude", "Longitude"]
    leveled = mapped_community(t).withColumn("_level", level_order("Taxa", GROUPS))
    return O.row_ids(leveled, keys, "Position").orderBy("Position").select("Position", "Taxa", "Year", "Latitude", "Longitude", "CPUE")


PIVOT_SQL = ", ".join(f"max(CASE WHEN Taxa = '{g}' THEN CPUE END) AS \"{g}\"" for g in GROUPS)


@register("pivot_groups", VIEWS + COM_MAP_SQL + f"SELECT Year, Latitude, Longitude, {PIVOT_SQL} FROM cmap GROUP BY 1, 2, 3")
def pivot_groups(t):
    return V.pivot_groups(mapped_community(t))


@register("cpue_by_taxon_year", VIEWS + f"""SELECT Taxlifestage, Year, {ZONE_SQL} AS Salinity_zone, round(avg(CPUE), 6) AS CPUE FROM taxv
 WHERE SizeClass IN ('Meso') AND SalSurf IS NOT NULL GROUP BY 1, 2, 3""")
def cpue_by_taxon_year(t):
    data = t.taxa(undersampled=t.listed, env_columns=SPOT).data
    return V.cpue_by_taxon_year(data, ["Meso"], (0.5, 6.0)).withColumn("CPUE", fixed("CPUE"))


@register("cpue_by_lineage_year", VIEWS + f"""SELECT Year, {RANKS_SQL}, Lifestage, Taxlifestage, {ZONE_SQL} AS Salinity_zone, round(avg(CPUE), 6) AS CPUE FROM comv
 WHERE NOT Undersampled AND SalSurf IS NOT NULL GROUP BY ALL""")
def cpue_by_lineage_year(t):
    data = t.community(undersampled=t.listed, env_columns=SPOT).data
    return V.cpue_by_lineage_year(data).withColumn("CPUE", fixed("CPUE"))


@register("community_cpue_by_year", VIEWS + """SELECT Year, Taxlifestage, round(avg(CPUE), 6) AS CPUE FROM comv WHERE SizeClass = 'Meso' GROUP BY 1, 2""")
def community_cpue_by_year(t):
    data = t.community(env_columns=["Year"]).data
    return V.cpue_by_taxon_year(data, ["Meso"]).withColumn("CPUE", fixed("CPUE"))


COUNTS_SQL = """SELECT c.Source, e.Year, e.Month, CAST(count(DISTINCT c.SampleID) AS BIGINT) AS N_samples
 FROM fx_catch c JOIN fx_env e ON e.SampleID = c.SampleID AND e.Source = c.Source WHERE CPUE > 0 GROUP BY 1, 2, 3"""


@register("sample_counts", COUNTS_SQL)
def sample_counts(t):
    return V.sample_counts(B.with_samples(t.catch, t.env))


@register("row_ids", f"SELECT *, row_number() OVER (ORDER BY Source, Year, Month) AS ID FROM ({COUNTS_SQL})")
def row_ids(t):
    return O.row_ids(V.sample_counts(B.with_samples(t.catch, t.env)), ["Source", "Year", "Month"])


@register("size_breaks", VIEWS + """,
m AS (SELECT max(a) AS largest FROM (SELECT avg(CPUE) AS a FROM taxv WHERE Latitude IS NOT NULL AND Longitude IS NOT NULL AND NOT Undersampled GROUP BY Taxlifestage, Year, Latitude, Longitude)),
b AS (SELECT largest, round_even(x * power(10, 1 - floor(log10(x))), 0) / power(10, 1 - floor(log10(x))) AS br
 FROM (SELECT largest, largest * unnest([1/3, 2/3, 1.0]) AS x FROM m))
SELECT br AS Break, round(sqrt(br) / sqrt(largest) * 22, 6) AS Radius FROM b""")
def size_breaks(t):
    mapped = V.taxa_map(t.taxa(undersampled=t.listed, env_columns=SPOT).data)
    return V.size_breaks(mapped).withColumn("Radius", fixed("Radius"))


@register("legend_labels", VIEWS + """,
m AS (SELECT max(a) AS largest FROM (SELECT avg(CPUE) AS a FROM taxv WHERE Latitude IS NOT NULL AND Longitude IS NOT NULL AND NOT Undersampled GROUP BY Taxlifestage, Year, Latitude, Longitude)),
b AS (SELECT round_even(x * power(10, 1 - floor(log10(x))), 0) / power(10, 1 - floor(log10(x))) AS br
 FROM (SELECT largest * unnest([1/3, 2/3, 1.0]) * 1000 AS x FROM m))
SELECT br AS Break, CASE WHEN br = floor(br) THEN format('{:,}', CAST(br AS BIGINT)) ELSE CAST(br AS VARCHAR) END AS Label FROM b""")
def legend_labels(t):
    mapped = V.taxa_map(t.taxa(undersampled=t.listed, env_columns=SPOT).data)
    return V.legend_labels(V.size_breaks(mapped.withColumn("CPUE", F.col("CPUE") * 1000))).select("Break", "Label")


@register("cpue_tooltips", VIEWS + f""",
v AS (SELECT Taxlifestage, Year, {ZONE_SQL} AS Salinity_zone, avg(CPUE) AS CPUE FROM taxv WHERE SizeClass IN ('Meso') AND SalSurf IS NOT NULL GROUP BY 1, 2, 3)
SELECT Taxlifestage, Year, Salinity_zone, CAST(row_number() OVER (ORDER BY Taxlifestage NULLS LAST, Year NULLS LAST, Salinity_zone NULLS LAST) AS VARCHAR) AS ID,
 concat('<table><tr><td>Year &nbsp</td><td>', coalesce(CAST(Year AS VARCHAR), 'NA'), '</td></tr><tr><td>Taxa &nbsp</td><td>', coalesce(Taxlifestage, 'NA'),
  '</td></tr><tr><td>Salinity &nbsp</td><td>', coalesce(Salinity_zone, 'NA'), '</td></tr><tr><td>CPUE &nbsp</td><td>', CAST(CAST(round_even(CPUE, 0) AS BIGINT) AS VARCHAR), '</td></tr></table>') AS tooltip FROM v""")
def cpue_tooltips(t):
    view = V.cpue_by_taxon_year(t.taxa(undersampled=t.listed, env_columns=SPOT).data, ["Meso"], (0.5, 6.0))
    shown = {"Year": "Year", "Taxa": "Taxlifestage", "Salinity": "Salinity_zone", "CPUE": F.bround("CPUE", 0).cast("long")}
    return V.with_tooltips(view, shown, ["Taxlifestage", "Year", "Salinity_zone"]).drop("CPUE")


@register("sample_count_tooltips", f"""SELECT *, CAST(row_number() OVER (ORDER BY Source, Year, Month) AS VARCHAR) AS ID,
 concat('<table><tr><td>Year &nbsp</td><td>', Year, '</td></tr><tr><td>Source &nbsp</td><td>', Source, '</td></tr><tr><td>N &nbsp</td><td>', N_samples, '</td></tr></table>') AS tooltip
 FROM ({COUNTS_SQL})""")
def sample_count_tooltips(t):
    counts = V.sample_counts(B.with_samples(t.catch, t.env))
    return V.with_tooltips(counts, {"Year": "Year", "Source": "Source", "N": "N_samples"}, ["Source", "Year", "Month"])


@register("menu_tree", VIEWS + """,
e AS (SELECT "Group", Taxlifestage, min(Taxatype) AS ty, min(Taxname) AS tn, min(Lifestage) AS ls FROM (
 SELECT CASE WHEN Class = 'Insecta' THEN 'Insecta' WHEN Phylum = 'Arthropoda' AND "Order" IS NOT NULL THEN "Order" ELSE Phylum END AS "Group",
  Taxatype, Taxname, Lifestage, Taxlifestage FROM tax) GROUP BY 1, 2)
SELECT "Group", row_number() OVER (PARTITION BY "Group" ORDER BY ty, tn, ls, Taxlifestage) AS Position, Taxlifestage FROM e""")
def menu_tree(t):
    return V.menu_tree(t.taxa(env_columns=()).data)


@register("n_distinct", "SELECT count(DISTINCT Taxlifestage) AS N_taxa FROM fx_label")
def n_distinct(t):
    return V.n_taxa(t.labelled)


@register("distinct_samples", "SELECT DISTINCT Station, Source, Date, Latitude, Longitude, SalSurf, SalBott, SampleID FROM fx_env")
def unique_samples(t):
    return distinct_samples(t.env)


@register("set_per_group", "SELECT SizeClass, len(l) AS N, array_to_string(l, '|') AS Labels FROM (SELECT SizeClass, list_sort(list(DISTINCT Taxlifestage)) AS l FROM fx_label GROUP BY 1)")
def set_per_group(t):
    sets = B.set_per_group(t.labelled, "SizeClass", "Taxlifestage")
    return sets.select("SizeClass", F.size("Taxlifestage").alias("N"), F.array_join("Taxlifestage", "|").alias("Labels"))


@register("sum_na_rm", "SELECT Station, coalesce(sum(Secchi), 0) AS Total FROM fx_env GROUP BY 1")
def total_na_rm(t):
    return t.env.groupBy("Station").agg(sum_na_rm("Secchi").alias("Total"))


@register("sum_strict", "SELECT Station, Source, CASE WHEN count(Secchi) = count(*) THEN sum(Secchi) END AS Total FROM fx_env GROUP BY 1, 2")
def total_strict(t):
    return t.env.groupBy("Station", "Source").agg(sum_strict("Secchi").alias("Total"))


@register("mean_na_rm", "SELECT Station, round(avg(Secchi), 6) AS Secchi FROM fx_env GROUP BY 1")
def mean_na_rm(t):
    return t.env.groupBy("Station").agg(F.round(F.avg("Secchi"), 6).alias("Secchi"))


@register("count_detections", "SELECT Taxlifestage, count(*) FILTER (CPUE > 0) AS N_detect FROM fx_label GROUP BY 1")
def count_detections(t):
    return t.labelled.groupBy("Taxlifestage").agg(F.count_if(F.col("CPUE") > 0).alias("N_detect"))


@register("sort_multi", 'SELECT SampleID, Taxname, "Order", Genus, CPUE FROM fx_catch ORDER BY "Order", Genus, Taxname, SampleID, CPUE')
def sort_multi(t):
    return O.arrange(t.catch.select("SampleID", "Taxname", "Order", "Genus", "CPUE"), "Order", "Genus", "Taxname", "SampleID", "CPUE")


@register("sort_by_level", f"""SELECT SampleID, {ZONE_SQL} AS Zone FROM fx_env
 ORDER BY CASE {ZONE_SQL} WHEN 'Freshwater' THEN 1 WHEN 'Low salinity zone' THEN 2 WHEN 'High salinity zone' THEN 3 END DESC NULLS LAST, SampleID""")
def sort_by_level(t):
    return O.arrange_by_level(t.env.select("SampleID", salinity_zone().alias("Zone")), "Zone", SALINITY_ZONES, "SampleID")


@register("level_index", """SELECT Taxlifestage, row_number() OVER (ORDER BY n1, Phylum, n2, Class, n3, "Order", n4, Family, n5, Genus, n6, Species, Lifestage, Taxlifestage) AS Level FROM (
 SELECT DISTINCT Taxlifestage, Phylum IS NULL AS n1, Phylum, Class IS NULL AS n2, Class, "Order" IS NULL AS n3, "Order", Family IS NULL AS n4, Family,
  Genus IS NULL AS n5, Genus, Species IS NULL AS n6, Species, Lifestage FROM fx_label)""")
def level_index(t):
    return O.level_index(t.labelled, "Taxlifestage", [*RANKS, "Lifestage"])


@register("first_choice", "SELECT min(Lifestage) AS Lifestage FROM fx_catch")
def first_choice(t):
    return O.first_choice(t.catch, "Lifestage")


@register("first_choice_by_level", "SELECT 'Micro' AS SizeClass FROM (SELECT 1 WHERE EXISTS (SELECT 1 FROM fx_catch WHERE SizeClass = 'Micro'))")
def first_choice_by_level(t):
    return O.first_choice(t.catch, "SizeClass", ["Micro", "Meso", "Macro"])


@register("union_ragged", """SELECT SampleID, Station, Secchi, NULL AS Taxname, NULL AS CPUE FROM fx_env
 UNION ALL SELECT SampleID, NULL, NULL, Taxname, CPUE FROM fx_catch""")
def union_ragged(t):
    return B.union_ragged(t.env.select("SampleID", "Station", "Secchi"), t.catch.select("SampleID", "Taxname", "CPUE"))


@register("intersect_values", "SELECT Taxlifestage FROM fx_label WHERE SizeClass = 'Micro' INTERSECT SELECT Taxlifestage FROM fx_label WHERE SizeClass = 'Macro'")
def intersect_values(t):
    one = lambda size: t.labelled.filter(F.col("SizeClass") == size).select("Taxlifestage")
    return one("Micro").intersect(one("Macro"))


@register("values_not_found", "SELECT DISTINCT Taxlifestage FROM fx_label WHERE SizeClass = 'Micro' EXCEPT SELECT Taxlifestage FROM fx_label WHERE SizeClass = 'Macro'")
def values_not_found(t):
    one = lambda size: t.labelled.filter(F.col("SizeClass") == size).select("Taxlifestage")
    return one("Micro").subtract(one("Macro"))


@register("explode_report", """SELECT Taxlifestage, SizeClass FROM (SELECT DISTINCT Source, Taxlifestage, SizeClass FROM fx_label)""")
def explode_report(t):
    items = t.labelled.select("Source", "Taxlifestage", "SizeClass").distinct()
    item = F.concat("Taxlifestage", F.lit(" ("), "SizeClass", F.lit(")"))
    report = items.groupBy("Source").agg(F.concat(F.lit("Removed: "), F.array_join(F.collect_list(item), ", ")).alias("message"))
    return B.explode_report(report)


@register("join_full", """SELECT coalesce(a.SampleID, b.SampleID) AS SampleID, Meso, Micro
 FROM (SELECT SampleID, sum(CPUE) AS Meso FROM fx_catch WHERE SizeClass = 'Meso' GROUP BY 1) a
 FULL JOIN (SELECT SampleID, sum(CPUE) AS Micro FROM fx_catch WHERE SizeClass = 'Micro' GROUP BY 1) b ON a.SampleID = b.SampleID""")
def join_full(t):
    one = lambda size: t.catch.filter(F.col("SizeClass") == size).groupBy("SampleID").agg(F.sum("CPUE").alias(size))
    return B.totals_before_after(one("Meso"), one("Micro"))


@register("join_anti", "SELECT SampleID, SizeClass, Taxlifestage, CPUE FROM fx_label l WHERE NOT EXISTS (SELECT 1 FROM fx_under u WHERE u.SizeClass = l.SizeClass AND concat(u.Taxname, ' ', u.Lifestage) = l.Taxlifestage)")
def join_anti(t):
    listed = t.under.selectExpr("SizeClass", "concat(Taxname, ' ', Lifestage) AS Taxlifestage")
    return B.without_listed(t.labelled, listed, ["SizeClass", "Taxlifestage"]).select("SampleID", "SizeClass", "Taxlifestage", "CPUE")


@register("join_semi", "SELECT SampleID, SizeClass, Taxname, CPUE FROM fx_catch WHERE SampleID IN (SELECT SampleID FROM fx_env WHERE SalSurf < 6)")
def join_semi(t):
    return B.keep_ids(t.catch, t.env.filter("SalSurf < 6"), "SampleID", "SampleID").select("SampleID", "SizeClass", "Taxname", "CPUE")


@register("export_with_env", VIEWS + """SELECT c.Source, c.SampleID, c.SizeClass, c.Taxlifestage, c.CPUE, c.Undersampled, e.Date, e.Year, e.Month, e.Station, e.Latitude, e.Longitude, e.SalSurf, e.SalBott, e.Secchi, e.Temperature, e.Chl, e.Tide
 FROM comv c LEFT JOIN fx_env e ON e.SampleID = c.SampleID AND e.Source = c.Source""")
def export_with_env(t):
    data = t.community(undersampled=t.listed, all_env=True).data
    return data.drop(*RANKS, "Taxname", "Lifestage")


LEVELS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"]
EFFORT_SQL = """, per AS (SELECT Source, Month, Year, avg(n) AS N FROM (SELECT Source, Month, Year, Station, count(*) AS n FROM fx_env
  WHERE Source IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD') GROUP BY ALL) GROUP BY ALL),
grid AS (SELECT s.Source, CAST(m.Month AS INT) AS Month, y.Year, N FROM (SELECT unnest(['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD']) AS Source) s
 CROSS JOIN (SELECT unnest(range(1, 13)) AS Month) m CROSS JOIN (SELECT DISTINCT Year FROM per) y
 LEFT JOIN per ON per.Source = s.Source AND per.Month = m.Month AND per.Year = y.Year)
"""


@register("effort_grid", EFFORT_SQL + "SELECT Source, Month, Year, round(N, 6) AS N FROM grid")
def effort_grid(t):
    return E.effort_grid(t.env, LEVELS).select("Source", "Month", "Year", fixed("N"))


@register("effort_year", EFFORT_SQL + "SELECT Source, Year, round(avg(N), 6) AS N FROM grid GROUP BY 1, 2 HAVING avg(N) IS NOT NULL")
def effort_year(t):
    return E.effort_by_year(E.effort_grid(t.env, LEVELS)).select("Source", "Year", fixed("N"))


@register("effort_month", EFFORT_SQL + """SELECT g.Source, Month, round(avg(coalesce(N, 0)), 6) AS N FROM grid g JOIN fx_start s ON s.Source = g.Source
 WHERE g.Year >= year(s.Startdate) GROUP BY 1, 2 HAVING avg(coalesce(N, 0)) > 0""")
def effort_month(t):
    return E.effort_by_month(E.effort_grid(t.env, LEVELS), t.start).select("Source", "Month", fixed("N"))


@register("complete_grid", """SELECT Source, Zone, Year, n FROM (SELECT unnest(['AUTOMOBILE', 'BUILDING']) AS Source) CROSS JOIN (SELECT unnest(['Freshwater', 'Low salinity zone', 'High salinity zone']) AS Zone)
 CROSS JOIN (SELECT DISTINCT Year FROM fx_env) LEFT JOIN (SELECT Source AS s, """ + ZONE_SQL + """ AS z, Year AS y, count(*) AS n FROM fx_env GROUP BY 1, 2, 3) ON s = Source AND z = Zone AND y = Year""")
def complete_grid(t):
    counts = t.env.groupBy("Source", salinity_zone().alias("Zone"), "Year").agg(F.count("*").alias("n"))
    return E.complete_grid(counts, {"Source": ["AUTOMOBILE", "BUILDING"], "Zone": SALINITY_ZONES}, "Year")


@register("yearly_levels", f"SELECT Year, Zone, count(*) AS N, any_value(o) AS Zone_order FROM (SELECT Year, {ZONE_SQL} AS Zone, CASE {ZONE_SQL} WHEN 'Freshwater' THEN 1 WHEN 'Low salinity zone' THEN 2 WHEN 'High salinity zone' THEN 3 END AS o FROM fx_env) GROUP BY 1, 2")
def yearly_levels(t):
    zoned = t.env.select("Year", level(salinity_zone(), SALINITY_ZONES).alias("Zone"))
    return zoned.groupBy("Year", "Zone").agg(F.count("*").alias("N")).withColumn("Zone_order", level_order("Zone", SALINITY_ZONES))


@register("rank_table", """SELECT Taxname AS query, max(Phylum) AS Phylum, max(Class) AS Class, max("Order") AS "Order", max(Family) AS Family, max(Genus) AS Genus, max(Species) AS Species FROM (
 SELECT Taxname, min(Phylum) AS Phylum, min(Class) AS Class, min("Order") AS "Order", min(Family) AS Family, min(Genus) AS Genus, min(Species) AS Species FROM fx_catch GROUP BY 1) GROUP BY 1""")
def rank_table(t):
    lines = t.catch.select(F.col("Taxname").alias("query"), *RANKS).distinct()
    long = lines.unpivot("query", list(RANKS), "rank", "name").filter("name IS NOT NULL")
    return B.rank_table(long)
