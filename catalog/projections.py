"""Queries of scalar expressions: classes, dates, text, rounding."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import fixed, register
from surveyloom.functions import classes as C
from surveyloom.functions import masking
from surveyloom.functions import missing as N
from surveyloom.functions import text as X
from surveyloom.operators.gear import ITALIC_TAXA, log1p_block
from surveyloom.schemas import SALINITY_ZONES

GROUP_SQL = """CASE WHEN "Order" = 'Calanoida' THEN 'Calanoida' WHEN "Order" = 'Cyclopoida' THEN 'Cyclopoida'
 WHEN "Order" = 'Harpacticoida' THEN 'Harpacticoida' WHEN Class = 'Copepoda' THEN 'UnID copepods'
 WHEN "Order" = 'Mysida' THEN 'Mysida' WHEN "Order" = 'Cladocera' THEN 'Cladocera' WHEN Class = 'Insecta' THEN 'Insecta'
 WHEN Class = 'Cirripedia' THEN 'Cirripedia' WHEN Phylum = 'Rotifera' THEN 'Rotifera' ELSE 'Other' END"""
ZONE_SQL = """CASE WHEN SalSurf < 0.5 THEN 'Freshwater' WHEN SalSurf > 0.5 AND SalSurf < 6 THEN 'Low salinity zone'
 WHEN SalSurf > 6 THEN 'High salinity zone' END"""


@register("classify_group", f"SELECT Source, SampleID, Taxname, CPUE, {GROUP_SQL} AS Taxa FROM fx_catch")
def classify_group(t):
    return t.catch.select("Source", "SampleID", "Taxname", "CPUE", C.major_group().alias("Taxa"))


@register("salinity_zone", f"SELECT SampleID, SalSurf, {ZONE_SQL} AS Salinity_zone FROM fx_env")
def salinity_zone(t):
    return t.env.select("SampleID", "SalSurf", C.salinity_zone().alias("Salinity_zone"))


@register("lump_other", f"SELECT SampleID, CPUE, CASE WHEN g IN ('Calanoida', 'Mysida') THEN g ELSE 'Other' END AS Taxa FROM (SELECT *, {GROUP_SQL} AS g FROM fx_catch)")
def lump_other(t):
    return t.catch.select("SampleID", "CPUE", C.lump_other(C.major_group(), ["Calanoida", "Mysida"]).alias("Taxa"))


@register("group_fallback", "SELECT SampleID, CPUE, Taxname AS Taxa FROM fx_catch")
def group_fallback(t):
    grouped = t.catch.withColumn("Group", C.lump_other(C.major_group(), ["Mysida"]))
    return C.group_or_name(grouped).select("SampleID", "CPUE", "Taxa")


@register("ordered_category", f"""SELECT SampleID, Zone, CASE Zone WHEN 'Freshwater' THEN 1 WHEN 'Low salinity zone' THEN 2 END AS Zone_order
 FROM (SELECT SampleID, CASE WHEN z IN ('Freshwater', 'Low salinity zone') THEN z END AS Zone FROM (SELECT SampleID, {ZONE_SQL} AS z FROM fx_env))""")
def ordered_category(t):
    levels = SALINITY_ZONES[:2]
    zoned = t.env.select("SampleID", N.level(C.salinity_zone(), levels).alias("Zone"))
    return zoned.withColumn("Zone_order", N.level_order("Zone", levels))


@register("recode", "SELECT SampleID, CASE Source WHEN 'AUTOMOBILE' THEN 'AUTO' WHEN 'MACHINERY' THEN 'MACH' ELSE Source END AS Source FROM fx_env")
def recode(t):
    return t.env.select("SampleID", "Source").replace({"AUTOMOBILE": "AUTO", "MACHINERY": "MACH"}, subset=["Source"])


@register("month_label", "SELECT SampleID, CAST(month(Date) AS INT) AS Month, monthname(Date) AS Month_name FROM fx_env")
def month_label(t):
    return t.env.select("SampleID", F.month("Date").alias("Month"), X.month_name("Date").alias("Month_name"))


@register("parse_date", "SELECT SampleID, Date AS A, Date AS B, Date AS C, CAST(NULL AS DATE) AS D FROM fx_env")
def parse_date(t):
    patterns = {"A": "MM/dd/yyyy", "B": "yyyy-MM-dd", "C": "MMddyyyy"}
    texts = t.env.select("SampleID", *[F.date_format("Date", p).alias(n) for n, p in patterns.items()])
    return texts.select(
        "SampleID", *[X.parse_date(n, p).alias(n) for n, p in patterns.items()],
        X.parse_date(F.concat("A", F.lit("x")), "MM/dd/yyyy").alias("D"),
    )


@register("clock_time", "SELECT event_id, strftime(ts, '%H:%M') AS Clock FROM events")
def clock_time(t):
    return t.table("events").select("event_id", X.clock("ts").alias("Clock"))


@register("date_bounds", "SELECT SampleID, CAST(Date - INTERVAL 15 DAY AS DATE) AS Lower, CAST(Date + INTERVAL 15 DAY AS DATE) AS Upper FROM fx_env")
def date_bounds(t):
    return t.env.select("SampleID", F.date_sub("Date", 15).alias("Lower"), F.date_add("Date", 15).alias("Upper"))


@register("round_even", "SELECT SampleID, Taxname, CPUE, round_even(CPUE / 2, 0) AS Half FROM fx_catch")
def round_even(t):
    return t.catch.select("SampleID", "Taxname", "CPUE", N.round_even(F.col("CPUE") / 2).alias("Half"))


@register("signif", """SELECT SampleID, Chl, CASE WHEN Chl = 0 THEN 0 ELSE round(round_even(Chl * power(10, 1 - floor(log10(Chl))), 0) / power(10, 1 - floor(log10(Chl))), 6) END AS Chl_2
 FROM fx_env""")
def signif(t):
    return t.env.select("SampleID", "Chl", F.round(N.signif("Chl", 2), 6).alias("Chl_2"))


@register("format_thousands", "SELECT SampleID, format('{:,}', CAST(sum(CPUE) * 1000 AS BIGINT)) AS Label FROM fx_catch GROUP BY SampleID")
def format_thousands(t):
    return t.catch.groupBy("SampleID").agg(X.thousands(F.sum("CPUE") * 1000).alias("Label"))


@register("label_template", """SELECT SampleID, concat('<table><tr><td>Year</td><td>', CAST(Year AS VARCHAR), '</td></tr><tr><td>Source</td><td>', Source, '</td></tr></table>') AS Tooltip
 FROM fx_env""")
def label_template(t):
    template = "<table><tr><td>Year</td><td>%s</td></tr><tr><td>Source</td><td>%s</td></tr></table>"
    return t.env.select("SampleID", X.tooltip(template, "Year", "Source").alias("Tooltip"))


@register("sample_key", "SELECT SampleID, concat(coalesce(CAST(Date AS VARCHAR), 'NA'), ' ', Station, ' ', coalesce(CAST(CAST(SalSurf * 10 AS BIGINT) AS VARCHAR), 'NA')) AS Key FROM fx_env")
def sample_key(t):
    return t.env.select("SampleID", N.paste("Date", "Station", (F.col("SalSurf") * 10).cast("long")).alias("Key"))


@register("label_markup", "SELECT SampleID, CASE WHEN Taxname IN ('gear', 'hot gear') THEN concat('italic(''', Taxname, ''')') ELSE Taxname END AS Label FROM fx_catch")
def label_markup(t):
    return t.catch.select("SampleID", X.italic("Taxname", (*ITALIC_TAXA, "gear", "hot gear")).alias("Label"))


@register("string_clean", """SELECT SampleID, Source = upper(Source) AS Heading, replace(trim(concat('  ', Station, ' ', Source, ' ')), ' ', '_') AS Clean,
 split_part(concat(Station, '.xlsx'), '.', 1) AS Base FROM fx_env""")
def string_clean(t):
    padded = F.concat(F.lit("  "), "Station", F.lit(" "), "Source", F.lit(" "))
    return t.env.select(
        "SampleID", X.is_heading("Source").alias("Heading"), X.underscored(padded).alias("Clean"),
        X.base_name(F.concat("Station", F.lit(".xlsx"))).alias("Base"),
    )


@register("regex_extract", "SELECT SampleID, nullif(regexp_extract(Station, '[A-Z]+'), '') AS Transect, regexp_replace(Station, '[A-Z]+', '') AS Number FROM fx_env")
def regex_extract(t):
    return t.env.select(
        "SampleID", X.leading_capitals("Station").alias("Transect"), F.regexp_replace("Station", "[A-Z]+", "").alias("Number")
    )


@register("document_capitals", "SELECT doc_id, nullif(regexp_extract(text, '[A-Z]+'), '') AS Capitals FROM documents")
def document_capitals(t):
    return t.table("documents").select("doc_id", X.leading_capitals("text").alias("Capitals"))


@register("fill_null", "SELECT SampleID, coalesce(Secchi, 0) AS Secchi, coalesce(SalSurf, -1) AS SalSurf FROM fx_env")
def fill_null(t):
    return t.env.select("SampleID", "Secchi", "SalSurf").fillna({"Secchi": 0.0, "SalSurf": -1.0})


@register("derived_arith", "SELECT SampleID, CPUE * Volume AS Catch FROM fx_catch")
def derived_arith(t):
    return t.catch.select("SampleID", (F.col("CPUE") * F.col("Volume")).alias("Catch"))


@register("mean_salinity", "SELECT SampleID, (SalBott + SalSurf) / 2 AS Sal_avg FROM fx_env")
def mean_salinity(t):
    return t.env.select("SampleID", ((F.col("SalBott") + F.col("SalSurf")) / 2).alias("Sal_avg"))


@register("mask_fraction", "SELECT SampleID, CASE WHEN (SampleID * 7919) % 10 >= 1 THEN Secchi END AS Secchi_2 FROM fx_env")
def mask_fraction(t):
    return t.env.select("SampleID", masking.mask_by("Secchi", (F.col("SampleID") * 7919) % 10, 1).alias("Secchi_2"))


@register("mask_random", f"""SELECT SampleID, CASE WHEN CAST('0x' || substr(md5(concat(SampleID, ':7')), 1, 8) AS BIGINT) >= {int(0.1 * 2**32)}
 THEN Secchi END AS Secchi_2 FROM fx_env""")
def mask_random(t):
    return t.env.select("SampleID", masking.mask_random("Secchi", 0.1, 7, "SampleID").alias("Secchi_2"))


@register("log1p_block", "SELECT SampleID, round(ln(Temperature + 1), 6) AS Temperature_l, round(ln(Chl + 1), 6) AS Chl_l FROM fx_env")
def logged(t):
    return log1p_block(t.env, ["Temperature", "Chl"]).select("SampleID", fixed("Temperature_l"), fixed("Chl_l"))


@register("row_sum", "SELECT SampleID, round(SalSurf + SalBott + Temperature + Chl, 6) AS Total FROM fx_env")
def row_sum(t):
    return t.env.select("SampleID", F.round(N.row_sum(["SalSurf", "SalBott", "Temperature", "Chl"]), 6).alias("Total"))


@register("near", "SELECT SampleID, abs(SalSurf - SalBott) < greatest(1.5e-8, 1e-9 * greatest(abs(SalSurf), abs(SalBott))) AS Same FROM fx_env")
def near(t):
    return t.env.select("SampleID", N.near("SalSurf", "SalBott").alias("Same"))
