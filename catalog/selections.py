"""Queries of row filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import register
from surveyloom.operators import filters as R
from surveyloom.operators.filters import SampleFilter

ROW = ["Source", "SampleID", "SizeClass", "Taxname", "Lifestage", "CPUE"]
ROW_SQL = "SELECT Source, SampleID, SizeClass, Taxname, Lifestage, CPUE FROM fx_catch WHERE "
ENV = ["Source", "SampleID", "Date", "Station", "Latitude", "Longitude", "SalSurf"]
ENV_SQL = "SELECT Source, SampleID, Date, Station, Latitude, Longitude, SalSurf FROM fx_env WHERE "


@register("filter_sources", ROW_SQL + "Source IN ('AUTOMOBILE', 'MACHINERY')")
def filter_sources(t):
    return R.select_catch(t.catch, sources=["AUTOMOBILE", "MACHINERY"]).select(*ROW)


@register("filter_sizeclass", ROW_SQL + "SizeClass IN ('Meso', 'Macro')")
def filter_sizeclass(t):
    return R.select_catch(t.catch, size_classes=["Meso", "Macro"]).select(*ROW)


@register("filter_taxa", ROW_SQL + """coalesce(Taxname IN ('Cladocera', 'hot gear'), FALSE) OR coalesce("Order" IN ('Cladocera', 'hot gear'), FALSE) OR coalesce(Species IN ('Cladocera', 'hot gear'), FALSE)""")
def filter_taxa(t):
    return R.select_catch(t.catch, taxa=["Cladocera", "hot gear"]).select(*ROW)


@register("filter_dates", ENV_SQL + "Date BETWEEN DATE '1995-02-01' AND DATE '1998-11-30'")
def filter_dates(t):
    return SampleFilter(dates=("1995-02-01", "1998-11-30")).apply(t.env).select(*ENV)


@register("filter_months", ENV_SQL + "month(Date) IN (4, 5, 6)")
def filter_months(t):
    return SampleFilter(months=(4, 5, 6)).apply(t.env).select(*ENV)


@register("filter_salinity", ENV_SQL + "SalSurf BETWEEN 0 AND 7")
def filter_salinity(t):
    return SampleFilter(sal_surf=(0, 7)).apply(t.env).select(*ENV)


@register("filter_latitude", ENV_SQL + "Latitude BETWEEN 37.9 AND 38.3")
def filter_latitude(t):
    return SampleFilter(latitude=(37.9, 38.3)).apply(t.env).select(*ENV)


@register("filter_longitude", ENV_SQL + "Longitude >= -122.1")
def filter_longitude(t):
    return SampleFilter(longitude=(-122.1, None)).apply(t.env).select(*ENV)


@register("drop_null_coords", ENV_SQL + "Latitude IS NOT NULL AND Longitude IS NOT NULL")
def drop_null_coords(t):
    return R.with_coordinates(t.env).select(*ENV)


@register("filter_in", ROW_SQL + "Lifestage IN ('Adult') AND Taxname IN ('hot gear', 'gear', 'Mysida')")
def filter_in(t):
    return t.catch.filter(F.col("Lifestage").isin("Adult") & F.col("Taxname").isin("hot gear", "gear", "Mysida")).select(*ROW)


@register("filter_not_in", "SELECT Source, SampleID, Genus, CPUE FROM fx_catch WHERE Genus IS NULL OR Genus NOT IN ('gear', 'ring')")
def filter_not_in(t):
    return R.without(t.catch, "Genus", ["gear", "ring"]).select("Source", "SampleID", "Genus", "CPUE")


@register("filter_ne", ENV_SQL + "Source <> 'HOUSEHOLD' AND Station = 'ST7'")
def filter_ne(t):
    return t.env.filter((F.col("Source") != "HOUSEHOLD") & (F.col("Station") == "ST7")).select(*ENV)


@register("filter_undersampled", """SELECT Source, SampleID, c.SizeClass, c.Taxname, c.Lifestage, CPUE FROM fx_catch c
 ANTI JOIN fx_under u ON u.SizeClass = c.SizeClass AND u.Taxname = c.Taxname AND u.Lifestage = c.Lifestage""")
def filter_undersampled(t):
    return R.drop_undersampled(R.flag_undersampled(t.catch.select(*ROW), t.under)).select(*ROW)


@register("select_taxa_or_all", """SELECT Source, SampleID, Taxlifestage, CPUE FROM fx_label
 WHERE (SELECT count(DISTINCT Taxlifestage) FROM fx_label WHERE Taxlifestage IN ('hot gear Adult', 'Mysida Juvenile')) < 2
 OR Taxlifestage IN ('hot gear Adult', 'Mysida Juvenile')""")
def select_taxa(t):
    return R.select_or_all(t.labelled, "Taxlifestage", ["hot gear Adult", "Mysida Juvenile"]).select(
        "Source", "SampleID", "Taxlifestage", "CPUE"
    )


@register("select_taxa_missing", "SELECT Source, SampleID, Taxlifestage, CPUE FROM fx_label")
def select_taxa_missing(t):
    return R.select_or_all(t.labelled, "Taxlifestage", ["hot gear Adult", "no such taxon"]).select(
        "Source", "SampleID", "Taxlifestage", "CPUE"
    )


@register("filter_year", ENV_SQL + "Year = 1996")
def filter_year(t):
    return t.env.filter("Year = 1996").select(*ENV)


@register("filter_or", ENV_SQL + "Date > DATE '1996-01-01' AND (SalSurf > 20 OR SalBott > 20)")
def filter_or(t):
    return t.env.filter("Date > DATE '1996-01-01' AND (SalSurf > 20 OR SalBott > 20)").select(*ENV)


@register("filter_threshold", "SELECT Source, SampleID, Taxname, CPUE, Volume FROM fx_catch WHERE Volume > 1")
def filter_threshold(t):
    return t.catch.filter("Volume > 1").select("Source", "SampleID", "Taxname", "CPUE", "Volume")


@register("drop_na", ENV_SQL + "Latitude IS NOT NULL AND Longitude IS NOT NULL AND SalSurf IS NOT NULL")
def drop_na(t):
    return R.drop_missing(t.env.select(*ENV))


@register("drop_na_named", ENV_SQL + "SalSurf IS NOT NULL")
def drop_na_named(t):
    return R.drop_missing(t.env.select(*ENV), ["SalSurf"])


@register("drop_blank", "SELECT SampleID, Secchi, SalSurf, SalBott FROM fx_env WHERE Secchi IS NOT NULL OR SalSurf IS NOT NULL OR SalBott IS NOT NULL")
def drop_blank(t):
    return R.drop_blank(t.env.select("SampleID", "Secchi", "SalSurf", "SalBott"), ["Secchi", "SalSurf", "SalBott"])


@register("groups_with_data", """SELECT c.SampleID, c.SizeClass, c.Taxname, c.CPUE FROM fx_catch c
 SEMI JOIN (SELECT SampleID, SizeClass FROM fx_catch GROUP BY ALL HAVING sum(CPUE) <> 0) g ON g.SampleID = c.SampleID AND g.SizeClass = c.SizeClass""")
def groups_with_data(t):
    rows = t.catch.select("SampleID", "SizeClass", "Taxname", "CPUE")
    return R.groups_with_data(rows, ["SampleID", "SizeClass"], "CPUE").select("SampleID", "SizeClass", "Taxname", "CPUE")
