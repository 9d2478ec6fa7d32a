"""Queries of kept summaries, of long lists in chunks, and of tables written and read again."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from catalog import community, views  # noqa: F401 - their SQL is used again
from catalog.registry import SQL, register
from surveyloom import schemas
from surveyloom.operators import combine as B
from surveyloom.operators import summary as M
from surveyloom.operators.filters import SampleFilter, select_or_all
from surveyloom.operators.gear import gear_matrix
from surveyloom.operators.synth import Timing, filtered_base
from surveyloom.operators.views import PLACE, menu_tree
from surveyloom.session import staged_folder
from surveyloom.sources import tables as S


def folder(t, label: str) -> str:
    return f"{staged_folder(t.spark)}/{label}-{uuid.uuid4().hex}"


def kept_summary(t):
    """The summary of all catches, written with a batch for each year."""
    path = folder(t, "summary")
    M.write_batches(filtered_base(t.catch, t.env, SampleFilter(), True), path, F.col("Year"))
    return M.read_summary(t.spark, path)


def again(name: str, other: str):
    """Register a query that must give what the SQL of another one gives."""
    keep = register(name)
    SQL[name] = SQL[other]
    return keep


@again("menu_from_summary", "menu_tree")
def menu_from_summary(t):
    return menu_tree(M.taxa_labels(kept_summary(t)))


@again("caveats_from_summary", "caveats")
def caveats_from_summary(t):
    return M.community_caveats(kept_summary(t), Timing(t.start, t.intro))


@again("detections_from_summary", "count_detections")
def detections_from_summary(t):
    return M.detections(kept_summary(t))


@register("select_taxa_by_summary", """SELECT Source, SampleID, Taxlifestage, CPUE FROM fx_label
 WHERE (SELECT count(DISTINCT Taxlifestage) FROM fx_label WHERE Taxlifestage IN ('old bolt Adult', 'Mysida Juvenile')) < 2
 OR Taxlifestage IN ('old bolt Adult', 'Mysida Juvenile')""")
def select_taxa_by_summary(t):
    labels = M.detections(kept_summary(t))
    chosen = select_or_all(t.labelled, "Taxlifestage", ["old bolt Adult", "Mysida Juvenile"], labels)
    return chosen.select("Source", "SampleID", "Taxlifestage", "CPUE")


@register("set_chunks", """SELECT SizeClass, (k - 1) // 16 AS Chunk, count(*) AS N, string_agg(Taxlifestage, '|' ORDER BY k) AS Labels FROM (
 SELECT SizeClass, Taxlifestage, row_number() OVER (PARTITION BY SizeClass ORDER BY Taxlifestage) AS k FROM (SELECT DISTINCT SizeClass, Taxlifestage FROM fx_label)) GROUP BY 1, 2""")
def set_chunks(t):
    chunks = B.list_chunks(t.labelled, "SizeClass", ["Taxlifestage"], 16)
    return chunks.select(
        "SizeClass", "Chunk", F.size("Items").cast("long").alias("N"), F.array_join("Items.Taxlifestage", "|").alias("Labels")
    )


@register("transect_chunks", """SELECT Source, (k - 1) // 8 AS Chunk, count(*) AS N,
 string_agg(concat(CAST(CAST(round(Longitude * 100) AS BIGINT) AS VARCHAR), ' ', CAST(CAST(round(Latitude * 100) AS BIGINT) AS VARCHAR)), ', ' ORDER BY k) AS Points
 FROM (SELECT *, row_number() OVER (PARTITION BY Source ORDER BY Longitude, Latitude) AS k
  FROM (SELECT DISTINCT Source, Longitude, Latitude FROM fx_env WHERE Latitude IS NOT NULL)) GROUP BY 1, 2""")
def transect_chunks(t):
    text = lambda p: F.concat_ws(" ", *[F.round(p[c] * 100).cast("bigint").cast("string") for c in ("Longitude", "Latitude")])
    chunks = B.list_chunks(t.env.dropna(subset=list(PLACE)), "Source", ["Longitude", "Latitude"], 8)
    return chunks.select(
        "Source", "Chunk", F.size("Items").cast("long").alias("N"), F.array_join(F.transform("Items", text), ", ").alias("Points")
    )


@again("explode_report_chunks", "explode_report")
def explode_report_chunks(t):
    items = t.labelled.select("Source", F.concat("Taxlifestage", F.lit(" ("), "SizeClass", F.lit(")")).alias("item"))
    chunks = B.list_chunks(items, "Source", ["item"], 16)
    return B.explode_report(chunks.select(F.concat(F.lit("Removed: "), F.array_join("Items.item", ", ")).alias("message")))


SAVED = ["Source", "SampleID", "Date", "Station", "Latitude", "Longitude", "SalSurf", "Tide"]
SAVED_SQL = "SELECT Source, SampleID, Date, Station, Latitude, Longitude, SalSurf, Tide FROM fx_env"


@register("csv_round_trip", SAVED_SQL)
def csv_round_trip(t):
    saved = t.env.select(*SAVED)
    return S.read_csv(t.spark, S.export_csv(saved, folder(t, "csv"), "1.0", dt.date(2020, 1, 1)), saved.schema)


@register("csv_named_columns", "SELECT SampleID, Date, SalSurf FROM fx_env")
def csv_named_columns(t):
    saved = t.env.select(*SAVED)
    path = S.export_csv(saved, folder(t, "csv"), "1.0", dt.date(2020, 1, 1))
    return S.read_csv(t.spark, path, saved.schema, ["SampleID", "Date", "SalSurf"])


GENERA = ["anvil", "bolt", "gear", "plate", "ring", "rod"]


@register("tow_matrix_csv", "SELECT Source, SampleID, " + ", ".join(
    f"coalesce(sum(CASE WHEN Genus = '{g}' THEN CPUE END), 0) AS {g}" for g in GENERA
) + " FROM fx_catch WHERE SizeClass = 'Meso' GROUP BY 1, 2")
def tow_matrix_csv(t):
    matrix = gear_matrix(t.catch.filter("SizeClass = 'Meso'"), "Genus", GENERA, ["Source", "SampleID"])
    path = S.export_csv(matrix, folder(t, "matrix"), "1.0", dt.date(2020, 1, 1))
    return S.read_csv(t.spark, path, schemas.tow_matrix({"Source": schemas.STR, "SampleID": matrix.schema["SampleID"].dataType}, GENERA))


@register("all_stations", """, listed AS (SELECT DISTINCT Source, Station, Latitude, Longitude FROM fx_env WHERE Source IN ('AUTOMOBILE', 'BUILDING') AND Latitude IS NOT NULL)
SELECT * FROM listed
UNION ALL
SELECT Source, Station, min(Latitude), min(Longitude) FROM fx_env e WHERE Latitude IS NOT NULL
 AND NOT EXISTS (SELECT 1 FROM listed l WHERE l.Source = e.Source AND l.Station = e.Station) GROUP BY 1, 2""")
def all_stations(t):
    columns = ["Source", "Station", *PLACE]
    paths = []
    for source in ("AUTOMOBILE", "BUILDING"):
        paths.append(folder(t, "stations"))
        t.env.filter(F.col("Source") == source).select(*columns).dropna().distinct().write.parquet(paths[-1])
    return S.read_all_stations(t.spark, paths, t.env)
