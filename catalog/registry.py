"""Registration of queries and the SQL form of the tables they read."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.functions.classes import taxlifestage
from surveyloom.operators.filters import select_catch
from surveyloom.operators.synth import Synth, synthesize
from surveyloom.schemas import LINEAGE_KEY, SAMPLE_KEY
from surveyloom.session import stage, tune
from surveyloom.sources import rolemap

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The survey tables of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = tune(spark), sf_dir

    @cached_property
    def env(self) -> DataFrame:
        return rolemap.env(self.spark, self.sf_dir)

    @cached_property
    def catch(self) -> DataFrame:
        return rolemap.catch(self.spark, self.sf_dir)

    @cached_property
    def under(self) -> DataFrame:
        return rolemap.undersampled(self.catch)

    @property
    def listed(self) -> Callable[[DataFrame], DataFrame]:
        """The same list from the lineages of a synthesis."""
        return rolemap.undersampled

    @cached_property
    def start(self) -> DataFrame:
        return rolemap.start_dates(self.spark, self.sf_dir)

    @cached_property
    def intro(self) -> DataFrame:
        return rolemap.introductions(self.spark)

    @cached_property
    def fish(self) -> DataFrame:
        return rolemap.fish(self.spark, self.sf_dir)

    @cached_property
    def regions(self) -> DataFrame:
        return rolemap.regions(self.spark)

    @cached_property
    def labelled(self) -> DataFrame:
        """Catch rows with their taxon and life stage label."""
        return self.catch.withColumn("Taxlifestage", taxlifestage())

    def table(self, name: str) -> DataFrame:
        return rolemap.table(self.spark, self.sf_dir, name)

    def written_catch(self, sources=None, size_classes=None, taxa=None) -> DataFrame:
        """The selected catches, joined once and written, for queries that read them more than once."""
        kept = select_catch(self.catch, sources, size_classes, taxa)
        return stage(kept.select(*SAMPLE_KEY, *LINEAGE_KEY, "CPUE"), "catch")

    def community(self, sources=None, size_classes=None, **options) -> Synth:
        return synthesize(self.written_catch(sources, size_classes), self.env, "Community", sources, size_classes, **options)

    def taxa(self, taxa=None, **options) -> Synth:
        return synthesize(self.written_catch(taxa=taxa), self.env, "Taxa", taxa=taxa, **options)


def register(name: str, sql: str | None = None):
    """Register a query function of ``Tables``; ``sql`` may use the common tables below."""

    def keep(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
        if sql is not None:
            recursive = "RECURSIVE " if " UNION ALL\n SELECT sys, k + 1" in sql else ""
            SQL[name] = f"WITH {recursive}{COMMON}\n{sql.strip()}" if not sql.lstrip().startswith(",") else f"WITH {recursive}{COMMON}{sql.strip()}"
        return build

    return keep


def fixed(column: str, digits: int = 6):
    """A computed floating-point column, rounded for comparison across engines."""
    return F.round(F.col(f"`{column}`"), digits).alias(column)


COMMON = """
fx_env AS (
 SELECT o_orderkey AS SampleID, c_mktsegment AS Source, CAST(o_orderdate AS DATE) AS Date,
  CAST(year(o_orderdate) AS INT) AS Year, CAST(month(o_orderdate) AS INT) AS Month,
  concat('ST', CAST(c_custkey % 40 AS VARCHAR)) AS Station,
  CASE WHEN c_custkey % 40 <> 39 THEN CAST(37.8 AS DOUBLE) + CAST(((c_custkey % 40) * 7) % 17 AS DOUBLE) * CAST(0.05 AS DOUBLE) END AS Latitude,
  CASE WHEN c_custkey % 40 <> 39 THEN CAST(-122.5 AS DOUBLE) + CAST(((c_custkey % 40) * 11) % 25 AS DOUBLE) * CAST(0.05 AS DOUBLE) END AS Longitude,
  CASE WHEN o_orderkey % 29 <> 0 THEN CAST((o_orderkey * 13 + o_custkey * 7) % 330 AS DOUBLE) / CAST(10 AS DOUBLE) END AS SalSurf,
  CASE WHEN o_orderkey % 31 <> 0 THEN CAST((o_orderkey * 13 + o_custkey * 7) % 330 + o_orderkey % 5 AS DOUBLE) / CAST(10 AS DOUBLE) END AS SalBott,
  CASE WHEN o_orderkey % 37 <> 0 THEN CAST((o_orderkey * 3) % 200 AS DOUBLE) END AS Secchi,
  CAST((o_orderkey * 17 + c_custkey) % 200 AS DOUBLE) / CAST(10 AS DOUBLE) AS Temperature,
  CAST((c_custkey * 29 + o_orderkey) % 300 AS DOUBLE) / CAST(10 AS DOUBLE) AS Chl,
  o_orderpriority AS Tide
 FROM orders JOIN customer ON o_custkey = c_custkey),
fx_raw AS (
 SELECT e.SampleID, e.Source, e.Year,
  CASE l_returnflag WHEN 'N' THEN 'Micro' WHEN 'A' THEN 'Meso' ELSE 'Macro' END AS SizeClass,
  CASE l_linestatus WHEN 'O' THEN 'Adult' ELSE 'Juvenile' END AS Lifestage,
  CASE WHEN l_discount = 0 THEN CAST(0 AS DOUBLE) ELSE l_quantity END AS CPUE,
  CAST(l_linenumber AS DOUBLE) AS Volume,
  split_part(p_name,' ',1) AS adj, split_part(p_name,' ',2) AS gen, p_name AS sp,
  CASE e.Source WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN 1 WHEN 'FURNITURE' THEN 2 WHEN 'HOUSEHOLD' THEN 3 ELSE 4 END AS si,
  CASE split_part(p_name,' ',1) WHEN 'blue' THEN 0 WHEN 'cold' THEN 1 WHEN 'hot' THEN 2 WHEN 'large' THEN 3 WHEN 'new' THEN 4 WHEN 'old' THEN 5 WHEN 'red' THEN 6 ELSE 7 END AS ai
 FROM lineitem JOIN fx_env e ON l_orderkey = e.SampleID JOIN part ON l_partkey = p_partkey),
fx_lvl AS (
 SELECT *, CASE
  WHEN gen = 'widget' AND si = 0 THEN 'none'
  WHEN gen = 'gizmo' AND si = 1 THEN 'Class'
  WHEN gen = 'rod' AND si = 2 THEN 'Order'
  WHEN gen = 'plate' AND adj = 'hot' AND Year < 1997 THEN 'Genus'
  WHEN gen = 'ring' AND adj = 'cold' AND Year < 2000 THEN 'Genus'
  WHEN (ai + si) % 7 = 0 THEN 'Genus' ELSE 'Species' END AS lvl
 FROM fx_raw),
fx_comb AS (
 SELECT SampleID, Source, SizeClass, Lifestage, CPUE, Volume,
  CASE WHEN gen='widget' THEN 'Rotifera' ELSE 'Arthropoda' END AS Phylum,
  CASE WHEN gen IN ('anvil','bolt','gear','gizmo') THEN 'Copepoda' WHEN gen IN ('plate','ring') THEN 'Branchiopoda' WHEN gen='rod' THEN 'Malacostraca' ELSE 'Eurotatoria' END AS Class,
  CASE WHEN lvl IN ('Order','Genus','Species') THEN CASE WHEN gen IN ('anvil','bolt') THEN 'Calanoida' WHEN gen='gear' THEN 'Cyclopoida' WHEN gen='gizmo' THEN 'Harpacticoida' WHEN gen IN ('plate','ring') THEN 'Cladocera' WHEN gen='rod' THEN 'Mysida' ELSE 'Ploima' END END AS "Order",
  CASE WHEN lvl IN ('Genus','Species') THEN concat(CASE WHEN gen IN ('anvil','bolt') THEN 'calan' ELSE gen END,'idae') END AS Family,
  CASE WHEN lvl IN ('Genus','Species') THEN gen END AS Genus,
  CASE WHEN lvl = 'Species' THEN sp END AS Species
 FROM fx_lvl WHERE lvl <> 'none'),
fx_catch AS (SELECT *, coalesce(Species, Genus, Family, "Order", Class, Phylum) AS Taxname FROM fx_comb),
fx_label AS (SELECT *, concat(Taxname, ' ', Lifestage) AS Taxlifestage FROM fx_catch),
fx_under AS (
 SELECT DISTINCT SizeClass, Taxname, Lifestage FROM fx_catch
 WHERE (SizeClass = 'Macro' AND Class <> 'Malacostraca') OR (SizeClass = 'Meso' AND Phylum = 'Rotifera')),
fx_start AS (SELECT Source, min(Date) AS Startdate FROM fx_env GROUP BY Source),
fx_intro AS (SELECT 'cold ring' AS Taxname, 1998 AS Intro_year UNION ALL SELECT 'hot plate', 1996),
fx_fish AS (
 SELECT event_id AS fishid, event_type AS survey, DATE '1995-01-01' + CAST((event_id * 13) % 2400 AS INT) AS date,
  CAST((event_id * 37) % 330 AS DOUBLE) / CAST(10 AS DOUBLE) AS sal,
  CAST(37.8 AS DOUBLE) + CAST(((user_id % 40) * 7) % 17 AS DOUBLE) * CAST(0.05 AS DOUBLE) + CAST(event_id % 9 - 4 AS DOUBLE) * CAST(0.004 AS DOUBLE) AS lat,
  CAST(-122.5 AS DOUBLE) + CAST(((user_id % 40) * 11) % 25 AS DOUBLE) * CAST(0.05 AS DOUBLE) + CAST(event_id % 7 - 3 AS DOUBLE) * CAST(0.004 AS DOUBLE) AS long
 FROM events),
fx_rect AS (
 SELECT 'West' AS Region, -122.525 AS x0, -122.125 AS x1, 37.775 AS y0, 38.225 AS y1
 UNION ALL SELECT 'Middle', -122.125, -121.725, 37.775, 38.225
 UNION ALL SELECT 'North', -122.525, -121.725, 38.225, 38.625)
"""


def roll_up_sql(base: str = "fx_catch", consistent: bool = False) -> str:
    """Common tables of the roll-up: coverage of rank values, targets, community rows, taxa rows.

    ``base`` needs a Year column when ``consistent`` asks for yearly counting.
    """
    ranks = ["Phylum", "Class", '"Order"', "Family", "Genus", "Species"]
    year = ", Year" if consistent else ""
    values = "\n UNION ".join(
        f"SELECT Source, SizeClass, Lifestage, {i} AS r, {name} AS v{year} FROM base WHERE {name} IS NOT NULL"
        for i, name in enumerate(ranks, 1)
    )
    joins = "\n ".join(
        f"LEFT JOIN cov k{i} ON k{i}.SizeClass = b.SizeClass AND k{i}.Lifestage = b.Lifestage AND k{i}.r = {i} AND k{i}.v = b.{name}"
        for i, name in enumerate(ranks, 1)
    )
    target = "coalesce(" + ", ".join(f"k{i}.v" for i in range(6, 0, -1)) + ")"
    target_rank = "CASE " + " ".join(f"WHEN k{i}.v IS NOT NULL THEN {i}" for i in range(6, 0, -1)) + " END"
    shown = ", ".join(f"max(CASE WHEN tr >= {i} THEN {name} END) AS {name}" for i, name in enumerate(ranks, 1))
    gap = """,
bad AS (SELECT DISTINCT p.Source, p.SizeClass, p.Lifestage, p.r, p.v
 FROM (SELECT DISTINCT Source, SizeClass, Lifestage, r, v FROM vals) p
 JOIN (SELECT DISTINCT Source, SizeClass, Year FROM base) y ON y.Source = p.Source AND y.SizeClass = p.SizeClass
 JOIN fx_start s ON s.Source = p.Source LEFT JOIN fx_intro i ON i.Taxname = p.v
 LEFT JOIN vals c ON c.Source = p.Source AND c.SizeClass = p.SizeClass AND c.Lifestage = p.Lifestage AND c.r = p.r AND c.v = p.v AND c.Year = y.Year
 WHERE y.Year >= year(s.Startdate) AND (i.Intro_year IS NULL OR y.Year >= i.Intro_year + 2) AND c.v IS NULL)""" if consistent else ""
    source = "(SELECT v.* FROM vals v ANTI JOIN bad b ON b.Source = v.Source AND b.SizeClass = v.SizeClass AND b.Lifestage = v.Lifestage AND b.r = v.r AND b.v = v.v)" if consistent else "vals"
    groups = "\n UNION ALL ".join(
        f"SELECT b.*, g.v AS gname, {i} AS gr FROM marked b JOIN grp g ON g.SizeClass = b.SizeClass AND g.Lifestage = b.Lifestage AND g.r = {i} AND g.v = b.{name}"
        for i, name in enumerate(ranks[:5], 1)
    )
    members = "\n UNION ".join(
        f"SELECT SizeClass, Lifestage, {i} AS r, {name} AS v, Taxname FROM base WHERE {name} IS NOT NULL"
        for i, name in enumerate(ranks[:5], 1)
    )
    group_shown = ", ".join(f"max(CASE WHEN gr >= {i} THEN {name} END) AS {name}" for i, name in enumerate(ranks, 1))
    return f""",
base AS ({base if base.lstrip().upper().startswith("SELECT") else f"SELECT * FROM {base}"}),
vals AS ({values}){gap},
marked AS (SELECT b.*, u.Taxname IS NOT NULL AS under FROM base b LEFT JOIN fx_under u
 ON u.SizeClass = b.SizeClass AND u.Taxname = b.Taxname AND u.Lifestage = b.Lifestage),
nsrc AS (SELECT SizeClass, count(DISTINCT Source) AS n FROM base GROUP BY SizeClass),
cov AS (SELECT v.SizeClass, v.Lifestage, v.r, v.v FROM {source} v JOIN nsrc ON nsrc.SizeClass = v.SizeClass
 GROUP BY v.SizeClass, v.Lifestage, v.r, v.v, nsrc.n HAVING count(DISTINCT v.Source) = nsrc.n),
tgt AS (SELECT b.*, {target} AS target, {target_rank} AS tr
 FROM marked b {joins}),
com AS (SELECT Source, SampleID, SizeClass, target AS Taxname, Lifestage, concat(target, ' ', Lifestage) AS Taxlifestage,
  sum(CPUE) AS CPUE, bool_or(under) AS Undersampled, {shown}
 FROM tgt WHERE target IS NOT NULL GROUP BY Source, SampleID, SizeClass, target, Lifestage),
memb AS ({members}),
grp AS (SELECT c.* FROM cov c JOIN (SELECT SizeClass, Lifestage, r, v FROM memb GROUP BY ALL HAVING count(DISTINCT Taxname) >= 2) m
 ON m.SizeClass = c.SizeClass AND m.Lifestage = c.Lifestage AND m.r = c.r AND m.v = c.v),
grows AS ({groups}),
tax AS (
 SELECT Source, SampleID, SizeClass, concat(gname, '_all') AS Taxname, Lifestage,
  concat(gname, '_all ', Lifestage, ' (', SizeClass, ')') AS Taxlifestage, 'Summed group' AS Taxatype, sum(CPUE) AS CPUE,
  bool_or(under) AS Undersampled, {group_shown}
 FROM grows w GROUP BY Source, SampleID, SizeClass, gname, Lifestage
 UNION ALL
 SELECT Source, SampleID, SizeClass, Taxname, Lifestage, concat(Taxname, ' ', Lifestage), 'Taxon', sum(CPUE), bool_or(under),
  Phylum, Class, "Order", Family, Genus, Species
 FROM marked GROUP BY Source, SampleID, SizeClass, Taxname, Lifestage, Phylum, Class, "Order", Family, Genus, Species)
"""


# The synthesis joined to its samples, as the views read it.
VIEW_SQL = """,
comv AS (SELECT c.*, e.Date, e.Year, e.Month, e.Station, e.Latitude, e.Longitude, e.SalSurf FROM com c LEFT JOIN fx_env e ON e.SampleID = c.SampleID AND e.Source = c.Source),
taxv AS (SELECT c.*, e.Date, e.Year, e.Month, e.Station, e.Latitude, e.Longitude, e.SalSurf FROM tax c LEFT JOIN fx_env e ON e.SampleID = c.SampleID AND e.Source = c.Source)
"""
ROLL_UP = roll_up_sql()
VIEWS = ROLL_UP + VIEW_SQL
