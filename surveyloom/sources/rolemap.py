"""The survey data model laid over order tables.

Roles: survey = market segment, sample = order, size class = return flag, life stage = line
status, genus = noun of the part name, species = part name, CPUE = quantity (0 where the discount
is 0). Surveys differ in resolution by rule, so the roll-up keeps, lifts and removes taxa.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from surveyloom.schemas import REGIONS

STATION_LAT = "37.8D + CAST(({n} * 7) % 17 AS DOUBLE) * 0.05D"
STATION_LONG = "-122.5D + CAST(({n} * 11) % 25 AS DOUBLE) * 0.05D"
SALT = "(o_orderkey * 13 + o_custkey * 7) % 330"


# Declared, so that opening a table needs no job to read its footer.
SCHEMAS = {
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, l_discount double,
        l_returnflag string, l_linestatus string""",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_size int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string",
    "documents": "doc_id bigint, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def env(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = "c_custkey % 40"
    return table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey"), "o_custkey"
    ).withColumnRenamed("o_custkey", "c_custkey").selectExpr(
        "o_orderkey AS SampleID", "c_mktsegment AS Source", "CAST(o_orderdate AS DATE) AS Date",
        "year(o_orderdate) AS Year", "month(o_orderdate) AS Month",
        f"concat('ST', {number}) AS Station",
        f"IF({number} <> 39, {STATION_LAT.format(n=f'({number})')}, NULL) AS Latitude",
        f"IF({number} <> 39, {STATION_LONG.format(n=f'({number})')}, NULL) AS Longitude",
        f"IF(o_orderkey % 29 <> 0, CAST({SALT.replace('o_custkey', 'c_custkey')} AS DOUBLE) / 10D, NULL) AS SalSurf",
        f"IF(o_orderkey % 31 <> 0, CAST({SALT.replace('o_custkey', 'c_custkey')} + o_orderkey % 5 AS DOUBLE) / 10D, NULL) AS SalBott",
        "IF(o_orderkey % 37 <> 0, CAST((o_orderkey * 3) % 200 AS DOUBLE), NULL) AS Secchi",
        "CAST((o_orderkey * 17 + c_custkey) % 200 AS DOUBLE) / 10D AS Temperature",
        "CAST((c_custkey * 29 + o_orderkey) % 300 AS DOUBLE) / 10D AS Chl",
        "o_orderpriority AS Tide",
    )


def taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as species: names split and placed once per part, before they meet the lines."""
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS l_partkey", "p_name AS sp",
        "split_part(p_name, ' ', 1) AS adj", "split_part(p_name, ' ', 2) AS gen",
    ).selectExpr(
        "*",
        "coalesce(nullif(array_position(array('blue', 'cold', 'hot', 'large', 'new', 'old', 'red'), adj), 0), 8) - 1 AS ai",
        "IF(gen = 'widget', 'Rotifera', 'Arthropoda') AS Phylum",
        """CASE WHEN gen IN ('anvil', 'bolt', 'gear', 'gizmo') THEN 'Copepoda' WHEN gen IN ('plate', 'ring') THEN 'Branchiopoda'
           WHEN gen = 'rod' THEN 'Malacostraca' ELSE 'Eurotatoria' END AS Class""",
        """CASE WHEN gen IN ('anvil', 'bolt') THEN 'Calanoida' WHEN gen = 'gear' THEN 'Cyclopoida' WHEN gen = 'gizmo' THEN 'Harpacticoida'
           WHEN gen IN ('plate', 'ring') THEN 'Cladocera' WHEN gen = 'rod' THEN 'Mysida' ELSE 'Ploima' END AS ord""",
        "concat(IF(gen IN ('anvil', 'bolt'), 'calan', gen), 'idae') AS fam",
        # The survey that identifies the part less and how deep, and the year since which surveys name the species.
        "CASE gen WHEN 'widget' THEN 0 WHEN 'gizmo' THEN 1 WHEN 'rod' THEN 2 ELSE -1 END AS less_si",
        "CASE gen WHEN 'widget' THEN 0 WHEN 'gizmo' THEN 2 ELSE 3 END AS less_depth",
        "CASE WHEN gen = 'plate' AND adj = 'hot' THEN 1997 WHEN gen = 'ring' AND adj = 'cold' THEN 2000 END AS since",
    )


def catch(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The catch of a line is known before it moves, and the flags move as they are, which are short.
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS SampleID", "l_partkey", "l_returnflag", "l_linestatus", "l_linenumber",
        "IF(l_discount = 0, 0D, l_quantity) AS CPUE",
    )
    samples = env(spark, sf_dir).selectExpr(
        "SampleID", "Source", "Year",
        "coalesce(nullif(array_position(array('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD'), Source), 0), 5) - 1 AS si",
    )
    # Depth of identification: 6 species, 5 genus, 3 order, 2 class, 0 not counted.
    depth = "CASE WHEN si = less_si THEN less_depth WHEN Year < since OR (ai + si) % 7 = 0 THEN 5 ELSE 6 END AS depth"
    # Both sides grow with the data: a merge join, whose partitioning by sample the sums reuse.
    return lines.join(samples.hint("merge"), "SampleID").join(taxonomy(spark, sf_dir), "l_partkey").selectExpr(
        "*", depth
    ).filter("depth > 0").selectExpr(
        "SampleID", "Source",
        "CASE l_returnflag WHEN 'N' THEN 'Micro' WHEN 'A' THEN 'Meso' ELSE 'Macro' END AS SizeClass",
        "IF(l_linestatus = 'O', 'Adult', 'Juvenile') AS Lifestage", "CPUE", "CAST(l_linenumber AS DOUBLE) AS Volume",
        "Phylum", "Class", "IF(depth >= 3, ord, NULL) AS `Order`", "IF(depth >= 5, fam, NULL) AS Family",
        "IF(depth >= 5, gen, NULL) AS Genus", "IF(depth = 6, sp, NULL) AS Species",
        "CASE depth WHEN 6 THEN sp WHEN 5 THEN gen WHEN 3 THEN ord ELSE Class END AS Taxname",
    )


def undersampled(lines: DataFrame) -> DataFrame:
    """List of taxa their size class undersamples, from catches or from lineages."""
    return lines.filter(
        "(SizeClass = 'Macro' AND Class <> 'Malacostraca') OR (SizeClass = 'Meso' AND Phylum = 'Rotifera')"
    ).select("SizeClass", "Taxname", "Lifestage").distinct()


def start_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return env(spark, sf_dir).groupBy("Source").agg({"Date": "min"}).toDF("Source", "Startdate")


def introductions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("cold ring", 1998), ("hot plate", 1996)], "Taxname string, Intro_year int")


def fish(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = "(user_id % 40)"
    return table(spark, sf_dir, "events").selectExpr(
        "event_id AS fishid", "event_type AS survey",
        "date_add(DATE '1995-01-01', CAST((event_id * 13) % 2400 AS INT)) AS date",
        "CAST((event_id * 37) % 330 AS DOUBLE) / 10D AS sal",
        f"{STATION_LAT.format(n=number)} + CAST(event_id % 9 - 4 AS DOUBLE) * 0.004D AS lat",
        f"{STATION_LONG.format(n=number)} + CAST(event_id % 7 - 3 AS DOUBLE) * 0.004D AS long",
    )


# Region rectangles as (name, west, east, south, north).
RECTANGLES = (
    ("West", -122.525, -122.125, 37.775, 38.225),
    ("Middle", -122.125, -121.725, 37.775, 38.225),
    ("North", -122.525, -121.725, 38.225, 38.625),
)


def regions(spark: SparkSession) -> DataFrame:
    rows = [(name, [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]) for name, x0, x1, y0, y1 in RECTANGLES]
    return spark.createDataFrame(rows, REGIONS)
