"""Table schemas and ordered categories."""

from __future__ import annotations

from pyspark.sql import types as T

STR, DBL, INT, DATE = T.StringType(), T.DoubleType(), T.IntegerType(), T.DateType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Category levels in their declared order.
RANKS = ("Phylum", "Class", "Order", "Family", "Genus", "Species")
SOURCES = ("EMP", "20mm", "FMWT", "STN", "FRP")
SIZE_CLASSES = ("Micro", "Meso", "Macro")
SALINITY_ZONES = ("Freshwater", "Low salinity zone", "High salinity zone")
MAJOR_GROUPS = (
    "Calanoida", "Cyclopoida", "Harpacticoida", "UnID copepods", "Mysida",
    "Cladocera", "Rotifera", "Cirripedia", "Insecta", "Other",
)
LOW_SALINITY_ZONE = (0.5, 6.0)
INTRO_LAG_YEARS = 2

SAMPLE_KEY = ("Source", "SampleID")
LINEAGE_KEY = ("SizeClass", "Lifestage", "Taxname", *RANKS)

CATCH = struct(
    Source=STR, SampleID=STR, SizeClass=STR, Taxname=STR, Lifestage=STR, Taxlifestage=STR,
    Phylum=STR, Class=STR, Order=STR, Family=STR, Genus=STR, Species=STR, CPUE=DBL, Volume=DBL,
)
ENV = struct(
    Source=STR, SampleID=STR, Date=DATE, Year=INT, Station=STR, Latitude=DBL, Longitude=DBL,
    SalSurf=DBL, SalBott=DBL, Secchi=DBL, Temperature=DBL, Chl=DBL, DO=DBL, pH=DBL,
    Tide=STR, BottomDepth=DBL,
)
STATIONS = struct(Source=STR, Station=STR, Latitude=DBL, Longitude=DBL)
START_DATES = struct(Source=STR, Startdate=DATE)
UNDERSAMPLED = struct(SizeClass=STR, Taxname=STR, Lifestage=STR)
INTRODUCTIONS = struct(Taxname=STR, Intro_year=INT)
FISH = struct(
    fishid=STR, survey=STR, date=STR, station=STR, lat=DBL, long=DBL,
    sal=DBL, secchi=DBL, temp=DBL,
)
LAB_CELLS = struct(workbook=STR, sheet=STR, row=INT, col=INT, value=STR)
TAXON_RECORDS = struct(id=STR, scientificname=STR, authority=STR, status=STR)
LINEAGE_LONG = struct(query=STR, rank=STR, name=STR, id=STR)
REGIONS = T.StructType([
    T.StructField("Region", STR),
    T.StructField("ring", T.ArrayType(struct(lon=DBL, lat=DBL))),
])


def tow_matrix(id_columns: dict[str, T.DataType], taxa: list[str]) -> T.StructType:
    """Schema of a wide one-row-per-tow matrix: identifiers, then a double per taxon."""
    return struct(**id_columns, **{taxon: DBL for taxon in taxa})
