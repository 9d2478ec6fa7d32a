"""Typed reads, exports and small declared tables."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyloom import schemas
from surveyloom.functions.missing import nan_to_null
from surveyloom.operators.filters import SampleFilter


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet with a declared schema; NaN reads as missing."""
    return nan_to_null(spark.read.schema(schema).parquet(path))


def read_catch(spark: SparkSession, path: str, sources: Iterable[str] | None = None) -> DataFrame:
    """Catch rows; with ``sources``, only those partitions of a table written by ``write_by_source``."""
    catch = read_table(spark, path, schemas.CATCH)
    return catch if sources is None else catch.filter(F.col("Source").isin(list(sources)))


def read_env(spark: SparkSession, path: str, samples: SampleFilter | None = None) -> DataFrame:
    """Samples; with ``samples``, only those it keeps, its limits reaching the scan."""
    if samples is None:
        return read_table(spark, path, schemas.ENV)
    stored = spark.read.schema(schemas.ENV).parquet(path)
    return samples.apply(nan_to_null(samples.bounded(stored)))


def read_all_stations(spark: SparkSession, stations: Iterable[str], env: DataFrame) -> DataFrame:
    """Station lists of the surveys, and the places of samples at stations that no list has."""
    listed = reduce(DataFrame.unionByName, [read_stations(spark, path) for path in stations]).distinct()
    columns = ["Source", "Station", "Latitude", "Longitude"]
    sampled = env.select(*columns).dropna().groupBy("Source", "Station").agg(F.min(F.struct("Latitude", "Longitude")).alias("place"))
    known = listed.select(F.col("Source").alias("_s"), F.col("Station").alias("_t")).distinct()
    extra = sampled.join(known, F.col("Source").eqNullSafe(F.col("_s")) & (F.col("Station") == F.col("_t")), "left_anti")
    return listed.select(*columns).unionByName(extra.select("Source", "Station", "place.*"))


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, schemas.STATIONS)


def read_start_dates(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, schemas.START_DATES)


def read_regions(spark: SparkSession, path: str) -> DataFrame:
    """Region polygons as rings of corners, one JSON object per line."""
    return spark.read.schema(schemas.REGIONS).json(path)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, columns: Iterable[str] | None = None
) -> DataFrame:
    """CSV with a header, ``NA`` and blank as missing; ``columns`` prunes the parse to the named ones."""
    data = (
        spark.read.schema(schema)
        .option("header", True)
        .option("nullValue", "NA")
        .option("emptyValue", "")
        .option("enforceSchema", False)
        .csv(path)
    )
    return data if columns is None else data.select(*columns)


def write_by_source(df: DataFrame, path: str, samples_per_file: int | None = None) -> None:
    """Parquet partitioned by survey. Rows are spread by sample, so a dominant survey stays many files."""
    spread = df.repartition("Source", "SampleID") if samples_per_file is None else df.repartition(
        F.col("Source"), F.pmod(F.xxhash64("SampleID"), F.lit(samples_per_file))
    )
    spread.write.partitionBy("Source").parquet(path)


def write_bucketed(df: DataFrame, name: str, path: str, buckets: int) -> DataFrame:
    """Table bucketed and sorted by sample. Two tables of as many buckets join and sum per sample without a shuffle."""
    keys = list(schemas.SAMPLE_KEY)
    df.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def export_csv(df: DataFrame, folder: str, version: str, on: date) -> str:
    """Write the result as CSV part files under a name with version and date; returns the path."""
    path = f"{folder.rstrip('/')}/data-_V{version}_{on.isoformat()}.csv"
    df.write.option("header", True).option("nullValue", "NA").csv(path)
    return path


def export_per_sample(df: DataFrame, folder: str, workbook: str) -> str:
    """One CSV directory per sample and date, under a folder named after the workbook."""
    path = f"{folder.rstrip('/')}/{workbook.split('.')[0]}"
    keyed = df.withColumns({"sample_file": F.col("sample"), "date_file": F.col("date")})
    (
        keyed.repartition("sample_file", "date_file")
        .write.option("header", True)
        .partitionBy("sample_file", "date_file")
        .csv(path)
    )
    return path


def literal_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def taxa_list(catch: DataFrame) -> DataFrame:
    """Every selectable taxon: all names and all rank values that occur."""
    lines = catch.select("Taxname", *schemas.RANKS).distinct()
    names = F.array("Taxname", *schemas.RANKS)
    return lines.select(F.explode(names).alias("Taxon")).filter("Taxon IS NOT NULL").distinct()
