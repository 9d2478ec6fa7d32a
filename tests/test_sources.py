import datetime as dt
import json
import os

from surveyloom import schemas
from surveyloom.operators.filters import SampleFilter
from surveyloom.session import stage, staging_root
from surveyloom.sources import tables as S
from tests.conftest import plan, rows


def test_csv_missing_marks_and_named_columns(spark, tmp_path):
    path = tmp_path / "stations.csv"
    path.write_text("Source,Station,Latitude,Longitude\nA,s1,38.1,NA\nB,,NA,-122.5\n")
    whole = S.read_csv(spark, str(path), schemas.STATIONS)
    assert rows(whole) == [("A", "s1", 38.1, None), ("B", None, None, -122.5)]
    assert S.read_csv(spark, str(path), schemas.STATIONS, ["Station", "Longitude"]).columns == ["Station", "Longitude"]


def test_catch_by_source_reads_one_partition(spark, tmp_path):
    row = lambda source, sample, cpue: (source, sample, "Meso", "x", "Adult", "x Adult", *["r"] * 6, cpue, 1.0)
    catch = spark.createDataFrame([row("EMP", "1", 1.0), row("STN", "2", float("nan"))], schemas.CATCH)
    S.write_by_source(catch, str(tmp_path / "catch"))
    one = S.read_catch(spark, str(tmp_path / "catch"), ["STN"])
    assert rows(one, "Source", "SampleID", "CPUE") == [("STN", "2", None)]
    assert "PartitionFilters: [isnotnull(Source" in plan(one)
    assert rows(S.taxa_list(S.read_catch(spark, str(tmp_path / "catch")))) == [("r",), ("x",)]


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([("s1", dt.date(2018, 3, 15), "t", 1.0), ("s2", dt.date(2018, 3, 16), "u", None)], "sample string, date date, taxon string, count double")
    path = S.export_csv(df, str(tmp_path), "2.1", dt.date(2020, 1, 2))
    assert path.endswith("data-_V2.1_2020-01-02.csv") and rows(S.read_csv(spark, path, df.schema)) == rows(df)
    folder = S.export_per_sample(df, str(tmp_path), "book.v1.xlsx")
    assert folder.endswith("/book") and os.path.isdir(f"{folder}/sample_file=s1/date_file=2018-03-15")


def test_regions_and_literals_and_matrix(spark, tmp_path):
    path = tmp_path / "regions.json"
    path.write_text(json.dumps({"Region": "R", "ring": [{"lon": 0, "lat": 0}, {"lon": 1, "lat": 0}, {"lon": 1, "lat": 1}]}))
    assert len(S.read_regions(spark, str(path)).first()["ring"]) == 3
    assert S.literal_table(spark, [("A", dt.date(1972, 1, 1))], schemas.START_DATES).count() == 1
    wide = schemas.tow_matrix({"Year": schemas.DBL, "Station": schemas.STR}, ["T1", "T2"])
    assert [f.name for f in wide] == ["Year", "Station", "T1", "T2"]


def test_stage_writes_once_and_reloads(spark):
    staged = stage(spark.range(5).toDF("x"), "test")
    assert staged.count() == 5 and "parquet" in plan(staged).lower() and staging_root(spark)


def env_row(sample, latitude, salinity, year=2000):
    row = dict.fromkeys(schemas.ENV.fieldNames())
    return tuple((row | {"Source": "EMP", "SampleID": sample, "Date": dt.date(year, 5, 1), "Year": year, "Station": f"s{sample}", "Latitude": latitude, "Longitude": -122.0, "SalSurf": salinity}).values())


def test_limits_reach_the_scan_and_leave_out_nan(spark, tmp_path):
    nan = float("nan")
    data = [env_row(str(k), *v) for k, v in enumerate([(38.0, 1.0), (nan, 1.0), (39.0, nan), (37.0, 2.0), (None, 3.0), (38.5, float("inf"))])]
    spark.createDataFrame(data, schemas.ENV).write.parquet(str(tmp_path / "env"))
    read = lambda **limits: S.read_env(spark, str(tmp_path / "env"), SampleFilter(**limits))
    assert rows(read(latitude=(37.5, None)), "SampleID") == [("0",), ("2",), ("5",)]
    assert rows(read(latitude=(None, 38.2), sal_surf=(0, None)), "SampleID") == [("0",), ("3",)]
    assert rows(read(sal_surf=(1.5, None)), "SampleID") == [("3",), ("4",), ("5",)]
    assert rows(read(dates=("2001-01-01", None)), "SampleID") == []
    text = plan(read(latitude=(37.5, None), dates=("1999-01-01", None)))
    pushed = next(line for line in text.splitlines() if "PushedFilters" in line).split("PushedFilters")[1]
    assert "IsNotNull(Date), GreaterThanOrEqual(Latitude,37.5), LessThanOrEqual(Latitud" in pushed  # the rest is cut from the plan's text


def test_bucketed_tables_join_and_sum_without_a_shuffle(spark, tmp_path):
    row = lambda sample, cpue: ("EMP", sample, "Meso", "x", "Adult", "x Adult", *["r"] * 6, cpue, 1.0)
    catch = S.write_bucketed(spark.createDataFrame([row(str(k % 7), 1.0) for k in range(50)], schemas.CATCH), "bucketed_catch", str(tmp_path / "c"), 4)
    env = S.write_bucketed(spark.createDataFrame([env_row(str(k), 38.0, 1.0) for k in range(7)], schemas.ENV), "bucketed_env", str(tmp_path / "e"), 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        sums = catch.join(env.select("Source", "SampleID", "Year"), ["Source", "SampleID"]).groupBy("Source", "SampleID", "Year").sum("CPUE")
        assert "Exchange" not in plan(sums).split("== Physical Plan ==")[1]
        assert sum(r[-1] for r in rows(sums)) == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("bucketed_catch", "bucketed_env"):
            spark.sql(f"DROP TABLE {name}")


def test_station_lists_and_sampled_stations(spark, tmp_path):
    place = lambda source, station, lat: tuple((dict.fromkeys(schemas.STATIONS.fieldNames()) | {"Source": source, "Station": station, "Latitude": lat, "Longitude": -122.0}).values())
    for name, data in (("a", [place("EMP", "s1", 38.0)]), ("b", [place("STN", "s1", 38.1), place("EMP", "s1", 38.0)])):
        spark.createDataFrame(data, schemas.STATIONS).write.parquet(str(tmp_path / name))
    env = spark.createDataFrame([env_row("1", 37.0, 1.0), env_row("2", 37.5, 1.0), env_row("2", 37.4, 1.0), env_row("9", None, 1.0)], schemas.ENV)
    found = S.read_all_stations(spark, [str(tmp_path / "a"), str(tmp_path / "b")], env)
    assert rows(found, "Source", "Station", "Latitude") == [("EMP", "s1", 38.0), ("EMP", "s2", 37.4), ("STN", "s1", 38.1)]


def test_staged_tables_lie_in_one_folder_that_can_be_removed(spark):
    from surveyloom import session

    table = stage(spark.range(3), "x")
    folder = session.staged_folder(spark)
    assert spark.sparkContext.applicationId in folder and all(folder in f for f in table.inputFiles())
