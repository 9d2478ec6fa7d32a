from pyspark.sql import functions as F

from surveyloom.functions import classes as C
from surveyloom.functions import missing as N
from surveyloom.functions import text as X
from surveyloom.operators import filters as R
from tests.conftest import rows


def test_rounding_and_digits(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.5,), (1234.0,), (0.01249,), (None,), (0.0,)], "x double")
    out = {r.x: (r.r, r.s) for r in df.select("x", N.round_even("x").alias("r"), N.signif("x", 2).alias("s")).collect()}
    assert [out[v][0] for v in (0.5, 1.5, 2.5, -0.5)] == [0, 2, 2, 0]
    assert out[1234.0][1] == 1200 and abs(out[0.01249][1] - 0.012) < 1e-12
    assert out[None] == (None, None) and out[0.0][1] == 0


def test_sums_over_missing(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 1.0), ("b", None), ("c", 2.0)], "k string, x double")
    out = rows(df.groupBy("k").agg(N.sum_na_rm("x"), N.sum_strict("x"), F.avg("x")))
    assert out == [("a", 0.0, None, None), ("b", 1.0, None, 1.0), ("c", 2.0, 2.0, 2.0)]


def test_membership_keeps_missing_when_negated(spark):
    df = spark.createDataFrame([("NZ1",), (None,), ("D4",)], "Station string")
    assert rows(R.without(df, "Station", ["NZ1"])) == [("D4",), (None,)]
    assert rows(df.filter(N.in_set("Station", ["NZ1"]))) == [("NZ1",)]


def test_paste_near_level(spark):
    df = spark.createDataFrame([("a", None, 1.0, 1.0 + 1e-9), ("z", "b", 1e12, 1e12 + 10)], "p string, q string, x double, y double")
    out = df.select(N.paste("p", "q"), N.near("x", "y"), N.level("p", ["a", "b"]), N.level_order("p", ["b", "a"])).collect()
    assert [tuple(r) for r in out] == [("a NA", True, "a", 2), ("z b", True, None, None)]


def test_salinity_bounds_have_no_zone(spark):
    df = spark.createDataFrame([(0.5,), (6.0,), (None,), (0.4,), (3.0,), (7.0,)], "SalSurf double")
    zones = [r[0] for r in df.select(C.salinity_zone()).collect()]
    assert zones == [None, None, None, "Freshwater", "Low salinity zone", "High salinity zone"]


def test_range_filters_drop_missing_only_when_on(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,)], "x double")
    assert R.between(df, "x").count() == 3
    assert rows(R.between(df, "x", 2.0, None)) == [(2.0,)]


def test_select_or_all_and_empty_groups(spark):
    df = spark.createDataFrame([("a", 0.0), ("a", 0.0), ("b", 3.0), ("c", None)], "k string, x double")
    assert rows(R.select_or_all(df, "k", ["a"]), "k") == [("a",), ("a",)]
    assert R.select_or_all(df, "k", ["a", "nope"]).count() == 4
    assert rows(R.groups_with_data(df, ["k"], "x")) == [("b", 3.0)]


def test_group_falls_back_to_names(spark):
    df = spark.createDataFrame([("A", "x"), ("B", "y"), ("B", "z")], "Group string, Taxname string")
    assert rows(C.group_or_name(df), "Taxa") == [("x",), ("y",), ("z",)]
    more = df.union(spark.createDataFrame([("C", "w")], df.schema))
    assert rows(C.group_or_name(more), "Taxa") == [("A",), ("B",), ("B",), ("C",)]


def test_text_helpers(spark):
    df = spark.createDataFrame([(" a b ", "02032015", "AB12"), ("X", "bad", "12")], "n string, d string, t string")
    out = df.select(X.underscored("n"), X.parse_date("d", "MMddyyyy"), X.leading_capitals("t"), X.base_name(F.lit("w.v.xlsx"))).collect()
    assert out[0][0] == "a_b" and str(out[0][1]) == "2015-02-03" and out[0][2] == "AB"
    assert out[1][1] is None and out[1][2] is None and out[1][3] == "w"


def test_nan_reads_as_missing(spark):
    df = spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "x double, i int")
    assert rows(N.nan_to_null(df)) == [(2.0, 2), (None, 1)]
