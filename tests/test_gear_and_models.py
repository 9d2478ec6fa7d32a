import math
import random

import numpy as np
from pyspark.sql import functions as F

from surveyloom.operators import effort as E
from surveyloom.operators import gear as A
from surveyloom.operators import grams as G
from surveyloom.operators import models as M
from surveyloom.operators import order as O
from tests.conftest import plan, rows


def test_missing_conditions_pair_up(spark):
    schema = "Date date, Station string, Secchi double, Volume double, g double"
    day = spark.sql("SELECT DATE '2010-01-01' AS d").first()["d"]
    cb = spark.createDataFrame([(day, "S1", None, 2.0, 3.0), (day, "S2", 1.0, 2.0, 0.0)], schema)
    pump = spark.createDataFrame([(day, "S1", None, 1.0, 1.0), (day, "S2", 2.0, 1.0, 1.0)], schema)
    a = A.prepare_gear(cb, ["g"], "CB", total_of=["g"])
    b = A.prepare_gear(pump, ["g"], "Pump", standardized=False)
    out = A.pair_gears(a, b, ["Date", "Station", "Secchi", "SampleID"]).collect()
    assert len(out) == 1 and out[0]["SampleID"] == "2010-01-01 S1" and out[0]["Catch_total_CB"] == 6.0
    assert abs(out[0]["g_CB_l"] - math.log(4)) < 1e-12 and abs(out[0]["g_CB_l_s"] - math.sqrt(0.5)) < 1e-9


def test_proportion_of_nothing_is_missing(spark):
    df = spark.createDataFrame([("Micro", "Oithona", "Adult", 0.0), ("Meso", "Oithona", "Adult", 0.0), ("Micro", "x", "Adult", 1.0), ("Meso", "x", "Adult", 3.0)],
                               "SizeClass string, Taxname string, Lifestage string, CPUE double")
    out = rows(A.gear_proportion(df), "Taxname_label", "SizeClass", "N_detect", "Proportion")
    assert out == [("italic('Oithona')", "Meso", 0, None), ("italic('Oithona')", "Micro", 0, None), ("x", "Meso", 2, 0.75), ("x", "Micro", 2, 0.25)]


def t_tail(t, df):
    """Two-sided tail of Student's t by numerical integration."""
    x = np.linspace(0, 1, 400_001)[:-1]
    v = t + x / (1 - x)
    density = np.exp(math.lgamma((df + 1) / 2) - math.lgamma(df / 2)) / math.sqrt(df * math.pi) * (1 + v * v / df) ** (-(df + 1) / 2)
    y = density / (1 - x) ** 2
    return 2 * float(np.sum((y[1:] + y[:-1]) / 2) * (x[1] - x[0]))


def test_grouped_regression(spark):
    rnd = random.Random(1)
    data = [("line", float(x), 2.0 * x + 1) for x in range(5)] + [("flat", 1.0, float(x)) for x in range(4)]
    data += [("two", 0.0, 1.0), ("two", 1.0, 5.0), ("gap", None, 1.0), ("gap", 1.0, 1.0)]
    noise = {f"n{k}": [(x, b * x + rnd.gauss(0, 1)) for x in range(n)] for k, (n, b) in enumerate([(6, 0.2), (40, 0.01), (300, 0.02)])}
    data += [(g, float(x), y) for g, pts in noise.items() for x, y in pts]
    out = {r["g"]: r for r in M.lm_by_group(spark.createDataFrame(data, "g string, x double, y double"), "g", "y", "x").collect()}
    line = out["line"]
    assert (round(line["Slope"], 9), round(line["Intercept"], 9), line["P_value"]) == (2.0, 1.0, 0.0) and line["Adj_R2"] > 0.999999
    assert out["flat"]["Slope"] is None and out["flat"]["P_value"] is None
    assert out["two"]["R2"] == 1.0 and out["two"]["P_value"] is None and out["two"]["Adj_R2"] is None
    for g, pts in noise.items():
        r = np.corrcoef(np.array(pts).T)[0, 1]
        df = len(pts) - 2
        assert abs(out[g]["P_value"] - t_tail(abs(r) * math.sqrt(df / (1 - r * r)), df)) < 1e-6


def model_data(spark):
    rnd = random.Random(2)
    points = [(i, rnd.gauss(0, 1), rnd.gauss(0, 1), rnd.random()) for i in range(200)]
    data = [(i, a, b, 1 + a - 2 * b + 0.5 * a * b + rnd.gauss(0, 0.1), 0.0 if u < 0.3 else math.exp(0.3 + 0.5 * a)) for i, a, b, u in points]
    return spark.createDataFrame(data + [(999, None, 1.0, 1.0, 1.0)], "id int, a double, b double, y double, z double"), data


def test_interactions_match_least_squares(spark):
    df, data = model_data(spark)
    fit = M.fit_gaussian(df, "y ~ (a + b)^2")
    a, b, y = (np.array([r[k] for r in data]) for k in (1, 2, 3))
    design = np.column_stack([np.ones_like(a), a, b, a * b])
    beta, *_ = np.linalg.lstsq(design, y, rcond=None)
    assert np.allclose(list(fit.terms.values()), beta, atol=1e-6) and fit.n == 200
    sigma2 = np.mean((y - design @ beta) ** 2)
    assert abs(fit.aic - (200 * (math.log(2 * math.pi * sigma2) + 1) + 10)) < 1e-4


def test_hurdle_parts_and_comparison(spark):
    df, data = model_data(spark)
    fit = M.fit_hurdle(df, "z ~ a")
    assert abs(fit.terms["(Intercept)"] - 0.3) < 1e-6 and abs(fit.terms["a"] - 0.5) < 1e-6 and fit.n == 200
    assert fit.terms["hu_(Intercept)"] > 0
    table = M.compare(df, ["y ~ a", "y ~ (a + b)^2"], "id", folds=2).collect()
    assert [r["formula"] for r in table] == ["y ~ (a + b)^2", "y ~ a"] and table[0]["AIC_diff"] == 0
    assert table[0]["CV_RMSE"] < 0.2 < table[1]["CV_RMSE"]


def test_effort_grid_is_complete(spark):
    env = spark.sql("""SELECT s AS Source, DATE '2001-03-05' AS Date, 2001 AS Year, st AS Station FROM
        VALUES ('EMP', 'a'), ('EMP', 'a'), ('EMP', 'b'), ('STN', 'c'), ('other', 'd') AS v(s, st)""")
    grid = E.effort_grid(env)
    assert grid.count() == 5 * 12 and rows(grid.filter("N IS NOT NULL"), "Source", "Month", "N") == [("EMP", 3, 1.5), ("STN", 3, 1.0)]
    start = spark.sql("SELECT 'EMP' AS Source, DATE '1999-01-01' AS Startdate UNION ALL SELECT 'STN', DATE '2002-01-01'")
    assert rows(E.effort_by_month(grid, start)) == [("EMP", 3, 1.5)]
    assert rows(E.effort_by_year(grid)) == [("EMP", 2001, 1.5), ("STN", 2001, 1.0)]


def test_row_ids_and_levels(spark):
    df = spark.createDataFrame([(k, i) for k in ("b", "a", None) for i in range(7)], "k string, i int")
    out = {(r["k"], r["i"]): r["ID"] for r in O.row_ids(df, ["k", "i"]).collect()}
    assert out == {(k, i): n * 7 + i + 1 for n, k in enumerate(("a", "b", None)) for i in range(7)}
    levels = O.level_index(df.withColumn("j", -F.col("i")), "i", ["j"])
    assert rows(levels.orderBy("Level"), "Level", "i") == [(7 - i, i) for i in range(6, -1, -1)]


def grouped(spark):
    """Rows of three groups (one unnamed), one of them with a response that the term separates."""
    rnd, data = random.Random(4), []
    for group, slope in (("x", 0.8), (None, -0.5), ("sep", 0.0)):
        for i in range(150):
            a, b = rnd.gauss(0, 1), rnd.gauss(0, 1)
            there = a > 0 if group == "sep" else rnd.random() < 1 / (1 + math.exp(-0.3 - slope * a))
            data.append((group, i % 4, a, b, math.exp(1 + slope * b + rnd.gauss(0, 0.2)) if there else 0.0))
    frame = spark.createDataFrame([*data, ("x", 1, None, 0.0, 1.0)], "g string, fold int, a double, b double, y double")
    return frame, data


def design(rows, *terms):
    columns = {"a": np.array([r[2] for r in rows]), "b": np.array([r[3] for r in rows])}
    return np.column_stack([np.ones(len(rows)), *[np.prod([columns[c] for c in t.split(":")], axis=0) for t in terms]])


def test_grouped_comparison_equals_refits(spark):
    frame, data = grouped(spark)
    formulas = {"y ~ (a + b)^2": ("a", "b", "a:b"), "y ~ (a + b)^2 - a:b": ("a", "b"), "y ~ b": ("b",)}
    table = G.ranked(G.gaussian(frame.repartition(7), list(formulas), "g", F.col("fold"))).collect()
    assert len(table) == 9
    for row in table:
        own = [r for r in data if r[0] == row["group"]]
        x, y, fold = design(own, *formulas[row["formula"]]), np.array([r[4] for r in own]), np.array([r[1] for r in own])
        beta = np.linalg.lstsq(x, y, rcond=None)[0]
        rss, error = np.sum((y - x @ beta) ** 2), 0.0
        for f in range(4):
            other = np.linalg.lstsq(x[fold != f], y[fold != f], rcond=None)[0]
            error += np.sum((y - x @ other)[fold == f] ** 2)
        assert np.allclose([t["estimate"] for t in row["terms"]], beta)
        aic = 150 * (math.log(2 * math.pi * rss / 150) + 1) + 2 * (len(beta) + 1)
        assert np.allclose([row["AIC"], row["R2"], row["RMSE"], row["CV_RMSE"]], [aic, 1 - rss / np.sum((y - y.mean()) ** 2), math.sqrt(rss / 150), math.sqrt(error / 150)])
        assert row["AIC_diff"] >= 0 and (row["N"], row["parameters"]) == (150, len(beta) + 1)


def test_hurdle_scores_are_zero_and_separation_is_reported(spark):
    frame, data = grouped(spark)
    table = {r["group"]: r for r in G.hurdle(frame, ["y ~ (a + b)^2"], "g").collect()}
    assert not table["sep"]["converged"]
    for group in ("x", None):
        row, own = table[group], [r for r in data if r[0] == group]
        x, present = design(own, "a", "b", "a:b"), np.array([r[4] > 0 for r in own], float)
        estimates = np.array([t["estimate"] for t in row["terms"]])
        assert row["converged"] and [t["term"] for t in row["terms"]][4:] == ["hu_(Intercept)", "hu_a", "hu_b", "hu_a:b"]
        p = 1 / (1 + np.exp(-x @ estimates[4:]))
        assert np.abs(x.T @ (present - p)).max() < 1e-8
        here, log_y = x[present == 1], np.log([r[4] for r in own if r[4] > 0])
        assert np.abs(here.T @ (log_y - here @ estimates[:4])).max() < 1e-8
        variance = np.mean((log_y - here @ estimates[:4]) ** 2)
        likelihood = np.sum(np.log(np.where(present == 1, p, 1 - p))) - len(log_y) / 2 * (math.log(2 * math.pi * variance) + 1) - log_y.sum()
        assert abs(row["AIC"] - (2 * 9 - 2 * likelihood)) < 1e-6


def test_models_of_no_rows_and_of_different_responses(spark):
    frame, _ = grouped(spark)
    assert G.gaussian(frame.limit(0), ["y ~ a"], "g").count() == 0
    try:
        G.gaussian(frame, ["y ~ a", "a ~ b"])
    except ValueError:
        return
    raise AssertionError


def test_moments_with_missing_values(spark):
    df = spark.createDataFrame([(1.0, 1.0), (3.0, None)], "a double, b double")
    out = A.standardize(df, {"a": "a_s", "b": "b_s"}, strict=["a", "b"]).collect()
    assert [r["b_s"] for r in out] == [None, None] and abs(out[1]["a_s"] - math.sqrt(0.5)) < 1e-9
    three = spark.createDataFrame([(1.0,), (3.0,), (None,)], "b double")
    assert [r["b_s"] is None for r in A.standardize(three, {"b": "b_s"}).orderBy("b").collect()] == [True, False, False]


def test_tows_of_both_gears_in_one_pass_equal_the_joined_matrices(spark):
    schema = "Date date, Station string, Secchi double, SizeClass string, Genus string, CPUE double, Volume double"
    day = spark.sql("SELECT DATE '2010-01-01' AS d").first()["d"]
    rnd = random.Random(6)
    data = [(day, f"S{rnd.randrange(9)}", rnd.choice([None, 1.0, 2.0]), rnd.choice(["Meso", "Micro", "Macro"]), rnd.choice(["g", "h", "other", None]), float(rnd.randrange(5)), 2.0) for _ in range(90)]
    rows_ = spark.createDataFrame(data, schema)
    ids, values = ["Date", "Station", "Secchi"], ["g", "h"]
    tows = A.tow_matrix(rows_, ids, {"CB": "Meso", "Pump": "Micro"}, "Genus", values)
    found = A.paired_tows(tows, ["CB", "Pump"], values, total_gear="CB")

    def matrix(size):
        own = rows_.filter(F.col("SizeClass") == size)
        sums = [F.coalesce(F.sum(F.when(F.col("Genus") == g, F.col("CPUE"))), F.lit(0.0)).alias(g) for g in values]
        return own.groupBy(*ids).agg(F.sum("Volume").alias("Volume"), *sums)

    a = A.prepare_gear(matrix("Meso"), values, "CB", total_of=values)
    b = A.prepare_gear(matrix("Micro"), values, "Pump", standardized=False)
    want = A.pair_gears(a, b, [*ids, "SampleID"])
    shown = ["SampleID", "Secchi", *[f"{v}_{g}{x}" for v in values for g in ("CB", "Pump") for x in ("", "_l")], "Catch_total_CB", "Catch_total_CB_s"]
    exact = lambda df: sorted([tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*shown).collect()], key=repr)
    assert exact(found) == exact(want) and len(exact(found)) > 5


def test_comparable_rows_read_the_catches_once(spark, tmp_path):
    data = [("A", "1", "Micro", "x", 1.0), ("A", "1", "Meso", "x", 2.0), ("A", "2", "Micro", "x", 1.0), ("A", "3", "Meso", "y", 1.0),
            ("A", "3", "Micro", "x", 1.0), ("A", "4", "Macro", "x", 1.0), ("A", None, "Micro", "x", 1.0), ("A", None, "Meso", "x", 1.0)]
    frame = spark.createDataFrame(data, "Source string, SampleID string, SizeClass string, Taxlifestage string, CPUE double")
    frame.write.parquet(str(tmp_path / "catch"))
    out = A.comparable_rows(spark.read.parquet(str(tmp_path / "catch")))
    assert rows(out, "SampleID", "SizeClass") == [("1", "Meso"), ("1", "Micro")]
    assert str(tmp_path / "catch") not in plan(out)


def test_pivot_of_gears_is_one_aggregate(spark):
    data = [("A", "a", "t", "Meso", 1.0), ("A", "a", "t", "Meso", 2.0), ("A", "a", "t", "Micro", None), (None, "b", "t", "Macro", 1.0)]
    wide = A.pivot_gear(spark.createDataFrame(data, "Source string, SampleID string, Taxlifestage string, SizeClass string, CPUE double"))
    assert "pivotfirst" not in plan(wide)
    assert {r["SampleID"]: (r["Meso_l"], r["Micro_l"]) for r in wide.collect()} == {"a": (math.log1p(3.0), None), "b": (None, None)}
