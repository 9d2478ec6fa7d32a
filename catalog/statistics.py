"""Queries of regressions and model comparison."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from catalog.gears import BOTH_SQL, GEARS, GENERA, IDS, JOIN_KEYS, MATRIX_SQL, tows
from catalog.registry import fixed, register
from surveyloom.operators import gear as A
from surveyloom.operators import grams as G
from surveyloom.operators import models as M
from surveyloom.session import stage

TOTALS_SQL = """, w AS (SELECT SampleID, ln(1 + sum(CPUE) FILTER (SizeClass = 'Meso')) AS x, ln(1 + sum(CPUE) FILTER (SizeClass = 'Micro')) AS y FROM fx_catch GROUP BY 1)
"""
GROUP_SQL = BOTH_SQL + """, w AS (SELECT Taxlifestage, ln(1 + sum(CPUE) FILTER (SizeClass = 'Meso')) AS x, ln(1 + sum(CPUE) FILTER (SizeClass = 'Micro')) AS y FROM gb GROUP BY Source, SampleID, Taxlifestage)
"""


@register("lm_global", TOTALS_SQL + "SELECT regr_count(y, x) AS N, round(regr_intercept(y, x), 6) AS Intercept, round(regr_slope(y, x), 6) AS Slope, round(regr_r2(y, x), 6) AS R2 FROM w")
def lm_global(t):
    log_sum = lambda size: F.log1p(F.sum(F.when(F.col("SizeClass") == size, F.col("CPUE"))))
    wide = t.catch.groupBy("SampleID").agg(log_sum("Meso").alias("x"), log_sum("Micro").alias("y"))
    return M.lm_global(wide, "y", "x").select("N", fixed("Intercept"), fixed("Slope"), fixed("R2"))


@register("lm_by_group", GROUP_SQL + """, f AS (SELECT Taxlifestage, regr_count(y, x) AS N, regr_intercept(y, x) AS a, regr_slope(y, x) AS b, regr_r2(y, x) AS r, CASE WHEN count(x) = count(*) THEN max(x) END AS X_max, CASE WHEN count(y) = count(*) THEN max(y) END AS Y_max FROM w GROUP BY 1)
SELECT Taxlifestage, N, round(a, 6) AS Intercept, round(b, 6) AS Slope, round(r, 6) AS R2, round(X_max, 6) AS X_max, round(Y_max, 6) AS Y_max,
 round(CASE WHEN N > 2 THEN 1 - (1 - r) * (N - 1) / (N - 2) END, 6) AS Adj_R2 FROM f""")
def lm_by_group(t):
    wide = A.pivot_gear(A.comparable_rows(t.labelled))
    fits = M.lm_by_group(wide, "Taxlifestage", "Micro_l", "Meso_l", with_p=False)
    return fits.select("Taxlifestage", "N", *[fixed(c) for c in ("Intercept", "Slope", "R2", "X_max", "Y_max", "Adj_R2")])


# Two-sided tail of Student's t by its finite series in the angle whose squared sine is R2.
P_SQL = GROUP_SQL + """, f AS (SELECT Taxlifestage, regr_r2(y, x) AS r, CAST(regr_count(y, x) AS BIGINT) - 2 AS v FROM w GROUP BY 1),
part AS (SELECT Taxlifestage, r, v, k, CASE WHEN k = 0 THEN 0 WHEN v % 2 = 1 THEN ln(2 * k / (2 * k + 1.0)) ELSE ln((2 * k - 1) / (2.0 * k)) END AS l
 FROM (SELECT *, unnest(range(greatest(v // 2, 1))) AS k FROM f WHERE v > 0 AND r > 0 AND r < 1)),
term AS (SELECT *, exp(sum(l) OVER (PARTITION BY Taxlifestage ORDER BY k) + k * ln(1 - r)) AS t FROM part),
series AS (SELECT Taxlifestage, CASE WHEN v % 2 = 0 THEN sqrt(r) * sum(t)
  ELSE 2 / pi() * (asin(sqrt(r)) + CASE WHEN v = 1 THEN 0 ELSE sqrt(r * (1 - r)) * sum(t) END) END AS a FROM term GROUP BY Taxlifestage, r, v)
SELECT Taxlifestage, round(r, 2) AS R2, CASE WHEN v > 0 AND r >= 1 THEN 0 WHEN v > 0 AND r <= 0 THEN 1 ELSE round(1 - a, 4) END AS P_value
FROM f LEFT JOIN series USING (Taxlifestage)"""


@register("lm_p_values", P_SQL)
def lm_p_values(t):
    wide = A.pivot_gear(A.comparable_rows(t.labelled))
    fits = M.lm_by_group(wide, "Taxlifestage", "Micro_l", "Meso_l")
    return fits.select("Taxlifestage", F.round("R2", 2).alias("R2"), F.round("P_value", 4).alias("P_value"))


def paired(t):
    """A row for each paired tow and genus: catches of both gears, logged, and standardised conditions."""
    both = stage(A.paired_tows(tows(t), GEARS, GENERA), "paired")
    both = A.standardize(both, {"Secchi": "Secchi_s", "Temperature": "Temperature_s"})
    genera = F.explode(F.array(*[
        F.struct(F.lit(g).alias("Genus"), *[F.col(f"{g}_{gear}{log}").alias(f"{gear}{log}") for gear in ("CB", "Pump") for log in ("", "_l")])
        for g in GENERA
    ])).alias("of")
    return both.select("Date", "Secchi_s", "Temperature_s", genera).select("Date", "Secchi_s", "Temperature_s", "of.*")


def days(folds: int = 3):
    """Tows of one day in three are left out together."""
    return F.pmod(F.unix_date("Date"), F.lit(folds))


PUMP = "Pump_l ~ (CB_l + Secchi_s + Temperature_s)^3"
NETS = "CB ~ (Pump_l + Secchi_s + Temperature_s)^3"
# Terms left out of the full models one after the other.
GAUSSIAN = [PUMP]
for gone in ("CB_l:Secchi_s:Temperature_s", "Secchi_s:Temperature_s", "CB_l:Secchi_s", "Secchi_s"):
    GAUSSIAN.append(f"{GAUSSIAN[-1]} - {gone}")
HURDLE = [NETS, f"{NETS} - Pump_l:Secchi_s:Temperature_s", f"{NETS} - Pump_l:Secchi_s:Temperature_s - Secchi_s:Temperature_s"]


def terms_of(formula: str) -> list[str]:
    """Terms of the formulas above, as the SQL needs them."""
    full, *gone = formula.split("~")[1].split(" - ")
    names = full.strip().removeprefix("(").removesuffix(")^3").split(" + ")
    return [":".join(t) for n in (1, 2, 3) for t in combinations(names, n) if ":".join(t) not in gone]


def design_sql(models: list[str], rows: str = "tow") -> str:
    """Common table ``d``: group, model, fold, terms as a list and response, for every model."""
    def one(k: int, formula: str) -> str:
        x = ", ".join(["1.0::DOUBLE", *(t.replace(":", " * ") for t in terms_of(formula))])
        return f"SELECT Genus || '|{k}' AS sys, Genus, {k} AS m, fold, [{x}] AS x, {formula.split('~')[0].strip()}::DOUBLE AS y FROM {rows}"

    return " UNION ALL ".join(one(k, f) for k, f in enumerate(models))


def solved_sql(name: str, source: str) -> str:
    """Common tables that solve the systems (sys, i, j, v) of ``source`` by elimination; the right side is j = 99."""
    return f"""{name}_w AS (SELECT sys, 0 AS k, i, j, v FROM {source} UNION ALL
 SELECT sys, k + 1, i, j, CASE WHEN i = k THEN v / piv ELSE v - below * beside / piv END FROM (
  SELECT *, max(v) FILTER (i = k AND j = k) OVER (PARTITION BY sys) AS piv, max(v) FILTER (j = k) OVER (PARTITION BY sys, i) AS below,
   max(v) FILTER (i = k) OVER (PARTITION BY sys, j) AS beside FROM {name}_w) WHERE piv IS NOT NULL),
{name} AS (SELECT sys, i, arg_max(v, k) AS b FROM {name}_w WHERE j = 99 GROUP BY sys, i)"""


def gram_sql(name: str, rows: str, keys: str) -> str:
    """Common table of sums of products of the terms, and with the response as j = 99."""
    return f"""{name} AS (SELECT {keys}, i, j, sum(CASE WHEN j = 99 THEN x[i + 1] * y ELSE x[i + 1] * x[j + 1] END) AS v FROM (
 SELECT *, unnest(list_append(range(len(x)), 99)) AS j FROM (SELECT *, unnest(range(len(x))) AS i FROM {rows})) GROUP BY ALL)"""


def newton_sql(rows: str, steps: int = 7) -> str:
    """Common tables of the logistic estimates ``bN`` of the models in ``rows`` (sys, x, present)."""
    parts = [f"b0 AS (SELECT sys, unnest(range(len(x))) AS i, 0.0::DOUBLE AS b FROM (SELECT sys, any_value(x) AS x FROM {rows} GROUP BY sys))"]
    for k in range(steps):
        parts += [
            f"l{k} AS (SELECT sys, list(b ORDER BY i) AS bs FROM b{k} GROUP BY sys)",
            f"e{k} AS MATERIALIZED (SELECT sys, x, 1 / (1 + exp(-list_dot_product(x, bs))) AS p, present FROM {rows} JOIN l{k} USING (sys))",
            f"""h{k} AS (SELECT sys, i, j, sum(CASE WHEN j = 99 THEN x[i + 1] * (present - p) ELSE x[i + 1] * x[j + 1] * p * (1 - p) END) AS v FROM (
 SELECT *, unnest(list_append(range(len(x)), 99)) AS j FROM (SELECT *, unnest(range(len(x))) AS i FROM e{k})) GROUP BY sys, i, j)""",
            solved_sql(f"s{k}", f"h{k}"),
            f"b{k + 1} AS (SELECT sys, i, b{k}.b + s{k}.b AS b FROM b{k} JOIN s{k} USING (sys, i))",
        ]
    return ",\n".join(parts)


TOW_SQL = MATRIX_SQL + f""", a AS (SELECT * FROM cb), pair AS (SELECT {", ".join(f"a.{c}" for c in IDS)}, {", ".join(f"a.{g} AS {g}_CB, b.{g} AS {g}_Pump" for g in GENERA)} FROM a JOIN pump b ON {JOIN_KEYS}),
cond AS (SELECT *, date_diff('day', DATE '1970-01-01', Date) % 3 AS fold, (Secchi - avg(Secchi) OVER ()) / stddev_samp(Secchi) OVER () AS Secchi_s,
 (Temperature - avg(Temperature) OVER ()) / stddev_samp(Temperature) OVER () AS Temperature_s FROM pair),
tow AS MATERIALIZED (SELECT * FROM ({" UNION ALL ".join(f"SELECT '{g}' AS Genus, fold, Secchi_s, Temperature_s, {g}_CB AS CB, {g}_Pump AS Pump, ln(1 + {g}_CB) AS CB_l, ln(1 + {g}_Pump) AS Pump_l FROM cond" for g in GENERA)}) WHERE Secchi_s IS NOT NULL AND Temperature_s IS NOT NULL)
"""


def named_sql(models: list[str], prefix: str = "") -> str:
    """Names of the terms by model and place."""
    values = ", ".join(f"({k}, {i}, '{prefix}{t}')" for k, f in enumerate(models) for i, t in enumerate(["(Intercept)", *terms_of(f)]))
    return f"(VALUES {values}) AS t(m, i, term)"


@register("lm_interactions", TOW_SQL + f""", d AS ({design_sql([PUMP])}), {gram_sql("g", "d", "sys, Genus, m")}, {solved_sql("s", "g")}
SELECT split_part(sys, '|', 1) AS Genus, term, round(b, 6) AS estimate FROM s JOIN {named_sql([PUMP])} USING (i)""")
def lm_interactions(t):
    fits = G.gaussian(paired(t), [PUMP], "Genus")
    return fits.select(F.col("group").alias("Genus"), F.inline("terms")).withColumn("estimate", F.round("estimate", 6))


@register("hurdle_lognormal", TOW_SQL + f""", d AS MATERIALIZED ({design_sql([NETS])}), here AS (SELECT * REPLACE (ln(y) AS y) FROM d WHERE y > 0),
{gram_sql("g", "here", "sys, Genus, m")}, {solved_sql("s", "g")}, p AS (SELECT *, (y > 0)::DOUBLE AS present FROM d), {newton_sql("p")}
SELECT split_part(sys, '|', 1) AS Genus, term, round(b, 4) AS estimate, true AS converged FROM s JOIN {named_sql([NETS])} USING (i)
UNION ALL SELECT split_part(sys, '|', 1), term, round(b, 4), true FROM b7 JOIN {named_sql([NETS], "hu_")} USING (i)""")
def hurdle_lognormal(t):
    fits = G.hurdle(paired(t), [NETS], "Genus")
    return fits.select(F.col("group").alias("Genus"), F.inline("terms"), "converged").withColumn("estimate", F.round("estimate", 4))


def compared_sql(models: list[str], hurdle: bool) -> str:
    """Measures of the models in the common table ``c``, from sums of products per fold."""
    labels = ", ".join(f"({k}, '{f}')" for k, f in enumerate(models))
    rows = "here" if hurdle else "d"
    solve = [
        f"d AS MATERIALIZED ({design_sql(models)})", "here AS MATERIALIZED (SELECT * REPLACE (ln(y) AS y) FROM d WHERE y > 0)",
        gram_sql("gf", rows, "sys, fold"), "g AS MATERIALIZED (SELECT sys, i, j, sum(v) AS v FROM gf GROUP BY ALL)",
        f"yy AS (SELECT sys, any_value(Genus) AS Genus, any_value(m) AS m, count(*) AS n, sum(y * y) AS yy, sum(y) AS y1, max(len(x)) AS q FROM {rows} GROUP BY sys)",
        solved_sql("s", "g"), "rss AS (SELECT sys, yy - sum(b * v) AS rss FROM s JOIN g USING (sys, i) JOIN yy USING (sys) WHERE j = 99 GROUP BY sys, yy)",
        # Each fold is predicted by the fit to the others.
        "lo AS (SELECT a.sys || '|' || f.fold AS sys, i, j, a.v - f.v AS v FROM g a JOIN gf f USING (sys, i, j))", solved_sql("o", "lo"),
        f"err AS (SELECT sys, sum((y - list_dot_product(x, bs)) ** 2) AS sse FROM {rows} r JOIN (SELECT sys AS out, list(b ORDER BY i) AS bs FROM o GROUP BY sys) o ON o.out = r.sys || '|' || r.fold GROUP BY sys)",
    ]
    if not hurdle:
        more, extra, family = "", "2 * (q + 1) + n * (ln(2 * pi() * rss / n) + 1)", "gaussian"
        count, k = "n", "q + 1"
    else:
        solve += [
            "p AS (SELECT *, (y > 0)::DOUBLE AS present FROM d)", newton_sql("p"),
            "ll AS (SELECT sys, sum(CASE WHEN present = 1 THEN ln(p) ELSE ln(1 - p) END) AS ll, count(*) AS n_all FROM e6 GROUP BY sys)",
        ]
        more, extra, family = "JOIN ll USING (sys)", "2 * (q + 1) + n * (ln(2 * pi() * rss / n) + 1) + 2 * q - 2 * ll + 2 * y1", "hurdle"
        count, k = "n_all", "2 * q + 1"
    return ",\n".join(solve) + f""",
c AS (SELECT Genus, '{family}' AS family, formula, {count} AS N, {k} AS parameters, {extra} AS AIC, 1 - rss / (yy - y1 * y1 / n) AS R2, sqrt(rss / n) AS RMSE, sqrt(sse / n) AS CV_RMSE
 FROM yy JOIN rss USING (sys) JOIN err USING (sys) JOIN (VALUES {labels}) AS f(m, formula) USING (m) {more})
SELECT Genus, family, formula, N, CAST(parameters AS BIGINT) AS parameters, round(AIC, 4) AS AIC, round(AIC - min(AIC) OVER (PARTITION BY Genus), 4) AS AIC_diff,
 round(R2, 6) AS R2, round(RMSE, 6) AS RMSE, round(CV_RMSE, 6) AS CV_RMSE FROM c"""


def measured(fits, family: str):
    return G.ranked(fits).select(
        F.col("group").alias("Genus"), F.lit(family).alias("family"), "formula", "N", "parameters", fixed("AIC", 4), fixed("AIC_diff", 4),
        *[fixed(c) for c in ("R2", "RMSE", "CV_RMSE")],
    )


@register("model_compare", TOW_SQL + ", " + compared_sql(GAUSSIAN, False))
def model_compare(t):
    return measured(G.gaussian(paired(t), GAUSSIAN, "Genus", days()), "gaussian")


@register("hurdle_compare", TOW_SQL + ", " + compared_sql(HURDLE, True))
def hurdle_compare(t):
    return measured(G.hurdle(paired(t), HURDLE, "Genus", days()), "hurdle")
