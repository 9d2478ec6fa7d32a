"""Regressions: grouped simple fits, linear models with interactions, hurdle log-normal models."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.functions.missing import max_strict
from surveyloom.functions.regress import adjusted_r2, regression, slope_p_value
from surveyloom.operators import grams


def lm_global(df: DataFrame, y: str, x: str) -> DataFrame:
    return df.agg(*regression(y, x))


def lm_by_group(df: DataFrame, group: str, y: str, x: str, with_p: bool = True) -> DataFrame:
    """Intercept, slope, R², adjusted R², largest values (and p-value) per group."""
    fits = df.groupBy(group).agg(
        *regression(y, x), max_strict(F.col(f"`{x}`")).alias("X_max"), max_strict(F.col(f"`{y}`")).alias("Y_max")
    ).withColumn("Adj_R2", adjusted_r2(F.col("N"), F.col("R2")))
    return fits.withColumn("P_value", slope_p_value()(F.col("R2"), F.col("N").cast("double"))) if with_p else fits


@dataclass(frozen=True)
class Fit:
    """Fitted model: its terms with estimates, and the measures models are compared by."""

    formula: str
    terms: dict[str, float]
    n: int
    log_likelihood: float
    parameters: int

    @property
    def aic(self) -> float:
        return 2 * self.parameters - 2 * self.log_likelihood


def _fit(row) -> Fit:
    terms = {t["term"]: t["estimate"] for t in row["terms"]}
    return Fit(row["formula"], terms, row["N"], row["parameters"] - row["AIC"] / 2, row["parameters"])


def fit_gaussian(df: DataFrame, formula: str) -> Fit:
    """Least squares for a formula such as ``y ~ (a + b + c)^3 - a:b:c``."""
    return _fit(grams.gaussian(df, [formula]).first())


def fit_hurdle(df: DataFrame, formula: str) -> Fit:
    """Hurdle log-normal: a logistic model of presence and a linear model of log(y) where present."""
    row = grams.hurdle(df, [formula]).first()
    if not row["converged"]:
        raise ArithmeticError(f"the presence part of {formula} has no finite estimates")
    return _fit(row)


def compare(df: DataFrame, formulas: list[str], key: str, folds: int = 5) -> DataFrame:
    """AIC, R² and cross-validated RMSE of Gaussian candidates, best AIC first.

    Folds follow a hash of ``key``, so reruns and retries see the same folds. All candidates are
    fitted to the rows complete for every one of them, in one pass.
    """
    fold = F.pmod(F.xxhash64(key), F.lit(folds)).cast("int")
    fits = grams.ranked(grams.gaussian(df, formulas, fold=fold))
    return fits.select("formula", "N", "parameters", "AIC", "AIC_diff", "R2", "RMSE", "CV_RMSE").orderBy("AIC")


def fit_table(df: DataFrame, fit: Fit) -> DataFrame:
    """A fit's terms as a table."""
    return df.sparkSession.createDataFrame(
        [(fit.formula, term, float(value)) for term, value in fit.terms.items()],
        "formula string, term string, estimate double",
    )
