"""Linear and hurdle log-normal models of many groups at once, from cross-product matrices.

One pass reduces the rows of every group and fold to Z'Z with Z = (1, terms, response). Every model whose
terms are among them, with any fold left out, is solved from blocks and differences of these matrices, so
comparing models and cross-validating them costs no further pass. The logistic part of a hurdle model
takes Newton steps; a step is one pass that sums the weighted cross-products of all groups and models at
their present estimates. Matrices are added up per task and then by a shuffle; only the largest step is
seen by the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import RFormula
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.session import join_lookup, stage

# Matrices a task holds before it hands them on.
HELD = 512
# Newton steps, and the largest change of an estimate at which they end.
STEPS, TOLERANCE = 30, 1e-9


def resolve(df: DataFrame, formula: str) -> tuple[str, list[str]]:
    """Response and terms of a formula such as ``y ~ (a + b)^2 - a:b``; the intercept is understood."""
    empty = df.sparkSession.createDataFrame([], df.schema)
    design = RFormula(formula=formula).fit(empty).transform(empty)
    attributes = design.schema["features"].metadata["ml_attr"]["attrs"]
    named = sorted((a for kind in attributes.values() for a in kind), key=lambda a: a["idx"])
    return formula.split("~")[0].strip(), [a["name"] for a in named]


def factors(terms: list[str]) -> list[str]:
    return sorted({name for term in terms for name in term.split(":")})


def frame(df: DataFrame, names: list[str], group: str | None, fold: Column | None) -> DataFrame:
    """Rows complete in ``names`` as doubles, with ``group`` and ``fold`` in front; written once."""
    complete = df.dropna(subset=names)
    of = F.lit("") if group is None else F.col(f"`{group}`").cast("string")
    part = F.lit(0) if fold is None else fold.cast("int")
    return stage(complete.select(of.alias("group"), part.alias("fold"), *[F.col(f"`{n}`").cast("double").alias(n) for n in names]), "model-frame")


def _columns(columns: dict[str, np.ndarray], terms: list[str]) -> np.ndarray:
    n = len(next(iter(columns.values())))
    products = [np.prod([columns[f] for f in term.split(":")], axis=0) for term in terms]
    return np.column_stack([np.ones(n), *products])


def _summed(
    data: DataFrame, work: Callable[[dict[str, np.ndarray], np.ndarray, list], Iterator[tuple[int, np.ndarray]]],
    extra: tuple[str, ...] = (),
) -> DataFrame:
    """``group``, ``part`` and ``z``, the sum of the vectors that ``work`` gives for them.

    ``work`` sees the columns of one group and fold of a batch, and the first row's ``extra`` values.
    """
    names = [c for c in data.columns if c not in ("group", "fold", *extra)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}

        def flush() -> pa.RecordBatch:
            keys, values = zip(*held.items())
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()), pa.array([v.tolist() for v in values], pa.list_(pa.float64()))],
                names=["group", "part", "z"],
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            whole = {n: np.asarray(batch.column(n)) for n in names}
            own = batch.column("group").dictionary_encode(null_encoding="encode")
            fold = np.asarray(batch.column("fold"))
            code = np.asarray(own.indices).astype(np.int64) << 32 | fold
            for c in np.unique(code):
                rows = np.flatnonzero(code == c)
                name = own.dictionary[int(c >> 32)].as_py()
                first = [batch.column(e)[int(rows[0])].as_py() for e in extra]
                for part, vector in work({n: v[rows] for n, v in whole.items()}, fold[rows], first):
                    key = name, int(part)
                    held[key] = held[key] + vector if key in held else vector
            if len(held) > HELD:
                yield flush()
        if held:
            yield flush()

    sums = data.mapInArrow(run, "group string, part int, z array<double>")
    cells = sums.select("group", "part", F.posexplode("z").alias("at", "v")).groupBy("group", "part", "at").agg(F.sum("v").alias("v"))
    # As many numbers as a matrix has for each group and part.
    joined = cells.groupBy("group", "part").agg(F.array_sort(F.collect_list(F.struct("at", "v"))).alias("cells"))
    return joined.select("group", "part", F.col("cells.v").alias("z"))


def grams(data: DataFrame, terms: list[str], response: str) -> DataFrame:
    """Z'Z of every ``group`` and ``part`` (fold), row by row, in one pass over the rows."""
    def work(columns: dict[str, np.ndarray], fold: np.ndarray, _: list) -> Iterator[tuple[int, np.ndarray]]:
        z = np.column_stack([_columns(columns, terms), columns[response]])
        yield int(fold[0]), (z.T @ z).ravel()

    return _summed(data, work)


def _solve(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least squares solution, the shortest one where the matrix is singular."""
    return np.linalg.lstsq(a, b, rcond=1e-12)[0]


def least_squares(z: np.ndarray, picked: list[int]) -> tuple[np.ndarray, float]:
    """Estimates on the picked columns and the sum of squared residuals, from Z'Z."""
    beta = _solve(z[np.ix_(picked, picked)], z[picked, -1])
    return beta, max(0.0, float(z[-1, -1] - beta @ z[picked, -1]))


def squared_error(z: np.ndarray, picked: list[int], beta: np.ndarray) -> float:
    """Sum of squared errors of given estimates on the rows behind Z'Z."""
    return max(0.0, float(z[-1, -1] - 2 * beta @ z[picked, -1] + beta @ z[np.ix_(picked, picked)] @ beta))


def measures(parts: dict[int, np.ndarray], picked: list[int]) -> dict[str, float | int | None | list]:
    """Fit on all folds, and the error on each fold of the fit to the others."""
    z = sum(parts.values())
    n, beta_rss = z[0, 0], least_squares(z, picked)
    beta, rss = beta_rss
    total = float(z[-1, -1] - z[0, -1] ** 2 / n)
    out = {"N": int(round(n)), "beta": beta, "rss": rss, "R2": 1 - rss / total if total > 0 else None, "RMSE": math.sqrt(rss / n)}
    out["log_likelihood"] = -n / 2 * (math.log(2 * math.pi * rss / n) + 1) if rss > 0 else math.inf
    held_out = [squared_error(own, picked, least_squares(z - own, picked)[0]) for own in parts.values()] if len(parts) > 1 else []
    out["CV_RMSE"] = math.sqrt(sum(held_out) / n) if held_out else None
    return out


def _by_group(table: DataFrame) -> DataFrame:
    """One row for each group with its matrices: a few folds or models."""
    return table.groupBy("group").agg(F.collect_list(F.struct("part", "z")).alias("parts"))


def _matrices(parts: list, width: int) -> dict[int, np.ndarray]:
    return {p["part"]: np.array(p["z"]).reshape(width, width) for p in sorted(parts, key=lambda p: p["part"])}


def _rows(table: DataFrame, work: Callable[[str, list], Iterator[tuple]], schema: str) -> DataFrame:
    """Rows that ``work`` makes of each group's matrices."""
    import pandas as pd
    from pyspark.sql.types import StructType

    names = StructType.fromDDL(schema).names

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [row for group, *rest in frame.itertuples(index=False) for row in work(group, *rest)]
            yield pd.DataFrame(rows, columns=names).astype(object)

    return table.mapInPandas(run, schema)


def gaussian(df: DataFrame, formulas: list[str], group: str | None = None, fold: Column | None = None) -> DataFrame:
    """Least squares of every formula in every group.

    Columns ``group``, ``formula``, ``N``, ``parameters`` (variance included), ``AIC``, ``R2``, ``RMSE``,
    ``CV_RMSE`` (null without folds) and ``terms``, an array of (term, estimate). Formulas share their
    response; rows complete for all of them count. A null group is a group.
    """
    models = [resolve(df, f) for f in formulas]
    response, terms = _shared(models)
    data = frame(df, [*factors(terms), response], group, fold)
    return _fits(_by_group(grams(data, terms, response)), formulas, models, terms)


def _shared(models: list[tuple[str, list[str]]]) -> tuple[str, list[str]]:
    if len({response for response, _ in models}) != 1:
        raise ValueError("compared models have one response")
    return models[0][0], list(dict.fromkeys(term for _, own in models for term in own))


FIT = "group string, formula string, N long, parameters long, AIC double, R2 double, RMSE double, CV_RMSE double, terms array<struct<term string, estimate double>>"


def _fits(table: DataFrame, formulas: list[str], models: list, terms: list[str]) -> DataFrame:
    def work(group: str, parts: list) -> Iterator[tuple]:
        matrices = _matrices(parts, len(terms) + 2)
        for formula, (_, own) in zip(formulas, models):
            picked = [0, *(1 + terms.index(t) for t in own)]
            fit = measures(matrices, picked)
            k = len(picked) + 1
            named = [{"term": t, "estimate": float(b)} for t, b in zip(["(Intercept)", *own], fit["beta"])]
            yield group, formula, fit["N"], k, 2 * k - 2 * fit["log_likelihood"], fit["R2"], fit["RMSE"], fit["CV_RMSE"], named

    return _rows(table, work, FIT)


LOGIT = "group string, betas array<array<double>>, step double, log_likelihoods array<double>, N double"


def logistic(data: DataFrame, models: list[list[str]], present: str) -> DataFrame:
    """Estimates of logistic models of ``present`` by Newton steps: one row for each ``group``.

    ``betas`` and ``log_likelihoods`` list the models in order, intercept first; ``step`` is the largest
    change the last step asked for and ``steps`` how many were taken: groups whose ``step`` stays above
    ``TOLERANCE`` (a response that the terms separate) have not converged.
    """
    widths = [len(own) + 1 for own in models]

    def work(columns: dict[str, np.ndarray], _: np.ndarray, first: list) -> Iterator[tuple[int, np.ndarray]]:
        y = columns[present]
        for k, own in enumerate(models):
            x = _columns(columns, own)
            eta = np.clip(x @ np.array(first[0][k]), -700, 700)
            p = 1 / (1 + np.exp(-eta))
            likelihood = float(np.sum(y * eta - np.logaddexp(0, eta)))
            # X'WX, X'(y - p), log likelihood and rows.
            yield k, np.concatenate([((x * (p * (1 - p))[:, None]).T @ x).ravel(), x.T @ (y - p), [likelihood, len(y)]])

    def step(group: str, parts: list, betas: list) -> Iterator[tuple]:
        moved, likelihoods, largest, n = [], [], 0.0, 0.0
        for p in sorted(parts, key=lambda p: p["part"]):
            z, w = np.array(p["z"]), widths[p["part"]]
            change = _solve(z[:w * w].reshape(w, w), z[w * w:w * w + w])
            largest = max(largest, float(np.max(np.abs(change))))
            moved.append((np.array(betas[p["part"]]) + change).tolist())
            likelihoods.append(float(z[-2]))
            n = float(z[-1])
        yield group, moved, largest, likelihoods, n

    start = [[0.0] * w for w in widths]
    state = data.select("group").distinct().select("group", F.lit(start).cast("array<array<double>>").alias("betas"))
    state = stage(state, "newton")
    groups = state.count()
    for taken in range(1, STEPS + 1):
        rows = join_lookup(data.withColumn("fold", F.lit(0)), state.select("group", "betas"), ["group"], null_safe=["group"], rows=groups)
        # One part for each model, as their matrices differ in size.
        sums = _summed(rows, work, extra=("betas",))
        met = join_lookup(_by_group(sums), state.select("group", "betas"), ["group"], null_safe=["group"], rows=groups)
        state = stage(_rows(met.select("group", "parts", "betas"), step, LOGIT), "newton")
        if (state.agg(F.max("step")).first()[0] or 0.0) <= TOLERANCE:
            break
    return state.withColumn("steps", F.lit(taken))


def hurdle(df: DataFrame, formulas: list[str], group: str | None = None, fold: Column | None = None) -> DataFrame:
    """Hurdle log-normal models: a logistic part of ``y > 0`` and least squares of log(y) where present.

    Columns as ``gaussian`` gives them, and ``converged``. ``AIC`` is that of both parts on the scale of y;
    ``R2``, ``RMSE`` and ``CV_RMSE`` are those of the amount on the log scale; the presence part's terms are
    named ``hu_``. Negative responses count as absent.
    """
    models = [resolve(df, f) for f in formulas]
    response, terms = _shared(models)
    names = [*factors(terms), response]
    data = frame(df, names, group, fold)
    y = F.col(f"`{response}`")
    amounts = data.where(y > 0).withColumn(response, F.log(y))
    fits = _fits(_by_group(grams(amounts, terms, response)), formulas, models, terms)
    presence = logistic(data.withColumn(response, (y > 0).cast("double")), [own for _, own in models], response)
    jacobian = amounts.groupBy("group").agg(F.sum(response).alias("jacobian"))
    at = F.array_position(F.array(*map(F.lit, formulas)), F.col("formula")).cast("int")
    labels = F.array(*[F.array(*[F.lit(f"hu_{t}") for t in ("(Intercept)", *own)]) for _, own in models])
    found = presence.select("group", "betas", "step", "log_likelihoods", F.col("N").alias("rows"))
    met = join_lookup(join_lookup(fits, found, ["group"], null_safe=["group"]), jacobian, ["group"], null_safe=["group"])
    presence_terms = F.zip_with(F.element_at(labels, at), F.element_at("betas", at), lambda t, b: F.struct(t.alias("term"), b.alias("estimate")))
    count = F.size(F.element_at("betas", at))
    return met.select(
        "group", "formula", F.col("rows").cast("long").alias("N"), (F.col("parameters") + count).alias("parameters"),
        (F.col("AIC") + 2 * count - 2 * F.element_at("log_likelihoods", at) + 2 * F.col("jacobian")).alias("AIC"),
        "R2", "RMSE", "CV_RMSE", F.concat("terms", presence_terms).alias("terms"),
        (F.col("step") <= TOLERANCE).alias("converged"),
    )


def ranked(fits: DataFrame) -> DataFrame:
    """``fits`` with ``AIC_diff``, the distance to the best model of the group."""
    best = fits.groupBy("group").agg(F.min("AIC").alias("best"))
    return join_lookup(fits, best, ["group"], null_safe=["group"]).withColumn("AIC_diff", F.col("AIC") - F.col("best")).drop("best")
