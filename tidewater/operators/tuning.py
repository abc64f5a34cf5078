"""Tuning of linear models from shared statistics.

A grid search over (regParam, elasticNet) needs of the data only the moments
of each fold: row count, means and the covariance matrix of the features and
the label.  One aggregation gives them for all folds; every grid point is then
solved and scored from two small matrices, however many points there are.
The objective is the one of ``pyspark.ml``'s linear regression (features and
label scaled to unit standard deviation, intercept not penalised).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import DataFrame, functions as F

MAX_FEATURES = 200                              # the aggregation has a sum per pair of features


@dataclass
class Moments:
    """Rows, means and sample covariances of the features, the label last."""

    n: int
    mean: np.ndarray
    cov: np.ndarray


def fold_moments(df: DataFrame, features: Sequence[str], label: str, fold: str) -> dict:
    """fold value -> Moments, in one pass over ``df`` with one row per fold as its result.

    Rows with a null or NaN in any of the columns are left out.
    """
    if len(features) > MAX_FEATURES:
        raise ValueError(f"at most {MAX_FEATURES} features")
    columns = [*features, label]
    slim = df.select(F.col(fold).alias("_fold"), *[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(columns)])
    for i in range(len(columns)):
        slim = slim.where(F.col(f"_{i}").isNotNull() & ~F.isnan(f"_{i}"))
    k = range(len(columns))
    pairs = [(i, j) for i in k for j in k if i <= j]
    found = slim.groupBy("_fold").agg(F.count(F.lit(1)).alias("n"), *[F.avg(f"_{i}").alias(f"m{i}") for i in k],
                                      *[F.covar_samp(f"_{i}", f"_{j}").alias(f"c{i}_{j}") for i, j in pairs]).collect()
    out = {}
    for row in found:
        cov = np.zeros((len(columns), len(columns)))
        for i, j in pairs:
            cov[i, j] = cov[j, i] = row[f"c{i}_{j}"] or 0.0
        out[row["_fold"]] = Moments(row["n"], np.array([row[f"m{i}"] for i in k]), cov)
    return out


def vector_moments(df: DataFrame, features: str, label: str) -> Moments | None:
    """Moments of a vector column and a label; None with fewer than two rows.  Sparse rows cost their own entries' pairs."""
    both = VectorAssembler(inputCols=[features, label], outputCol="_xy").transform(df.select(features, label)).select("_xy")
    n, own = both.agg(F.count(F.lit(1)), Summarizer.metrics("mean", "variance").summary(F.col("_xy"))).head()
    if n < 2:
        return None
    std = np.sqrt(own.variance.toArray())
    correlation = np.nan_to_num(Correlation.corr(both, "_xy").head()[0].toArray())      # NaN: a constant column
    return Moments(n, own.mean.toArray(), correlation * np.outer(std, std))


def elastic_net(m: Moments, reg_param: float, alpha: float, tol: float = 1e-10,
                max_iter: int = 10_000, population: bool = False) -> tuple[np.ndarray, float]:
    """(coefficients, intercept): coordinate descent on the scaled covariance matrix.

    ``population``: scaled by the rows' own deviations, as the solver ``normal`` does, not the sample's as ``l-bfgs`` does.
    """
    std = np.sqrt(np.diag(m.cov) * ((m.n - 1) / m.n if population else 1.0))
    p, y_std = len(std) - 1, std[-1]
    w = np.zeros(p)
    if y_std > 0 and m.n > 1:
        live = np.flatnonzero(std[:-1] > 0)             # a constant feature has no weight
        scale = np.outer(std, std)
        gram = np.divide(m.cov, scale, out=np.zeros_like(m.cov), where=scale > 0) * (m.n - 1) / m.n
        l1, l2 = reg_param / y_std * alpha, reg_param / y_std * (1 - alpha)
        for _ in range(max_iter):
            moved = 0.0
            for j in live:
                rho = gram[j, -1] - gram[j, :-1] @ w + gram[j, j] * w[j]
                new = np.sign(rho) * max(abs(rho) - l1, 0.0) / (gram[j, j] + l2)
                moved, w[j] = max(moved, abs(new - w[j])), new
            if moved < tol:
                break
        w = np.divide(w * y_std, std[:-1], out=np.zeros(p), where=std[:-1] > 0)
    return w, float(m.mean[-1] - w @ m.mean[:-1])


def r2(m: Moments, w: np.ndarray, intercept: float) -> float:
    """R² of a linear model on the rows that the moments describe."""
    total = (m.n - 1) * m.cov[-1, -1]
    off = m.mean[-1] - intercept - w @ m.mean[:-1]
    sse = total - 2 * (m.n - 1) * (w @ m.cov[:-1, -1]) + (m.n - 1) * (w @ m.cov[:-1, :-1] @ w) + m.n * off * off
    return float(1.0 - sse / total) if total > 0 else float("nan")


def grid_from_moments(df: DataFrame, features: Sequence[str], label: str, fold: str, reg_params: Sequence[float],
                      elastic_nets: Sequence[float], train=0, held=1) -> DataFrame:
    """(reg_param, elastic_net, r2, chosen) of every grid point: fitted on fold ``train``, scored on ``held``."""
    m = fold_moments(df, features, label, fold)
    schema = "reg_param double, elastic_net double, r2 double, chosen boolean"
    if train not in m or held not in m:
        return df.sparkSession.createDataFrame([], schema)
    points = [(float(r), float(a), r2(m[held], *elastic_net(m[train], r, a))) for r in reg_params for a in elastic_nets]
    best = max(range(len(points)), key=lambda i: points[i][2])
    return df.sparkSession.createDataFrame([(*x, i == best) for i, x in enumerate(points)], schema)
