"""Ridge regression for many segments at once (M1-M3, M8).

1. Moments per segment in ONE ``groupBy`` (count, means, ``n*covar_pop``
   for every feature pair and feature/target pair) - partial-aggregated,
   so the rows of a segment are never gathered anywhere.
2. Per segment (one row each) a 9x9 eigen-decomposition in
   ``mapInPandas``: A = Q diag(lam) Q', b~ = Q'b.  For every alpha the
   coefficients are Q (b~ / (lam + alpha)) and the intercept
   ybar - xbar . coef (intercept not penalised, no scaling).
3. Leave-one-out error for every alpha in one row pass with array
   higher-order functions (JVM side):
   yhat = ybar + z~ . (b~/(lam+alpha)), h = 1/n + z~^2 . 1/(lam+alpha),
   e = (y - yhat) / (1 - h), z~ = Q'(x - xbar); then ``avg(e^2)`` per
   (segment, alpha) and ``min_by`` (ties -> first alpha).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from .joins import join_on_keys

# The alpha grid, 20 values log-spaced from 1e-3 to 1e3.
ALPHAS = [float(a) for a in np.logspace(-3, 3, 20)]


def _dot(a: str, b: str) -> str:
    return f"aggregate(zip_with({a}, {b}, (u, v) -> u * v), 0D, (acc, t) -> acc + t)"


def feature_vector(features: Sequence[str]) -> F.Column:
    """Features as one array, NULL -> 0 (model input rule)."""
    return F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features])


def moments(df: DataFrame, keys: Sequence[str], features: Sequence[str], y: str) -> DataFrame:
    """Step 1: sufficient statistics per segment (NULL features -> 0;
    rows without a target are ignored)."""
    p = len(features)
    d = df.where(F.col(y).isNotNull()).select(
        *keys, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"x{i}")
                 for i, c in enumerate(features)], F.col(y).cast("double").alias("y"))
    n = F.count(F.lit(1))
    aggs = [n.alias("n"), F.avg("y").alias("ybar")]
    aggs += [F.avg(f"x{i}").alias(f"m{i}") for i in range(p)]
    aggs += [(F.covar_pop(f"x{i}", f"x{j}") * n).alias(f"s{i}_{j}")
             for i in range(p) for j in range(i, p)]
    aggs += [(F.covar_pop(f"x{i}", "y") * n).alias(f"t{i}") for i in range(p)]
    return d.groupBy(*keys).agg(*aggs)


def _eigen_schema(keys_schema: list[StructField]) -> StructType:
    arr = ArrayType(DoubleType())
    return StructType(keys_schema + [
        StructField("n", LongType()), StructField("ybar", DoubleType()),
        StructField("xbar", arr), StructField("qt", ArrayType(arr)), StructField("bt", arr),
        StructField("lam", arr), StructField("alphas", arr), StructField("g", ArrayType(arr)),
        StructField("dinv", ArrayType(arr)), StructField("coefs", ArrayType(arr)),
        StructField("intercepts", arr)])


def eigen_solve(mom: DataFrame, keys: Sequence[str], p: int,
                alphas: Sequence[float] = ALPHAS) -> DataFrame:
    """Step 2: one small eigen-problem per segment row (Python in the
    worker, Arrow batches of segment rows; nothing reaches the driver)."""
    alphas = [float(a) for a in alphas]
    keys = list(keys)
    schema = _eigen_schema([mom.schema[k] for k in keys])

    pairs = [(i, j) for i in range(p) for j in range(i, p)]

    def solve(batches):
        for pdf in batches:
            m = len(pdf)
            a = np.zeros((m, p, p))
            for i, j in pairs:
                a[:, i, j] = a[:, j, i] = pdf[f"s{i}_{j}"]
            b = pdf[[f"t{i}" for i in range(p)]].to_numpy(float)
            xbar = pdf[[f"m{i}" for i in range(p)]].to_numpy(float)
            ybar = pdf["ybar"].to_numpy(float)
            lam, q = np.linalg.eigh(a)  # all segments of the batch at once
            lam = np.clip(lam, 0.0, None)
            bt = np.einsum("mji,mj->mi", q, b)
            dinv = 1.0 / (lam[:, None, :] + np.array(alphas)[None, :, None])
            g = bt[:, None, :] * dinv
            coefs = np.einsum("mij,maj->mai", q, g)
            icpts = ybar[:, None] - np.einsum("mi,mai->ma", xbar, coefs)
            rows = {k: pdf[k] for k in keys}
            rows |= {"n": pdf["n"], "ybar": ybar, "xbar": xbar.tolist(), "qt": q.transpose(0, 2, 1).tolist(),
                     "bt": bt.tolist(), "lam": lam.tolist(), "alphas": [alphas] * m, "g": g.tolist(),
                     "dinv": dinv.tolist(), "coefs": coefs.tolist(), "intercepts": icpts.tolist()}
            yield pd.DataFrame(rows, columns=schema.fieldNames())

    return mom.mapInPandas(solve, schema)


def loo_errors(df: DataFrame, eig: DataFrame, keys: Sequence[str], features: Sequence[str],
               y: str) -> DataFrame:
    """Step 3: mean squared leave-one-out error per (segment, alpha index), with that model, so
    that the solve need not run again for the chosen one."""
    keys = list(keys)
    rows = df.where(F.col(y).isNotNull()).select(
        *keys, feature_vector(features).alias("x"), F.col(y).cast("double").alias("y"))
    j = join_on_keys(rows, eig, keys)
    zt = f"transform(qt, v -> {_dot('v', 'zip_with(x, xbar, (a, b) -> a - b)')})"
    j = j.withColumn("zt", F.expr(zt)).withColumn("zt2", F.expr("transform(zt, v -> v * v)"))
    per_alpha = F.expr(f"""transform(sequence(0, size(alphas) - 1), i -> named_struct(
        'ai', i, 'alpha', alphas[i], 'intercept', intercepts[i], 'coef', coefs[i],
        'e2', pow((y - (ybar + {_dot('zt', 'g[i]')}))
                  / (1D - (1D / n + {_dot('zt2', 'dinv[i]')})), 2)))""")
    e = j.select(*keys, "n", F.inline(per_alpha))
    model = F.struct("n", "alpha", "intercept", "coef")  # the same on every row of (segment, alpha)
    return e.groupBy(*keys, "ai").agg(F.avg("e2").alias("loo_mse"), F.first(model).alias("model"))


def fit_ridge(df: DataFrame, keys: Sequence[str], features: Sequence[str], y: str,
              alphas: Sequence[float] = ALPHAS, min_rows: int = 0,
              loo: bool = True) -> DataFrame:
    """Model table: one row per segment with the chosen alpha, intercept,
    coefficient array and the LOO error (RMSE of LOO residuals).

    With ``loo=False`` and a single alpha this is plain ``Ridge(alpha)``.
    ``min_rows`` is the A7 gate (segments with fewer priced rows skipped).
    """
    keys = list(keys)
    mom = moments(df, keys, features, y)
    if min_rows:
        mom = mom.where(F.col("n") >= min_rows)
    eig = eigen_solve(mom, keys, len(features), alphas)
    if loo:
        errs = loo_errors(df, eig, keys, features, y)
        best = errs.groupBy(*keys).agg(F.min(F.struct("loo_mse", "ai", "model")).alias("b"))
        chosen = best.select(*keys, "b.model.*", F.col("b.loo_mse").alias("loo_mse"))
    else:
        chosen = eig.select(*keys, "n", F.expr("alphas[0]").alias("alpha"), F.expr("intercepts[0]").alias("intercept"),
                            F.expr("coefs[0]").alias("coef"), F.lit(None).cast("double").alias("loo_mse"))
    return chosen.select(
        *keys, "n", "alpha", "intercept", "coef", F.array(*[F.lit(c) for c in features]).alias("features"),
        F.sqrt("loo_mse").alias("loo_rmse"))


def predict(df: DataFrame, models: DataFrame, keys: Sequence[str], features: Sequence[str],
            out: str = "prediction") -> DataFrame:
    """M3: intercept + coef . x (NULL features -> 0), model joined by
    segment key (the model table has one row per segment)."""
    keys = list(keys)
    j = join_on_keys(df, models.select(*keys, "intercept", "coef"), keys)
    j = j.withColumn("_x", feature_vector(features))
    return j.withColumn(out, F.col("intercept") + F.expr(_dot("coef", "_x"))).drop("_x")


def model_name(segment_type: F.Column, country: F.Column, grade: F.Column) -> F.Column:
    """File-name style model id: global_ridge, country_<c>, grade_<g>,
    country_grade_<c>_<g> (spaces -> underscores)."""
    c = F.regexp_replace(country, " ", "_")
    g = F.regexp_replace(grade, " ", "_")
    return (F.when(segment_type == "global", F.lit("global_ridge"))
            .when(segment_type == "country", F.concat(F.lit("country_"), c))
            .when(segment_type == "grade", F.concat(F.lit("grade_"), g))
            .otherwise(F.concat(F.lit("country_grade_"), c, F.lit("_"), g)))
