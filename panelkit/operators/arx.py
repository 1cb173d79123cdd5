"""Differenced autoregressions with an exogenous driver, for many series and orders at once (M7, K7).

A cell of the grid is (p, d, P, D, x): ordinary and seasonal autoregressive lags, ordinary and seasonal
differences, and whether the driver takes part.  With z and w the differenced target and driver,
z_t = c + sum a_i z_(t-i) + sum A_j z_(t-jm) + b w_t is fitted by least squares:

1. ``product_grid`` makes the grid a relation: the lists of a (name, value) table, crossed.
2. ``differenced`` lags the series once (one window per series) and gives a row per week and pair of
   differences, with the lags of the largest cell; ONE aggregate per series and pair of differences
   then holds the moments that every cell needs, so cells are compared on one sample.
3. ``solve_cells`` takes each cell's part of the moments (a few numbers per row, in the workers) and
   multiplies the lag polynomials out, so that a forecast is a dot product with the last values.
4. ``arx_forecast`` runs the recursion in Catalyst over arrays of one polynomial's length.

A series too short or too regular for a cell has NULL coefficients and NULL scores there.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from .joins import join_on_keys
from .ridge import _dot, moments

#: Weeks of a season.
SEASON = 52
ORDER = ["p", "d", "sp", "sd", "x"]
#: The orders tried by default.
ORDERS = {"p": [0, 1], "d": [1], "sp": [0, 1], "sd": [1], "x": [1]}


def parameter_table(spark: SparkSession, lists: Mapping[str, Sequence[int]]) -> DataFrame:
    """(name, value) rows of parameter lists."""
    rows = [(name, int(v)) for name, values in lists.items() for v in values]
    return spark.createDataFrame(rows, "name string, value int")


def product_grid(parameters: DataFrame, names: Sequence[str]) -> DataFrame:
    """K7: every combination of the values that ``parameters`` (name, value) lists for ``names``, with its
    number ``cell`` (the last name runs fastest); repeated values count once, a name without values
    gives an empty grid."""
    lists = parameters.groupBy().agg(*[
        F.sort_array(F.collect_set(F.when(F.col("name") == n, F.col("value")))).alias(n) for n in names])
    cell = F.lit(0)
    out = lists
    for n in names:
        out = out.select(*[c for c in out.columns if c != n], F.size(n).alias(f"_n_{n}"),
                         F.posexplode(n).alias(f"_at_{n}", n))
        cell = cell * F.col(f"_n_{n}") + F.col(f"_at_{n}")
    return out.select(cell.alias("cell"), *names)


def difference(d: int, sd: int, season: int) -> np.ndarray:
    """Coefficients of (1 - B)^d (1 - B^season)^sd by falling recency."""
    out = np.ones(1)
    for _ in range(d):
        out = np.convolve(out, [1.0, -1.0])
    step = np.zeros(season + 1)
    step[[0, -1]] = 1.0, -1.0
    for _ in range(sd):
        out = np.convolve(out, step)
    return out


def lagged(column: str, weights: np.ndarray, back: int, w) -> F.Column:
    """Sum of weights[i] times the value i + back rows ago."""
    total = None
    for i in np.flatnonzero(weights).tolist():
        v = F.lag(column, i + back).over(w) if i + back else F.col(column)
        term = v if weights[i] == 1 else v * F.lit(float(weights[i]))
        total = term if total is None else total + term
    return total


def regressors(lists: Mapping[str, Sequence[int]]) -> list[str]:
    """Names of the regressors of the largest cell."""
    return [f"z{i + 1}" for i in range(max(lists["p"]))] + [f"s{j + 1}" for j in range(max(lists["sp"]))] + ["w"]


def differenced(series: DataFrame, keys: Sequence[str], y: str, x: str, lists: Mapping[str, Sequence[int]],
                season: int = SEASON) -> DataFrame:
    """keys, d, sd, z, its lags and w, for every week that has them all.  Lags go by row (weeks without a
    target take no part), an absent driver counts as 0."""
    w = Window.partitionBy(*keys).orderBy("week_start")
    d = series.where(F.col(y).isNotNull()).select(*keys, "week_start", F.col(y).cast("double").alias("_y"),
                                                  F.coalesce(F.col(x).cast("double"), F.lit(0.0)).alias("_x"))
    variants = []
    for n in sorted(set(lists["d"])):
        for sn in sorted(set(lists["sd"])):
            poly = difference(n, sn, season)
            lags = {f"z{i + 1}": i + 1 for i in range(max(lists["p"]))}
            lags |= {f"s{j + 1}": season * (j + 1) for j in range(max(lists["sp"]))}
            variants.append(F.struct(F.lit(n).alias("d"), F.lit(sn).alias("sd"), lagged("_y", poly, 0, w).alias("z"),
                                     *[lagged("_y", poly, back, w).alias(c) for c, back in lags.items()],
                                     lagged("_x", poly, 0, w).alias("w")))
    rows = d.select(*keys, F.array(*variants).alias("v")).select(*keys, F.inline("v"))
    return rows.dropna(subset=["z", *regressors(lists)])


def solve_cells(moments_: DataFrame, grid: DataFrame, keys: Sequence[str], lists: Mapping[str, Sequence[int]],
                season: int = SEASON) -> DataFrame:
    """keys and cell with n (weeks of the sample), const, phi (the cell's lag coefficients), beta, and the two
    polynomials as arrays from the oldest lag on: ``past`` for the target, ``driver`` for the driver.
    NULLs where the sample has too few weeks or its moments are singular."""
    names = regressors(lists)
    at = {c: i for i, c in enumerate(names)}
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    array = ArrayType(DoubleType())
    schema = StructType([moments_.schema[k] for k in keys] + [
        StructField("cell", IntegerType()), StructField("n", LongType()), StructField("const", DoubleType()),
        StructField("phi", array), StructField("beta", DoubleType()), StructField("past", array),
        StructField("driver", array), StructField("problem", StringType())])

    def one(r) -> tuple:
        use = [at[f"z{i + 1}"] for i in range(r.p)] + [at[f"s{j + 1}"] for j in range(r.sp)] + [at["w"]] * r.x
        if r.n <= len(use) + 1:
            return r.n, None, None, None, None, None, "too few weeks"
        a = np.zeros((len(names), len(names)))
        for i, j in pairs:
            a[i, j] = a[j, i] = getattr(r, f"s{i}_{j}")
        a, b = a[np.ix_(use, use)], np.array([getattr(r, f"t{i}") for i in use])
        if use and np.linalg.matrix_rank(a, hermitian=True) < len(use):
            return r.n, None, None, None, None, None, "singular"
        coef = np.linalg.solve(a, b) if use else b
        const = r.ybar - sum(c * getattr(r, f"m{i}") for c, i in zip(coef, use))
        lags = np.zeros(1 + max(r.p, season * r.sp))
        lags[0] = 1.0
        lags[1:r.p + 1] -= coef[:r.p]
        for j in range(r.sp):
            lags[season * (j + 1)] -= coef[r.p + j]
        diff = difference(r.d, r.sd, season)
        past = -np.convolve(lags, diff)[1:]
        return (r.n, float(const), coef[:r.p + r.sp].tolist(), float(coef[-1]) if r.x else 0.0,
                past[::-1].tolist(), diff[::-1].tolist(), None)

    def solve(batches):
        for pdf in batches:
            rows = [one(r) for r in pdf.itertuples()]
            out = pd.DataFrame(rows, columns=schema.fieldNames()[len(keys) + 1:])
            yield pd.concat([pdf[[*keys, "cell"]].reset_index(drop=True), out], axis=1)[schema.fieldNames()]

    return moments_.join(F.broadcast(grid), ["d", "sd"]).mapInPandas(solve, schema)  # the grid is a list of parameters


def arx_models(train: DataFrame, keys: Sequence[str], y: str, x: str, lists: Mapping[str, Sequence[int]] = ORDERS,
               season: int = SEASON) -> DataFrame:
    """Every cell of the grid for every series with a row in ``train``."""
    keys = list(keys)
    names = regressors(lists)
    grid = product_grid(parameter_table(train.sparkSession, lists), ORDER)
    rows = differenced(train, keys, y, x, lists, season)
    # the inner names of moments() are x0, x1, ...; the target is z
    known = solve_cells(moments(rows, [*keys, "d", "sd"], names, "z"), grid, keys, lists, season)
    every = train.select(*keys).distinct().crossJoin(F.broadcast(grid))
    return join_on_keys(every, known, [*keys, "cell"], "left").withColumn(
        "problem", F.when(F.col("n").isNull(), "too few weeks").otherwise(F.col("problem")))


def arx_forecast(train: DataFrame, ahead: DataFrame, models: DataFrame, keys: Sequence[str], y: str, x: str,
                 lists: Mapping[str, Sequence[int]] = ORDERS, season: int = SEASON) -> DataFrame:
    """keys, cell, step, forecast of the weeks in ``ahead`` (in their order; their driver is known, their
    target is not read), from the last weeks of ``train``."""
    keys = list(keys)
    longest = max(lists["d"]) + season * max(lists["sd"]) + max(*lists["p"], season * max(lists["sp"]))
    newest = Window.partitionBy(*keys).orderBy(F.col("week_start").desc())
    driver = F.coalesce(F.col(x).cast("double"), F.lit(0.0))
    ordered = lambda c: F.expr(f"transform(array_sort(collect_list(struct(week_start, {c}))), s -> s.{c})")
    past = (train.where(F.col(y).isNotNull()).withColumn("_rk", F.row_number().over(newest))
            .where(F.col("_rk") <= longest + 1)  # no more than the longest polynomial reads
            .select(*keys, "week_start", F.col(y).cast("double").alias("y"), driver.alias("x"))
            .groupBy(*keys).agg(ordered("y").alias("ys"), ordered("x").alias("xs")))
    future = (ahead.select(*keys, "week_start", driver.alias("x")).groupBy(*keys)
              .agg(ordered("x").alias("later")).withColumn("steps", F.size("later")))
    rows = join_on_keys(join_on_keys(models.where(F.col("problem").isNull()), past, keys), future, keys)
    rows = rows.where("size(ys) >= size(past) and size(xs) >= size(driver)").withColumn("xs", F.concat("xs", "later"))
    w = _dot("driver", "slice(xs, size(ys) + k - size(driver) + 1, size(driver))")
    value = f"const + beta * {w} + {_dot('past', 'slice(h, size(h) - size(past) + 1, size(past))')}"
    path = f"aggregate(sequence(1, steps), ys, (h, k) -> concat(h, array({value})), h -> slice(h, size(ys) + 1, steps))"
    return rows.select(*keys, "cell", F.posexplode(F.expr(path)).alias("step", "forecast")).withColumn("step", F.col("step") + 1)


def arx_grid(series: DataFrame, keys: Sequence[str], y: str, x: str, lists: Mapping[str, Sequence[int]] = ORDERS,
             holdout: int = 12, season: int = SEASON) -> tuple[DataFrame, DataFrame]:
    """(models of all cells without the last ``holdout`` weeks, forecasts of those weeks with the actual
    value: keys, cell, step, week_start, y, forecast)."""
    keys = list(keys)
    newest = Window.partitionBy(*keys).orderBy(F.col("week_start").desc())
    d = series.where(F.col(y).isNotNull()).withColumn("_rk", F.row_number().over(newest))
    train, test = d.where(F.col("_rk") > holdout), d.where(F.col("_rk") <= holdout)
    models = arx_models(train, keys, y, x, lists, season)
    ahead = arx_forecast(train, test, models, keys, y, x, lists, season)
    step = F.row_number().over(Window.partitionBy(*keys).orderBy("week_start"))
    actual = test.select(*keys, step.alias("step"), "week_start", F.col(y).alias("y"))
    return models, join_on_keys(ahead, actual, [*keys, "step"])
