"""P8 train, P9 evaluate, M5 OLS, M6 back-test, M7 grid search, M9 gate.

Every model step is keyed by segment: one row per segment leaves the
moment aggregate, and the per-row passes (LOO, prediction, metrics) join
that small table back to the weekly segment rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.aggregates import error_metrics
from ..operators.arx import ORDERS, SEASON, arx_grid
from ..operators.forecast import recursive_forecast
from ..operators.joins import attach_row, join_on_keys
from ..operators.ridge import ALPHAS, eigen_solve, fit_ridge, model_name, moments, predict
from ..operators.segments import MIN_ROWS_PER_MODEL, SEGMENT_KEYS
from ..operators.windows import FEATURES
from ..session import stored
from .series import segment_features

PRICE = "price_usd_per_l"


def train(processed: DataFrame, alphas: Sequence[float] = ALPHAS) -> DataFrame:
    """RidgeCV (LOO over ``alphas``) for every segment with >= 26
    priced weeks; returns the model table."""
    seg = segment_features(processed)
    models = fit_ridge(seg, SEGMENT_KEYS, FEATURES, PRICE, alphas, MIN_ROWS_PER_MODEL)
    return models.withColumn("model_name", model_name(F.col("segment_type"), F.col("country"),
                                                      F.col("grade")))


def segment_label(df: DataFrame) -> DataFrame:
    return df.withColumn("segment", F.when(F.col("segment_type") == "global", F.lit(None))
                         .when(F.col("segment_type") == "country", F.col("country"))
                         .when(F.col("segment_type") == "grade", F.col("grade"))
                         .otherwise(F.concat_ws("|", "country", "grade")))


def evaluate(processed: DataFrame, models: DataFrame) -> DataFrame:
    """In-sample MAE / RMSE per segment for all four segment types
    (Q19: keys, not file names)."""
    seg = segment_features(processed)
    pred = predict(seg, models, SEGMENT_KEYS, FEATURES)
    return segment_label(error_metrics(pred, SEGMENT_KEYS, "prediction", PRICE))


def quality_gate(metrics: DataFrame, models: DataFrame, threshold: float = 0.12) -> DataFrame:
    """M9: models registered only when the global MAE is within the
    threshold (a scalar subquery read by every model row)."""
    g = metrics.where(F.col("segment_type") == "global").select(F.max("mae"))
    return (models.withColumn("global_mae", g.scalar())
            .withColumn("approved", F.col("global_mae") <= threshold))


def backtest(series: DataFrame, keys: Sequence[str], features: Sequence[str], y: str,
             holdout: int = 12, alpha: float = 1.0, loo_alphas: Sequence[float] | None = None
             ) -> DataFrame:
    """M6: hold out the last ``holdout`` rows of every series, fit on the
    rest (plain ridge at ``alpha``, or RidgeCV over ``loo_alphas``), score
    the held-out rows: MAE / RMSE per series.  As in the exploration it follows, a held-out
    row's rolling means contain its own price; ``grid_search`` scores without that leak."""
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy(F.col("week_start").desc())
    d = series.where(F.col(y).isNotNull()).withColumn("_rk", F.row_number().over(w))
    train_rows = d.where(F.col("_rk") > holdout)
    test_rows = d.where(F.col("_rk") <= holdout)
    if loo_alphas:
        models = fit_ridge(train_rows, keys, features, y, loo_alphas)
    else:
        models = fit_ridge(train_rows, keys, features, y, [alpha], loo=False)
    pred = predict(test_rows, models, keys, features)
    return join_on_keys(error_metrics(pred, keys, "prediction", y),
                        models.select(*keys, "alpha"), keys)


def student_p(t: float, dof: int) -> float:
    """Two-sided p-value of Student's t for whole degrees of freedom, from the finite series in
    the angle atan(t / sqrt(dof)); beyond a million degrees the normal limit."""
    if not math.isfinite(t):
        return 0.0 if math.isinf(t) else float("nan")
    if dof > 1_000_000:
        return math.erfc(abs(t) / math.sqrt(2.0))
    angle = math.atan2(abs(t), math.sqrt(dof))
    # terms cos^2k times (1*3*5../2*4*6..) for even, (2*4../3*5..) for odd degrees
    k = np.arange(1, (dof - dof % 2) // 2) if dof % 2 == 0 else np.arange(1, (dof - 1) // 2)
    ratio = (2 * k - 1) / (2 * k) if dof % 2 == 0 else 2 * k / (2 * k + 1)
    series = 1.0 + float(np.cumprod(ratio * math.cos(angle) ** 2).sum())
    if dof % 2 == 0:
        inside = math.sin(angle) * series
    elif dof == 1:
        inside = 2 * angle / math.pi
    else:
        inside = 2 / math.pi * (angle + math.sin(angle) * math.cos(angle) * series)
    return min(max(1.0 - inside, 0.0), 1.0)


OLS_SCHEMA = ("term string, coef double, std_error double, t_value double, p_value double, "
              "r2 double, n_obs long")


def ols_drivers(df: DataFrame, y: str, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """M5: least squares with an intercept and dummy terms (the alphabetically first level of
    each category is the base) and a coefficient table.

    Rows are reduced in one pass to the sums and cross-products of the numbers in each combination
    of categories (combined map side), which are stored; numpy adds them to partial cross-products
    in tasks, (p+2)^2 sums per partition are added up and one small row is solved in a task with the
    pseudo-inverse, so collinear dummies (market within country) give the minimum-norm solution.
    Only the categories' levels are read when the plan is made, from the stored sums.
    """
    k = len(numeric)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    values = [F.col(c).cast("double") for c in [*numeric, y]]
    used = df.dropna(subset=[y, *numeric, *categorical]).select(*categorical, *[v.alias(f"_{i}") for i, v in enumerate(values)])
    sums = {"_n": F.count(F.lit(1))} | {f"_s{i}": F.sum(f"_{i}") for i in range(k + 1)}
    products_of = [*pairs, *[(i, k) for i in range(k + 1)]]  # y is the last
    sums |= {f"_p{i}_{j}": F.sum(F.col(f"_{i}") * F.col(f"_{j}")) for i, j in products_of}
    cells = stored(used.groupBy(*categorical).agg(*[v.alias(c) for c, v in sums.items()]), "ols-cells")
    levels = {c: sorted(r[0] for r in cells.select(c).distinct().collect())[1:] for c in categorical}
    terms = [*numeric, *[f"{c}_{v}" for c in categorical for v in levels[c]], "Intercept"]
    p = len(terms)

    def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((p + 1, p + 1))
        for pdf in batches:
            dummies = [(pdf[c] == v).to_numpy(float) for c in categorical for v in levels[c]]
            d = np.column_stack([*dummies, np.ones(len(pdf))])
            x = pdf[[f"_s{i}" for i in range(k)]].to_numpy(float)
            for i, j in pairs:
                total[i, j] += pdf[f"_p{i}_{j}"].sum()
                total[j, i] = total[i, j]
            total[:k, k:p] += x.T @ d
            total[k:p, :k] = total[:k, k:p].T
            total[k:p, k:p] += d.T @ (d * pdf["_n"].to_numpy(float)[:, None])
            total[:k, p] += [pdf[f"_p{i}_{k}"].sum() for i in range(k)]
            total[k:p, p] += d.T @ pdf[f"_s{k}"].to_numpy(float)
            total[p, p] += pdf[f"_p{k}_{k}"].sum()
        i, j = np.indices(total.shape)
        yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "v": total.ravel()})

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        entries = pd.concat(list(batches))
        gram = np.zeros((p + 1, p + 1))
        gram[entries["i"], entries["j"]] = entries["v"]
        xtx, xty, yty = gram[:p, :p], gram[:p, p], gram[p, p]
        n = xtx[p - 1, p - 1]
        if not n:
            return
        inverse = np.linalg.pinv(xtx, hermitian=True)
        beta = inverse @ xty
        dof = int(n - np.linalg.matrix_rank(xtx, hermitian=True))
        rss = float(yty - 2 * beta @ xty + beta @ xtx @ beta)
        error = np.sqrt(np.clip(np.diag(inverse) * rss / max(dof, 1), 0.0, None))
        t = np.divide(beta, error, out=np.full(p, np.nan), where=error > 0)
        yield pd.DataFrame({
            "term": terms, "coef": beta, "std_error": error, "t_value": t,
            "p_value": [student_p(float(v), dof) for v in t],
            "r2": 1.0 - rss / float(yty - xty[p - 1] ** 2 / n), "n_obs": int(n)})

    # (p + 2)^2 entries in one task
    gram = cells.mapInPandas(products, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    return gram.coalesce(1).mapInPandas(solve, OLS_SCHEMA)


def ols_level_means(df: DataFrame, table: DataFrame, y: str, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """term, level, n and mean residual of every level of the categories, for the model ``table`` of
    ``ols_drivers`` (read twice: callers hand in a stored one).  A row's residual takes the numbers alone;
    the dummies, equal for all rows of a combination of categories, come off the combinations' sums."""
    numbers = {f"_b{i}": c for i, c in enumerate([*numeric, "Intercept"])}
    slopes = table.agg(*[F.max(F.when(F.col("term") == c, F.col("coef"))).alias(b) for b, c in numbers.items()])  # one row
    fitted = F.col(f"_b{len(numeric)}")
    for i, c in enumerate(numeric):
        fitted = fitted + F.col(f"_b{i}") * F.col(c)
    rows = attach_row(df.dropna(subset=[y, *numeric, *categorical]), slopes)
    cells = rows.groupBy(*categorical).agg(F.count(F.lit(1)).alias("_n"), F.sum(F.col(y) - fitted).alias("_e"))
    coefs = table.agg(F.map_from_entries(F.collect_list(F.struct("term", "coef"))).alias("_b"))  # one row
    for c in categorical:
        dummy = F.coalesce(F.try_element_at("_b", F.concat(F.lit(f"{c}_"), F.col(c))), F.lit(0.0))
        effect = dummy if c == categorical[0] else effect + dummy
    pairs = F.array(*[F.struct(F.lit(c).alias("term"), F.col(c).alias("level")) for c in categorical])
    return attach_row(cells, coefs).select("_n", (F.col("_e") - F.col("_n") * effect).alias("_e"), F.inline(pairs)).groupBy(
        "term", "level").agg(F.sum("_n").alias("n"), (F.sum("_e") / F.sum("_n")).alias("mean_residual"))


NAIVE, SEASONAL, DRIFT = "naive_last_week", "seasonal_naive_52", "drift"


def arx_scores(series: DataFrame, keys: Sequence[str], y: str, x: str = "cost_pressure",
               lists: Mapping[str, Sequence[int]] = ORDERS, holdout: int = 12, season: int = SEASON) -> DataFrame:
    """M7 + K7: a row per segment and cell of the order grid with its model and its error over the
    held-out weeks, which it forecasts recursively; a cell that cannot be fitted keeps NULL scores."""
    keys = list(keys)
    models, ahead = arx_grid(series, keys, y, x, lists, holdout, season)
    scored = error_metrics(ahead, [*keys, "cell"], "forecast", "y").select(
        *keys, "cell", F.col("n").alias("n_holdout"), "mae", "rmse")
    return join_on_keys(models, scored, [*keys, "cell"], "left")


def arx_label() -> F.Column:
    """Name of a cell: arx(p,d)(P,D)52, with + where the driver takes part."""
    return F.concat(F.lit("arx("), "p", F.lit(","), "d", F.lit(")("), "sp", F.lit(","), "sd", F.lit(f"){SEASON}"),
                    F.when(F.col("x") == 1, "+").otherwise(""))


def grid_search(series: DataFrame, keys: Sequence[str], features: Sequence[str], y: str,
                holdout: int = 12, alphas: Sequence[float] = ALPHAS,
                orders: Mapping[str, Sequence[int]] = ORDERS, exogenous: str = "cost_pressure") -> DataFrame:
    """M7: candidates = ridge at every alpha (one moment pass and one eigen-solve per segment),
    last week, the same week a year before, drift, and the cells of a grid of differenced
    autoregressions with a driver (where the series has that column).  Each forecasts the held-out weeks from
    the training rows alone - the ridges recursively, their own forecasts feeding the lags - and
    is scored on the weeks that exist; failures (NULL scores) are skipped, the best MAE is kept
    per segment (ties -> first candidate)."""
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy(F.col("week_start").desc())
    d = series.where(F.col(y).isNotNull()).withColumn("_rk", F.row_number().over(w))
    train_rows, test_rows = d.where(F.col("_rk") > holdout), d.where(F.col("_rk") <= holdout)
    eig = eigen_solve(moments(train_rows, keys, features, y), keys, len(features), alphas)
    ridges = eig.select(*keys, F.lit(None).cast("double").alias("loo_rmse"), F.inline(F.expr(
        "transform(sequence(0, size(alphas) - 1), i -> named_struct('model_name', cast(i as string), "
        "'intercept', intercepts[i], 'coef', coefs[i]))")))
    # a series may skip weeks, so its hold-out may span more weeks than rows
    ahead = recursive_forecast(train_rows, ridges, keys, 2 * holdout, price_col=y)
    number = F.col("model_name").cast("int")
    label = F.concat(F.lit("ridge_alpha_"), F.element_at(F.array(*[F.lit(str(a)) for a in alphas]), number + 1))
    actual = test_rows.select(*keys, "week_start", F.col(y).alias("y"))
    ridge = join_on_keys(actual, ahead.select(*keys, "week_start", number.alias("cand"),
                                              label.alias("candidate"), F.col("forecast").alias("pred")),
                         [*keys, "week_start"])
    ends = train_rows.groupBy(*keys).agg(
        F.max_by(y, "week_start").alias("last"), F.min_by(y, "week_start").alias("first"),
        F.max("week_start").alias("end"), F.min("week_start").alias("begin"))
    slope = F.try_divide(F.col("last") - F.col("first"), F.datediff("end", "begin"))
    year_ago = train_rows.select(*keys, F.date_add("week_start", 364).alias("week_start"), F.col(y).alias("year_ago"))
    base = join_on_keys(join_on_keys(actual, ends, keys), year_ago, [*keys, "week_start"], "left")
    simple = base.select(*keys, "week_start", "y", F.inline(F.array(*[
        F.struct(F.lit(len(alphas) + i).alias("cand"), F.lit(name).alias("candidate"), pred.alias("pred"))
        for i, (name, pred) in enumerate([
            (NAIVE, F.col("last")), (SEASONAL, F.col("year_ago")),
            (DRIFT, F.col("last") + slope * F.datediff("week_start", "end"))])])))
    scored = error_metrics(ridge.unionByName(simple), keys + ["cand", "candidate"], "pred", "y")
    if exogenous in series.columns:
        cells = arx_scores(series, keys, y, exogenous, orders, holdout)
        scored = scored.select(*keys, "cand", "candidate", "n", "mae", "rmse").unionByName(cells.select(
            *keys, (F.col("cell") + len(alphas) + 3).alias("cand"), arx_label().alias("candidate"),
            F.coalesce("n_holdout", F.lit(0)).alias("n"), "mae", "rmse"))
    best = (scored.where(F.col("mae").isNotNull()).groupBy(*keys)
            .agg(F.min(F.struct("mae", "cand", "candidate", "rmse", "n")).alias("b"),
                 F.count(F.lit(1)).alias("n_candidates")))
    return best.select(*keys, F.col("b.candidate").alias("best_candidate"),
                       F.col("b.mae").alias("mae"), F.col("b.rmse").alias("rmse"),
                       F.col("b.n").alias("n_holdout"), "n_candidates")
