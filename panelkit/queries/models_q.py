"""Step 7 queries: ridge moments and models, metrics, back-test, grid
search, OLS drivers and the quality gate."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import register
from ..session import cut_lineage
from ..operators.aggregates import error_metrics
from ..operators.ridge import ALPHAS, moments
from ..operators.segments import SEGMENT_KEYS
from ..operators.windows import FEATURES, rolling_mean, series_window
from ..plans.exploration import weekly_overall
from ..plans.models import arx_scores, backtest, evaluate, grid_search, ols_drivers, quality_gate, train
from ..plans.series import segment_features
from .features_q import features
from .series_q import SEGMENT_SQL, processed
from .sqlparts import r

P = len(FEATURES)
X_SQL = ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0.0) AS x{i}" for i, c in enumerate(FEATURES))
MOM_SQL = SEGMENT_SQL + f""",
xs AS (SELECT segment_type, country, grade, {X_SQL}, price_usd_per_l AS y FROM segp)
SELECT segment_type, country, grade, count(*) AS n, {r('avg(y)', 'ybar')},
       {', '.join(r(f'avg(x{i})', f'm{i}') for i in range(P))},
       {', '.join(r(f'covar_pop(x{i}, x{j}) * count(*)', f's{i}_{j}')
                  for i in range(P) for j in range(i, P))},
       {', '.join(r(f'covar_pop(x{i}, y) * count(*)', f't{i}') for i in range(P))}
FROM xs GROUP BY ALL"""


def seg_rows(spark, sf_dir):
    return segment_features(processed(spark, sf_dir))


@register("ridge_moments", MOM_SQL)
def q_ridge_moments(spark, sf_dir):
    """M2 step 1: per-segment sufficient statistics (n, means, centred
    cross-products) - the only pass over the rows the fit needs."""
    return moments(seg_rows(spark, sf_dir), SEGMENT_KEYS, FEATURES, "price_usd_per_l")


@register("ridge_loo_models")
def q_ridge_loo_models(spark, sf_dir):
    """RidgeCV (LOO over 20 alphas) per segment with >= 26 weeks."""
    return train(processed(spark, sf_dir))


NOTEBOOK_FEATURES = ["lag1week", "lag2week", "rolling3", "rolling10", "month", "dayofweek",
                     "quarter", "cost_pressure"]


def notebook_series(spark, sf_dir):
    """The notebook's overall weekly series with strict rolling windows."""
    wk = weekly_overall(features(spark, sf_dir), store=cut_lineage).withColumn("series", F.lit("overall"))
    w = series_window(["series"], "week_start")
    from ..functions.calendar import calendar_parts
    parts = calendar_parts(F.col("week_start"))
    return cut_lineage(wk.withColumns({
        "lag1week": F.lag("base_usd_per_l", 1).over(w),
        "lag2week": F.lag("base_usd_per_l", 2).over(w),
        "rolling3": rolling_mean("base_usd_per_l", 3, w, strict=True),
        "rolling10": rolling_mean("base_usd_per_l", 10, w, strict=True),
        **parts})
        .dropna(subset=NOTEBOOK_FEATURES + ["base_usd_per_l"]))


@register("ridge_fixed_alpha")
def q_ridge_fixed_alpha(spark, sf_dir):
    """M1 + M6: Ridge(alpha=1) on the notebook's weekly series, last 12
    weeks held out: hold-out MAE / RMSE."""
    return backtest(notebook_series(spark, sf_dir), ["series"], NOTEBOOK_FEATURES,
                    "base_usd_per_l", holdout=12, alpha=1.0)


OLS_NUMERIC = ["ocean_idx", "diesel_usd_per_gal", "ppi_glass", "ppi_plastic_bottles", "ppi_steel",
               "pack_cost", "duty_rate"]
OLS_CATEGORICAL = ["country", "grade", "market"]


@register("ols_drivers")
def q_ols_drivers(spark, sf_dir):
    """M5: OLS of the base price on drivers with country/grade/market terms."""
    f = features(spark, sf_dir).where(F.col("base_usd_per_l").isNotNull()
                                      & (F.col("base_usd_per_l") > 0))
    return ols_drivers(f, "base_usd_per_l", OLS_NUMERIC, OLS_CATEGORICAL)


@register("naive_metrics", SEGMENT_SQL + f"""
SELECT segment_type, country, grade, count(*) AS n,
       {r('avg(abs(lag1week - price_usd_per_l))', 'mae')},
       {r('sqrt(avg((lag1week - price_usd_per_l) * (lag1week - price_usd_per_l)))', 'rmse')},
       {r('avg(CASE WHEN price_usd_per_l <> 0 THEN abs((lag1week - price_usd_per_l) / price_usd_per_l) * 100 END)', 'mape')}
FROM segp WHERE lag1week IS NOT NULL GROUP BY ALL""")
def q_naive_metrics(spark, sf_dir):
    """MAE, RMSE, MAPE of the naive (last week) forecast per segment."""
    return error_metrics(seg_rows(spark, sf_dir), SEGMENT_KEYS, "lag1week", "price_usd_per_l")


@register("segment_metrics")
def q_segment_metrics(spark, sf_dir):
    """In-sample MAE / RMSE of every segment's ridge model."""
    p = processed(spark, sf_dir)
    return evaluate(p, train(p))


@register("backtest_12w")
def q_backtest_12w(spark, sf_dir):
    """M6: per segment, ridge (alpha=1) fitted without the last 12 weeks,
    scored on them."""
    return backtest(seg_rows(spark, sf_dir), SEGMENT_KEYS, FEATURES, "price_usd_per_l",
                    holdout=12, alpha=1.0)


@register("backtest_200w")
def q_backtest_200w(spark, sf_dir):
    """M6: RidgeCV with the seasonal sine on the weekly overall series, last 200 weeks held out."""
    return backtest(notebook_series(spark, sf_dir), ["series"], NOTEBOOK_FEATURES + ["sin_week"],
                    "base_usd_per_l", holdout=200, loo_alphas=ALPHAS)


@register("grid_search")
def q_grid_search(spark, sf_dir):
    """M7: every (segment, candidate) scored on the 12-week hold-out; the
    best candidate per segment by MAE."""
    return grid_search(seg_rows(spark, sf_dir), SEGMENT_KEYS, FEATURES, "price_usd_per_l")


ARX_ORDERS = {"p": [0, 1], "d": [1], "sp": [0, 1], "sd": [0, 1], "x": [0, 1]}


def det3(m: list[list[str]]) -> str:
    """Determinant of a 3 x 3 matrix of SQL expressions."""
    (a, b, c), (d, e, f), (g, h, i) = m
    return f"({a} * ({e} * {i} - {f} * {h}) - {b} * ({d} * {i} - {f} * {g}) + {c} * ({d} * {h} - {e} * {g}))"


def cramer(col: int) -> str:
    """Unknown ``col`` of the masked normal equations (a regressor left out has a row of the unit matrix)."""
    names = ("a", "b", "c")
    m = [[f"m_{x} * m_{y} * s_{min(x, y)}{max(x, y)}" + (f" + (1 - m_{x})" if x == y else "") for y in names] for x in names]
    m = [[f"({e})" for e in row] for row in m]
    top = [[f"(m_{x} * t_{x})" if j == col else m[i][j] for j in range(3)] for i, x in enumerate(names)]
    return f"{det3(top)} / nullif({det3(m)}, 0)"


ARX_SQL = SEGMENT_SQL.replace("WITH ", "WITH RECURSIVE ", 1) + f""",
ar AS (SELECT segment_type, country, grade, week_start, price_usd_per_l AS y, coalesce(cost_pressure, 0.0) AS x,
              row_number() OVER (PARTITION BY segment_type, country, grade ORDER BY week_start DESC) AS rk FROM segp),
az AS (SELECT ar.*, v.sd, y - lag(y, 1) OVER o - v.sd * (lag(y, 52) OVER o - lag(y, 53) OVER o) AS z,
              x - lag(x, 1) OVER o - v.sd * (lag(x, 52) OVER o - lag(x, 53) OVER o) AS w
       FROM ar, (VALUES (0), (1)) v(sd) WINDOW o AS (PARTITION BY segment_type, country, grade, v.sd ORDER BY week_start)),
zz AS (SELECT * REPLACE (CASE WHEN sd = 0 THEN y - y1 ELSE z END AS z, CASE WHEN sd = 0 THEN x - x1 ELSE w END AS w)
       FROM (SELECT *, lag(y) OVER o AS y1, lag(x) OVER o AS x1 FROM az
             WINDOW o AS (PARTITION BY segment_type, country, grade, sd ORDER BY week_start))),
zl AS (SELECT *, lag(z, 1) OVER o AS a, lag(z, 52) OVER o AS b, w AS c FROM zz
       WINDOW o AS (PARTITION BY segment_type, country, grade, sd ORDER BY week_start)),
mo AS (SELECT segment_type, country, grade, sd, count(*) AS n, avg(z) AS mz, avg(a) AS ma, avg(b) AS mb, avg(c) AS mc,
              covar_pop(a, a) AS s_aa, covar_pop(a, b) AS s_ab, covar_pop(a, c) AS s_ac, covar_pop(b, b) AS s_bb,
              covar_pop(b, c) AS s_bc, covar_pop(c, c) AS s_cc, covar_pop(a, z) AS t_a, covar_pop(b, z) AS t_b, covar_pop(c, z) AS t_c
       FROM zl WHERE rk > 12 AND z IS NOT NULL AND a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL GROUP BY ALL),
gr AS (SELECT p, 1 AS d, sp, sd, x, CAST(((p * 2 + sp) * 2 + sd) * 2 + x AS INTEGER) AS cell, p AS m_a, sp AS m_b, x AS m_c
       FROM (VALUES (0), (1)) p(p), (VALUES (0), (1)) q(sp), (VALUES (0), (1)) s(sd), (VALUES (0), (1)) t(x)),
sg AS (SELECT DISTINCT segment_type, country, grade FROM ar WHERE rk > 12),
ce AS (SELECT sg.*, gr.*, mo.* EXCLUDE (segment_type, country, grade, sd) FROM sg CROSS JOIN gr LEFT JOIN mo
       ON mo.segment_type = sg.segment_type AND mo.country IS NOT DISTINCT FROM sg.country
       AND mo.grade IS NOT DISTINCT FROM sg.grade AND mo.sd = gr.sd),
so AS (SELECT *, CASE WHEN n > p + sp + x + 1 THEN {cramer(0)} END AS fa, CASE WHEN n > p + sp + x + 1 THEN {cramer(1)} END AS fb,
              CASE WHEN n > p + sp + x + 1 THEN {cramer(2)} END AS fc FROM ce),
mm AS (SELECT *, mz - fa * ma - fb * mb - fc * mc AS const FROM so),
hi AS (SELECT segment_type, country, grade, sd, list(y ORDER BY week_start) FILTER (rk > 12) AS ys,
              list(z ORDER BY week_start) FILTER (rk > 12) AS zs, list(w ORDER BY week_start) FILTER (rk <= 12) AS ws,
              list(y ORDER BY week_start) FILTER (rk <= 12) AS act FROM zl GROUP BY ALL),
rc AS (
  SELECT mm.segment_type, mm.country, mm.grade, mm.cell, mm.sd, const, fa, fb, fc, 0 AS step, ws, act, ys[-110:] AS ys, zs[-110:] AS zs
  FROM mm JOIN hi ON mm.segment_type = hi.segment_type AND mm.country IS NOT DISTINCT FROM hi.country
    AND mm.grade IS NOT DISTINCT FROM hi.grade AND mm.sd = hi.sd WHERE const IS NOT NULL
  UNION ALL
  SELECT segment_type, country, grade, cell, sd, const, fa, fb, fc, step + 1, ws, act,
         list_append(ys, f + ys[-1] + CASE WHEN sd = 1 THEN ys[-52] - ys[-53] ELSE 0 END), list_append(zs, f)
  FROM (SELECT *, const + fa * zs[-1] + fb * zs[-52] + fc * ws[step + 1] AS f FROM rc WHERE step < len(ws)) t),
fe AS (SELECT segment_type, country, grade, cell, ys[-1] - act[step] AS e FROM rc WHERE step > 0),
er AS (SELECT segment_type, country, grade, cell, count(*) AS n_holdout, avg(abs(e)) AS mae, sqrt(avg(e * e)) AS rmse FROM fe GROUP BY ALL)"""


@register("arx_grid", ARX_SQL + f"""
SELECT mm.segment_type, mm.country, mm.grade, mm.cell, CAST(p AS INTEGER) AS p, CAST(d AS INTEGER) AS d, CAST(sp AS INTEGER) AS sp,
       CAST(mm.sd AS INTEGER) AS sd, CAST(x AS INTEGER) AS x, n, {r('const', 'const')}, {r('fc', 'beta')}, n_holdout,
       {r('mae', 'mae')}, {r('rmse', 'rmse')}
FROM mm LEFT JOIN er ON mm.segment_type = er.segment_type AND mm.country IS NOT DISTINCT FROM er.country
  AND mm.grade IS NOT DISTINCT FROM er.grade AND mm.cell = er.cell""")
def q_arx_grid(spark, sf_dir):
    """M7 / K7: 16 differenced autoregressions (five crossed lists) per segment: coefficients from one moment
    pass and their errors over the last 12 weeks."""
    return arx_scores(seg_rows(spark, sf_dir), SEGMENT_KEYS, "price_usd_per_l", lists=ARX_ORDERS).select(
        *SEGMENT_KEYS, "cell", "p", "d", "sp", "sd", "x", "n", "const", "beta", "n_holdout", "mae", "rmse")


@register("quality_gate")
def q_quality_gate(spark, sf_dir):
    """M9: models approved when the global in-sample MAE <= 0.12."""
    p = processed(spark, sf_dir)
    models = train(p)
    return quality_gate(evaluate(p, models), models).select(
        "model_name", "segment_type", "country", "grade", "alpha", "global_mae", "approved")

