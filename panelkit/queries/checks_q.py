"""Queries that pin the model half and the branches the plain tables never reach to SQL: fixed
coefficients after the fit, closed forms and normal equations for the fit, and inputs derived
from the tables in mixed encodings, with blanks, free-text grades and graded tariffs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import register
from ..functions import calendar as cal
from ..functions.coerce import canon_grade, parse_date_text, to_double
from ..operators.aggregates import error_metrics
from ..operators.forecast import recursive_forecast
from ..operators.joins import join_on_keys
from ..operators.ridge import ALPHAS, fit_ridge, moments, predict
from ..operators.segments import SEGMENT_KEYS, segment_gate
from ..operators.windows import FEATURES
from ..plans.features import impute, usable_rows
from ..plans.forecast import forecast, monthly_forecast
from ..plans.models import ols_drivers, ols_level_means, quality_gate, segment_label, train
from ..plans.monitoring import freshness, monitor_summary, retrain_candidates
from ..plans.panel import join_tariffs
from ..plans.standardize import normalize_tariffs, price_to_eur_per_l, standardize_prices
from ..session import stored
from ..sources import tables as T
from .features_q import FEAT_SQL, features
from .forecast_q import FIXED_COEF, FIXED_STEPS
from .insights_q import ERR_SQL, FRESH_SQL, fresh_sources, naive_errors
from .models_q import OLS_CATEGORICAL, OLS_NUMERIC, seg_rows
from .panel_q import PANEL_CTES, SNAPSHOT, weekly_panel
from .series_q import SEGMENT_SQL, processed
from .sqlparts import OBS, r, rr, with_
from .standardize_q import CANON_GRADE_SQL

PRICE = "price_usd_per_l"
COEF = [0.4, 0.2, 0.1, 0.1, 0.05, 0.02, 0.01, 0.3, 0.5]
INTERCEPT, FIXED_RMSE = 0.25, 2.0


def fixed_models(seg, coef=COEF, intercept=INTERCEPT):
    return (seg.select(*SEGMENT_KEYS).distinct().withColumn("intercept", F.lit(intercept))
            .withColumn("coef", F.array(*[F.lit(c) for c in coef])).withColumn("loo_rmse", F.lit(FIXED_RMSE))
            .withColumn("model_name", F.lit("fixed")))


# ---- after the fit ------------------------------------------------------------------

PRED_SQL = SEGMENT_SQL + f""",
pr AS (SELECT *, {INTERCEPT} + """ + " + ".join(
    f"{c} * coalesce(CAST({f} AS DOUBLE), 0.0)" for c, f in zip(COEF, FEATURES)) + """ AS prediction FROM segp)"""


@register("predict_fixed", PRED_SQL + f"""
SELECT segment_type, country, grade, week_start, {r('prediction', 'prediction')} FROM pr""")
def q_predict_fixed(spark, sf_dir):
    """Every segment row through a fixed model."""
    seg = seg_rows(spark, sf_dir)
    return predict(seg, fixed_models(seg), SEGMENT_KEYS, FEATURES).select(*SEGMENT_KEYS, "week_start", "prediction")


METRIC_SQL = PRED_SQL + f""",
mt AS (SELECT segment_type, country, grade, count(*) AS n, avg(abs(prediction - {PRICE})) AS mae,
              sqrt(avg((prediction - {PRICE}) * (prediction - {PRICE}))) AS rmse FROM pr GROUP BY ALL)"""


def fixed_metrics(spark, sf_dir):
    seg = seg_rows(spark, sf_dir)
    pred = predict(seg, fixed_models(seg), SEGMENT_KEYS, FEATURES)
    return segment_label(error_metrics(pred, SEGMENT_KEYS, "prediction", PRICE))


@register("segment_metrics_fixed", METRIC_SQL + f"""
SELECT segment_type, CASE segment_type WHEN 'country' THEN country WHEN 'grade' THEN grade
         WHEN 'country_grade' THEN country || '|' || grade END AS segment, n,
       {r('mae', 'mae')}, {r('rmse', 'rmse')} FROM mt""")
def q_segment_metrics_fixed(spark, sf_dir):
    """Metrics per segment of a fixed model, by segment label."""
    return fixed_metrics(spark, sf_dir).select("segment_type", "segment", "n", "mae", "rmse")


GATES = (0.12, 1000.0)


@register("quality_gate_levels", METRIC_SQL + f""",
g AS (SELECT max(mae) AS global_mae FROM mt WHERE segment_type = 'global')
SELECT t.threshold, mt.segment_type, mt.country, mt.grade, {r('g.global_mae', 'global_mae')},
       g.global_mae <= t.threshold AS approved
FROM mt, g, (VALUES {', '.join(f'(CAST({t} AS DOUBLE))' for t in GATES)}) t(threshold)""")
def q_quality_gate_levels(spark, sf_dir):
    """M9: the gate at a threshold that rejects and at one that approves."""
    metrics = fixed_metrics(spark, sf_dir)
    models = metrics.select(*SEGMENT_KEYS)
    parts = [quality_gate(metrics, models, t).withColumn("threshold", F.lit(t)) for t in GATES]
    return parts[0].unionByName(parts[1]).select("threshold", *SEGMENT_KEYS, "global_mae", "approved")


@register("holdout_metrics_fixed", PRED_SQL + f""",
ho AS (SELECT *, row_number() OVER (PARTITION BY segment_type, country, grade ORDER BY week_start DESC) AS rk FROM pr)
SELECT segment_type, country, grade, count(*) AS n, {r(f'avg(abs(prediction - {PRICE}))', 'mae')},
       {r(f'sqrt(avg((prediction - {PRICE}) * (prediction - {PRICE})))', 'rmse')}
FROM ho WHERE rk <= 12 GROUP BY ALL""")
def q_holdout_metrics_fixed(spark, sf_dir):
    """M6 / K2: a fixed model scored on the last 12 rows of every segment."""
    from pyspark.sql import Window
    seg = seg_rows(spark, sf_dir)
    pred = predict(seg, fixed_models(seg), SEGMENT_KEYS, FEATURES)
    w = Window.partitionBy(*SEGMENT_KEYS).orderBy(F.col("week_start").desc())
    held = pred.withColumn("rk", F.row_number().over(w)).where("rk <= 12")
    return error_metrics(held, SEGMENT_KEYS, "prediction", PRICE).drop("mape")


REC_SQL = SEGMENT_SQL.replace("WITH ", "WITH RECURSIVE ", 1) + f""",
ranked AS (SELECT *, row_number() OVER (PARTITION BY segment_type, country, grade ORDER BY week_start DESC) AS rk FROM segp),
hist AS (SELECT segment_type, country, grade, list(price_usd_per_l ORDER BY week_start) AS h, max(week_start) AS last_week
         FROM ranked WHERE rk <= 10 GROUP BY ALL),
rec AS (
  SELECT segment_type, country, grade, last_week, 0 AS step, h, CAST(NULL AS DOUBLE) AS forecast FROM hist
  UNION ALL
  SELECT segment_type, country, grade, last_week, step + 1, list_append(h, f), f
  FROM (SELECT *, 0.0 + (0.0 + 0.5 * coalesce(h[-1], 0.0) + 0.3 * coalesce(h[-2], 0.0)
                          + 0.1 * coalesce(list_avg(h[-2:]), 0.0) + 0.1 * coalesce(list_avg(h[-9:]), 0.0)) AS f
        FROM rec WHERE step < {FIXED_STEPS}) t),
fc AS (SELECT segment_type, country, grade, step, CAST(last_week + 7 * step AS DATE) AS week_start, forecast,
              forecast - 1.96 * {FIXED_RMSE} * sqrt(step) AS lower, forecast + 1.96 * {FIXED_RMSE} * sqrt(step) AS upper
       FROM rec WHERE step > 0)"""


def fixed_forecast(spark, sf_dir, **how):
    p = processed(spark, sf_dir)
    from ..plans.series import segment_features
    return forecast(p, fixed_models(segment_features(p), FIXED_COEF, 0.0), steps=FIXED_STEPS, **how)


@register("forecast_intervals_fixed", REC_SQL + f"""
SELECT segment_type, country, grade, step, strftime(week_start, '%Y-%m-%d') AS week_start,
       {r('forecast', 'forecast')}, {r('lower', 'lower')}, {r('upper', 'upper')} FROM fc""")
def q_forecast_intervals_fixed(spark, sf_dir):
    """P10 / M8: forecasts with intervals that widen with the square root of the step."""
    return fixed_forecast(spark, sf_dir).drop("model_used")


@register("forecast_monthly_fixed", REC_SQL + f""",
mo AS (SELECT segment_type, country, grade, strftime(week_start, '%Y-%m') AS month, avg(forecast) AS f, avg(lower) AS l,
              avg(upper) AS u, count(*) AS n_weeks FROM fc GROUP BY ALL),
mi AS (SELECT *, CAST(row_number() OVER (PARTITION BY segment_type, country, grade ORDER BY month) AS INTEGER) AS month_index FROM mo)
SELECT segment_type, country, grade, month, {r('f', 'predicted_price_usd_per_liter')},
       {r('l', 'confidence_interval_lower')}, {r('u', 'confidence_interval_upper')}, n_weeks, month_index
FROM mi WHERE month_index <= 2""")
def q_forecast_monthly_fixed(spark, sf_dir):
    """T4: the first two months of a fixed model's forecasts."""
    return monthly_forecast(fixed_forecast(spark, sf_dir), 2)


PLAN_COUNTRIES = ["ASIA", "EUROPE"]


@register("planning_fixed", REC_SQL + f"""
SELECT country, grade, step, strftime(week_start, '%Y-%m-%d') AS date, {r('forecast', 'forecast')},
       {r('lower', 'lower')}, {r('upper', 'upper')}
FROM fc WHERE segment_type = 'country_grade' AND grade = 'R' AND country IN ('ASIA', 'EUROPE') AND step <= 5""")
def q_planning_fixed(spark, sf_dir):
    """One grade, a list of countries, 30 days ahead, with a fixed model."""
    from ..plans.forecast import planning_scenario
    from ..plans.series import segment_features
    p = processed(spark, sf_dir)
    return planning_scenario(p, fixed_models(segment_features(p), FIXED_COEF, 0.0), PLAN_COUNTRIES, "R", 30)


@register("forecast_named_model", REC_SQL + f"""
SELECT segment_type, country, grade, 'global_ridge' AS model_used, step, strftime(week_start, '%Y-%m-%d') AS week_start,
       {r('forecast', 'forecast')}, {r('lower', 'lower')}, {r('upper', 'upper')}
FROM fc WHERE country = 'ASIA'""")
def q_forecast_named_model(spark, sf_dir):
    """One named model applied to every history of a country."""
    p = processed(spark, sf_dir)
    from ..plans.series import segment_features
    models = fixed_models(segment_features(p).where("segment_type = 'global'"), FIXED_COEF, 0.0).withColumn(
        "model_name", F.lit("global_ridge"))
    return forecast(p, models, steps=FIXED_STEPS, country="ASIA", model_name="global_ridge")


# ---- the fit ------------------------------------------------------------------------

@register("ridge_one_feature", SEGMENT_SQL + f""",
xy AS (SELECT segment_type, country, grade, coalesce(lag1week, 0.0) AS x, {PRICE} AS y FROM segp),
m0 AS (SELECT segment_type, country, grade, count(*) AS n, avg(x) AS mx, avg(y) AS my,
              covar_pop(x, x) * count(*) AS sxx, covar_pop(x, y) * count(*) AS sxy FROM xy GROUP BY ALL HAVING count(*) >= 26),
al AS (SELECT unnest([{', '.join(repr(a) for a in ALPHAS)}]) AS alpha),
e AS (SELECT m0.*, alpha, avg(pow((y - (my + sxy / (sxx + alpha) * (x - mx)))
                                  / (1 - (1.0 / n + (x - mx) * (x - mx) / (sxx + alpha))), 2)) AS mse
      FROM xy JOIN m0 ON xy.segment_type = m0.segment_type AND xy.country IS NOT DISTINCT FROM m0.country
                     AND xy.grade IS NOT DISTINCT FROM m0.grade, al GROUP BY ALL),
b AS (SELECT *, row_number() OVER (PARTITION BY segment_type, country, grade ORDER BY mse, alpha) AS k FROM e)
SELECT segment_type, country, grade, n, {r('alpha', 'alpha')}, {r('my - sxy / (sxx + alpha) * mx', 'intercept')},
       {r('sxy / (sxx + alpha)', 'coef')}, {r('sqrt(mse)', 'loo_rmse')}
FROM b WHERE k = 1""")
def q_ridge_one_feature(spark, sf_dir):
    """M2: the leave-one-out choice among 20 alphas with one feature, where it has a closed form."""
    m = fit_ridge(seg_rows(spark, sf_dir), SEGMENT_KEYS, ["lag1week"], PRICE, ALPHAS, 26)
    return m.select(*SEGMENT_KEYS, "n", "alpha", "intercept", F.col("coef")[0].alias("coef"), "loo_rmse")


@register("ridge_normal_equations", SEGMENT_SQL + """
SELECT segment_type, country, grade, count(*) AS n, CAST(0.0 AS DOUBLE) AS worst_residual
FROM segp GROUP BY ALL HAVING count(*) >= 26""")
def q_ridge_normal_equations(spark, sf_dir):
    """The chosen nine-feature model of every segment solves (S + alpha I) b = t; the
    largest residual, relative to the largest term, is zero."""
    p = processed(spark, sf_dir)
    from ..plans.series import segment_features
    models = train(p).select(*SEGMENT_KEYS, "alpha", "coef")
    both = join_on_keys(moments(segment_features(p), SEGMENT_KEYS, FEATURES, PRICE), models, SEGMENT_KEYS)
    k = range(len(FEATURES))
    gaps, sizes = [], []
    for i in k:
        terms = [F.col(f"s{min(i, j)}_{max(i, j)}") * F.col("coef")[j] for j in k] + [F.col("alpha") * F.col("coef")[i]]
        gap = F.col(f"t{i}")
        for t in terms:
            gap = gap - t
        gaps.append(F.abs(gap))
        sizes += [F.abs(t) for t in terms]
    worst = F.greatest(*gaps) / F.greatest(F.lit(1.0), *sizes)
    return both.select(*SEGMENT_KEYS, "n", worst.alias("worst_residual"))


@register("ols_residual_means", FEAT_SQL + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS term, {c} AS level, count(*) AS n, CAST(0.0 AS DOUBLE) AS mean_residual FROM feat "
    f"WHERE base_usd_per_l > 0 AND {' AND '.join(f'{x} IS NOT NULL' for x in OLS_NUMERIC)} GROUP BY {c}"
    for c in OLS_CATEGORICAL))
def q_ols_residual_means(spark, sf_dir):
    """M5: a least-squares fit with dummies leaves a mean residual of zero in every level."""
    f = features(spark, sf_dir).where(F.col("base_usd_per_l") > 0)
    table = stored(ols_drivers(f, "base_usd_per_l", OLS_NUMERIC, OLS_CATEGORICAL), "ols-terms")
    return ols_level_means(f, table, "base_usd_per_l", OLS_NUMERIC, OLS_CATEGORICAL)


# ---- encodings ----------------------------------------------------------------------

DATE_FORMS = ["yyyy-MM-dd", "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd HH:mm:ss.S", "M/d/yyyy", "MM.dd.yyyy",
              "MMM d, yyyy", "yyyyMMdd", "yyyy-M-d"]


@register("date_encodings", f"""
SELECT CAST(o_orderkey % {len(DATE_FORMS) + 1} AS INTEGER) AS form, count(*) AS n_rows,
       count(*) FILTER (WHERE o_orderkey % {len(DATE_FORMS) + 1} < {len(DATE_FORMS)}) AS n_parsed,
       CAST(sum(CASE WHEN o_orderkey % {len(DATE_FORMS) + 1} < {len(DATE_FORMS)}
                     THEN date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) END) AS BIGINT) AS sum_days
FROM orders GROUP BY ALL""")
def q_date_encodings(spark, sf_dir):
    """Order dates written in eight forms (month first, zoned, fractional, unpadded, compact)
    and as junk, parsed back; checked against the dates themselves."""
    o = T.read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate"])
    form = F.pmod("o_orderkey", F.lit(len(DATE_FORMS) + 1)).cast("int")
    text = F.lit("n/a")
    for i, f in enumerate(DATE_FORMS):
        text = F.when(form == i, F.date_format(F.col("o_orderdate").cast("timestamp"), f)).otherwise(text)
    days = F.datediff(F.to_date(parse_date_text(text)), F.lit("1970-01-01").cast("date")).cast("long")
    return o.select(form.alias("form"), days.alias("d")).groupBy("form").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("d").alias("n_parsed"), F.sum("d").alias("sum_days"))


@register("number_encodings", """
SELECT CAST(p_partkey % 6 AS INTEGER) AS form, count(*) AS n_rows,
       count(*) FILTER (WHERE p_partkey % 6 IN (0, 4, 5)) AS n_numbers,
       CAST(sum(CASE p_partkey % 6 WHEN 0 THEN p_size WHEN 4 THEN p_size * 100.0 WHEN 5 THEN -p_size END) AS DOUBLE) AS total
FROM part GROUP BY ALL""")
def q_number_encodings(spark, sf_dir):
    """Sizes as plain, suffixed (``12d``, ``12F``), hexadecimal, exponent and signed text:
    codes are no numbers."""
    p = T.read_table(spark, sf_dir, "part", ["p_partkey", "p_size"])
    form, size = F.pmod("p_partkey", F.lit(6)).cast("int"), F.col("p_size").cast("string")
    text = (F.when(form == 0, F.concat(F.lit(" "), size)).when(form == 1, F.concat(size, F.lit("d")))
            .when(form == 2, F.concat(size, F.lit("F"))).when(form == 3, F.concat(F.lit("0x"), size, F.lit("p3")))
            .when(form == 4, F.concat(size, F.lit("e2"))).otherwise(F.concat(F.lit("-"), size)))
    v = to_double(text)
    return p.select(form.alias("form"), v.alias("v")).groupBy("form").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("v").alias("n_numbers"), F.sum("v").alias("total"))


@register("iso_week_junk", """
SELECT CAST(o_orderkey % 5 AS INTEGER) AS form, count(*) AS n_rows,
       count(*) FILTER (WHERE o_orderkey % 5 = 0) AS n_weeks,
       max(CASE WHEN o_orderkey % 5 = 0 THEN CAST(date_trunc('week', o_orderdate) AS DATE) END) AS last_week
FROM orders GROUP BY ALL""")
def q_iso_week_junk(spark, sf_dir):
    """Year and week texts, good and junk (words, week 54, a year beyond all calendars)."""
    o = T.read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate"])
    form = F.pmod("o_orderkey", F.lit(5)).cast("int")
    year = F.when(form == 1, F.lit("year?")).when(form == 2, F.lit("99999999999")).otherwise(
        cal.iso_year("o_orderdate").cast("string"))
    week = F.when(form == 3, F.lit("54")).when(form == 4, F.lit("w")).otherwise(cal.iso_week("o_orderdate").cast("string"))
    return o.select(form.alias("form"), cal.iso_week_start(year, week).alias("w")).groupBy("form").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("w").alias("n_weeks"), F.max("w").alias("last_week"))


GRADE_TEXTS = [" Extra virgin", "Virgin olive oil", "lampante ", "Refined oil", "Olive-pomace", "blend"]


@register("canon_grade_text", f"""
WITH t AS (SELECT p_size % 6 AS k, [{', '.join(f"'{g}'" for g in GRADE_TEXTS)}][p_size % 6 + 1] AS grade FROM part)
SELECT {CANON_GRADE_SQL} AS code, count(*) AS n_rows FROM t GROUP BY ALL""")
def q_canon_grade_text(spark, sf_dir):
    """Free-text grades of every kind to their codes."""
    p = T.read_table(spark, sf_dir, "part", ["p_size"])
    text = F.element_at(F.array(*[F.lit(g) for g in GRADE_TEXTS]), F.pmod("p_size", F.lit(6)).cast("int") + 1)
    return p.select(canon_grade(text).alias("code")).groupBy("code").agg(F.count(F.lit(1)).alias("n_rows"))


UNITS = {"price_eur_per_l": "1.0", "eur_per_kg": "1.0 / 0.916", "eur_100kg": "0.916 / 100.0", "price": "0.916 / 100.0"}


@register("price_units", "WITH p AS (SELECT l_extendedprice / nullif(l_quantity, 0) AS v FROM lineitem)\n" + "\nUNION ALL\n".join(
    f"SELECT '{u}' AS header, count(v) AS n, {r(f'avg(v) * {k}', 'mean_eur_per_l')} FROM p" for u, k in UNITS.items()))
def q_price_units(spark, sf_dir):
    """The same numbers under every header that names a unit."""
    li = T.read_table(spark, sf_dir, "lineitem", ["l_extendedprice", "l_quantity"])
    v = F.try_divide("l_extendedprice", "l_quantity").cast("string")
    each = li.select(F.inline(F.array(*[
        F.struct(F.lit(u).alias("header"), price_to_eur_per_l(v, u).alias("x")) for u in UNITS])))
    return each.groupBy("header").agg(F.count("x").alias("n"), F.avg("x").alias("mean_eur_per_l"))


# ---- blanks, gates, tariffs ---------------------------------------------------------

BLANK_SQL = PANEL_CTES + """,
bl AS (
  SELECT week_start, day(date) AS d, price_eur_per_l, usd_per_eur, adval_pct, specific_usd_per_kg, pack,
         CASE WHEN day(date) % 2 = 0 THEN NULL ELSE price_usd_per_l END AS usd0,
         CASE WHEN day(date) % 2 = 0 THEN NULL ELSE base_usd_per_l END AS base0,
         CASE WHEN day(date) % 3 = 0 THEN NULL ELSE duty_usd_per_l END AS duty0,
         CASE WHEN day(date) % 5 = 0 THEN NULL ELSE pack_cost END AS pack0,
         CASE WHEN day(date) % 4 = 0 THEN NULL ELSE country END AS country0
  FROM panel),
im AS (
  SELECT *, coalesce(usd0, price_eur_per_l * usd_per_eur) AS usd1,
         coalesce(base0, coalesce(usd0, price_eur_per_l * usd_per_eur)) AS base1,
         coalesce(pack0, CASE pack WHEN 'glass' THEN 0.22 WHEN 'plastic' THEN 0.12 WHEN 'steel' THEN 0.30 ELSE 0.22 END) AS pack1
  FROM bl),
im2 AS (SELECT *, coalesce(duty0, CASE WHEN base1 IS NOT NULL
                                       THEN adval_pct / 100.0 * base1 + specific_usd_per_kg * 0.916 END) AS duty1 FROM im)"""


def blanked_panel(spark, sf_dir):
    day = F.dayofmonth("date")

    def blank(c: str, every: int):
        return F.when(day % every != 0, F.col(c))

    return weekly_panel(spark, sf_dir).withColumns({
        "price_usd_per_l": blank("price_usd_per_l", 2), "base_usd_per_l": blank("base_usd_per_l", 2),
        "duty_usd_per_l": blank("duty_usd_per_l", 3), "pack_cost": blank("pack_cost", 5)})


@register("impute_blanks", BLANK_SQL + f"""
SELECT week_start, count(*) AS n_rows, count(usd0) AS n_usd_before, count(usd1) AS n_usd, count(base1) AS n_base,
       count(duty1) AS n_duty, count(pack1) AS n_pack, {r('sum(usd1)', 'sum_usd')}, {r('sum(duty1)', 'sum_duty')},
       {r('sum(pack1)', 'sum_pack')}
FROM im2 GROUP BY ALL""")
def q_impute_blanks(spark, sf_dir):
    """F8: prices, bases, duties and pack costs blanked by day of month are imputed again."""
    p = blanked_panel(spark, sf_dir)
    full = impute(p.withColumn("usd0", F.col("price_usd_per_l")))
    return full.groupBy("week_start").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("usd0").alias("n_usd_before"), F.count("price_usd_per_l").alias("n_usd"),
        F.count("base_usd_per_l").alias("n_base"), F.count("duty_usd_per_l").alias("n_duty"),
        F.count("pack_cost").alias("n_pack"), F.sum("price_usd_per_l").alias("sum_usd"),
        F.sum("duty_usd_per_l").alias("sum_duty"), F.sum("pack_cost").alias("sum_pack"))


@register("usable_rows_blanks", BLANK_SQL + """
SELECT CAST(d % 4 AS INTEGER) AS day_mod, count(*) AS n_rows FROM bl WHERE country0 IS NOT NULL GROUP BY ALL""")
def q_usable_rows_blanks(spark, sf_dir):
    """rows whose country is blanked are not usable, all others are."""
    p = weekly_panel(spark, sf_dir).withColumn("country", F.when(F.dayofmonth("date") % 4 != 0, F.col("country")))
    used = usable_rows(p, SNAPSHOT)
    return used.groupBy((F.dayofmonth("date") % 4).cast("int").alias("day_mod")).agg(F.count(F.lit(1)).alias("n_rows"))


@register("segment_gate_fine", SEGMENT_SQL + """
SELECT country, market, grade, count(*) AS n_weeks, count(*) >= 26 AS eligible
FROM processed WHERE price_usd_per_l IS NOT NULL AND month = 1 AND price_usd_per_l > rolling10 GROUP BY ALL""")
def q_segment_gate_fine(spark, sf_dir):
    """The 26-row gate on fine series, some of which fall short."""
    p = processed(spark, sf_dir).where((F.col("month") == 1) & (F.col(PRICE) > F.col("rolling10")))
    return segment_gate(p, keys=["country", "market", "grade"])


@register("tariff_by_grade", with_(OBS, f"""
prices AS (SELECT upper(trim(grade)) AS grade_norm, hs_prefix, {CANON_GRADE_SQL} AS grade FROM obs
           WHERE date IS NOT NULL AND price_eur_per_l IS NOT NULL)""", """
tg AS (SELECT lpad(substr(regexp_replace(p_brand, '[^0-9]', '', 'g'), 1, 4), 4, '0') AS hs_prefix,
              CASE p_size % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'R' END AS g, CAST(p_size AS DOUBLE) AS adval, p_partkey FROM part)""", """
ex AS (SELECT hs_prefix, g, arg_max(adval, p_partkey) AS adval FROM tg WHERE g IS NOT NULL GROUP BY ALL)""", """
wh AS (SELECT hs_prefix, arg_max(adval, p_partkey) AS adval FROM tg GROUP BY ALL)""") + f"""
SELECT p.grade, p.hs_prefix, count(*) AS n_rows, {r('max(coalesce(ex.adval, wh.adval))', 'adval_pct')},
       {r('min(coalesce(ex.adval, wh.adval))', 'least_adval_pct')}
FROM prices p LEFT JOIN ex ON p.hs_prefix = ex.hs_prefix AND p.grade_norm = ex.g LEFT JOIN wh ON p.hs_prefix = wh.hs_prefix
GROUP BY ALL""")
def q_tariff_by_grade(spark, sf_dir):
    """Tariffs with and without a grade: a price row takes its own grade's rate, else the
    last of its code."""
    sheet = T.tariff_sheet(spark, sf_dir).join(
        T.read_table(spark, sf_dir, "part", ["p_partkey", "p_size"]), F.col("row_order") == F.col("p_partkey"))
    size = F.col("p_size") % 4
    sheet = sheet.withColumn("Grade", F.when(size == 0, "A").when(size == 1, "R")).drop("p_partkey", "p_size")
    tariffs = normalize_tariffs(sheet, keep_order=True)
    rows = standardize_prices(T.price_sheet(spark, sf_dir)).withColumn("grade_norm", F.upper(F.trim("grade")))
    return join_tariffs(rows, tariffs).groupBy("grade", "hs_prefix").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("adval_pct").alias("adval_pct"), F.min("adval_pct").alias("least_adval_pct"))


ALERTS = (5.0, 1000.0)
LATER = "1990-01-01"


@register("monitor_levels", SEGMENT_SQL + ERR_SQL + "," + FRESH_SQL + f""",
lv AS (SELECT unnest([{', '.join(map(str, ALERTS))}])::DOUBLE AS alert),
checks AS (SELECT alert, date_diff('day', CAST(last_update AS DATE), DATE '{LATER}') < 7 AS ok FROM fr2, lv
           UNION ALL SELECT alert, mape_recent <= alert FROM re, lv)
SELECT alert, count(*) AS n_checks, count(*) FILTER (WHERE NOT coalesce(ok, false)) AS n_alerts,
       CASE WHEN count(*) FILTER (WHERE NOT coalesce(ok, false)) > 0 THEN 'WARNING' ELSE 'OK' END AS status
FROM checks GROUP BY alert""")
def q_monitor_levels(spark, sf_dir):
    """Fresh sources, at an alert level that fires and one that does not."""
    fresh, errors = freshness(fresh_sources(spark, sf_dir), LATER), naive_errors(spark, sf_dir)
    parts = [monitor_summary(fresh, errors, a).withColumn("alert", F.lit(a)) for a in ALERTS]
    return parts[0].unionByName(parts[1])


@register("retrain_growth", SEGMENT_SQL + ERR_SQL + f"""
SELECT segment_type, country, grade, {r('mape_all', 'mape_all')}, {r('mape_recent', 'mape_recent')}, 'error_growth' AS reason
FROM re WHERE mape_recent > mape_all""")
def q_retrain_growth(spark, sf_dir):
    """By growth alone, some segments are refitted and others are not."""
    return retrain_candidates(naive_errors(spark, sf_dir), SEGMENT_KEYS, ratio=1.0, alert=1e9)
