"""Step 6 queries: cost pressure, processed series, segments."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import register
from ..session import cut_lineage
from ..operators.aggregates import COST_DRIVERS, COST_DRIVERS_FIXED, cost_pressure
from ..operators.segments import segment_gate
from ..operators.windows import rolling_mean, series_window
from ..plans.exploration import weekly_overall, weekly_price_flags
from ..plans.series import (SERIES_KEYS, preprocess_weekly, segment_features, weekly_drivers,
                            weekly_prices)
from .features_q import FEAT_SQL, features
from .panel_q import panel_inputs
from .sqlparts import (SUNDAY, cost_pressure_fixed_sql, cost_pressure_sql, interp_parts_sql,
                       interp_sql, r)

CP_SQL = FEAT_SQL + "," + cost_pressure_sql("feat", COST_DRIVERS)


@register("cost_pressure", CP_SQL + f"""
SELECT week_start, count(*) AS n_rows, count(cost_pressure) AS n_cp,
       {r('max(cost_pressure)', 'cost_pressure')}
FROM cp GROUP BY ALL""")
def q_cost_pressure(spark, sf_dir):
    """Renormalised weighted driver z-score on the feature rows, per week."""
    cp = cost_pressure(features(spark, sf_dir))
    return (cp.groupBy("week_start")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.count("cost_pressure").alias("n_cp"),
                 F.max("cost_pressure").alias("cost_pressure")))


OVERALL_SQL = FEAT_SQL + """,
pos_rows AS (SELECT * FROM feat WHERE base_usd_per_l IS NOT NULL AND base_usd_per_l > 0),""" + \
    cost_pressure_fixed_sql("pos_rows", COST_DRIVERS_FIXED) + f""",
wk AS (SELECT {SUNDAY.format(c='week_start')} AS week_start, avg(base_usd_per_l) AS base_usd_per_l,
              avg(cost_pressure) AS cost_pressure FROM cpf GROUP BY 1),
grid AS (SELECT CAST(unnest(generate_series(CAST(min(week_start) AS TIMESTAMP),
                CAST(max(week_start) AS TIMESTAMP), INTERVAL 7 DAY)) AS DATE) AS week_start FROM wk),
j AS (SELECT g.week_start, wk.base_usd_per_l, wk.cost_pressure,
             row_number() OVER (ORDER BY g.week_start) AS pos
      FROM grid g LEFT JOIN wk ON g.week_start = wk.week_start),
k AS (SELECT *, {interp_parts_sql('base_usd_per_l', '', 'week_start')},
             {interp_parts_sql('cost_pressure', '', 'week_start')} FROM j),
overall AS (SELECT week_start, {interp_sql('base_usd_per_l')} AS base_usd_per_l,
                   {interp_sql('cost_pressure')} AS cost_pressure FROM k)"""


@register("cost_pressure_fixed", OVERALL_SQL + f"""
SELECT week_start, {r('base_usd_per_l', 'base_usd_per_l')}, {r('cost_pressure', 'cost_pressure')}
FROM overall""")
def q_cost_pressure_fixed(spark, sf_dir):
    """E23 fixed weights + A5: the notebook's interpolated weekly series."""
    return weekly_overall(features(spark, sf_dir), store=cut_lineage)


@register("price_change_flag", OVERALL_SQL + f""",
d AS (SELECT *, base_usd_per_l - lag(base_usd_per_l) OVER (ORDER BY week_start) AS price_diff
      FROM overall)
SELECT week_start, {r('base_usd_per_l', 'base_usd_per_l')}, {r('cost_pressure', 'cost_pressure')},
       {r('price_diff', 'price_diff')},
       coalesce(CAST(price_diff > 0.05 AS INT), 0) AS price_up_flag
FROM d""")
def q_price_change_flag(spark, sf_dir):
    """Weekly first difference and the > 0.05 rise flag."""
    return weekly_price_flags(features(spark, sf_dir), store=cut_lineage)


PROCESSED_SQL = CP_SQL + f""",
wk3 AS (
  SELECT country, market, grade, {SUNDAY.format(c='week_start')} AS week_start,
         avg(price_usd_per_l) AS price_usd_per_l, avg(cost_pressure) AS cost_pressure
  FROM cp WHERE country IS NOT NULL AND market IS NOT NULL AND grade IS NOT NULL GROUP BY ALL),
processed AS (
  SELECT week_start, price_usd_per_l, cost_pressure,
         lag(price_usd_per_l, 1) OVER w AS lag1week, lag(price_usd_per_l, 2) OVER w AS lag2week,
         avg(price_usd_per_l) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS rolling3,
         avg(price_usd_per_l) OVER (w ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS rolling10,
         CAST(month(week_start) AS INT) AS month, CAST(isodow(week_start) - 1 AS INT) AS dayofweek,
         CAST(quarter(week_start) AS INT) AS quarter,
         sin(2 * pi() * weekofyear(week_start) / 52.0) AS sin_week,
         country, market, grade,
         count(price_usd_per_l) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS c3,
         count(price_usd_per_l) OVER (w ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS c10
  FROM wk3 WINDOW w AS (PARTITION BY country, market, grade ORDER BY week_start))"""

PROC_DOUBLES = ["price_usd_per_l", "cost_pressure", "lag1week", "lag2week", "rolling3",
                "rolling10", "sin_week"]


def processed(spark, sf_dir):
    """The weekly ``processed`` table.  Price rows are scanned once and reduced to weekly rows;
    that reduction, the weekly drivers and the result (each read several times, none larger
    than series x weeks) are materialised in the shared checkpoint folder."""
    prices, macros, freight, _ = panel_inputs(spark, sf_dir)
    weekly = cut_lineage(weekly_prices(prices))
    drivers = cut_lineage(weekly_drivers(cut_lineage(macros), freight))
    return cut_lineage(preprocess_weekly(weekly, drivers))


@register("lag_rolling", PROCESSED_SQL + "\nSELECT " + ", ".join(
    [r(c, c) for c in PROC_DOUBLES] + ["week_start", "month", "dayofweek", "quarter", "country",
                                       "market", "grade"]) + " FROM processed")
def q_lag_rolling(spark, sf_dir):
    """The processed weekly series with lag, loose
    rolling and calendar features per (country, market, grade)."""
    return processed(spark, sf_dir)


@register("rolling_strict", PROCESSED_SQL + f"""
SELECT country, market, grade, week_start,
       {r('CASE WHEN c3 = 3 THEN rolling3 END', 'rolling3_strict')},
       {r('CASE WHEN c10 = 10 THEN rolling10 END', 'rolling10_strict')}
FROM processed""")
def q_rolling_strict(spark, sf_dir):
    """Rolling means that need a full window of non-NULL values."""
    p = processed(spark, sf_dir)
    w = series_window(SERIES_KEYS, "week_start")
    return p.select(*SERIES_KEYS, "week_start",
                    rolling_mean("price_usd_per_l", 3, w, strict=True).alias("rolling3_strict"),
                    rolling_mean("price_usd_per_l", 10, w, strict=True).alias("rolling10_strict"))


SEGMENT_SQL = PROCESSED_SQL + """,
seg AS (
  SELECT 'global' AS segment_type, CAST(NULL AS VARCHAR) AS country, CAST(NULL AS VARCHAR) AS grade,
         week_start, avg(price_usd_per_l) AS price_usd_per_l, avg(cost_pressure) AS cost_pressure
  FROM processed GROUP BY week_start
  UNION ALL
  SELECT 'country', country, NULL, week_start, avg(price_usd_per_l), avg(cost_pressure)
  FROM processed WHERE country IS NOT NULL GROUP BY country, week_start
  UNION ALL
  SELECT 'grade', NULL, grade, week_start, avg(price_usd_per_l), avg(cost_pressure)
  FROM processed WHERE grade IS NOT NULL GROUP BY grade, week_start
  UNION ALL
  SELECT 'country_grade', country, grade, week_start, avg(price_usd_per_l), avg(cost_pressure)
  FROM processed WHERE country IS NOT NULL AND grade IS NOT NULL
  GROUP BY country, grade, week_start),
segf AS (
  SELECT *, lag(price_usd_per_l, 1) OVER w AS lag1week, lag(price_usd_per_l, 2) OVER w AS lag2week,
         avg(price_usd_per_l) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS rolling3,
         avg(price_usd_per_l) OVER (w ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS rolling10,
         CAST(month(week_start) AS INT) AS month, CAST(isodow(week_start) - 1 AS INT) AS dayofweek,
         CAST(quarter(week_start) AS INT) AS quarter,
         sin(2 * pi() * weekofyear(week_start) / 52.0) AS sin_week
  FROM seg WINDOW w AS (PARTITION BY segment_type, country, grade ORDER BY week_start)),
segp AS (SELECT * FROM segf WHERE price_usd_per_l IS NOT NULL)"""

SEG_DOUBLES = PROC_DOUBLES


@register("segment_series", SEGMENT_SQL + "\nSELECT " + ", ".join(
    ["segment_type", "country", "grade", "week_start", "month", "dayofweek", "quarter"]
    + [r(c, c) for c in SEG_DOUBLES]) + " FROM segp")
def q_segment_series(spark, sf_dir):
    """A6 + W6: global / country / grade / country x grade weekly series
    from one grouping-sets aggregate, with model features."""
    return segment_features(processed(spark, sf_dir)).select(
        "segment_type", "country", "grade", "week_start", "month", "dayofweek", "quarter",
        *SEG_DOUBLES)


@register("segment_gate", SEGMENT_SQL + """
SELECT segment_type, country, grade, count(*) AS n_weeks, count(*) >= 26 AS eligible
FROM segp GROUP BY ALL""")
def q_segment_gate(spark, sf_dir):
    """Weeks with a price per segment and the 26-row model gate."""
    return segment_gate(segment_features(processed(spark, sf_dir)))
