"""Step 8 queries: recursive forecasts, monthly table, planning scenario."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import register
from ..operators.forecast import recursive_forecast
from ..operators.segments import SEGMENT_KEYS
from ..plans.forecast import forecast, monthly_forecast, planning_scenario, steps_for_months
from ..plans.models import train
from ..plans.series import segment_features
from .series_q import SEGMENT_SQL, processed
from .sqlparts import r


@register("forecast_segments")
def q_forecast_segments(spark, sf_dir):
    """P10 / M4 / M8: 12-week recursive forecast of every segment model."""
    p = processed(spark, sf_dir)
    return forecast(p, train(p), steps=12)


# Fixed coefficients for the SQL-checkable recursion (lag1, lag2, rolling3,
# rolling10; calendar and cost-pressure weights 0).
FIXED_COEF = [0.5, 0.3, 0.1, 0.1, 0.0, 0.0, 0.0, 0.0, 0.0]
FIXED_STEPS = 12


@register("forecast_fixed_coef", SEGMENT_SQL.replace("WITH ", "WITH RECURSIVE ", 1) + f""",
ranked AS (SELECT *, row_number() OVER (PARTITION BY segment_type, country, grade
                                        ORDER BY week_start DESC) AS rk FROM segp),
hist AS (SELECT segment_type, country, grade, list(price_usd_per_l ORDER BY week_start) AS h,
                max(week_start) AS last_week
         FROM ranked WHERE rk <= 10 GROUP BY ALL),
rec AS (
  SELECT segment_type, country, grade, last_week, 0 AS step, h, CAST(NULL AS DOUBLE) AS forecast
  FROM hist
  UNION ALL
  SELECT segment_type, country, grade, last_week, step + 1,
         list_append(h, f), f
  FROM (SELECT *, 0.0 + (0.0 + 0.5 * coalesce(h[-1], 0.0) + 0.3 * coalesce(h[-2], 0.0)
                          + 0.1 * coalesce(list_avg(h[-2:]), 0.0)
                          + 0.1 * coalesce(list_avg(h[-9:]), 0.0)) AS f
        FROM rec WHERE step < {FIXED_STEPS}) t)
SELECT segment_type, country, grade, step, CAST(last_week + 7 * step AS DATE) AS week_start,
       {r('forecast', 'forecast')}
FROM rec WHERE step > 0""")
def q_forecast_fixed_coef(spark, sf_dir):
    """M4 recursion with a fixed coefficient vector, so that the recursion
    itself can be checked against a recursive SQL CTE."""
    seg = segment_features(processed(spark, sf_dir))
    models = (seg.select(*SEGMENT_KEYS).distinct()
              .withColumn("intercept", F.lit(0.0))
              .withColumn("coef", F.array(*[F.lit(c) for c in FIXED_COEF]))
              .withColumn("loo_rmse", F.lit(0.0)))
    out = recursive_forecast(seg, models, SEGMENT_KEYS, FIXED_STEPS)
    return out.select(*SEGMENT_KEYS, "step", "week_start", "forecast")


@register("forecast_monthly")
def q_forecast_monthly(spark, sf_dir):
    """T4: three-month forecast table with 95 % intervals per segment."""
    p = processed(spark, sf_dir)
    weekly = forecast(p, train(p), steps=steps_for_months(3))
    return monthly_forecast(weekly, 3)


@register("planning_scenario")
def q_planning_scenario(spark, sf_dir):
    """Every country, grade 'R', 30 days ahead, in date order."""
    p = processed(spark, sf_dir)
    return planning_scenario(p, train(p), None, "R", 30)
