"""Queries that watch weekly series: outliers (D5), error drifts (D3, D4), rolling-origin back-tests (M6, M8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import register
from ..operators.segments import SEGMENT_KEYS
from ..operators.watch import MAD_SCALE, anomalies, first_alarms, interval_coverage, rolling_origins
from .checks_q import fixed_models
from .forecast_q import FIXED_COEF
from .models_q import seg_rows
from .series_q import SEGMENT_SQL
from .sqlparts import r

KEYS = "segment_type, country, grade"
PART = f"PARTITION BY {KEYS} ORDER BY week_start"

ANOMALY_SQL = SEGMENT_SQL + f""",
pl AS (SELECT {KEYS}, week_start, price_usd_per_l * CASE WHEN grade = 'A' AND weekofyear(week_start) = 20 THEN 3.0 ELSE 1.0 END AS v
       FROM segp),
a1 AS (SELECT *, list(v) OVER ({PART} ROWS BETWEEN 13 PRECEDING AND 1 PRECEDING) AS b FROM pl),
a2 AS (SELECT *, CASE WHEN len(b) >= 8 THEN list_median(b) END AS level FROM a1),
a3 AS (SELECT *, v - level AS o FROM a2),
a4 AS (SELECT *, lag(o, 51) OVER w AS o1, lag(o, 52) OVER w AS o2, lag(o, 53) OVER w AS o3 FROM a3 WINDOW w AS ({PART})),
a5 AS (SELECT *, coalesce(list_median(list_filter([o1, o2, o3], lambda q: q IS NOT NULL)), 0.0) AS seasonal,
              CASE WHEN level IS NOT NULL THEN greatest({MAD_SCALE} * list_median(list_transform(b, lambda q: abs(q - level))), 0.01 * abs(level)) END AS scale
       FROM a4),
a6 AS (SELECT *, (o - seasonal) / nullif(scale, 0) AS score FROM a5)"""


@register("price_anomalies", ANOMALY_SQL + f"""
SELECT {KEYS}, week_start, {r('v', 'price')}, {r('level', 'level')}, {r('seasonal', 'seasonal')},
       {r('scale', 'scale')}, {r('score', 'score')}, coalesce(abs(score) > 4.0, false) AS outlier FROM a6""")
def q_price_anomalies(spark, sf_dir):
    """Outliers of every segment's weekly price; grade A's price is tripled in week 20 of each year, the
    other series are as they are."""
    seg = seg_rows(spark, sf_dir)
    odd = (F.col("grade") == "A") & (F.weekofyear("week_start") == 20)
    price = F.col("price_usd_per_l") * F.when(F.coalesce(odd, F.lit(False)), 3.0).otherwise(1.0)
    found = anomalies(seg.select(*SEGMENT_KEYS, "week_start", price.alias("price")), SEGMENT_KEYS, "price")
    return found.select(*SEGMENT_KEYS, "week_start", "price", "level", "seasonal", "scale", "score", "outlier")


CUSUM_SQL = SEGMENT_SQL.replace("WITH ", "WITH RECURSIVE ", 1) + f""",
er AS (SELECT {KEYS}, week_start, abs(lag1week - price_usd_per_l) * CASE WHEN country = 'ASIA' AND week_start >= DATE '1996-01-01' THEN 1.8 ELSE 1.0 END AS e
       FROM segp WHERE lag1week IS NOT NULL),
en AS (SELECT *, row_number() OVER ({PART}) AS i, count(*) OVER (PARTITION BY {KEYS}) AS n_weeks FROM er),
es AS (SELECT {KEYS}, avg(e) AS m, stddev_pop(e) AS sd, max(n_weeks) AS n_weeks, count(*) AS refs FROM en WHERE i <= 52 GROUP BY ALL),
cu AS (
  SELECT {KEYS}, m, sd, 52::BIGINT AS i, 0.0::DOUBLE AS s, 0.0::DOUBLE AS top, CAST(NULL AS DATE) AS week, 0 AS after, n_weeks FROM es WHERE sd > 0
  UNION ALL
  SELECT cu.segment_type, cu.country, cu.grade, m, sd, cu.i + 1,
         CASE WHEN week IS NOT NULL THEN s ELSE greatest(0.0, s + (e - m) / sd - 0.5) END,
         CASE WHEN week IS NOT NULL THEN top ELSE greatest(top, s + (e - m) / sd - 0.5) END,
         CASE WHEN week IS NOT NULL THEN week WHEN s + (e - m) / sd - 0.5 > 5.0 THEN en.week_start END,
         CASE WHEN week IS NOT NULL THEN after + 1 ELSE 0 END, cu.n_weeks
  FROM cu JOIN en ON en.segment_type = cu.segment_type AND en.country IS NOT DISTINCT FROM cu.country
    AND en.grade IS NOT DISTINCT FROM cu.grade AND en.i = cu.i + 1),
la AS (SELECT {KEYS}, arg_max(struct_pack(week := week, top := top, after := after), i) AS z FROM cu GROUP BY ALL)"""


@register("error_alarms", CUSUM_SQL + f"""
SELECT es.segment_type, es.country, es.grade, CAST(es.n_weeks AS INTEGER) AS n_weeks, z.week AS alarm_week,
       {r('coalesce(z.top, 0.0)', 'highest')}, CAST(coalesce(z.after, 0) AS INTEGER) AS weeks_after
FROM es LEFT JOIN la ON es.segment_type = la.segment_type AND es.country IS NOT DISTINCT FROM la.country
  AND es.grade IS NOT DISTINCT FROM la.grade""")
def q_error_alarms(spark, sf_dir):
    """First week in which the cumulative excess of the naive error raises an alarm; Asia's errors
    grow by four fifths from 1996 on."""
    seg = seg_rows(spark, sf_dir).where(F.col("lag1week").isNotNull())
    grown = (F.col("country") == "ASIA") & (F.col("week_start") >= F.lit("1996-01-01").cast("date"))
    error = F.abs(F.col("lag1week") - F.col("price_usd_per_l")) * F.when(F.coalesce(grown, F.lit(False)), 1.8).otherwise(1.0)
    return first_alarms(seg.select(*SEGMENT_KEYS, "week_start", error.alias("e")), SEGMENT_KEYS, "e")


ORIGIN_SQL = SEGMENT_SQL.replace("WITH ", "WITH RECURSIVE ", 1) + f""",
og AS (SELECT {KEYS}, week_start AS origin, list(price_usd_per_l) OVER ({PART} ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS h FROM segp),
ro AS (
  SELECT {KEYS}, origin, 0 AS step, h, CAST(NULL AS DOUBLE) AS forecast FROM og WHERE len(h) = 10
  UNION ALL
  SELECT {KEYS}, origin, step + 1, list_append(h, f), f
  FROM (SELECT *, 0.5 * h[-1] + 0.3 * h[-2] + 0.1 * list_avg(h[-2:]) + 0.1 * list_avg(h[-9:]) AS f FROM ro WHERE step < 4) t),
rs AS (SELECT ro.segment_type, ro.country, ro.grade, step, s.week_start, s.price_usd_per_l - forecast AS residual
       FROM ro JOIN segp s ON s.segment_type = ro.segment_type AND s.country IS NOT DISTINCT FROM ro.country
         AND s.grade IS NOT DISTINCT FROM ro.grade AND s.week_start = ro.origin + 7 * step WHERE step > 0),
rh AS (SELECT *, week_start > max(week_start) OVER (PARTITION BY {KEYS}) - 364 AS held FROM rs),
ft AS (SELECT {KEYS}, step, count(*) AS n_fit, quantile_cont(residual, 0.05) AS lower, quantile_cont(residual, 0.95) AS upper
       FROM rh WHERE NOT held GROUP BY ALL),
ht AS (SELECT rh.segment_type, rh.country, rh.grade, rh.step, count(*) AS n_held,
              avg(CASE WHEN residual BETWEEN lower AND upper THEN 1.0 ELSE 0.0 END) AS coverage
       FROM rh JOIN ft ON ft.segment_type = rh.segment_type AND ft.country IS NOT DISTINCT FROM rh.country
         AND ft.grade IS NOT DISTINCT FROM rh.grade AND ft.step = rh.step WHERE held GROUP BY ALL)"""


@register("rolling_origin_intervals", ORIGIN_SQL + f"""
SELECT ft.segment_type, ft.country, ft.grade, ft.step, n_fit, {r('lower', 'lower')}, {r('upper', 'upper')},
       coalesce(n_held, 0) AS n_held, {r('coverage', 'coverage')}
FROM ft LEFT JOIN ht ON ft.segment_type = ht.segment_type AND ft.country IS NOT DISTINCT FROM ht.country
  AND ft.grade IS NOT DISTINCT FROM ht.grade AND ft.step = ht.step""")
def q_rolling_origin_intervals(spark, sf_dir):
    """M6 / M8: forecasts 1 to 4 weeks ahead from every week of every segment by a fixed model, empirical 90 % intervals
    per step, and their coverage in the last 52 weeks."""
    seg = seg_rows(spark, sf_dir)
    residuals = rolling_origins(seg, fixed_models(seg, FIXED_COEF, 0.0), SEGMENT_KEYS, 4)
    return interval_coverage(residuals, SEGMENT_KEYS, 0.9, 52)
