"""Step 3 queries: macro weekly merge, filled grid, interpolation."""

from __future__ import annotations

from ..catalog import register
from ..plans.macros import macro_grid, weekly_long, wide_by_week
from ..plans.series import interpolated_weekly
from ..sources import tables as T
from .sqlparts import MACRO_OBS, MONDAY, OBS, SUNDAY, r, with_

SIX = ["usd_per_eur", "brent_usd_per_bbl", "diesel_usd_per_gal",
       "ppi_glass", "ppi_plastic_bottles", "ppi_steel"]
SIX_SQL = ", ".join(f"'{s}'" for s in SIX)
PIVOT_RAW_SQL = ",\n       ".join(f"max(CASE WHEN series = '{s}' THEN value END) AS {s}" for s in SIX)
PIVOT_SQL = ",\n       ".join(r(f"max(CASE WHEN series = '{s}' THEN value END)", s) for s in SIX)

WEEKLY_LONG = f"""
wl AS (
  SELECT series, {MONDAY.format(c='date')} AS week_start, avg(value) AS value
  FROM macro_obs WHERE series IS NOT NULL AND date IS NOT NULL AND value IS NOT NULL
  GROUP BY ALL)"""


@register("macro_outer_merge", with_(MACRO_OBS, WEEKLY_LONG) + f"""
SELECT week_start,
       {PIVOT_SQL}
FROM wl WHERE series IN ({SIX_SQL}) GROUP BY week_start""")
def q_macro_outer_merge(spark, sf_dir):
    """The six weekly macro series outer-aligned on week_start."""
    return wide_by_week(weekly_long(T.macro_observations(spark, sf_dir)))


@register("macro_grid_ffill", with_(MACRO_OBS, WEEKLY_LONG, f"""
w6 AS (SELECT * FROM wl WHERE series IN ({SIX_SQL}))""", """
span AS (SELECT min(week_start) AS lo, max(week_start) AS hi FROM w6)""", """
grid AS (
  SELECT s.series, CAST(unnest(generate_series(CAST(span.lo AS TIMESTAMP),
                                CAST(span.hi AS TIMESTAMP), INTERVAL 7 DAY)) AS DATE) AS week_start
  FROM (SELECT DISTINCT series FROM w6) s, span)""", """
filled AS (
  SELECT g.series, g.week_start,
         last_value(w.value IGNORE NULLS) OVER (PARTITION BY g.series ORDER BY g.week_start
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value
  FROM grid g LEFT JOIN w6 w ON g.series = w.series AND g.week_start = w.week_start)""") + f"""
SELECT week_start,
       {PIVOT_SQL},
       epoch_ms(CAST(week_start AS TIMESTAMP)) AS week_start_ms
FROM filled GROUP BY week_start""")
def q_macro_grid_ffill(spark, sf_dir):
    """J6 + F9: gap-free Monday grid of the macros, forward-filled."""
    return macro_grid(weekly_long(T.macro_observations(spark, sf_dir)))


@register("interpolate_weekly", with_(OBS, f"""
wk AS (
  SELECT market, grade, {SUNDAY.format(c='date')} AS week_start, avg(price_eur_per_l) AS price
  FROM obs WHERE market IS NOT NULL AND grade IS NOT NULL GROUP BY ALL)""", """
b AS (SELECT market, grade, min(week_start) AS lo, max(week_start) AS hi FROM wk GROUP BY ALL)""", """
g AS (
  SELECT market, grade, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP),
                                    INTERVAL 7 DAY)) AS DATE) AS week_start
  FROM b)""", """
j AS (
  SELECT g.market, g.grade, g.week_start, wk.price,
         row_number() OVER (PARTITION BY g.market, g.grade ORDER BY g.week_start) AS pos
  FROM g LEFT JOIN wk ON g.market = wk.market AND g.grade = wk.grade
                     AND g.week_start = wk.week_start)""", """
k AS (
  SELECT *, last_value(price IGNORE NULLS) OVER bw AS pv,
         last_value(CASE WHEN price IS NOT NULL THEN pos END IGNORE NULLS) OVER bw AS pp,
         first_value(price IGNORE NULLS) OVER aw AS nv,
         first_value(CASE WHEN price IS NOT NULL THEN pos END IGNORE NULLS) OVER aw AS np
  FROM j
  WINDOW bw AS (PARTITION BY market, grade ORDER BY week_start
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         aw AS (PARTITION BY market, grade ORDER BY week_start
                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))""") + f"""
SELECT market, grade, week_start, {r('price', 'price')},
       {r('''CASE WHEN price IS NOT NULL THEN price WHEN pv IS NULL THEN NULL
                  WHEN nv IS NULL THEN pv ELSE pv + (nv - pv) * (pos - pp) / (np - pp) END''',
          'price_interp')}
FROM k""")
def q_interpolate_weekly(spark, sf_dir):
    """A5 + F10: weekly (market, grade) price on a gap-free grid, interpolated."""
    return interpolated_weekly(T.price_observations(spark, sf_dir))
