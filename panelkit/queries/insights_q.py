"""Step 9 queries: market comparison, insights, drivers, risk, monitoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import register
from ..plans.insights import (DRIVER_LABELS, country_risk, market_comparison, market_insights,
                              price_change, price_drivers)
from ..plans.monitoring import freshness, monitor_summary, recent_errors, retrain_candidates
from ..operators.segments import SEGMENT_KEYS
from ..sources import tables as T
from .features_q import FEAT_SQL, features
from .models_q import seg_rows
from .series_q import SEGMENT_SQL
from .sqlparts import r

AS_OF = "2024-02-10"


def country_series(spark, sf_dir):
    return seg_rows(spark, sf_dir).where(F.col("segment_type") == "country")


MC_SQL = SEGMENT_SQL + """,
cs AS (SELECT country, week_start, price_usd_per_l FROM segp WHERE segment_type = 'country'),
rk AS (SELECT *, row_number() OVER (PARTITION BY country ORDER BY week_start DESC) AS rk
       FROM cs WHERE price_usd_per_l IS NOT NULL),
mc AS (SELECT country, arg_max(price_usd_per_l, week_start) AS current_price,
              avg(price_usd_per_l) AS average_price_period, stddev_pop(price_usd_per_l) AS sd
       FROM rk WHERE rk <= 12 GROUP BY country),
mc2 AS (SELECT country, current_price, average_price_period,
               (current_price - average_price_period) / average_price_period * 100
                 AS price_change_percent,
               sd / average_price_period AS volatility FROM mc)"""


@register("market_comparison", MC_SQL + f"""
SELECT country, {r('current_price', 'current_price')},
       {r('average_price_period', 'average_price_period')},
       {r('price_change_percent', 'price_change_percent')},
       CASE WHEN price_change_percent > 2.0 THEN 'increasing'
            WHEN price_change_percent < -2.0 THEN 'decreasing' ELSE 'stable' END AS trend,
       {r('volatility', 'volatility')}
FROM mc2""")
def q_market_comparison(spark, sf_dir):
    """Current vs 12-week mean price per country, change % and trend."""
    return market_comparison(country_series(spark, sf_dir))


@register("market_insights", MC_SQL + f"""
SELECT arg_min(country, current_price) AS cheapest_market,
       arg_max(country, current_price) AS most_expensive_market,
       arg_max(country, volatility) AS most_volatile_market,
       {r('(max(current_price) - min(current_price)) / min(current_price) * 100',
          'price_spread_percent')},
       count(*) AS n_markets
FROM mc2""")
def q_market_insights(spark, sf_dir):
    """Cheapest / dearest / most volatile market and the price spread."""
    return market_insights(market_comparison(country_series(spark, sf_dir)))


@register("price_change", SEGMENT_SQL + f""",
cs AS (SELECT country, week_start, price_usd_per_l AS p FROM segp WHERE segment_type = 'country'),
rk AS (SELECT *, row_number() OVER (PARTITION BY country ORDER BY week_start DESC) AS rk FROM cs),
pc AS (SELECT country, avg(CASE WHEN rk <= 12 THEN p END) AS current_price,
              avg(CASE WHEN rk > 12 THEN p END) AS previous_price FROM rk WHERE rk <= 24 GROUP BY country),
pch AS (SELECT *, (current_price - previous_price) / previous_price * 100 AS change_percent FROM pc)
SELECT country, {r('current_price', 'current_price')}, {r('previous_price', 'previous_price')},
       {r('change_percent', 'change_percent')},
       CASE WHEN abs(change_percent) < 3.0 THEN 'stable' WHEN change_percent > 0 THEN 'increasing'
            ELSE 'decreasing' END AS direction
FROM pch""")
def q_price_change(spark, sf_dir):
    """Mean price of the last 12 weeks against the 12 before, per country."""
    return price_change(country_series(spark, sf_dir))


DRIVER_COUNTRY = "EUROPE"


@register("price_drivers_country", FEAT_SQL + """,
dw AS (SELECT week_start, """ + ", ".join(f"avg({c}) AS {c}" for c, _ in DRIVER_LABELS) + f"""
       FROM feat WHERE country = '{DRIVER_COUNTRY}' GROUP BY week_start),
drk AS (SELECT *, row_number() OVER (ORDER BY week_start DESC) AS rk FROM dw),
dlong AS (""" + "\n  UNION ALL ".join(
    f"SELECT rk, '{label}' AS factor, {c} AS value FROM drk" for c, label in DRIVER_LABELS) + f"""),
dagg AS (SELECT factor, avg(CASE WHEN rk <= 12 THEN value END) AS current_value,
                avg(CASE WHEN rk > 12 AND rk <= 24 THEN value END) AS previous_value
         FROM dlong GROUP BY factor)
SELECT factor, {r('current_value', 'current_value')}, {r('previous_value', 'previous_value')},
       {r('(current_value - previous_value) / previous_value * 100', 'change_percent')} FROM dagg""")
def q_price_drivers_country(spark, sf_dir):
    """T3 with its country argument: drivers over the weeks in which that country has prices."""
    return price_drivers(driver_weekly(spark, sf_dir, DRIVER_COUNTRY)).select(
        "factor", "current_value", "previous_value", "change_percent")


def driver_weekly(spark, sf_dir, country=None):
    rows = features(spark, sf_dir)
    rows = rows if country is None else rows.where(F.col("country") == country)
    return rows.groupBy("week_start").agg(*[F.avg(c).alias(c) for c, _ in DRIVER_LABELS])


DRIVER_SQL = FEAT_SQL + """,
dw AS (SELECT week_start, """ + ", ".join(f"avg({c}) AS {c}" for c, _ in DRIVER_LABELS) + """
       FROM feat GROUP BY week_start),
drk AS (SELECT *, row_number() OVER (ORDER BY week_start DESC) AS rk FROM dw),
dlong AS (""" + "\n  UNION ALL ".join(
    f"SELECT rk, '{label}' AS factor, {c} AS value FROM drk" for c, label in DRIVER_LABELS) + """),
dagg AS (SELECT factor, avg(CASE WHEN rk <= 12 THEN value END) AS current_value,
                avg(CASE WHEN rk > 12 AND rk <= 24 THEN value END) AS previous_value
         FROM dlong GROUP BY factor),
dch AS (SELECT *, (current_value - previous_value) / previous_value * 100 AS change_percent
        FROM dagg)"""


@register("price_drivers", DRIVER_SQL + f"""
SELECT factor, {r('current_value', 'current_value')}, {r('previous_value', 'previous_value')},
       {r('change_percent', 'change_percent')},
       CASE WHEN abs(change_percent) >= 10.0 THEN 'High'
            WHEN abs(change_percent) >= 3.0 THEN 'Medium' ELSE 'Low' END AS impact,
       CASE WHEN abs(change_percent) < 3.0 THEN 'stable'
            WHEN change_percent > 0 THEN 'increasing' ELSE 'decreasing' END AS direction,
       CAST(row_number() OVER (ORDER BY abs(change_percent) DESC NULLS LAST, factor) AS INTEGER)
         AS rank
FROM dch""")
def q_price_drivers(spark, sf_dir):
    """Driver change last 12 weeks vs the 12 before, impact, direction, rank."""
    return price_drivers(driver_weekly(spark, sf_dir))


@register("country_risk", SEGMENT_SQL + f""",
cs AS (SELECT country, price_usd_per_l FROM segp WHERE segment_type = 'country')
SELECT country, {r('stddev_pop(price_usd_per_l) / avg(price_usd_per_l)', 'risk')},
       count(price_usd_per_l) AS n_weeks,
       CASE WHEN stddev_pop(price_usd_per_l) / avg(price_usd_per_l) IS NULL THEN NULL
            WHEN stddev_pop(price_usd_per_l) / avg(price_usd_per_l) >= 0.1 THEN 'High'
            WHEN stddev_pop(price_usd_per_l) / avg(price_usd_per_l) >= 0.05 THEN 'Medium'
            ELSE 'Low' END AS risk_level
FROM cs GROUP BY country""")
def q_country_risk(spark, sf_dir):
    """T5: price volatility per country with a risk label."""
    return country_risk(country_series(spark, sf_dir))


def fresh_sources(spark, sf_dir):
    return [("events", T.read_table(spark, sf_dir, "events", ["ts"]), "ts"),
            ("orders", T.read_table(spark, sf_dir, "orders", ["o_orderdate"]), "o_orderdate"),
            ("lineitem", T.read_table(spark, sf_dir, "lineitem", ["l_shipdate"]), "l_shipdate")]


FRESH_SQL = """
fr AS (
  SELECT 'events' AS source, CAST(max(ts) AS TIMESTAMP) AS last_update, count(*) AS n_rows FROM events
  UNION ALL
  SELECT 'orders', CAST(max(o_orderdate) AS TIMESTAMP), count(*) FROM orders
  UNION ALL
  SELECT 'lineitem', CAST(max(l_shipdate) AS TIMESTAMP), count(*) FROM lineitem),
fr2 AS (SELECT *, CAST(date_diff('day', CAST(last_update AS DATE), DATE '2024-02-10') AS INTEGER)
                   AS age_days FROM fr)"""


@register("freshness", "WITH " + FRESH_SQL.strip() + """
SELECT source, last_update, n_rows, age_days, age_days < 7 AS is_fresh FROM fr2""")
def q_freshness(spark, sf_dir):
    """Newest timestamp, age at 2024-02-10 and row count per source."""
    return freshness(fresh_sources(spark, sf_dir), AS_OF)


ERR_SQL = """,
re0 AS (SELECT *, row_number() OVER (PARTITION BY segment_type, country, grade
                                     ORDER BY week_start DESC) AS rk,
               CASE WHEN price_usd_per_l <> 0
                    THEN abs((lag1week - price_usd_per_l) / price_usd_per_l) * 100 END AS ape
        FROM segp WHERE lag1week IS NOT NULL AND price_usd_per_l IS NOT NULL),
re AS (SELECT segment_type, country, grade, avg(ape) AS mape_all,
              avg(CASE WHEN rk <= 12 THEN ape END) AS mape_recent,
              avg(CASE WHEN rk <= 12 THEN abs(lag1week - price_usd_per_l) END) AS mae_recent
       FROM re0 GROUP BY ALL)"""


def naive_errors(spark, sf_dir):
    return recent_errors(seg_rows(spark, sf_dir), SEGMENT_KEYS, "lag1week", "price_usd_per_l")


@register("monitor_summary", SEGMENT_SQL + ERR_SQL + "," + FRESH_SQL + """,
checks AS (SELECT age_days < 7 AS ok FROM fr2 UNION ALL SELECT mape_recent <= 10.0 FROM re)
SELECT count(*) AS n_checks, count(*) FILTER (WHERE NOT coalesce(ok, false)) AS n_alerts,
       CASE WHEN count(*) FILTER (WHERE NOT coalesce(ok, false)) > 0 THEN 'WARNING' ELSE 'OK' END
         AS status
FROM checks""")
def q_monitor_summary(spark, sf_dir):
    """D3: freshness and recent-error checks -> alert count and status."""
    return monitor_summary(freshness(fresh_sources(spark, sf_dir), AS_OF),
                           naive_errors(spark, sf_dir))


@register("retrain_candidates", SEGMENT_SQL + ERR_SQL + f"""
SELECT segment_type, country, grade, {r('mape_all', 'mape_all')},
       {r('mape_recent', 'mape_recent')},
       CASE WHEN mape_recent > mape_all * 1.2 AND mape_recent > 10.0 THEN 'error_growth_and_level'
            WHEN mape_recent > mape_all * 1.2 THEN 'error_growth'
            WHEN mape_recent > 10.0 THEN 'error_level' END AS reason
FROM re WHERE mape_recent > mape_all * 1.2 OR mape_recent > 10.0""")
def q_retrain_candidates(spark, sf_dir):
    """Segments to refit, with the reason."""
    return retrain_candidates(naive_errors(spark, sf_dir), SEGMENT_KEYS)
