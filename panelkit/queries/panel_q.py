"""Step 4 queries: the landed-cost panel and its components."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import register
from ..plans.macros import weekly_long, wide_by_week
from ..plans.panel import PANEL_COLS, build_weekly_panel, ocean_proxy_table
from ..plans.standardize import normalize_tariffs, standardize_freight, standardize_prices
from ..session import cut_lineage, stored
from ..sources import tables as T
from .macros_q import PIVOT_RAW_SQL, SIX_SQL, WEEKLY_LONG
from .sqlparts import MACRO_OBS, OBS, r, with_
from .standardize_q import CANON_GRADE_SQL

SNAPSHOT = "2024-02-10"


def panel_inputs(spark, sf_dir):
    prices = standardize_prices(T.price_sheet(spark, sf_dir))
    macros = wide_by_week(weekly_long(T.macro_observations(spark, sf_dir)))
    freight = standardize_freight(T.freight_sheet(spark, sf_dir))
    tariffs = normalize_tariffs(T.tariff_sheet(spark, sf_dir), keep_order=True)
    return prices, macros, freight, tariffs


def weekly_panel(spark, sf_dir):
    """The panel over all price rows.  The standardised prices are stored first, as the standardising job
    does: the facts are parsed and joined once, and the weekly states read two columns of the store."""
    prices, macros, freight, tariffs = panel_inputs(spark, sf_dir)
    return build_weekly_panel(stored(prices, "prices"), cut_lineage(macros), freight, tariffs, snapshot=SNAPSHOT)


MACROS_CTE = f"""
macros AS (SELECT week_start, {PIVOT_RAW_SQL}
           FROM wl WHERE series IN ({SIX_SQL}) GROUP BY week_start)"""

FBX_CTE = """
fbx AS (SELECT week_start, avg(value) AS fbx FROM wl WHERE series = 'fbx' GROUP BY week_start)"""

OCEAN_CTES = ["""
temp AS (SELECT coalesce(m.week_start, f.week_start) AS week_start,
                m.brent_usd_per_bbl AS brent, f.fbx
         FROM macros m FULL OUTER JOIN fbx f ON m.week_start = f.week_start)""", """
temp2 AS (SELECT week_start, (fbx * 100.0) / (SELECT avg(fbx) FROM temp) AS a,
                 (brent * 100.0) / (SELECT avg(brent) FROM temp) AS b FROM temp)""", """
oc AS (SELECT week_start,
              CASE WHEN (CAST(a IS NOT NULL AS INT) + CAST(b IS NOT NULL AS INT)) > 0
                   THEN (coalesce(a, 0.0) + coalesce(b, 0.0))
                        / (CAST(a IS NOT NULL AS INT) + CAST(b IS NOT NULL AS INT)) END AS ocean_proxy
       FROM temp2)"""]

PANEL_CTES = with_(OBS, MACRO_OBS, WEEKLY_LONG, MACROS_CTE, FBX_CTE, *OCEAN_CTES, f"""
prices AS (
  SELECT date, country, market, {CANON_GRADE_SQL} AS grade,
         price_eur_per_l / 100.0 * 0.916 AS price_eur_per_l, pack, hs_prefix
  FROM obs WHERE date IS NOT NULL AND price_eur_per_l IS NOT NULL)""", """
tar AS (
  SELECT hs_prefix, arg_max(adval_pct, p_partkey) AS adval_pct,
         arg_max(specific_usd_per_kg, p_partkey) AS specific_usd_per_kg
  FROM (SELECT lpad(substr(regexp_replace(p_brand, '[^0-9]', '', 'g'), 1, 4), 4, '0') AS hs_prefix,
               CAST(p_size AS DOUBLE) AS adval_pct, p_retailprice / 1000.0 AS specific_usd_per_kg,
               p_partkey FROM part)
  GROUP BY hs_prefix)""", """
p2 AS (
  SELECT pr.*, CAST(date_trunc('week', pr.date) AS DATE) AS week_start, pr.country AS iso2,
         coalesce(CASE pr.pack WHEN 'glass' THEN 0.22 WHEN 'plastic' THEN 0.12
                               WHEN 'steel' THEN 0.30 END, 0.22) AS pack_cost,
         m.usd_per_eur, m.brent_usd_per_bbl, m.diesel_usd_per_gal, m.ppi_glass,
         m.ppi_plastic_bottles, m.ppi_steel,
         pr.price_eur_per_l * m.usd_per_eur AS price_usd_per_l,
         oc.ocean_proxy, upper(trim(pr.grade)) AS grade_norm,
         coalesce(t.adval_pct, 0.0) AS adval_pct,
         coalesce(t.specific_usd_per_kg, 0.0) AS specific_usd_per_kg
  FROM prices pr
  LEFT JOIN macros m ON CAST(date_trunc('week', pr.date) AS DATE) = m.week_start
  LEFT JOIN oc ON CAST(date_trunc('week', pr.date) AS DATE) = oc.week_start
  LEFT JOIN tar t ON pr.hs_prefix = t.hs_prefix)""", """
p3 AS (
  SELECT *, adval_pct AS duty_rate,
         coalesce(specific_usd_per_kg * 0.916, 0.0) AS duty_specific_usd_per_l,
         price_usd_per_l AS base_usd_per_l, ocean_proxy AS ocean_idx,
         0.003 * ocean_proxy AS ocean_uplift
  FROM p2)""", """
p4 AS (
  SELECT *, adval_pct / 100.0 * price_usd_per_l + duty_specific_usd_per_l AS duty_cost,
         CASE WHEN price_usd_per_l IS NOT NULL
              THEN adval_pct / 100.0 * price_usd_per_l + specific_usd_per_kg * 0.916 END
           AS duty_usd_per_l,
         0.15 * (diesel_usd_per_gal - (SELECT avg(diesel_usd_per_gal) FROM p3)) AS diesel_uplift
  FROM p3)""", """
panel AS (
  SELECT *, coalesce(base_usd_per_l, 0.0) + coalesce(pack_cost, 0.0) + coalesce(ocean_uplift, 0.0)
            + coalesce(diesel_uplift, 0.0) + coalesce(duty_cost, 0.0) AS deliv_hat_usd_per_l,
         CASE WHEN (SELECT stddev_samp(base_usd_per_l) FROM p4) = 0 THEN 0.0
              ELSE (base_usd_per_l - (SELECT avg(base_usd_per_l) FROM p4))
                   / (SELECT stddev_samp(base_usd_per_l) FROM p4) END AS z_base,
         '2024-02-10' AS snapshot_date
  FROM p4)""")

DOUBLE_PANEL = {"price_eur_per_l", "price_usd_per_l", "base_usd_per_l", "usd_per_eur", "adval_pct",
                "duty_rate", "specific_usd_per_kg", "duty_specific_usd_per_l", "duty_cost",
                "duty_usd_per_l", "brent_usd_per_bbl", "ocean_proxy", "ocean_idx", "ocean_uplift",
                "diesel_usd_per_gal", "diesel_uplift", "pack_cost", "ppi_glass",
                "ppi_plastic_bottles", "ppi_steel", "deliv_hat_usd_per_l", "z_base"}
PANEL_SELECT = ", ".join(r(c, c) if c in DOUBLE_PANEL else c for c in PANEL_COLS + ["date"])


@register("weekly_panel", PANEL_CTES + f"\nSELECT {PANEL_SELECT} FROM panel")
def q_weekly_panel(spark, sf_dir):
    """P5: the full landed-cost panel from the four standardised inputs."""
    return weekly_panel(spark, sf_dir)


@register("landed_cost", PANEL_CTES + f"""
SELECT country, market, grade, week_start, count(*) AS n_rows,
       {r('avg(base_usd_per_l)', 'base_usd_per_l')},
       {r('avg(deliv_hat_usd_per_l)', 'deliv_hat_usd_per_l')}
FROM panel GROUP BY ALL""")
def q_landed_cost(spark, sf_dir):
    """Mean landed price per (country, market, grade, week)."""
    return (weekly_panel(spark, sf_dir)
            .groupBy("country", "market", "grade", "week_start")
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.avg("base_usd_per_l").alias("base_usd_per_l"),
                 F.avg("deliv_hat_usd_per_l").alias("deliv_hat_usd_per_l")))


@register("duty_cost", PANEL_CTES + f"""
SELECT hs_prefix, count(*) AS n_rows, {r('max(adval_pct)', 'adval_pct')},
       {r('max(duty_specific_usd_per_l)', 'duty_specific_usd_per_l')},
       {r('sum(duty_cost)', 'sum_duty_cost')}, {r('sum(duty_usd_per_l)', 'sum_duty_usd_per_l')},
       count(duty_usd_per_l) AS n_duty
FROM panel GROUP BY ALL""")
def q_duty_cost(spark, sf_dir):
    """Duty per HS-4 code - rate, specific duty, totals."""
    return (weekly_panel(spark, sf_dir).groupBy("hs_prefix")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.max("adval_pct").alias("adval_pct"),
                 F.max("duty_specific_usd_per_l").alias("duty_specific_usd_per_l"),
                 F.sum("duty_cost").alias("sum_duty_cost"),
                 F.sum("duty_usd_per_l").alias("sum_duty_usd_per_l"),
                 F.count("duty_usd_per_l").alias("n_duty")))


@register("ocean_proxy", with_(MACRO_OBS, WEEKLY_LONG, MACROS_CTE, FBX_CTE, *OCEAN_CTES)
          + f"\nSELECT week_start, {r('ocean_proxy', 'ocean_proxy')} FROM oc")
def q_ocean_proxy(spark, sf_dir):
    """Weekly ocean freight proxy from the FBX and Brent indices."""
    _, macros, freight, _ = panel_inputs(spark, sf_dir)
    return ocean_proxy_table(macros, freight)


@register("diesel_uplift", PANEL_CTES + f"""
SELECT week_start, count(*) AS n_rows, {r('max(diesel_usd_per_gal)', 'diesel_usd_per_gal')},
       {r('max(diesel_uplift)', 'diesel_uplift')}
FROM panel GROUP BY ALL""")
def q_diesel_uplift(spark, sf_dir):
    """Diesel uplift against the panel-row mean, per week."""
    return (weekly_panel(spark, sf_dir).groupBy("week_start")
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.max("diesel_usd_per_gal").alias("diesel_usd_per_gal"),
                 F.max("diesel_uplift").alias("diesel_uplift")))


@register("zscore_base", PANEL_CTES + f"""
SELECT country, grade, count(z_base) AS n_z, {r('avg(z_base)', 'mean_z')},
       {r('min(z_base)', 'min_z')}, {r('max(z_base)', 'max_z')}
FROM panel GROUP BY ALL""")
def q_zscore_base(spark, sf_dir):
    """E22 (sample std): z_base summarised per (country, grade)."""
    return (weekly_panel(spark, sf_dir).groupBy("country", "grade")
            .agg(F.count("z_base").alias("n_z"), F.avg("z_base").alias("mean_z"),
                 F.min("z_base").alias("min_z"), F.max("z_base").alias("max_z")))


@register("pack_cost_lookup", PANEL_CTES + f"""
SELECT pack, {r('max(pack_cost)', 'pack_cost')}, count(*) AS n_rows FROM panel GROUP BY ALL""")
def q_pack_cost_lookup(spark, sf_dir):
    """Pack material -> packaging cost with the default for unknowns."""
    return (weekly_panel(spark, sf_dir).groupBy("pack")
            .agg(F.max("pack_cost").alias("pack_cost"), F.count(F.lit(1)).alias("n_rows")))
