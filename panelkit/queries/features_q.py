"""Step 5 queries: features job and quality report."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import register
from ..operators.aggregates import coverage, describe, null_counts, numeric_ranges
from ..plans.features import (KEY_FIELDS, MODEL_COLS, PROFILE_FIELDS, RANGE_FIELDS,
                              build_features, model_features)
from ..plans.panel import PANEL_COLS
from ..plans.quality import distinct_counts, range_violations, RANGE_RULES
from .panel_q import PANEL_CTES, SNAPSHOT, weekly_panel
from .sqlparts import r, rr

FEAT_SQL = PANEL_CTES + """,
feat AS (
  SELECT * REPLACE (CAST(week_start AS TIMESTAMP) AS week_start,
                    coalesce(base_usd_per_l, price_usd_per_l) AS base_usd_per_l)
  FROM panel
  WHERE week_start IS NOT NULL AND country IS NOT NULL AND market IS NOT NULL
    AND grade_norm IS NOT NULL AND price_eur_per_l IS NOT NULL)"""


def features(spark, sf_dir):
    return build_features(weekly_panel(spark, sf_dir), SNAPSHOT)


@register("features_usable", FEAT_SQL + f"""
SELECT country, market, grade_norm, count(*) AS n_rows, count(price_usd_per_l) AS n_price_usd,
       {r('sum(price_usd_per_l)', 'sum_price_usd')}, count(duty_usd_per_l) AS n_duty
FROM feat GROUP BY ALL""")
def q_features_usable(spark, sf_dir):
    """usable feature rows (core columns present) per series."""
    return (features(spark, sf_dir).groupBy("country", "market", "grade_norm")
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count("price_usd_per_l").alias("n_price_usd"),
                 F.sum("price_usd_per_l").alias("sum_price_usd"),
                 F.count("duty_usd_per_l").alias("n_duty")))


@register("impute_usd_and_duty", FEAT_SQL + f"""
SELECT week_start, count(*) AS n_rows, count(price_usd_per_l) AS n_price_usd,
       count(base_usd_per_l) AS n_base, count(duty_usd_per_l) AS n_duty,
       {r('sum(duty_usd_per_l)', 'sum_duty_usd')}, {r('sum(pack_cost)', 'sum_pack_cost')}
FROM feat GROUP BY ALL""")
def q_impute_usd_and_duty(spark, sf_dir):
    """F8: imputed USD price, base and duty coverage per week."""
    return (features(spark, sf_dir).groupBy("week_start")
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count("price_usd_per_l").alias("n_price_usd"),
                 F.count("base_usd_per_l").alias("n_base"),
                 F.count("duty_usd_per_l").alias("n_duty"),
                 F.sum("duty_usd_per_l").alias("sum_duty_usd"),
                 F.sum("pack_cost").alias("sum_pack_cost")))


MODEL_DOUBLES = {"price_eur_per_l", "price_usd_per_l", "adval_pct", "specific_usd_per_kg",
                 "duty_usd_per_l", "usd_per_eur", "brent_usd_per_bbl", "diesel_usd_per_gal",
                 "ppi_glass", "ppi_plastic_bottles", "ppi_steel", "ocean_proxy"}


@register("model_features", FEAT_SQL + "\nSELECT " + ", ".join(
    r(c, c) if c in MODEL_DOUBLES else c for c in MODEL_COLS) + " FROM feat")
def q_model_features(spark, sf_dir):
    """H7: the model-ready 19-column projection of the features."""
    return model_features(features(spark, sf_dir))


def _union(parts):
    return "\nUNION ALL\n".join(parts)


@register("coverage_report", FEAT_SQL + "\n" + _union(
    [f"SELECT '{c}' AS column_name, {rr(f'100.0 * avg(CAST({c} IS NOT NULL AS DOUBLE))')} "
     f"AS non_null_pct FROM feat" for c in KEY_FIELDS]))
def q_coverage_report(spark, sf_dir):
    """Percent non-NULL of the key model fields."""
    return coverage(features(spark, sf_dir), KEY_FIELDS)


@register("numeric_ranges", FEAT_SQL + "\n" + _union(
    [f"SELECT '{c}' AS column_name, {r(f'min({c})', 'min_value')}, {r(f'max({c})', 'max_value')} "
     f"FROM feat" for c in RANGE_FIELDS]))
def q_numeric_ranges(spark, sf_dir):
    """A10: min / max of the major numeric fields."""
    return numeric_ranges(features(spark, sf_dir), RANGE_FIELDS)


@register("distribution_profile", FEAT_SQL + "\n" + _union(
    [f"SELECT '{c}' AS column_name, count({c}) AS count, {r(f'avg({c})', 'mean')}, "
     f"{r(f'stddev_samp({c})', 'std')}, {r(f'min({c})', 'min')}, "
     f"{r(f'quantile_cont({c}, 0.25)', 'p25')}, {r(f'quantile_cont({c}, 0.5)', 'p50')}, "
     f"{r(f'quantile_cont({c}, 0.75)', 'p75')}, {r(f'max({c})', 'max')} FROM feat"
     for c in PROFILE_FIELDS]))
def q_distribution_profile(spark, sf_dir):
    """describe() of price, landed price and z_base (exact quartiles,
    computed without gathering a column into one task)."""
    return describe(features(spark, sf_dir).select(*PROFILE_FIELDS), PROFILE_FIELDS, exact=True)


@register("null_counts", PANEL_CTES + "\n" + _union(
    [f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
     f"count(*) AS row_count FROM panel" for c in PANEL_COLS]))
def q_null_counts(spark, sf_dir):
    """NULL count of every panel column."""
    return null_counts(weekly_panel(spark, sf_dir), PANEL_COLS)


DISTINCT_COLS = ["country", "market", "grade_norm", "week_start"]


@register("distinct_counts", FEAT_SQL + "\n" + _union(
    [f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct FROM feat"
     for c in DISTINCT_COLS]))
def q_distinct_counts(spark, sf_dir):
    """Distinct entities and weeks in the features."""
    return distinct_counts(features(spark, sf_dir), DISTINCT_COLS)


@register("range_violations", FEAT_SQL + "\n" + _union(
    [f"SELECT '{c}' AS column_name, CAST({lo} AS DOUBLE) AS lo, CAST({hi} AS DOUBLE) AS hi, "
     f"count({c}) AS n_checked, count(*) FILTER (WHERE {c} < {lo}) AS n_below, "
     f"count(*) FILTER (WHERE {c} > {hi}) AS n_above, "
     f"count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM feat" for c, lo, hi in RANGE_RULES]))
def q_range_violations(spark, sf_dir):
    """Rule table (column, lo, hi) -> violation counts, one pass."""
    return range_violations(features(spark, sf_dir), RANGE_RULES)
