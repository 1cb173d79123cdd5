"""Queries over mergeable states (A3, A8, A11, P5): parts are summarised alone, stored, and merged."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import register
from ..operators.upsert import upsert, write_keyed
from ..operators.states import (DISTINCT_ERROR, RANK_ERROR, THETA_BITS, distinct_state, merged_distinct, merged_profiles,
                               profile_of, profile_state, rank_errors)
from ..plans.features import PROFILE_FIELDS
from ..plans.quality import distinct_counts
from ..plans.panel import merged_week_states, panel_constants, price_week_state
from ..session import stored
from ..sources import tables as T
from .features_q import FEAT_SQL, features
from .panel_q import PANEL_CTES, panel_inputs
from .sqlparts import r

PROBS = [0.25, 0.5, 0.75]


@register("panel_constants_merged", PANEL_CTES + f"""
SELECT {r('avg(diesel_usd_per_gal)', 'diesel_mean')}, {r('avg(base_usd_per_l)', 'base_mean')},
       {r('stddev_samp(base_usd_per_l)', 'base_std')} FROM panel""")
def q_panel_constants_merged(spark, sf_dir):
    """A3 / P5: the panel's constants from weekly price states of each country's sheet, stored and merged."""
    prices, macros, _, _ = panel_inputs(spark, sf_dir)
    states = stored(price_week_state(prices, ["country"]), "week-states")  # a sheet per country lands alone
    row = panel_constants(merged_week_states(states), macros)
    return row.select(F.col("_diesel_mean").alias("diesel_mean"), F.col("_base_mean").alias("base_mean"),
                      F.col("_base_std").alias("base_std"))


@register("profile_merged", FEAT_SQL + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count({c}) AS count, {r(f'avg({c})', 'mean')}, {r(f'stddev_samp({c})', 'std')}, "
    f"{r(f'min({c})', 'min')}, {r(f'max({c})', 'max')}, true AS p25_close, true AS p50_close, true AS p75_close FROM feat"
    for c in PROFILE_FIELDS))
def q_profile_merged(spark, sf_dir):
    """The profile of all features from stored states per country; whether each quantile read from the
    merged sketches is within the stated rank error is counted over the rows."""
    rows = stored(features(spark, sf_dir).select("country", *PROFILE_FIELDS), "profile-rows")
    states = stored(profile_state(rows, PROFILE_FIELDS, ["country"]), "profile-states")
    profile = profile_of(merged_profiles(states), probs=PROBS)
    errors = rank_errors(rows, profile, PROFILE_FIELDS, PROBS)
    close = [(F.col(f"p{100 * q:g}_error") <= RANK_ERROR).alias(f"p{100 * q:g}_close") for q in PROBS]
    return profile.join(errors, "column_name").select("column_name", "count", "mean", "std", "min", "max", *close)


DISTINCT_COLS = ["country", "market", "grade_norm", "week_start", "price_eur_per_l"]


@register("distinct_merged", FEAT_SQL + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count({c}) AS n_values, count(DISTINCT {c}) AS n_distinct, true AS close FROM feat"
    for c in DISTINCT_COLS))
def q_distinct_merged(spark, sf_dir):
    """Distinct values of the features from stored sketches per country, beside the exact counts; an estimate
    is close if it is exact for few values and within four standard errors for many."""
    rows = stored(features(spark, sf_dir).select(*DISTINCT_COLS), "distinct-rows")
    estimate = merged_distinct(stored(distinct_state(rows, DISTINCT_COLS, ["country"]).drop("country"), "distinct-states"))
    exact = distinct_counts(rows, DISTINCT_COLS)
    off = F.abs(F.col("estimate") - F.col("n_distinct"))
    limit = F.when(F.col("n_distinct") < 2 ** THETA_BITS, 0.5).otherwise(4 * DISTINCT_ERROR * F.col("n_distinct"))
    return estimate.withColumnRenamed("n_distinct", "estimate").join(exact, "column_name").select(
        "column_name", F.col("n").alias("n_values"), "n_distinct", (off <= limit).alias("close"))


@register("tariff_upsert", f"""
SELECT hs_prefix, arg_max(adval_pct, p_partkey) AS adval_pct, {r('arg_max(specific_usd_per_kg, p_partkey)', 'specific_usd_per_kg')},
       max(p_partkey) AS row_order
FROM (SELECT lpad(substr(regexp_replace(p_brand, '[^0-9]', '', 'g'), 1, 4), 4, '0') AS hs_prefix,
             CAST(p_size AS DOUBLE) AS adval_pct, p_retailprice / 1000.0 AS specific_usd_per_kg, p_partkey FROM part)
GROUP BY hs_prefix""")
def q_tariff_upsert(spark, sf_dir):
    """The tariff table from three sheets that came one after the other, merged into a stored keyed
    table; the second brings old rows again."""
    from ..operators.windows import keep_last
    from ..plans.standardize import normalize_tariffs
    keys, order = ["hs_prefix"], ["row_order"]
    sheet = T.tariff_sheet(spark, sf_dir)
    part = F.pmod("row_order", F.lit(3))
    sheets = [normalize_tariffs(sheet.where(part == i), keep_order=True).drop("grade") for i in (0, 1, 2)]
    name = write_keyed(keep_last(sheets[0], keys, order), keys)
    name = upsert(spark, name, sheets[1].unionByName(sheets[0]), keys, order)
    name = upsert(spark, name, sheets[2], keys, order)
    return spark.table(name).select("hs_prefix", "adval_pct", "specific_usd_per_kg", "row_order")
