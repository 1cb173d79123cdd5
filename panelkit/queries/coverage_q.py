"""Schema, coverage and pairing queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..catalog import register
from ..operators.aggregates import error_metrics
from ..operators.joins import join_on_keys
from ..operators.segments import SEGMENT_KEYS
from ..plans.macros import normalize_fx, weekly_long
from ..plans.monitoring import file_availability
from ..plans.panel import build_weekly_panel
from ..session import cut_lineage, stored
from ..sources import tables as T
from ..sources.headers import distinct_labels
from .features_q import FEAT_SQL, features
from .macros_q import WEEKLY_LONG
from .models_q import seg_rows
from .panel_q import PANEL_CTES, SNAPSHOT, panel_inputs
from .series_q import SEGMENT_SQL
from .sqlparts import MACRO_OBS, OBS, r, with_


#: Headers under which a feed may bring its rate; ``usdeur`` is quoted the other way round, to 4 digits.
FX_HEADERS = ["usd_per_eur", "value", "eurusd", "eur_usd", "usdeur", "other"]


def fx_feed(spark, sf_dir, header):
    """The weekly rate as a feed with that header would bring it; a quote of 0 in weeks 26."""
    wl = weekly_long(T.macro_observations(spark, sf_dir)).where(F.col("series") == "usd_per_eur")
    quote = F.col("value") if header != "usdeur" else F.when(F.weekofyear("week_start") == 26, 0.0).otherwise(
        F.rint(F.lit(10000.0) / F.col("value")) / 10000.0)
    return wl.select("week_start", quote.alias(header))


QUOTED = """
qt AS (SELECT week_start, value, CASE WHEN weekofyear(week_start) = 26 THEN 0.0 ELSE round_even(10000.0 / value, 0) / 10000.0 END AS q
       FROM wl WHERE series = 'usd_per_eur')"""


@register("fx_normalize", with_(MACRO_OBS, WEEKLY_LONG, QUOTED) + "\nUNION ALL\n".join(
    f"SELECT '{h}' AS header, week_start, " + r({"usdeur": "1.0 / nullif(q, 0)", "other": "CAST(NULL AS DOUBLE)"}.get(h, "value"), "usd_per_eur")
    + " FROM qt" for h in FX_HEADERS))
def q_fx_normalize(spark, sf_dir):
    """H3: the weekly rate from feeds under every known header, an inverse quote and an unknown header."""
    parts = [normalize_fx(fx_feed(spark, sf_dir, h)).select(F.lit(h).alias("header"), "week_start", "usd_per_eur") for h in FX_HEADERS]
    return reduce(DataFrame.unionByName, parts)


@register("panel_inverse_fx", PANEL_CTES.replace("macros AS (SELECT", "macros0 AS (SELECT", 1).replace("fbx AS (SELECT", QUOTED.strip() + """,
macros AS (SELECT coalesce(m.week_start, q.week_start) AS week_start, m.* EXCLUDE (week_start, usd_per_eur), 1.0 / nullif(q.q, 0) AS usd_per_eur
           FROM macros0 m FULL OUTER JOIN qt q ON m.week_start = q.week_start),
fbx AS (SELECT""", 1) + f"""
SELECT week_start, count(*) AS n_rows, count(price_usd_per_l) AS n_priced, {r('avg(price_usd_per_l)', 'price_usd_per_l')},
       {r('avg(duty_usd_per_l)', 'duty_usd_per_l')}, {r('avg(deliv_hat_usd_per_l)', 'deliv_hat_usd_per_l')},
       {r('avg(z_base)', 'z_base')} FROM panel GROUP BY ALL""")
def q_panel_inverse_fx(spark, sf_dir):
    """P5 / H3: the panel job on an exchange-rate feed quoted the other way round, per week."""
    prices, macros, freight, tariffs = panel_inputs(spark, sf_dir)
    panel = build_weekly_panel(stored(prices, "prices"), cut_lineage(macros), freight, tariffs, snapshot=SNAPSHOT,
                               fx=cut_lineage(fx_feed(spark, sf_dir, "usdeur")))
    return panel.groupBy("week_start").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("price_usd_per_l").alias("n_priced"),
        *[F.avg(c).alias(c) for c in ("price_usd_per_l", "duty_usd_per_l", "deliv_hat_usd_per_l", "z_base")])


SOURCES = ["lineitem", "orders", "part", "events"]


@register("source_availability", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS source, true AS has_files, count(*) AS n_rows, true AS dated FROM {t}" for t in SOURCES))
def q_source_availability(spark, sf_dir):
    """Whether each raw source has data files and a time of its last change, and its rows."""
    parts = [file_availability(spark, f"{sf_dir}/{t}.parquet").select(
        F.lit(t).alias("source"), (F.col("n_files") > 0).alias("has_files"), "n_rows",
        F.col("last_modified").isNotNull().alias("dated")) for t in SOURCES]
    return reduce(DataFrame.unionByName, parts)


@register("distinct_labels", with_(OBS) + """
SELECT 'country' AS column_name, country AS label FROM obs WHERE country IS NOT NULL GROUP BY 2
UNION ALL
SELECT 'market', market FROM obs WHERE market IS NOT NULL GROUP BY 2
UNION ALL
SELECT 'grade', grade FROM obs WHERE grade IS NOT NULL GROUP BY 2""")
def q_distinct_labels(spark, sf_dir):
    """H8: distinct non-NULL labels of country, market and grade, from one scan."""
    return distinct_labels(T.price_observations(spark, sf_dir), ["country", "market", "grade"])


# flag -> (columns, "all" / "any" of them non-NULL)
COVERAGE_FLAGS = {
    "has_core": (["week_start", "country", "market", "grade_norm", "price_eur_per_l"], "all"),
    "has_fx": (["usd_per_eur"], "any"),
    "has_price_usd": (["price_usd_per_l"], "any"),
    "has_tariff": (["adval_pct", "specific_usd_per_kg"], "any"),
    "has_duty_usd": (["duty_usd_per_l"], "any"),
    "has_ocean": (["ocean_proxy"], "any"),
    "has_diesel": (["diesel_usd_per_gal"], "any"),
    "has_ppi": (["ppi_glass", "ppi_plastic_bottles", "ppi_steel"], "any"),
}


def _flag_sql(cols, how):
    return f" {'AND' if how == 'all' else 'OR'} ".join(f"{c} IS NOT NULL" for c in cols)


@register("coverage_flags", FEAT_SQL + "\nSELECT count(*) AS n_rows, " + ", ".join(
    f"count(*) FILTER (WHERE {_flag_sql(cols, how)}) AS {name}"
    for name, (cols, how) in COVERAGE_FLAGS.items()) + " FROM feat")
def q_coverage_flags(spark, sf_dir):
    """rows with core fields and with FX, tariff, duty, ocean, diesel and
    PPI coverage.  As in the reference, a flag whose columns are all absent
    is false; an "any" flag uses the columns that exist."""
    f = features(spark, sf_dir)
    flags = []
    for name, (cols, how) in COVERAGE_FLAGS.items():
        present = [F.col(c).isNotNull() for c in cols if c in f.columns]
        if not present or (how == "all" and len(present) < len(cols)):
            cond = F.lit(False)
        else:
            cond = present[0]
            for p in present[1:]:
                cond = (cond & p) if how == "all" else (cond | p)
        flags.append(F.count_if(cond).alias(name))
    return f.agg(F.count(F.lit(1)).alias("n_rows"), *flags)


@register("prediction_pairs", SEGMENT_SQL + f""",
pred AS (SELECT segment_type, country, grade, CAST(week_start + 7 AS DATE) AS week_start,
                price_usd_per_l AS prediction FROM segp),
pairs AS (SELECT a.segment_type, a.country, a.grade, p.prediction, a.price_usd_per_l AS actual
          FROM segp a JOIN pred p
            ON a.segment_type IS NOT DISTINCT FROM p.segment_type
           AND a.country IS NOT DISTINCT FROM p.country
           AND a.grade IS NOT DISTINCT FROM p.grade AND a.week_start = p.week_start)
SELECT segment_type, country, grade, count(*) AS n,
       {r('avg(abs(prediction - actual))', 'mae')},
       {r('sqrt(avg((prediction - actual) * (prediction - actual)))', 'rmse')},
       {r('avg(CASE WHEN actual <> 0 THEN abs((prediction - actual) / actual) * 100 END)', 'mape')}
FROM pairs GROUP BY ALL""")
def q_prediction_pairs(spark, sf_dir):
    """J7 + A14: predictions (last week's price, moved one calendar week on)
    paired with actuals by (segment, week) - an equi-join, not positions."""
    seg = seg_rows(spark, sf_dir)
    pred = seg.select(*SEGMENT_KEYS, F.date_add("week_start", 7).alias("week_start"),
                      F.col("price_usd_per_l").alias("prediction"))
    actual = seg.select(*SEGMENT_KEYS, "week_start", F.col("price_usd_per_l").alias("actual"))
    pairs = join_on_keys(actual, pred, SEGMENT_KEYS + ["week_start"])
    return error_metrics(pairs, SEGMENT_KEYS, "prediction", "actual")


@register("time_coverage", FEAT_SQL + """
SELECT min(week_start) AS earliest_week, max(week_start) AS latest_week,
       count(DISTINCT week_start) AS total_weeks, count(*) AS n_rows FROM feat""")
def q_time_coverage(spark, sf_dir):
    """A10: earliest / latest week and number of distinct weeks."""
    return features(spark, sf_dir).agg(
        F.min("week_start").alias("earliest_week"), F.max("week_start").alias("latest_week"),
        F.count_distinct("week_start").alias("total_weeks"), F.count(F.lit(1)).alias("n_rows"))
