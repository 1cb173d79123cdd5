"""Analyst questions answered from data.

Inputs are weekly series (one row per series and week), so the windows
here are partitioned by series over weekly rows; the cross-market summary
is one aggregate over one row per market.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Trend / impact thresholds (percent) and the period length.
TREND_THRESHOLD = 2.0
IMPACT_HIGH = 10.0
IMPACT_MEDIUM = 3.0
STABLE_BELOW = 3.0
PERIOD_WEEKS = 12

# Driver column -> factor label.
DRIVER_LABELS = [("ocean_proxy", "Ocean Freight Costs"), ("usd_per_eur", "USD/EUR Exchange Rate"),
                 ("diesel_usd_per_gal", "Diesel Prices"), ("ppi_glass", "Packaging Costs (Glass)")]

# Coefficient-of-variation cut-offs for the risk label.
RISK_HIGH = 0.10
RISK_MEDIUM = 0.05


def _recent(df: DataFrame, keys, value: str, weeks: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.col("week_start").desc())
    return (df.where(F.col(value).isNotNull())
            .withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") <= weeks))


def market_comparison(series: DataFrame, key: str = "country", value: str = "price_usd_per_l",
                      weeks: int = PERIOD_WEEKS, markets=None) -> DataFrame:
    """Current price, mean over the last ``weeks`` weeks, change % and
    trend per market (F6 ``isin`` when ``markets`` is given)."""
    s = series if markets is None else series.where(F.col(key).isin(list(markets)))
    rec = _recent(s, [key], value, weeks)
    agg = rec.groupBy(key).agg(F.max_by(value, "week_start").alias("current_price"),
                               F.avg(value).alias("average_price_period"),
                               F.stddev_pop(value).alias("_sd"))
    change = F.try_divide(F.col("current_price") - F.col("average_price_period"),
                          F.col("average_price_period")) * 100
    trend = (F.when(change > TREND_THRESHOLD, "increasing")
             .when(change < -TREND_THRESHOLD, "decreasing").otherwise("stable"))
    return (agg.withColumn("price_change_percent", change).withColumn("trend", trend)
            .withColumn("volatility", F.try_divide(F.col("_sd"), F.col("average_price_period")))
            .drop("_sd"))


def market_insights(comparison: DataFrame, key: str = "country") -> DataFrame:
    """Cheapest, dearest, most volatile market and the spread % of
    current prices - one aggregate over one row per market."""
    return comparison.agg(
        F.min_by(key, "current_price").alias("cheapest_market"),
        F.max_by(key, "current_price").alias("most_expensive_market"),
        F.max_by(key, "volatility").alias("most_volatile_market"),
        (F.try_divide(F.max("current_price") - F.min("current_price"), F.min("current_price"))
         * 100).alias("price_spread_percent"),
        F.count(F.lit(1)).alias("n_markets"))


def price_change(series: DataFrame, country: str | None = None, value: str = "price_usd_per_l",
                 weeks: int = PERIOD_WEEKS) -> DataFrame:
    """T3's price block: per country (or of one) the mean price of the last ``weeks`` weeks, that
    of the ``weeks`` before, the change in percent and its direction."""
    s = series if country is None else series.where(F.col("country") == country)
    rec = _recent(s, ["country"], value, 2 * weeks)
    agg = rec.groupBy("country").agg(
        F.avg(F.when(F.col("_rk") <= weeks, F.col(value))).alias("current_price"),
        F.avg(F.when(F.col("_rk") > weeks, F.col(value))).alias("previous_price"))
    change = F.try_divide(F.col("current_price") - F.col("previous_price"), F.col("previous_price")) * 100
    return agg.withColumn("change_percent", change).withColumn("direction", _direction(F.col("change_percent")))


def _direction(change) -> F.Column:
    return (F.when(F.abs(change) < STABLE_BELOW, "stable")
            .when(change > 0, "increasing").otherwise("decreasing"))


def price_drivers(weekly: DataFrame, weeks: int = PERIOD_WEEKS) -> DataFrame:
    """Per driver, mean of the last ``weeks`` weeks vs the ``weeks``
    before, change %, impact and direction, ranked by |change|.

    ``weekly`` has one row per week (bounded by the calendar), so the
    un-keyed ranking window is small by construction.
    """
    cols = [c for c, _ in DRIVER_LABELS if c in weekly.columns]
    stack = ", ".join(f"'{label}', `{c}`" for c, label in DRIVER_LABELS if c in cols)
    w = Window.orderBy(F.col("week_start").desc())
    ranked = weekly.withColumn("_rk", F.row_number().over(w))
    long = ranked.selectExpr("_rk", f"stack({len(cols)}, {stack}) as (factor, value)")
    agg = long.groupBy("factor").agg(
        F.avg(F.when(F.col("_rk") <= weeks, F.col("value"))).alias("current_value"),
        F.avg(F.when((F.col("_rk") > weeks) & (F.col("_rk") <= 2 * weeks), F.col("value")))
        .alias("previous_value"))
    change = F.try_divide(F.col("current_value") - F.col("previous_value"),
                          F.col("previous_value")) * 100
    out = agg.withColumn("change_percent", change)
    a = F.abs(F.col("change_percent"))
    out = out.withColumns({
        "impact": F.when(a >= IMPACT_HIGH, "High").when(a >= IMPACT_MEDIUM, "Medium")
        .otherwise("Low"),
        "direction": _direction(F.col("change_percent"))})
    rank_w = Window.orderBy(F.abs(F.col("change_percent")).desc_nulls_last(), F.col("factor"))
    return out.withColumn("rank", F.row_number().over(rank_w))


def country_risk(series: DataFrame, key: str = "country",
                 value: str = "price_usd_per_l") -> DataFrame:
    """T5: price volatility (coefficient of variation) per country and its
    label; countries without prices still get a row (NULL risk)."""
    agg = series.groupBy(key).agg(
        F.try_divide(F.stddev_pop(value), F.avg(value)).alias("risk"),
        F.count(value).alias("n_weeks"))
    label = (F.when(F.col("risk").isNull(), F.lit(None))
             .when(F.col("risk") >= RISK_HIGH, "High")
             .when(F.col("risk") >= RISK_MEDIUM, "Medium").otherwise("Low"))
    return agg.withColumn("risk_level", label)
