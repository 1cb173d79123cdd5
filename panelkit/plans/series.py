"""Series preparation jobs: P7 ``preprocess`` and the per-segment feature
tables used by training, evaluation and forecasting.

Shuffle plan: the raw rows are reduced by one partial-aggregated
``groupBy`` (country, market, grade, week); every window after that is
partitioned by a series key over weekly rows only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import monday_week, sunday_week_label
from ..operators.aggregates import cost_pressure, group_week_mean, zscore
from ..operators.segments import SEGMENT_KEYS, segment_series
from ..operators.windows import add_series_features
from ..sources.headers import ensure_columns

SERIES_KEYS = ["country", "market", "grade"]
PROCESSED_COLS = ["week_start", "price_usd_per_l", "cost_pressure", "lag1week", "lag2week",
                  "rolling3", "rolling10", "month", "dayofweek", "quarter", "sin_week", *SERIES_KEYS]


def preprocess(features: DataFrame, with_cost_pressure: bool = True) -> DataFrame:
    """Cost pressure on the feature rows, weekly (Sunday-labelled) means
    per (country, market, grade), then lag/rolling/calendar features per
    series.  Output columns follow the reference ``processed`` table."""
    df = features
    if "price_usd_per_l" not in df.columns:
        if {"price_eur_per_l", "usd_per_eur"}.issubset(df.columns):
            df = df.withColumn("price_usd_per_l", F.col("price_eur_per_l") * F.col("usd_per_eur"))
        else:
            raise ValueError("the features have neither a USD price nor a EUR price with an exchange rate")
    df = ensure_columns(df, {k: F.lit("ALL") for k in SERIES_KEYS})
    if with_cost_pressure:
        df = cost_pressure(df)
    df = ensure_columns(df, {"cost_pressure": F.lit(0.0)})
    date_col = "week_start" if "week_start" in df.columns else "date"
    weekly = group_week_mean(df, SERIES_KEYS, date_col, ["price_usd_per_l", "cost_pressure"])
    feats = add_series_features(weekly, SERIES_KEYS, "week_start", "price_usd_per_l")
    return feats.select(*PROCESSED_COLS)


def weekly_prices(prices: DataFrame) -> DataFrame:
    """The core-usable price rows reduced to one row per (country, market, grade, Monday week):
    ``n_rows`` and the mean price.  The only shuffle of the facts that ``preprocess`` needs."""
    usable = prices.dropna(subset=[*SERIES_KEYS, "date", "price_eur_per_l"])
    return (usable.groupBy(*SERIES_KEYS, monday_week("date").alias("week_start"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.avg("price_eur_per_l").alias("price_eur_per_l")))


def weekly_drivers(macros: DataFrame, freight: DataFrame) -> DataFrame:
    """One row per week: exchange rate and cost drivers, the ocean proxy included."""
    from .panel import MACRO_COLS, ocean_proxy_table
    return macros.select("week_start", *MACRO_COLS).join(
        ocean_proxy_table(macros, freight), "week_start", "full_outer")


def preprocess_weekly(weekly: DataFrame, drivers: DataFrame) -> DataFrame:
    """P7 from the weekly reduction.  Everything but the price depends on the week alone, so the
    mean over a week's rows is the week's value; constants over the feature rows weigh each
    weekly row by the rows it stands for.  Equals ``preprocess`` of the full feature table."""
    df = (weekly.join(F.broadcast(drivers), "week_start", "left")  # one row per calendar week
          .withColumn("price_usd_per_l", F.col("price_eur_per_l") * F.col("usd_per_eur")))
    df = cost_pressure(df, rows="n_rows").withColumn("week_start", sunday_week_label("week_start"))
    return add_series_features(df, SERIES_KEYS, "week_start", "price_usd_per_l").select(*PROCESSED_COLS)


def segment_features(processed: DataFrame, types=None, price_col: str = "price_usd_per_l",
                     drop_unpriced: bool = True) -> DataFrame:
    """A6 + W6: weekly series of every segment with model features; features
    are computed before unpriced weeks are dropped (as in training)."""
    kwargs = {} if types is None else {"types": types}
    seg = segment_series(processed, "week_start", (price_col, "cost_pressure"), **kwargs)
    feats = add_series_features(seg, SEGMENT_KEYS, "week_start", price_col)
    return feats.where(F.col(price_col).isNotNull()) if drop_unpriced else feats


def weekly_segment_features(obs: DataFrame) -> DataFrame:
    """Flagship slice: price observations -> weekly mean per
    (country, market, grade) -> country x grade series -> lag, rolling and
    calendar features plus a per-series z-score of the price."""
    weekly = group_week_mean(obs, SERIES_KEYS, "date", ["price_eur_per_l"])
    seg = (weekly.groupBy("country", "grade", "week_start")
           .agg(F.avg("price_eur_per_l").alias("price")))
    feats = add_series_features(seg, ["country", "grade"], "week_start", "price")
    return zscore(feats, "price", "z_price", ddof=0, by=["country", "grade"])


def interpolated_weekly(obs: DataFrame, keys=("market", "grade"),
                        price_col: str = "price_eur_per_l") -> DataFrame:
    """A5: Sunday-week mean per series on a gap-free grid spanning the
    series' own first..last week, gaps filled by linear interpolation."""
    from ..operators.fill import densify, interpolate_linear
    keys = list(keys)
    weekly = group_week_mean(obs, keys, "date", [price_col]).withColumnRenamed(price_col, "price")
    dense = densify(weekly, keys, ["price"], "week_start")
    return interpolate_linear(dense, "price", keys, "week_start", out="price_interp")
