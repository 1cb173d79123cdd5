"""Watching weekly series: outliers against a rolling robust level (D5), drifts of the error (D3, D4), and
rolling-origin back-tests with empirical intervals (M6, M8).

All of it runs over weekly rows, one series per window or array: a few hundred rows at most, however
many observations stand behind them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .forecast import HISTORY, step_features_sql
from .joins import join_on_keys
from .ridge import _dot

#: Robust scale of a normal distribution over its median absolute deviation.
MAD_SCALE = 1.4826


def median_of(values: Column) -> Column:
    """Median of an array without NULLs; NULL of an empty one."""
    s, n = F.array_sort(values), F.size(values)
    low, high = F.floor((n - 1) / 2).cast("int"), F.floor(n / 2).cast("int")
    return F.when(n > 0, (F.get(s, low) + F.get(s, high)) / 2)


def anomalies(weekly: DataFrame, keys: Sequence[str], value: str, window: int = 13, least: int = 8,
              limit: float = 4.0, floor: float = 0.01, season: int = 52) -> DataFrame:
    """``weekly`` with level, seasonal, scale, score and outlier.

    The level is the median of the ``window`` rows before (the row itself takes no part), the scale
    their median absolute deviation, but no less than ``floor`` of the level.  What the series did a
    year before is expected again: the median of its distances from the level ``season`` - 1 to
    ``season`` + 1 rows ago, so that one old outlier does not announce itself.  A row is an outlier if it
    is more than ``limit`` scales from level and season; with fewer than ``least`` values before it, or no
    value, it has no score.  Weeks without a value take no place in the windows.
    """
    w = Window.partitionBy(*keys).orderBy("week_start")
    before = F.collect_list(F.col(value).cast("double")).over(w.rowsBetween(-window, -1))
    priced = weekly.where(F.col(value).isNotNull())
    d = priced.withColumn("_before", before).withColumn("level", F.when(F.size("_before") >= least, median_of(F.col("_before"))))
    d = d.withColumn("_off", F.col(value) - F.col("level"))
    year = F.filter(F.array(*[F.lag("_off", season + i).over(w) for i in (-1, 0, 1)]), lambda v: v.isNotNull())
    d = d.withColumn("_year", year).withColumn("seasonal", F.coalesce(median_of(F.col("_year")), F.lit(0.0)))
    away = F.transform("_before", lambda v: F.abs(v - F.col("level")))
    d = d.withColumn("_away", away).withColumn(
        "scale", F.greatest(F.lit(MAD_SCALE) * median_of(F.col("_away")), F.lit(floor) * F.abs("level")))
    d = d.withColumn("score", F.try_divide(F.col("_off") - F.col("seasonal"), F.col("scale")))
    d = d.withColumn("outlier", F.coalesce(F.abs("score") > limit, F.lit(False)))
    return d.drop("_before", "_off", "_year", "_away")


def first_alarms(errors: DataFrame, keys: Sequence[str], error: str, reference: int = 52, slack: float = 0.5,
                 alarm: float = 5.0) -> DataFrame:
    """One-sided cumulative sums of the weekly errors of every series, folded in week order:
    S = max(0, S + (e - mean) / std - slack), mean and std those of the first ``reference`` weeks.
    keys, n_weeks, alarm_week (the first week after the reference with S > ``alarm``, else NULL), the highest
    S up to then, and n_weeks after it.  A series no longer than its reference, or with errors all
    alike there, has no alarm."""
    keys = list(keys)
    rows = errors.where(F.col(error).isNotNull()).select(*keys, F.struct(
        "week_start", F.col(error).cast("double").alias("e")).alias("r"))
    series = rows.groupBy(*keys).agg(F.array_sort(F.collect_list("r")).alias("r"))  # a row per week
    series = series.withColumn("first", F.slice("r", 1, reference)).withColumn(
        "mean", F.expr("aggregate(first, 0D, (s, v) -> s + v.e) / size(first)")).withColumn(
        "std", F.expr("sqrt(aggregate(first, 0D, (s, v) -> s + (v.e - mean) * (v.e - mean)) / size(first))"))
    fold = f"""aggregate(slice(r, {reference + 1}, greatest(size(r) - {reference}, 0)),
        named_struct('s', 0D, 'top', 0D, 'week', cast(null as date), 'after', 0),
        (a, v) -> if(a.week is not null, named_struct('s', a.s, 'top', a.top, 'week', a.week, 'after', a.after + 1),
            named_struct('s', greatest(0D, a.s + (v.e - mean) / std - {slack}D),
                         'top', greatest(a.top, a.s + (v.e - mean) / std - {slack}D),
                         'week', if(a.s + (v.e - mean) / std - {slack}D > {alarm}D, v.week_start, null), 'after', 0)))"""
    found = F.when(F.col("std") > 0, F.expr(fold))
    return series.select(*keys, F.size("r").alias("n_weeks"), found.alias("a")).select(
        *keys, "n_weeks", F.col("a.week").alias("alarm_week"), F.coalesce("a.top", F.lit(0.0)).alias("highest"),
        F.coalesce("a.after", F.lit(0)).alias("weeks_after"))


def rolling_origins(series: DataFrame, models: DataFrame, keys: Sequence[str], horizon: int = 4,
                    price_col: str = "price_usd_per_l", cp_col: str = "cost_pressure") -> DataFrame:
    """M6 / M8: recursive forecasts 1 to ``horizon`` weeks ahead from EVERY week of every series with at least
    ``HISTORY`` priced weeks before it, beside the price that came: keys, origin, step, week_start,
    forecast, actual, residual.  Weeks that the series does not have are left out."""
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy("week_start").rowsBetween(-(HISTORY - 1), 0)
    priced = series.where(F.col(price_col).isNotNull())
    origins = priced.select(*keys, F.col("week_start").alias("origin"), F.collect_list(F.col(price_col).cast("double")).over(w).alias("hist"),
                            F.col(cp_col).alias("last_cp")).where(F.size("hist") == HISTORY)
    m = join_on_keys(origins, models.select(*keys, "intercept", "coef"), keys)
    day = "date_add(origin, 7 * k)"
    pred = f"(intercept + {_dot('coef', step_features_sql('h', day, 'last_cp'))})"
    path = f"slice(aggregate(sequence(1, {int(horizon)}), hist, (h, k) -> concat(h, array({pred}))), {HISTORY + 1}, {int(horizon)})"
    ahead = m.select(*keys, "origin", F.posexplode(F.expr(path)).alias("step", "forecast")).withColumn("step", F.col("step") + 1)
    ahead = ahead.withColumn("week_start", F.expr("date_add(origin, 7 * step)"))
    actual = priced.select(*keys, "week_start", F.col(price_col).alias("actual"))
    return join_on_keys(ahead, actual, [*keys, "week_start"]).withColumn("residual", F.col("actual") - F.col("forecast"))


def interval_coverage(residuals: DataFrame, keys: Sequence[str], level: float = 0.9, held_out: int = 52) -> DataFrame:
    """M8: empirical prediction intervals and how well they hold.  Per series and step the interval is
    [quantile((1 - level) / 2), quantile((1 + level) / 2)] of the residuals of all origins whose forecast week lies
    before the last ``held_out`` weeks of the series; coverage is counted over the weeks held out.
    keys, step, n_fit, lower, upper, n_held, coverage (NULL where nothing is held out)."""
    keys = list(keys)
    last = Window.partitionBy(*keys)
    d = residuals.withColumn("_end", F.max("week_start").over(last)).withColumn(
        "_held", F.col("week_start") > F.expr(f"date_sub(_end, {7 * held_out})"))
    edge = (1 - level) / 2
    fit = d.where(~F.col("_held")).groupBy(*keys, "step").agg(
        F.count(F.lit(1)).alias("n_fit"), F.percentile("residual", F.lit(edge)).alias("lower"),
        F.percentile("residual", F.lit(1 - edge)).alias("upper"))
    held = join_on_keys(d.where("_held"), fit, [*keys, "step"])
    hit = held.groupBy(*keys, "step").agg(F.count(F.lit(1)).alias("n_held"), F.avg(
        F.col("residual").between(F.col("lower"), F.col("upper")).cast("double")).alias("coverage"))
    return join_on_keys(fit, hit, [*keys, "step"], "left").withColumn("n_held", F.coalesce("n_held", F.lit(0)))
