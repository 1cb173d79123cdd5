"""P10 forecast, T4 monthly forecast table, T6 planning scenario."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.forecast import recursive_forecast
from ..operators.segments import SEGMENT_KEYS
from ..sources.files import select_model
from .series import segment_features


def last_row_history(processed: DataFrame) -> DataFrame:
    """Q16 ``history='last'``: per (country, grade, week) the row of the
    last market (explicit tie-break) instead of the mean over markets, as
    the serving code keeps the last row per week."""
    from ..operators.windows import keep_last
    last = keep_last(processed.select("country", "grade", "week_start", "market",
                                      "price_usd_per_l", "cost_pressure"),
                     ["country", "grade", "week_start"], ["market"])
    return last.select(F.lit("country_grade").alias("segment_type"), "country", "grade",
                       "week_start", "price_usd_per_l", "cost_pressure")


def forecast(processed: DataFrame, models: DataFrame, steps: int = 12,
             country: str | None = None, grade: str | None = None,
             check_empty: bool = False, history: str = "mean",
             model_name: str | None = None) -> DataFrame:
    """P10: recursive forecasts for every modelled segment (a request is a
    filter on the result); optional country / grade filters (F5) are
    applied to the segment rows before the recursion.  ``history='last'``
    starts the country x grade series from the last row per week (Q16).

    ``model_name`` applies that one model (say ``global_ridge``) to every requested history,
    whether or not the segment has a model of its own; an unknown name raises."""
    if history == "last":
        seg = last_row_history(processed)
    else:
        seg = segment_features(processed)
    if country is not None:
        seg = seg.where(F.col("country") == country)
    if grade is not None:
        seg = seg.where(F.col("grade") == grade)
    if check_empty and seg.limit(1).count() == 0:
        raise ValueError("No rows found for the requested country / grade")
    if model_name is not None:
        one = select_model(models, model_name).select("intercept", "coef", "loo_rmse", "model_name").limit(1)
        models = seg.select(*SEGMENT_KEYS).distinct().crossJoin(F.broadcast(one))  # one row
    out = recursive_forecast(seg, models, SEGMENT_KEYS, steps)
    return out.select(*SEGMENT_KEYS, F.col("model_name").alias("model_used"), "step",
                      F.date_format("week_start", "yyyy-MM-dd").alias("week_start"),
                      "forecast", "lower", "upper")


def monthly_forecast(weekly: DataFrame, months_ahead: int = 3,
                     keys: Sequence[str] = SEGMENT_KEYS) -> DataFrame:
    """T4: weekly forecasts averaged per calendar month (``yyyy-MM``), the
    first ``months_ahead`` months of every segment."""
    keys = list(keys)
    m = (weekly.withColumn("month", F.substring("week_start", 1, 7))
         .groupBy(*keys, "month")
         .agg(F.avg("forecast").alias("predicted_price_usd_per_liter"),
              F.avg("lower").alias("confidence_interval_lower"),
              F.avg("upper").alias("confidence_interval_upper"),
              F.count(F.lit(1)).alias("n_weeks")))
    w = Window.partitionBy(*keys).orderBy("month")
    return (m.withColumn("month_index", F.row_number().over(w))
            .where(F.col("month_index") <= months_ahead))


def steps_for_months(months_ahead: int) -> int:
    return int(math.ceil(months_ahead * 31 / 7.0)) + 1


def planning_scenario(processed: DataFrame, models: DataFrame,
                      countries: Sequence[str] | None, grade: str, days_ahead: int) -> DataFrame:
    """Country x grade forecasts for ``ceil(days/7)`` weeks, rows in
    (country, date) order."""
    seg = segment_features(processed, types=["country_grade"]).where(F.col("grade") == grade)
    if countries is not None:
        seg = seg.where(F.col("country").isin(list(countries)))
    steps = max(1, int(math.ceil(days_ahead / 7.0)))
    out = recursive_forecast(seg, models, SEGMENT_KEYS, steps)
    return (out.select("country", "grade", "step",
                       F.date_format("week_start", "yyyy-MM-dd").alias("date"),
                       "forecast", "lower", "upper")
            .orderBy("country", "date"))
