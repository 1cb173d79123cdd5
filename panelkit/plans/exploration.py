"""The exploration notebook's weekly overall series (A5, E23 fixed, W4).

The overall series has one row per calendar week, so its un-keyed windows
hold at most 52 rows per year of data - bounded by the calendar, not by the
data volume.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.aggregates import cost_pressure_fixed, group_week_mean
from ..operators.fill import densify, interpolate_linear
from ..operators.windows import price_change_flag


def weekly_overall(features: DataFrame, price_col: str = "base_usd_per_l",
                   store: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """F1/F4 (price present and > 0), fixed-weight cost pressure per row,
    mean per Sunday-labelled week, gap-free grid, linear interpolation.

    ``store`` may materialise the weekly means (one row per week), which the grid and the join
    both read; by default this is a plan only."""
    df = features.where(F.col(price_col).isNotNull() & (F.col(price_col) > 0))
    df = cost_pressure_fixed(df)
    weekly = store(group_week_mean(df, [], "week_start", [price_col, "cost_pressure"]))
    dense = densify(weekly, [], [price_col, "cost_pressure"], "week_start")
    out = interpolate_linear(dense, price_col, [], "week_start")
    return interpolate_linear(out, "cost_pressure", [], "week_start")


def weekly_price_flags(features: DataFrame, price_col: str = "base_usd_per_l", threshold: float = 0.05,
                       store: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """W4 on the overall weekly series."""
    return price_change_flag(weekly_overall(features, price_col, store), [], "week_start", price_col,
                             threshold)
