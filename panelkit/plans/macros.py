"""Macro series -> weekly series, outer-merged table, filled grid.

The reference folds full outer joins over the per-series frames.  Here the
series stay in one long table: one partial-aggregated ``groupBy`` gives the
weekly means, and the wide table is a single ``groupBy(week)`` with one
conditional aggregate per series - no chain of full outer joins, and the
result has at most one row per calendar week.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import epoch_millis
from ..operators.aggregates import weekly_mean
from ..operators.fill import densify, ffill
from ..sources.tables import MACRO_SERIES


def weekly_long(obs: DataFrame) -> DataFrame:
    """A1 per series: (series, week_start, value) Monday-week means."""
    rows = obs.dropna(subset=["date", "value"])
    return weekly_mean(rows, "date", ["value"], keys=["series"])


def wide_by_week(long: DataFrame, series: Sequence[str] = MACRO_SERIES,
                 week_col: str = "week_start") -> DataFrame:
    """Outer alignment of the series on the week key (a week present
    in any series appears once; absent series are NULL)."""
    wanted = long.where(F.col("series").isin(list(series)))
    return (wanted.groupBy(week_col)
            .agg(*[F.max(F.when(F.col("series") == s, F.col("value"))).alias(s) for s in series]))


def macro_grid(long: DataFrame, series: Sequence[str] = MACRO_SERIES,
               week_col: str = "week_start") -> DataFrame:
    """J6 + F9 + E7: gap-free Monday grid from the first to the last week of
    any series, each series forward-filled, plus the epoch-ms week key the
    reference's ``macros`` file carries."""
    wanted = long.where(F.col("series").isin(list(series)))
    dense = densify(wanted, ["series"], ["value"], week_col, global_span=True)
    filled = dense.withColumn("value", ffill("value", ["series"], week_col))
    wide = wide_by_week(filled, series, week_col)
    return wide.withColumn("week_start_ms", epoch_millis(F.col(week_col)))


# Accepted FX headers (USD per EUR), in order; ``usdeur`` is
# the inverse quote.
FX_ALIASES = ["value", "eurusd", "eur_usd"]


def normalize_fx(fx: DataFrame) -> DataFrame:
    """H3: (week_start, usd_per_eur) from whichever FX column a feed has -
    renamed alias, or ``1 / usdeur`` (zero rate -> NULL, Q20), or a NULL
    placeholder when none is present."""
    cols = fx.columns
    if "usd_per_eur" in cols:
        rate = F.col("usd_per_eur")
    else:
        alias = next((c for c in FX_ALIASES if c in cols), None)
        if alias:
            rate = F.col(alias)
        elif "usdeur" in cols:
            rate = F.try_divide(F.lit(1.0), F.col("usdeur"))
        else:
            rate = F.lit(None).cast("double")
    return fx.select("week_start", rate.cast("double").alias("usd_per_eur"))
