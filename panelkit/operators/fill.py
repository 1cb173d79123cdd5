"""Gap filling along time (F9, F10) and the calendar grid.

All windows are partitioned by a series key and run over weekly rows; the
grid is bounded by the calendar span (52 rows per series-year), not by the
data volume.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import attach_row


def week_grid(bounds: DataFrame, keys: Sequence[str], lo: str = "lo", hi: str = "hi",
              week_col: str = "week_start") -> DataFrame:
    """One row per key and week from ``lo`` to ``hi`` (7-day steps)."""
    return bounds.select(*keys, F.explode(
        F.sequence(F.col(lo), F.col(hi), F.expr("INTERVAL 7 DAYS"))).alias(week_col))


def densify(df: DataFrame, keys: Sequence[str], value_cols: Sequence[str],
            week_col: str = "week_start", global_span: bool = False) -> DataFrame:
    """Left-join the observed weeks onto a gap-free weekly grid per series.

    ``global_span`` uses one min..max over all series (a single calendar
    for every key, as the macro grid does); otherwise each series spans its
    own first..last week.
    """
    keys = list(keys)
    if global_span:
        span = df.agg(F.min(week_col).alias("lo"), F.max(week_col).alias("hi"))
        series = df.select(*keys).distinct() if keys else None
        bounds = attach_row(series, span) if keys else span
    else:
        bounds = df.groupBy(*keys).agg(F.min(week_col).alias("lo"), F.max(week_col).alias("hi"))
    grid = week_grid(bounds, keys, week_col=week_col)
    return grid.join(df.select(*keys, week_col, *value_cols), [*keys, week_col], "left")


def ffill(col: str, keys: Sequence[str], order_col: str) -> Column:
    """last non-NULL value up to the current row."""
    w = (Window.partitionBy(*keys).orderBy(order_col)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return F.last(col, ignorenulls=True).over(w)


def interpolate_linear(df: DataFrame, col: str, keys: Sequence[str], order_col: str,
                       out: str | None = None) -> DataFrame:
    """pandas ``interpolate()`` on a regular grid - interior gaps are
    filled linearly by position, trailing gaps carry the last value, leading
    gaps stay NULL."""
    out = out or col
    base = Window.partitionBy(*keys).orderBy(order_col)
    before = base.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = base.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    pos = F.row_number().over(base)
    d = df.withColumn("_pos", pos)
    known_pos = F.when(F.col(col).isNotNull(), F.col("_pos"))
    d = d.withColumns({
        "_pv": F.last(col, ignorenulls=True).over(before),
        "_pp": F.last(known_pos, ignorenulls=True).over(before),
        "_nv": F.first(col, ignorenulls=True).over(after),
        "_np": F.first(known_pos, ignorenulls=True).over(after),
    })
    interp = (F.col("_pv") + (F.col("_nv") - F.col("_pv"))
              * (F.col("_pos") - F.col("_pp")) / (F.col("_np") - F.col("_pp")))
    val = (F.when(F.col(col).isNotNull(), F.col(col))
           .when(F.col("_pv").isNull(), F.lit(None))
           .when(F.col("_nv").isNull(), F.col("_pv"))
           .otherwise(interp))
    return d.withColumn(out, val).drop("_pos", "_pv", "_pp", "_nv", "_np")
