"""Window operators.

Every window here is partitioned by a series key.  They are meant to run
*after* the weekly aggregation, so one partition holds at most one row per
week of one series - even a series holding a third of all raw rows is only a
few hundred weekly rows.  Never used un-partitioned on a fact table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import calendar_parts

FEATURES = ["lag1week", "lag2week", "rolling3", "rolling10", "month", "dayofweek",
            "quarter", "sin_week", "cost_pressure"]


def series_window(keys: Sequence[str], order_col: str):
    return Window.partitionBy(*keys).orderBy(order_col)


def rolling_mean(col: str, n: int, w, strict: bool = False) -> Column:
    """W2 (loose, ``min_periods=1``; NULLs skipped) or W3 (strict: all ``n``
    values present)."""
    frame = w.rowsBetween(-(n - 1), 0)
    mean = F.avg(col).over(frame)
    if not strict:
        return mean
    return F.when(F.count(col).over(frame) == n, mean)


def add_series_features(df: DataFrame, keys: Sequence[str], order_col: str = "week_start",
                        price_col: str = "price_usd_per_l") -> DataFrame:
    """Lags by row (Q6), loose rolling means including the current value
    (Q7), calendar parts and the seasonal sine - one window spec, no loop."""
    w = series_window(keys, order_col)
    cols = {
        "lag1week": F.lag(price_col, 1).over(w),
        "lag2week": F.lag(price_col, 2).over(w),
        "rolling3": rolling_mean(price_col, 3, w),
        "rolling10": rolling_mean(price_col, 10, w),
    }
    cols.update(calendar_parts(F.col(order_col)))
    return df.withColumns(cols)


def price_change_flag(df: DataFrame, keys: Sequence[str], order_col: str, price_col: str,
                      threshold: float = 0.05) -> DataFrame:
    """First difference and a 0/1 flag for a rise above ``threshold``
    (a NULL difference gives 0)."""
    w = series_window(keys, order_col)
    diff = F.col(price_col) - F.lag(price_col, 1).over(w)
    return (df.withColumn("price_diff", diff)
            .withColumn("price_up_flag",
                        F.coalesce((F.col("price_diff") > threshold).cast("int"), F.lit(0))))


def keep_last(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """One row per key - the last by ``order_cols`` (explicit tie-break,
    Q14).  Written as ``max_by`` over a struct of the row, so it is a plain
    aggregate: partial-aggregated before the shuffle, and a hot key is
    reduced map side instead of being sorted in one task."""
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(*[F.col(c) for c in order_cols])
    agg = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in rest]), order).alias("_r"))
    return agg.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*df.columns)


def keep_last_rows(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """W5 for tables with few rows per key (facts), where combining map side saves nothing:
    one shuffle and one sort, instead of ``max_by``'s sort on either side of the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order_cols])
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") == 1).drop("_rank")
