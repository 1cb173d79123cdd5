"""Recursive multi-step forecast (M4) and intervals (M8), all in Catalyst.

Each segment becomes one row holding its last <= 10 priced weeks (a
bounded array - only the window the features need), the model row is
joined on, and ``aggregate(sequence(1, h), state, step)`` runs the
recursion: each step builds the features of the next week from the
history array (lags, rolling means of the previous <=2 / <=9 values - the
new week's own price is unknown, Q17 - calendar parts, carried cost
pressure), predicts, and appends the prediction to the history.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .joins import join_on_keys
from .ridge import _dot

HISTORY = 10


def _mean(arr: str) -> str:
    return (f"try_divide(aggregate({arr}, 0D, (acc, v) -> acc + v), "
            f"cast(size({arr}) AS DOUBLE))")


def step_features_sql(h: str, d: str, cp: str) -> str:
    """The nine model features of the week ``d`` given the history ``h``."""
    lag1 = f"coalesce(try_element_at({h}, -1), 0D)"
    lag2 = f"coalesce(try_element_at({h}, -2), 0D)"
    r3 = f"coalesce({_mean(f'slice({h}, greatest(1, size({h}) - 1), 2)')}, 0D)"
    r10 = f"coalesce({_mean(f'slice({h}, greatest(1, size({h}) - 8), 9)')}, 0D)"
    cal = (f"cast(month({d}) AS DOUBLE), cast(weekday({d}) AS DOUBLE), "
           f"cast(quarter({d}) AS DOUBLE), sin({2 * math.pi!r} * weekofyear({d}) / 52D)")
    return f"array({lag1}, {lag2}, {r3}, {r10}, {cal}, coalesce({cp}, 0D))"


def history_rows(series: DataFrame, keys: Sequence[str], price_col: str,
                 cp_col: str = "cost_pressure", n: int = HISTORY) -> DataFrame:
    """One row per segment: last week, last cost pressure and the last
    ``n`` priced values in week order (NULL prices removed first)."""
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy(F.col("week_start").desc())
    priced = series.where(F.col(price_col).isNotNull())
    recent = priced.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") <= n)
    agg = recent.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("week_start", F.col(price_col).alias("p"))))
        .alias("_h"),
        F.max("week_start").alias("last_week"),
        F.max_by(F.col(cp_col), F.col("week_start")).alias("last_cp"))
    return agg.select(*keys, "last_week", "last_cp",
                      F.expr("transform(_h, s -> s.p)").alias("hist"))


def recursive_forecast(series: DataFrame, models: DataFrame, keys: Sequence[str],
                       steps: int | str = 12, price_col: str = "price_usd_per_l",
                       z: float = 1.96) -> DataFrame:
    """M4 + M8: ``steps`` weekly forecasts per segment with a
    ``forecast +/- z * loo_rmse * sqrt(k)`` interval."""
    keys = list(keys)
    hist = history_rows(series, keys, price_col)
    m = join_on_keys(hist, models.select(*keys, "intercept", "coef", "loo_rmse",
                                         *[c for c in ["model_name"] if c in models.columns]),
                     keys)
    steps_sql = str(steps) if isinstance(steps, int) else steps
    d = "date_add(last_week, 7 * k)"
    x = step_features_sql("s.h", d, "last_cp")
    pred = f"(intercept + {_dot('coef', x)})"
    rec = f"""aggregate(sequence(1, {steps_sql}),
        named_struct('h', hist, 'out',
                     cast(array() AS array<struct<step:int, week_start:date, forecast:double>>)),
        (s, k) -> named_struct(
            'h', concat(s.h, array({pred})),
            'out', concat(s.out, array(named_struct('step', k, 'week_start', {d},
                                                    'forecast', {pred})))),
        s -> s.out)"""
    out = m.select(*keys, *[c for c in ["model_name"] if c in m.columns], "loo_rmse",
                   F.inline(F.expr(rec)))
    half = F.lit(z) * F.col("loo_rmse") * F.sqrt(F.col("step").cast("double"))
    return out.withColumns({"lower": F.col("forecast") - half,
                            "upper": F.col("forecast") + half}).drop("loo_rmse")
