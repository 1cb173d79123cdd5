"""Join helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str],
                 how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL (segment keys use NULL
    for a rolled-up level, e.g. the global series).  ``<=>`` is still an
    equi-join key for Spark's hash / sort-merge joins; the right-side key
    columns are dropped so the result has one copy of each key."""
    keys = list(keys)
    if not keys:
        return attach_row(left, right)
    r = right.select(*[right[k].alias(f"_rk_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"_rk_{k}"])
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*[f"_rk_{k}" for k in keys])


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a ONE-row table (global constants) to every row: a cross join with
    a broadcast side that is one row by construction (a global aggregate)."""
    return df.crossJoin(F.broadcast(one_row))
