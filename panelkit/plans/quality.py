"""Quality checks over the features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Plausible ranges for the validated inputs (column, lo, hi).
RANGE_RULES = [
    ("price_eur_per_l", 0.0, 100.0),
    ("usd_per_eur", 0.5, 2.0),
    ("brent_usd_per_bbl", 10.0, 200.0),
    ("diesel_usd_per_gal", 0.5, 10.0),
    ("ocean_proxy", 0.0, 500.0),
    ("deliv_hat_usd_per_l", 0.0, 150.0),
]


def distinct_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Exact distinct count per column, in one aggregate (long table).
    ``states.distinct_state`` is the mergeable, bounded-memory alternative at scale."""
    wide = df.agg(*[F.count_distinct(c).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {stack}) as (column_name, n_distinct)")


def range_violations(df: DataFrame, rules: Sequence[tuple[str, float, float]]) -> DataFrame:
    """Counts below / above each rule's bounds and NULLs, one pass."""
    aggs = []
    for c, lo, hi in rules:
        aggs += [F.count(c).alias(f"{c}__n"), F.count_if(F.col(c) < lo).alias(f"{c}__lo"),
                 F.count_if(F.col(c) > hi).alias(f"{c}__hi"),
                 F.count_if(F.col(c).isNull()).alias(f"{c}__null")]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', CAST({lo} AS DOUBLE), CAST({hi} AS DOUBLE), `{c}__n`, `{c}__lo`, "
                      f"`{c}__hi`, `{c}__null`" for c, lo, hi in rules)
    return wide.selectExpr(
        f"stack({len(rules)}, {stack}) as (column_name, lo, hi, n_checked, n_below, n_above, n_null)")
