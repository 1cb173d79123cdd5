"""Aggregations.

All grouped aggregates are plain ``groupBy().agg()``: Spark runs a partial
(map-side) aggregate before the shuffle, so a hot key that holds a third of
the rows still ships one partial row per map task, not its rows.
Table-wide constants (means, standard deviations) are one global ``agg``
whose single row is cross-joined back (broadcast: one row by construction).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import monday_week, sunday_week_label


def weekly_mean(df: DataFrame, date_col: str, value_cols: Sequence[str],
                keys: Sequence[str] = (), week_col: str = "week_start") -> DataFrame:
    """A1/A2: irregular observations -> Monday-week means (NULLs skipped)."""
    return (df.groupBy(*keys, monday_week(date_col).alias(week_col))
            .agg(*[F.avg(c).alias(c) for c in value_cols]))


def group_week_mean(df: DataFrame, keys: Sequence[str], date_col: str,
                    value_cols: Sequence[str], week_col: str = "week_start") -> DataFrame:
    """A4: mean per (keys, Sunday-labelled week); observed weeks only (Q5);
    rows with a NULL key are dropped first, as pandas ``groupby`` does (Q1)."""
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    src = df.where(cond) if cond is not None else df
    return (src.groupBy(*keys, sunday_week_label(date_col).alias(week_col))
            .agg(*[F.avg(c).alias(c) for c in value_cols]))


def with_constants(df: DataFrame, aggs: Mapping[str, Column]) -> DataFrame:
    """A3: table-wide scalar aggregates attached to every row.  One global
    aggregate (partial-aggregated per task) whose single row is broadcast
    to all.  (Scalar subqueries via ``DataFrame.scalar()`` give the same
    result but measured up to 2x slower here.)"""
    from .joins import attach_row
    return attach_row(df, df.agg(*[c.alias(n) for n, c in aggs.items()]))


def zscore_expr(col: str, mean: Column, std: Column, zero_to: float | None = 0.0) -> Column:
    """(x - mean) / std with the zero/undefined-std rule of Q8."""
    z = F.try_divide(F.col(col) - mean, std)
    if zero_to is None:
        return z
    return F.when((std == 0) | std.isNull(), F.lit(zero_to)).otherwise(z)


def zscore(df: DataFrame, col: str, out: str, ddof: int = 0,
           by: Sequence[str] | None = None, zero_to: float | None = 0.0) -> DataFrame:
    """Z-score with population (ddof=0) or sample (ddof=1) std.

    ``by`` gives a per-group z-score over a partitioned window (for series
    after weekly aggregation); without it, one global aggregate is broadcast.
    """
    std_fn = F.stddev_pop if ddof == 0 else F.stddev_samp
    if by:
        w = Window.partitionBy(*by)
        return df.withColumn(out, zscore_expr(col, F.avg(col).over(w),
                                              std_fn(col).over(w), zero_to))
    mean_n, std_n = f"_{out}_mean", f"_{out}_std"
    with_c = with_constants(df, {mean_n: F.avg(col), std_n: std_fn(col)})
    return (with_c.withColumn(out, zscore_expr(col, F.col(mean_n), F.col(std_n), zero_to))
            .drop(mean_n, std_n))


# Cost-pressure drivers and their weights.
COST_DRIVERS = {
    "ocean_proxy": 0.4,
    "diesel_usd_per_gal": 0.3,
    "ppi_glass": 0.1,
    "ppi_plastic_bottles": 0.1,
    "ppi_steel": 0.1,
}
# The notebook's three-driver variant (no renormalisation).
COST_DRIVERS_FIXED = {"ocean_idx": 0.4, "diesel_usd_per_gal": 0.3, "pack_cost": 0.3}


def cost_pressure(df: DataFrame, out: str = "cost_pressure",
                  weights: Mapping[str, float] | None = None,
                  renormalise: bool = True, rows: str | None = None) -> DataFrame:
    """Weighted sum of population z-scores of the usable drivers.

    ``rows`` names a column that says how many observations a row stands for
    (after an aggregation); counts, means and standard deviations are then
    those of the observations.

    A driver is usable when present in the schema, not all NULL and not all
    zero.  Usability is decided *inside the plan* from one aggregate row
    (count, non-zero count, mean, std per driver) - no collect - and the
    weights are renormalised over the usable drivers with ``CASE``.  A NULL
    value of a usable driver makes the row's pressure NULL, as in pandas.
    A zero std gives z = 0.
    """
    weights = dict(weights or COST_DRIVERS)
    present = [c for c in weights if c in df.columns]
    if not present:
        return df.withColumn(out, F.lit(0.0))
    stands = F.lit(1) if rows is None else F.col(rows)
    aggs = {"_rows": F.sum(stands)}
    for c in present:
        aggs[f"_n_{c}"] = F.coalesce(F.sum(F.when(F.col(c).isNotNull(), stands)), F.lit(0))
        aggs[f"_z0_{c}"] = F.coalesce(F.sum(F.when(F.col(c) == 0, stands)), F.lit(0))
        aggs[f"_m_{c}"] = F.avg(c) if rows is None else F.try_divide(
            F.sum(F.col(c) * stands), F.sum(F.when(F.col(c).isNotNull(), stands)))
        if rows is None:
            aggs[f"_s_{c}"] = F.stddev_pop(c)
    with_c = with_constants(df, aggs)
    if rows is not None:  # squares about the means, which are known now
        squares = {f"_s_{c}": F.sqrt(F.try_divide(
            F.sum((F.col(c) - F.col(f"_m_{c}")) * (F.col(c) - F.col(f"_m_{c}")) * stands),
            F.sum(F.when(F.col(c).isNotNull(), stands)))) for c in present}
        with_c = with_constants(with_c, squares)
        aggs |= squares
    usable = {c: (F.col(f"_n_{c}") > 0) & (F.col(f"_z0_{c}") < F.col("_rows")) for c in present}
    total = None
    for c in present:
        term = F.when(usable[c], F.lit(weights[c])).otherwise(F.lit(0.0))
        total = term if total is None else total + term
    pressure = None
    for c in present:
        z = zscore_expr(c, F.col(f"_m_{c}"), F.col(f"_s_{c}"))
        w = F.lit(weights[c]) / total if renormalise else F.lit(weights[c])
        term = F.when(usable[c], z * w).otherwise(F.lit(0.0))
        pressure = term if pressure is None else pressure + term
    any_usable = None
    for c in present:
        any_usable = usable[c] if any_usable is None else any_usable | usable[c]
    result = F.when(any_usable, pressure).otherwise(F.lit(0.0))
    return with_c.withColumn(out, result).drop(*aggs.keys())


def cost_pressure_fixed(df: DataFrame, out: str = "cost_pressure",
                        weights: Mapping[str, float] | None = None) -> DataFrame:
    """E23 notebook variant: fixed weights, population z-scores, no
    usability test; a zero std gives NULL (pandas would give inf/NaN)."""
    weights = dict(weights or COST_DRIVERS_FIXED)
    aggs = {}
    for c in weights:
        aggs[f"_m_{c}"] = F.avg(c)
        aggs[f"_s_{c}"] = F.stddev_pop(c)
    with_c = with_constants(df, aggs)
    total = None
    for c, w in weights.items():
        term = F.lit(w) * zscore_expr(c, F.col(f"_m_{c}"), F.col(f"_s_{c}"), zero_to=None)
        total = term if total is None else total + term
    return with_c.withColumn(out, total).drop(*aggs.keys())


def error_metrics(df: DataFrame, keys: Sequence[str], pred: str, actual: str) -> DataFrame:
    """MAE, RMSE, MAPE (zero actuals skipped; 0 if all are) and n per group."""
    err = F.col(pred) - F.col(actual)
    ape = F.when(F.col(actual) != 0, F.abs(F.try_divide(err, F.col(actual))) * 100)
    return (df.where(F.col(pred).isNotNull() & F.col(actual).isNotNull())
            .groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("n"),
                 F.avg(F.abs(err)).alias("mae"),
                 F.sqrt(F.avg(err * err)).alias("rmse"),
                 F.coalesce(F.avg(ape), F.lit(0.0)).alias("mape")))


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULL count per column, as a long table (column, nulls, rows)."""
    wide = df.agg(F.count(F.lit(1)).alias("_rows"),
                  *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {stack}) as (column_name, null_count)",
                           "_rows as row_count")


def coverage(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Percent of non-NULL values per column (long table)."""
    wide = df.agg(*[(F.avg(F.col(c).isNotNull().cast("double")) * 100).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {stack}) as (column_name, non_null_pct)")


def numeric_ranges(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A10: min / max per column (long table)."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).cast("double").alias(f"{c}__min"), F.max(c).cast("double").alias(f"{c}__max")]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', `{c}__min`, `{c}__max`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {stack}) as (column_name, min_value, max_value)")


def describe(df: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    """Count, mean, sample std, min, quartiles, max per column.

    Moments come from one aggregate pass for all columns.  ``exact``
    quartiles (pandas' linear interpolation) use ``exact_quantiles_multi``
    (never a column gathered into one task); its passes and that of the moments
    read the profiled columns alone, which are stored first, so ``df`` is computed once.
    ``exact=False`` uses the
    mergeable sketch ``percentile_approx`` in the same pass; ``states.profile_state`` keeps
    mergeable states of parts instead.
    """
    from ..session import stored
    from .quantiles import exact_quantiles_multi
    if exact:
        df = stored(df.select(*[F.col(c).cast("double").alias(c) for c in cols]), "profile")
    stats = []
    for c in cols:
        fields = [F.lit(c).alias("column_name"), F.count(c).alias("count"),
                  F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
                  F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max")]
        if not exact:
            q = F.percentile_approx(F.col(c), [0.25, 0.5, 0.75], 10000)
            fields += [q[0].alias("p25"), q[1].alias("p50"), q[2].alias("p75")]
        stats.append(F.struct(*fields))
    moments = df.agg(F.array(*stats).alias("_s")).selectExpr("inline(_s)")
    if not exact:
        return moments.select("column_name", "count", "mean", "std", "min", "p25", "p50",
                              "p75", "max")
    quarts = exact_quantiles_multi(df, cols, [0.25, 0.5, 0.75]).select(
        "column_name", F.col("q_0").alias("p25"), F.col("q_1").alias("p50"),
        F.col("q_2").alias("p75"))
    return (moments.join(quarts, "column_name", "left")
            .select("column_name", "count", "mean", "std", "min", "p25", "p50", "p75", "max"))
