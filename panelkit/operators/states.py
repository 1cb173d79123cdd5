"""Mergeable states of a column: what a table tells about its values, kept beside it and added up later.

A moment state is (n, mean, m2): values, their mean, the sum of squares about it.  A profile state
adds the extremes and a KLL sketch of the distribution.  States of parts (weeks, snapshots) merge into
the state of the whole without reading the parts again; merging is pairwise, so no large sums of
squares cancel.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size parameter of the sketches.  At 4,096 a rank read from a sketch is off by less than
#: ``RANK_ERROR`` of the values in all but one of a hundred sketches (the library's bound,
#: 2.296 / k ** 0.9723, for one rank).
KLL_K = 4096
RANK_ERROR = 2.296 / KLL_K ** 0.9723


def moment_state(col: str) -> Column:
    """Aggregate: the moment state of a column, NULLs left out."""
    n = F.count(col)
    return F.struct(n.alias("n"), F.coalesce(F.avg(col), F.lit(0.0)).alias("mean"),
                    F.coalesce(F.var_pop(col) * n, F.lit(0.0)).alias("m2"))


def scaled_state(state: str, factor: str) -> Column:
    """The state of the same values times a factor; of no value where the factor is NULL."""
    f = F.col(factor).cast("double")
    empty = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    return F.when(f.isNull(), empty).otherwise(F.struct(
        F.col(f"{state}.n").alias("n"), (F.col(f"{state}.mean") * f).alias("mean"), (F.col(f"{state}.m2") * f * f).alias("m2")))


def constant_state(value: str, times: str) -> Column:
    """The state of one value that occurs ``times`` times; of no value where it is NULL."""
    v = F.col(value).cast("double")
    return F.struct(F.when(v.isNull(), F.lit(0)).otherwise(F.col(times)).cast("long").alias("n"),
                    F.coalesce(v, F.lit(0.0)).alias("mean"), F.lit(0.0).alias("m2"))


def merged_moments(state: str) -> Column:
    """Aggregate: the state of all values, from the states of their parts (few rows per group: weeks or
    snapshots), by pairwise updates in a fixed order."""
    return F.expr(f"""aggregate(sort_array(collect_list({state})), named_struct('n', 0L, 'mean', 0D, 'm2', 0D),
        (s, t) -> if(t.n = 0, s, named_struct(
            'n', s.n + t.n,
            'mean', s.mean + (t.mean - s.mean) * (t.n / (s.n + t.n)),
            'm2', s.m2 + t.m2 + (t.mean - s.mean) * (t.mean - s.mean) * s.n * (t.n / (s.n + t.n)))))""")


def mean_of(state: str) -> Column:
    return F.when(F.col(f"{state}.n") > 0, F.col(f"{state}.mean"))


def std_of(state: str, ddof: int = 1) -> Column:
    """Standard deviation of a state; NULL with no more than ``ddof`` values."""
    n = F.col(f"{state}.n")
    return F.when(n > ddof, F.sqrt(F.col(f"{state}.m2") / (n - ddof)))


def profile_state(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """keys, column_name, moments, least, most, sketch: one row per column and group, from one pass.
    Columns without a value have an empty sketch (NULL)."""
    def one(c: str) -> Column:
        return F.struct(F.lit(c).alias("column_name"), moment_state(c).alias("moments"),
                        F.min(c).cast("double").alias("least"), F.max(c).cast("double").alias("most"),
                        F.when(F.count(c) > 0, F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(KLL_K))).alias("sketch"))

    return df.groupBy(*keys).agg(F.array(*map(one, cols)).alias("_s")).select(*keys, F.inline("_s"))


def merged_profiles(states: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The profile states of the groups that ``keys`` leave, from those of their parts."""
    return states.groupBy(*keys, "column_name").agg(
        merged_moments("moments").alias("moments"), F.min("least").alias("least"), F.max("most").alias("most"),
        F.kll_merge_agg_double("sketch").alias("sketch"))


def profile_of(states: DataFrame, keys: Sequence[str] = (), probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """keys, column_name, count, mean, std, min, max and the quantiles p25, p50, ... read from the sketches:
    each is a value whose rank is within ``RANK_ERROR`` of the values from the one asked for."""
    quantiles = [F.when(F.col("moments.n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))))
                 .alias(f"p{100 * q:g}") for q in probs]
    return states.select(*keys, "column_name", F.col("moments.n").alias("count"), mean_of("moments").alias("mean"),
                         std_of("moments").alias("std"), F.col("least").alias("min"), F.col("most").alias("max"), *quantiles)


#: Nominal entries (as a power of two) of the sketches of distinct values: counts are exact below it, and
#: off by ``DISTINCT_ERROR`` of the count, as a standard error, beyond.
THETA_BITS = 13
DISTINCT_ERROR = 1 / (2 ** THETA_BITS) ** 0.5


def distinct_state(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """keys, column_name, n (values), sketch: a theta sketch of each column's distinct values per group, of
    bounded size however many there are, from one pass."""
    parts = [F.struct(F.lit(c).alias("column_name"), F.count(c).alias("n"),
                      F.theta_sketch_agg(F.col(c).cast("string"), F.lit(THETA_BITS)).alias("sketch")) for c in cols]
    return df.groupBy(*keys).agg(F.array(*parts).alias("_s")).select(*keys, F.inline("_s"))


def merged_distinct(states: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """keys, column_name, n, n_distinct: the estimate of the union of the parts; a value that many parts hold
    counts once."""
    union = states.groupBy(*keys, "column_name").agg(
        F.sum("n").alias("n"), F.theta_union_agg("sketch", F.lit(THETA_BITS)).alias("sketch"))
    return union.select(*keys, "column_name", "n", F.theta_sketch_estimate("sketch").alias("n_distinct"))


def rank_errors(values: DataFrame, quantiles: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """column_name, p25_error, ...: how far, as a share of the values, the quantiles of one profile are from
    ranks that they could have (0: exact), counted over the values themselves in one pass."""
    row = quantiles.groupBy().agg(*[F.max(F.when(F.col("column_name") == c, F.col(f"p{100 * q:g}"))).alias(f"_{i}_{j}")
                                    for i, c in enumerate(cols) for j, q in enumerate(probs)])

    def error(i: int, c: str, j: int, q: float) -> Column:
        below, upto = F.count_if(F.col(c) < F.col(f"_{i}_{j}")), F.count_if(F.col(c) <= F.col(f"_{i}_{j}"))
        n = F.count(c)
        return F.when(n > 0, F.greatest(F.lit(0.0), below / n - q, F.lit(q) - upto / n)).alias(f"p{100 * q:g}_error")

    parts = [F.struct(F.lit(c).alias("column_name"), *[error(i, c, j, q) for j, q in enumerate(probs)])
             for i, c in enumerate(cols)]
    return values.crossJoin(F.broadcast(row)).agg(F.array(*parts).alias("_s")).select(F.inline("_s"))  # one row
