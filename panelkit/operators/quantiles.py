"""Exact quantiles without gathering a column into one task and without shuffling its values.

1. One scan with the mergeable sketch ``percentile_approx`` gives, for each wanted quantile, a
   bracket of values that holds the wanted ranks for certain (the sketch's rank error is known).
2. A second scan counts, map side, the values below each bracket and each distinct value inside
   it: only the share of the values that the sketch leaves open (a few in ``accuracy``) moves.
3. Ranks inside the bracket start at the count below it; the order statistics at floor(h) and
   ceil(h), h = (n - 1) q, are interpolated linearly (pandas / DuckDB ``quantile_cont``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: The sketch's rank error is at most n / ACCURACY.
ACCURACY = 20_000


def exact_quantiles_multi(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                          accuracy: int = ACCURACY) -> DataFrame:
    """Exact quantiles of several columns from two scans.  One row per column:
    ``column_name, q_0, q_1, ...`` (NULLs ignored; a column without values is absent)."""
    probs = [float(q) for q in probs]
    margin = 3.0 / accuracy
    edges = [min(max(q + side * margin, 0.0), 1.0) for q in probs for side in (-1, 1)]
    pairs = F.array(*[F.struct(F.lit(c).alias("k"), F.col(c).cast("double").alias("v")) for c in cols])
    vals = df.select(F.inline(pairs)).where(F.col("v").isNotNull())
    sketch = vals.groupBy("k").agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("least"), F.max("v").alias("most"),
        F.percentile_approx("v", edges, accuracy).alias("e"))
    # one row per column and quantile; brackets next to an end reach to it, and few values
    # (where the margin is less than a rank) are one bracket
    few = F.col("n") <= accuracy
    brackets = sketch.select("k", F.inline(F.array(*[
        F.struct(F.lit(i).alias("p"), F.lit(q).alias("q"), F.col("n"),
                 F.when(few | F.lit(q <= 2 * margin), F.col("least")).otherwise(F.col("e")[2 * i]).alias("lo"),
                 F.when(few | F.lit(q >= 1 - 2 * margin), F.col("most")).otherwise(F.col("e")[2 * i + 1]).alias("hi"))
        for i, q in enumerate(probs)])))
    held = vals.join(F.broadcast(brackets), "k").where("v <= hi")
    inside = F.when(F.col("v") >= F.col("lo"), F.col("v"))  # NULL: below the bracket
    counts = held.groupBy("k", "p", "q", "n", inside.alias("v")).agg(F.count(F.lit(1)).alias("c"))
    run = Window.partitionBy("k", "p").orderBy(F.col("v").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, 0)
    ranked = counts.withColumn("upto", F.sum("c").over(run))
    h = (F.col("n") - 1) * F.col("q")
    at = lambda rank: F.max(F.when((F.col("upto") - F.col("c") <= rank) & (rank < F.col("upto")), F.col("v")))
    picks = ranked.groupBy("k", "p").agg(at(F.floor(h)).alias("a"), at(F.ceil(h)).alias("z"),
                                         F.max(h - F.floor(h)).alias("f"))
    value = F.col("a") + (F.col("z") - F.col("a")) * F.col("f")
    out = picks.groupBy("k").agg(*[F.max(F.when(F.col("p") == i, value)).alias(f"q_{i}") for i in range(len(probs))])
    return out.withColumnRenamed("k", "column_name")


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], accuracy: int = ACCURACY) -> DataFrame:
    """One row: ``q_<i>`` for every probability in ``probs`` (NULLs ignored)."""
    return exact_quantiles_multi(df, [col], probs, accuracy).drop("column_name")
