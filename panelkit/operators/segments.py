"""Segment series (A6, A7): global, per country, per grade and per
(country, grade) weekly series computed in ONE grouping-sets aggregate.

The input is the weekly ``processed`` table (one row per country, market,
grade and week), so the aggregate is small and partial-aggregated map side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SEGMENT_KEYS = ["segment_type", "country", "grade"]

# Segment types and the minimum weekly rows for a model.
SEGMENT_TYPES = ["global", "country", "grade", "country_grade"]
MIN_ROWS_PER_MODEL = 26


def segment_series(df: DataFrame, week_col: str = "week_start",
                   value_cols=("price_usd_per_l", "cost_pressure"),
                   types=SEGMENT_TYPES) -> DataFrame:
    """Mean of the group rows per (segment, week) for every segment type.

    ``grouping()`` separates a rolled-up key from a NULL key; rows whose own
    key is NULL are dropped from that segment type (pandas ``groupby``, Q1),
    but still count towards the global series.
    """
    sets_by_type = {
        "global": [week_col],
        "country": ["country", week_col],
        "grade": ["grade", week_col],
        "country_grade": ["country", "grade", week_col],
    }
    sets = [[F.col(c) for c in sets_by_type[t]] for t in types]
    agg = (df.groupingSets(sets, "country", "grade", week_col)
           .agg(*[F.avg(c).alias(c) for c in value_cols],
                F.grouping("country").alias("_gc"), F.grouping("grade").alias("_gg")))
    seg_type = (F.when((F.col("_gc") == 1) & (F.col("_gg") == 1), F.lit("global"))
                .when(F.col("_gg") == 1, F.lit("country"))
                .when(F.col("_gc") == 1, F.lit("grade"))
                .otherwise(F.lit("country_grade")))
    keep = (((F.col("_gc") == 1) | F.col("country").isNotNull())
            & ((F.col("_gg") == 1) | F.col("grade").isNotNull()))
    return (agg.where(keep)
            .select(seg_type.alias("segment_type"), "country", "grade", week_col,
                    *value_cols))


def segment_gate(df: DataFrame, price_col: str = "price_usd_per_l",
                 min_rows: int = MIN_ROWS_PER_MODEL, keys=SEGMENT_KEYS) -> DataFrame:
    """Per segment, number of weeks with a price and whether it reaches
    ``min_rows`` (segments below it get no model)."""
    return (df.where(F.col(price_col).isNotNull())
            .groupBy(*keys).agg(F.count(F.lit(1)).alias("n_weeks"))
            .withColumn("eligible", F.col("n_weeks") >= min_rows))

