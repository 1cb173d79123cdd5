"""Monitoring and the retraining decision.

The reference looks at file listings and sends mail; here the checks are
computed from the data itself (newest timestamp per source, forecast
errors per segment) against an explicit ``as_of`` date, and the
retraining decision is a table of segments to refit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Freshness limit (days), MAPE alert level (percent), and the
# recent-to-overall error ratio that triggers a refit.
FRESH_DAYS = 7
MAPE_ALERT = 10.0
RETRAIN_RATIO = 1.2
RECENT_WEEKS = 12


def freshness(sources: Sequence[tuple[str, DataFrame, str]], as_of: str) -> DataFrame:
    """Per source the newest timestamp, its age in days at
    ``as_of``, the row count, and whether it is fresh (age < 7 days)."""
    parts = []
    for name, df, ts_col in sources:
        parts.append(df.agg(F.lit(name).alias("source"), F.max(ts_col).cast("timestamp")
                            .alias("last_update"), F.count(F.lit(1)).alias("n_rows")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    age = F.datediff(F.to_date(F.lit(as_of)), F.to_date("last_update"))
    return out.withColumn("age_days", age).withColumn("is_fresh", F.col("age_days") < FRESH_DAYS)


def recent_errors(series: DataFrame, keys: Sequence[str], pred: str, actual: str,
                  weeks: int = RECENT_WEEKS) -> DataFrame:
    """MAPE over all weeks and over the last ``weeks`` weeks per series."""
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy(F.col("week_start").desc())
    d = (series.where(F.col(pred).isNotNull() & F.col(actual).isNotNull())
         .withColumn("_rk", F.row_number().over(w)))
    ape = F.when(F.col(actual) != 0, F.abs((F.col(pred) - F.col(actual)) / F.col(actual)) * 100)
    return d.groupBy(*keys).agg(
        F.avg(ape).alias("mape_all"),
        F.avg(F.when(F.col("_rk") <= weeks, ape)).alias("mape_recent"),
        F.avg(F.when(F.col("_rk") <= weeks, F.abs(F.col(pred) - F.col(actual)))).alias("mae_recent"))


def monitor_summary(fresh: DataFrame, errors: DataFrame, alert: float = MAPE_ALERT) -> DataFrame:
    """D3: check rows (freshness per source, recent MAPE per series) ->
    counts and an overall WARNING / OK status (one row)."""
    checks = (fresh.select(F.col("is_fresh").alias("ok"))
              .unionByName(errors.select((F.col("mape_recent") <= alert).alias("ok"))))
    return (checks.agg(F.count(F.lit(1)).alias("n_checks"),
                       F.count_if(~F.coalesce(F.col("ok"), F.lit(False))).alias("n_alerts"))
            .withColumn("status", F.when(F.col("n_alerts") > 0, "WARNING").otherwise("OK")))


def retrain_candidates(errors: DataFrame, keys: Sequence[str], ratio: float = RETRAIN_RATIO,
                       alert: float = MAPE_ALERT) -> DataFrame:
    """Segments whose recent error grew past ``ratio`` times
    their overall error or past the alert level, with the reason."""
    grew = F.col("mape_recent") > F.col("mape_all") * ratio
    high = F.col("mape_recent") > alert
    reason = (F.when(grew & high, "error_growth_and_level").when(grew, "error_growth")
              .when(high, "error_level"))
    return (errors.withColumn("reason", reason).where(F.col("reason").isNotNull())
            .select(*keys, "mape_all", "mape_recent", "reason"))


def file_availability(spark, path: str, fmt: str = "parquet") -> DataFrame:
    """D2 on storage: number of data files and the newest modification time under ``path`` (listed
    by the file source, no content read) and the row count."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", f"*.{fmt}").option("recursiveFileLookup", True)
             .load(path).select("path", "modificationTime").agg(F.count(F.lit(1)).alias("n_files"), F.max("modificationTime").alias("last_modified")))
    rows = spark.read.format(fmt).load(path).agg(F.count(F.lit(1)).alias("n_rows"))
    return files.crossJoin(F.broadcast(rows))  # one row each
