"""The streaming weekly means equal the batch A4 means for closed weeks."""

import tempfile

from pyspark.sql import functions as F

from conftest import SF001
from panelkit.operators.aggregates import group_week_mean
from panelkit.plans.standardize import standardize_prices
from panelkit.sources import tables as T
from panelkit.streaming.weekly_prices import start_weekly_price_sink, weekly_price_stream


def test_stream_matches_batch(spark):
    root = tempfile.mkdtemp(prefix="panelkit-stream-")
    sheet = T.price_sheet(spark, SF001).drop("Pack", "HS Prefix")
    sheet.where(F.col("Reference From") < "1998-01-01").write.option("header", True).csv(f"{root}/raw/a")
    sheet.where(F.col("Reference From") >= "1998-01-01").write.option("header", True).csv(f"{root}/raw/b")
    # a late sentinel sheet far in the future closes every real week
    spark.createDataFrame([("X", "Y", "Z", "2030-01-01", "1.0")], sheet.schema).write.option(
        "header", True).csv(f"{root}/raw/c")
    q = start_weekly_price_sink(weekly_price_stream(spark, f"{root}/raw/*", sheet.schema, "0 seconds"),
                                f"{root}/out", f"{root}/ckpt", available_now=True)
    q.awaitTermination(300)
    got = spark.read.parquet(f"{root}/out")
    batch = group_week_mean(standardize_prices(sheet, keep=()), ["country", "market", "grade"], "date",
                            ["price_eur_per_l"])
    a = {(r.country, r.market, r.grade, r.week_start): round(r.price_eur_per_l, 9) for r in got.collect()}
    b = {(r.country, r.market, r.grade, r.week_start): round(r.price_eur_per_l, 9) for r in batch.collect()}
    assert a == b
