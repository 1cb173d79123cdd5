"""Property tests: Spark operators against pandas on random series."""

import datetime as dt

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from panelkit.functions import calendar as cal
from panelkit.operators.fill import ffill, interpolate_linear
from panelkit.operators.windows import rolling_mean, series_window
from pyspark.sql import functions as F

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
values = st.lists(st.one_of(st.none(), st.floats(-1e3, 1e3, allow_nan=False)), min_size=1,
                  max_size=30)


def frame(spark, vals):
    return spark.createDataFrame([("s", i, v) for i, v in enumerate(vals)], "k string, t int, v double")


def same(a, b):
    a, b = np.array(a, dtype=float), np.array(b, dtype=float)
    return np.allclose(a, b, rtol=1e-9, atol=1e-9, equal_nan=True)


@SETTINGS
@given(values)
def test_interpolate_matches_pandas(spark, vals):
    got = [r["vi"] for r in interpolate_linear(frame(spark, vals), "v", ["k"], "t", "vi")
           .orderBy("t").collect()]
    assert same([np.nan if g is None else g for g in got],
                pd.Series(vals, dtype=float).interpolate().tolist())


@SETTINGS
@given(values)
def test_ffill_matches_pandas(spark, vals):
    got = [r["f"] for r in frame(spark, vals).withColumn("f", ffill("v", ["k"], "t"))
           .orderBy("t").collect()]
    assert same([np.nan if g is None else g for g in got], pd.Series(vals, dtype=float).ffill().tolist())


@SETTINGS
@given(values, st.sampled_from([3, 10]))
def test_rolling_matches_pandas(spark, vals, n):
    w = series_window(["k"], "t")
    rows = (frame(spark, vals).select("t", rolling_mean("v", n, w).alias("a"),
                                      rolling_mean("v", n, w, strict=True).alias("b"))
            .orderBy("t").collect())
    s = pd.Series(vals, dtype=float)
    assert same([np.nan if r["a"] is None else r["a"] for r in rows],
                s.rolling(n, min_periods=1).mean().tolist())
    assert same([np.nan if r["b"] is None else r["b"] for r in rows], s.rolling(n).mean().tolist())


@SETTINGS
@given(st.lists(st.dates(dt.date(1995, 1, 1), dt.date(2030, 12, 31)), min_size=1, max_size=40))
def test_calendar_matches_pandas(spark, days):
    df = spark.createDataFrame([(d,) for d in days], "d date")
    parts = cal.calendar_parts(F.col("d"))
    rows = df.select("d", cal.monday_week("d").alias("mon"), cal.sunday_week_label("d").alias("sun"),
                     parts["month"].alias("m"), parts["quarter"].alias("q"),
                     parts["dayofweek"].alias("w"), parts["sin_week"].alias("s"),
                     cal.iso_week_start(cal.iso_year("d"), cal.iso_week("d")).alias("iso")).collect()
    for r in rows:
        ts = pd.Timestamp(r["d"])
        assert r["mon"] == (ts - pd.Timedelta(days=ts.dayofweek)).date() == r["iso"]
        label = pd.Series([1.0], index=[ts]).resample("W").mean().index[0]
        assert r["sun"] == label.date()
        assert (r["m"], r["q"], r["w"]) == (ts.month, ts.quarter, ts.dayofweek)
        assert abs(r["s"] - np.sin(2 * np.pi * ts.isocalendar().week / 52)) < 1e-12
