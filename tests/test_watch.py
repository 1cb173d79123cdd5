"""Outliers, error alarms and rolling-origin intervals against plain Python."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from panelkit.operators import watch
from panelkit.operators.windows import FEATURES

START = dt.date(2018, 1, 7)


def frame(spark, series, name="v"):
    rows = [(k, START + dt.timedelta(7 * i), v) for k, vs in series.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, f"k string, week_start date, {name} double")


def test_planted_outliers_are_found_and_clean_series_left_alone(spark):
    rng = random.Random(4)
    clean = [100 + 0.1 * i + rng.gauss(0, 2) for i in range(200)]
    planted = list(clean)
    for i in (40, 90, 150):
        planted[i] *= 1.6
    season = [v + (60 if 18 <= i % 52 <= 22 else 0) for i, v in enumerate(clean)]
    got = {(r.k, r.week_start): r for r in watch.anomalies(frame(spark, {
        "clean": clean, "planted": planted, "season": season, "short": clean[:8], "flat": [5.0] * 30 + [6.0], "gap": [None] * 20 + clean[:30]}),
        ["k"], "v").collect()}
    flagged = lambda k: [(d - START).days // 7 for (n, d), r in sorted(got.items()) if n == k and r.outlier]
    assert set(flagged("planted")) >= {40, 90, 150} and len(flagged("planted")) <= 5
    assert len(flagged("clean")) <= 2
    assert 20 in flagged("season") and not {72, 124, 176} & set(flagged("season"))  # expected again a year later
    assert flagged("flat") == [30] and flagged("short") == []
    assert all(r.score is None for (k, _), r in got.items() if k == "short")
    assert len([1 for k, _ in got if k == "gap"]) == 30
    r = got["clean", START + dt.timedelta(7 * 30)]
    level = statistics.median(clean[17:30])
    scale = watch.MAD_SCALE * statistics.median(abs(v - level) for v in clean[17:30])
    assert r.level == pytest.approx(level) and r.scale == pytest.approx(max(scale, 0.01 * level))


def plain_alarm(errors, reference=52, slack=0.5, alarm=5.0):
    ref = errors[:reference]
    m, sd = statistics.fmean(ref), statistics.pstdev(ref)
    s = top = 0.0
    if sd:
        for i, e in enumerate(errors[reference:], reference):
            s = max(0.0, s + (e - m) / sd - slack)
            top = max(top, s)
            if s > alarm:
                return i, top, len(errors) - i - 1
    return None, top, 0


def test_first_alarms(spark):
    rng = random.Random(9)
    series = {"calm": [abs(rng.gauss(0, 1)) for _ in range(150)]}
    series["drift"] = [e + (0.02 * max(0, i - 80)) for i, e in enumerate(series["calm"])]
    series["jump"] = [e * (3 if i >= 100 else 1) for i, e in enumerate(series["calm"])]
    series |= {"alike": [1.0] * 52 + [9.0] * 5, "short": series["calm"][:30]}
    got = {r.k: r for r in watch.first_alarms(frame(spark, series, "e"), ["k"], "e").collect()}
    for k, errors in series.items():
        i, top, after = plain_alarm(errors)
        assert got[k].alarm_week == (None if i is None else START + dt.timedelta(7 * i)), k
        assert got[k].highest == pytest.approx(top) and got[k].weeks_after == after and got[k].n_weeks == len(errors)
    assert got["jump"].alarm_week and got["drift"].alarm_week and got["alike"].alarm_week is None


def test_rolling_origins_and_coverage(spark):
    rng = random.Random(3)
    p = [50.0]
    for _ in range(299):
        p.append(0.9 * p[-1] + 5 + rng.gauss(0, 1))
    df = frame(spark, {"a": p, "b": p[:12]}, "price_usd_per_l").withColumn("cost_pressure", F.lit(0.0))
    coef = [0.9] + [0.0] * (len(FEATURES) - 1)
    models = df.select("k").distinct().withColumn("intercept", F.lit(5.0)).withColumn("coef", F.array(*[F.lit(c) for c in coef]))
    res = watch.rolling_origins(df, models, ["k"], 3)
    rows = {(r.k, (r.origin - START).days // 7, r.step): r for r in res.collect()}
    assert len([1 for k in rows if k[0] == "a"]) == (300 - 10) + (300 - 11) + (300 - 12) and len([1 for k in rows if k[0] == "b"]) == 2 + 1
    one, two = rows["a", 100, 1], rows["a", 100, 2]
    assert one.forecast == pytest.approx(0.9 * p[100] + 5) and two.forecast == pytest.approx(0.9 * (0.9 * p[100] + 5) + 5)
    assert two.actual == p[102] and two.residual == pytest.approx(p[102] - two.forecast)
    cover = {(r.k, r.step): r for r in watch.interval_coverage(res, ["k"], 0.9, 100).collect()}
    for step in (1, 2, 3):
        r = cover["a", step]
        assert r.n_held == 100 and 0.8 <= r.coverage <= 0.98 and r.lower < 0 < r.upper
    assert cover["a", 3].upper - cover["a", 3].lower > cover["a", 1].upper - cover["a", 1].lower
    assert ("b", 1) not in cover  # all of its weeks are held out
