"""Ridge with LOO alpha choice against numpy brute force (closed form and
leave-one-out by refitting)."""

import numpy as np
from pyspark.sql import functions as F

from conftest import SF001
from panelkit.operators.ridge import ALPHAS, fit_ridge
from panelkit.operators.segments import SEGMENT_KEYS
from panelkit.operators.windows import FEATURES
from panelkit.plans.series import segment_features, weekly_segment_features  # noqa: F401
from panelkit.queries.series_q import processed


def ridge_closed(X, y, a):
    xm, ym = X.mean(0), y.mean()
    Z = X - xm
    coef = np.linalg.solve(Z.T @ Z + a * np.eye(X.shape[1]), Z.T @ (y - ym))
    return coef, ym - xm @ coef


def loo_mse(X, y, a):
    errs = []
    for i in range(len(y)):
        m = np.ones(len(y), bool)
        m[i] = False
        c, b = ridge_closed(X[m], y[m], a)
        errs.append(y[i] - (X[i] @ c + b))
    return float(np.mean(np.square(errs)))


def test_ridge_loo_matches_brute_force(spark):
    seg = segment_features(processed(spark, SF001)).where(
        F.col("segment_type").isin("global", "grade"))
    models = fit_ridge(seg, SEGMENT_KEYS, FEATURES, "price_usd_per_l", ALPHAS, 26).collect()
    rows = seg.collect()
    assert len(models) == 4
    for m in models:
        sel = [r for r in rows if (r["segment_type"], r["country"], r["grade"])
               == (m["segment_type"], m["country"], m["grade"])]
        X = np.array([[0.0 if r[c] is None else float(r[c]) for c in FEATURES] for r in sel])
        y = np.array([r["price_usd_per_l"] for r in sel])
        scores = [loo_mse(X, y, a) for a in ALPHAS]
        best = ALPHAS[int(np.argmin(scores))]
        assert abs(m["alpha"] - best) < 1e-12
        coef, icpt = ridge_closed(X, y, best)
        np.testing.assert_allclose(m["coef"], coef, rtol=1e-6, atol=1e-8)
        assert abs(m["intercept"] - icpt) < 1e-6 * max(1, abs(icpt))
        assert abs(m["loo_rmse"] ** 2 - min(scores)) < 1e-8 * max(1, min(scores))


def test_forecast_history_last_and_filters(spark):
    import pytest
    from panelkit.plans.forecast import forecast
    from panelkit.plans.models import train
    p = processed(spark, SF001)
    models = train(p)
    out = forecast(p, models, steps=3, history="last").collect()
    assert out and all(r["segment_type"] == "country_grade" for r in out)
    assert {r["step"] for r in out} == {1, 2, 3}
    one = forecast(p, models, steps=2, country="EUROPE", grade="R", check_empty=True).collect()
    assert one and all(r["country"] in ("EUROPE", None) for r in one)
    with pytest.raises(ValueError):
        forecast(p, models, steps=2, country="NOWHERE", check_empty=True)


def test_monthly_table_and_planning_order(spark):
    from panelkit.plans.forecast import (forecast, monthly_forecast, planning_scenario,
                                         steps_for_months)
    from panelkit.plans.models import train
    p = processed(spark, SF001)
    models = train(p)
    weekly = forecast(p, models, steps=steps_for_months(2))
    monthly = monthly_forecast(weekly, 2).collect()
    per_seg = {}
    for r in monthly:
        per_seg.setdefault((r["segment_type"], r["country"], r["grade"]), []).append(r)
    assert per_seg and all(len(v) == 2 for v in per_seg.values())
    assert all(r["confidence_interval_lower"] <= r["predicted_price_usd_per_liter"]
               <= r["confidence_interval_upper"] for r in monthly)
    plan = planning_scenario(p, models, ["EUROPE", "ASIA"], "R", 15).collect()
    keys = [(r["country"], r["date"]) for r in plan]
    assert keys == sorted(keys) and {r["country"] for r in plan} <= {"EUROPE", "ASIA"}
    assert {r["step"] for r in plan} == {1, 2, 3}
