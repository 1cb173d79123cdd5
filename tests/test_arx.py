"""Differenced autoregressions: the grid, the fits and the forecasts against plain numpy."""

import datetime as dt

import numpy as np
import pytest

from panelkit.operators import arx
from panelkit.plans.models import arx_scores, grid_search
from panelkit.operators.windows import FEATURES, add_series_features

LISTS = {"p": [0, 2], "d": [0, 1], "sp": [0, 1], "sd": [0, 1], "x": [0, 1]}
SEASON = 4


def series(spark, n=60, seed=5):
    rng = np.random.default_rng(seed)
    week = dt.date(2020, 1, 5)
    rows = []
    for key, count in (("a", n), ("b", n // 2), ("short", 13), ("flat", n), ("one", 1)):
        y = np.cumsum(rng.normal(0, 1, count)) + np.sin(np.arange(count) * 2 * np.pi / SEASON) if key != "flat" else np.ones(count)
        x = rng.normal(0, 1, count)
        rows += [(key, week + dt.timedelta(7 * i), float(a), float(b) if i % 9 else None) for i, (a, b) in enumerate(zip(y, x))]
    return spark.createDataFrame(rows, "k string, week_start date, p double, cost_pressure double")


def plain_forecast(y, x, steps, p, d, sp, sd, use_x, largest):
    """Forecasts of one cell by numpy's least squares, None where they cannot be made."""
    diff = arx.difference(d, sd, SEASON)
    z = np.convolve(y, diff, "valid")
    w = np.convolve(x, diff, "valid")
    back = max(largest[0], SEASON * largest[1])
    lags = [*range(1, p + 1), *[SEASON * (j + 1) for j in range(sp)]]
    at = np.arange(back, len(z) - steps)
    if len(at) <= len(lags) + use_x + 1:
        return None
    m = np.column_stack([z[at - i] for i in lags] + [w[at]] * use_x + [np.ones(len(at))])
    if np.linalg.matrix_rank(m - m.mean(0) + np.eye(1, m.shape[1], m.shape[1] - 1)) < m.shape[1]:
        return None
    coef = np.linalg.lstsq(m, z[at], rcond=None)[0]
    ys, zs = list(y[:-steps]), list(z[:-steps])
    for k in range(steps):
        f = sum(c * zs[-i] for c, i in zip(coef, lags)) + (coef[-2] * w[len(zs)] if use_x else 0.0) + coef[-1]
        zs.append(f)
        ys.append(f - sum(c * ys[-i] for i, c in enumerate(diff) if i))
    return np.array(ys[-steps:])


def test_product_of_lists(spark):
    table = arx.parameter_table(spark, {"a": [2, 1, 2], "b": [5], "c": [0, 1], "other": [9]})
    got = sorted(tuple(r) for r in arx.product_grid(table, ["a", "b", "c"]).collect())
    assert got == [(0, 1, 5, 0), (1, 1, 5, 1), (2, 2, 5, 0), (3, 2, 5, 1)]
    assert arx.product_grid(table, ["a", "absent"]).collect() == []


def test_every_cell_against_least_squares(spark):
    df = series(spark)
    models, ahead = arx.arx_grid(df, ["k"], "p", "cost_pressure", LISTS, 5, SEASON)
    cells = {(r.k, r.cell): r for r in models.collect()}
    got = {}
    for r in ahead.orderBy("step").collect():
        got.setdefault((r.k, r.cell), []).append(r.forecast)
    data = {}
    for r in df.orderBy("week_start").collect():
        data.setdefault(r.k, []).append((r.p, r.cost_pressure or 0.0))
    fitted = 0
    for (k, cell), r in cells.items():
        y, x = np.array(data[k]).T
        want = plain_forecast(y, x, 5, r.p, r.d, r.sp, r.sd, r.x, (2, 1))
        if want is None:
            assert (k, cell) not in got and r.problem is not None and r.const is None
        else:
            fitted += 1
            assert got[k, cell] == pytest.approx(want, abs=1e-8)
    assert fitted >= 2 * 32 and {k for k, _ in cells} == {"a", "b", "flat", "short"}
    assert {r.problem for r in cells.values() if r.k == "flat"} == {None, "singular"}


def test_failures_keep_empty_scores_and_the_best_cell_wins(spark):
    df = series(spark, 200)
    scores = {(r.k, r.cell): r for r in arx_scores(df, ["k"], "p", lists={**arx.ORDERS}, holdout=12).collect()}
    assert len(scores) == 4 * 4  # "one" has no training week
    assert all(r.mae is None for (k, _), r in scores.items() if k in ("short", "b"))
    assert all(r.mae is not None and r.n_holdout == 12 for (k, _), r in scores.items() if k == "a")
    feats = add_series_features(df, ["k"], "week_start", "p")
    best = {r.k: r for r in grid_search(feats, ["k"], FEATURES, "p").collect()}
    assert best["a"].n_candidates == 20 + 3 + 4
    assert best["a"].mae <= min(r.mae for (k, _), r in scores.items() if k == "a") + 1e-9
