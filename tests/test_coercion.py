"""Text coercion against pandas / datetime, storage listings, empty inputs, plan shape."""

import datetime as dt
import os
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from panelkit.functions import calendar as cal
from panelkit.functions.coerce import nan_to_null, parse_date_text, to_double
from panelkit.plans.features import usable_rows
from panelkit.plans.insights import price_change
from panelkit.plans.models import grid_search, ols_drivers, ols_level_means
from panelkit.plans.panel import join_tariffs
from panelkit.operators.aggregates import error_metrics
from panelkit.sources import files as S
from panelkit.sources.headers import require_columns
from panelkit.sources.tables import price_observations

DATES = {
    "2024-03-04": "2024-03-04", "03/04/2024": "2024-03-04", "3/4/2024": "2024-03-04", "03.04.2024": "2024-03-04",
    "13/04/2024": "2024-04-13", "2024-01-05T00:00:00Z": "2024-01-05", "2024-01-05 10:11:12.5": "2024-01-05 10:11:12.5",
    "Jan 5, 2024": "2024-01-05", "2024-1-5": "2024-01-05", "20240105": "2024-01-05", "2024/01/05 07:08": "2024-01-05 07:08",
    " 2024-01-05T01:02:03+02:00 ": "2024-01-04 23:02:03", "5 January 2024": "2024-01-05", "junk": None, "": None, None: None,
    "2024-13-45": None,
}


def test_date_texts(spark):
    df = spark.createDataFrame([(k,) for k in DATES], "t string")
    got = {r.t: r.d for r in df.select("t", parse_date_text("t").alias("d")).collect()}
    assert got == {k: None if v is None else dt.datetime.fromisoformat(v) for k, v in DATES.items()}
    both = df.where("t = '03/04/2024'").select(parse_date_text("t", dayfirst=True), cal.to_timestamp_multi(F.col("t"))).first()
    assert both == (dt.datetime(2024, 4, 3), dt.datetime(2024, 3, 4))


def test_number_texts_like_pandas(spark):
    texts = ["1", " 2.5 ", "-3e2", "+.5", "12d", "5F", "0x1p3", "abc", "", "inf", "-Infinity", "nan", "1,000", "7f", "1e", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(to_double("t")).collect()]
    want = pd.to_numeric(pd.Series(texts), errors="coerce")
    assert [None if pd.isna(w) else w for w in want] == got


def test_iso_week_junk_gives_null(spark):
    rows = [("2024", "1"), ("x", "1"), ("2024", "99999999999"), ("99999999999", "1"), ("2024", "54"), ("2020", "53"), (None, "1")]
    df = spark.createDataFrame(rows, "y string, w string")
    got = [r[0] for r in df.select(cal.iso_week_start(F.col("y"), F.col("w"))).collect()]
    assert got == [dt.date(2024, 1, 1), None, None, None, None, dt.date(2020, 12, 28), None]


def test_nan_is_missing_at_the_sources(spark):
    df = nan_to_null(spark.createDataFrame([(1.0,), (float("nan"),), (3.0,)], "x double"))
    assert df.agg(F.avg("x")).first()[0] == 2.0


def test_tariff_of_the_own_grade(spark):
    prices = spark.createDataFrame([("EVOO", "1509"), ("LAMPANTE", "1509"), ("EVOO", "9")], "grade_norm string, hs_prefix string")
    tariffs = spark.createDataFrame([("EVOO", "1509", 1.0, 0.1, 1), ("VIRGIN", "1509", 7.0, 0.2, 2), (None, "1509", 3.0, None, 0)],
                                    "grade string, hs_prefix string, adval_pct double, specific_usd_per_kg double, row_order int")
    got = {(r.grade_norm, r.hs_prefix): (r.adval_pct, r.specific_usd_per_kg) for r in join_tariffs(prices, tariffs).collect()}
    assert got == {("EVOO", "1509"): (1.0, 0.1), ("LAMPANTE", "1509"): (7.0, 0.2), ("EVOO", "9"): (None, None)}


def test_mape_of_all_zero_actuals_is_zero(spark):
    df = spark.createDataFrame([("a", 1.0, 0.0)], "k string, p double, y double")
    assert error_metrics(df, ["k"], "p", "y").first().mape == 0.0


def test_snapshots_by_listing(spark, tmp_path):
    root = f"{tmp_path}/t"
    for d, n in (("2024-01-01", 2), ("2024-02-01", 3)):
        S.write_snapshot(spark.range(n), root, d)
    os.makedirs(f"{root}/snapshot_date=2024-03-01")  # newest, without data
    assert S.snapshot_dates(spark, root) == ["2024-03-01", "2024-02-01", "2024-01-01"]
    snap, df = S.read_latest_snapshot(spark, root)
    assert snap == "2024-02-01" and df.count() == 3
    assert S.read_latest_snapshot(spark, root, as_of="2024-01-31")[0] == "2024-01-01"
    found = S.read_series_snapshots(spark, {"a": root, "b": f"{tmp_path}/none"})
    assert found["a"].count() == 3 and found["b"] is None
    with pytest.raises(FileNotFoundError):
        S.read_latest_snapshot(spark, root, as_of="2023-01-01")


def test_newest_csv_even_if_empty(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    time.sleep(0.05)
    assert S.read_newest_csv(spark, str(tmp_path)).count() == 1
    (tmp_path / "b.csv").write_text("")
    os.utime(tmp_path / "b.csv", (time.time() + 60, time.time() + 60))
    assert S.newest_file(spark, str(tmp_path)).endswith("b.csv")
    with pytest.raises(ValueError):
        S.read_newest_csv(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        S.read_newest_csv(spark, str(tmp_path / "none-here") if (tmp_path / "none-here").mkdir() else str(tmp_path / "none-here"))


def test_missing_columns_raise(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError):
        require_columns(df, ["a", "b"], "sheet")
    with pytest.raises(ValueError):
        usable_rows(df, "2024-01-01")


def test_ols_against_least_squares(spark):
    import numpy as np
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"x": rng.normal(size=200), "g": rng.choice(list("abc"), 200)})
    pdf["y"] = 2 + 3 * pdf.x + pdf.g.map({"a": 0.0, "b": 1.0, "c": -1.0}) + rng.normal(size=200) * 0.1
    table = {r.term: r for r in ols_drivers(spark.createDataFrame(pdf), "y", ["x"], ["g"]).collect()}
    design = np.column_stack([pdf.x, pdf.g == "b", pdf.g == "c", np.ones(200)]).astype(float)
    beta, rss, *_ = np.linalg.lstsq(design, pdf.y.to_numpy(), rcond=None)
    assert np.allclose([table[t].coef for t in ("x", "g_b", "g_c", "Intercept")], beta)
    se = np.sqrt(np.diag(np.linalg.inv(design.T @ design)) * rss[0] / 196)
    assert np.allclose([table[t].std_error for t in ("x", "g_b", "g_c", "Intercept")], se)
    assert abs(table["x"].r2 - (1 - rss[0] / ((pdf.y - pdf.y.mean()) ** 2).sum())) < 1e-9 and table["x"].p_value < 1e-9


def test_ols_reads_its_rows_once(spark):
    """One pass for levels and products, one for the residuals; level means as numpy has them."""
    import numpy as np
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"x": rng.normal(50, 9, 300), "z": rng.normal(size=300), "g": rng.choice(list("abc"), 300)})
    pdf["h"] = pdf.g + rng.choice(["1", "2"], 300)  # levels of h lie within those of g
    pdf["y"] = 2 + 3 * pdf.x - pdf.z + rng.normal(size=300)
    pdf.loc[7, "x"], pdf.loc[9, "h"], pdf.loc[11, "y"] = np.nan, None, np.nan
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(len(b))
            yield b

    df = spark.createDataFrame(pdf).mapInPandas(counted, "x double, z double, g string, h string, y double")
    table = spark.createDataFrame(ols_drivers(df, "y", ["x", "z"], ["g", "h"]).collect())
    assert read.value == 300
    used = pdf.dropna()
    coef = {r.term: r.coef for r in table.collect()}
    off = {"x": 0.0, "z": 0.5, "g_b": 0.25}  # a model that is not the fit leaves means of its own
    other = spark.createDataFrame([(t, c + off.get(t, 0.0)) for t, c in coef.items()], "term string, coef double")
    for model, slope in ((table, coef), (other, {t: c + off.get(t, 0.0) for t, c in coef.items()})):
        e = used.y - slope["Intercept"] - slope["x"] * used.x - slope["z"] * used.z - used.g.map(
            lambda v: slope.get(f"g_{v}", 0.0)) - used.h.map(lambda v: slope.get(f"h_{v}", 0.0))
        want = {(c, v): (len(x), x.mean()) for c in "gh" for v, x in e.groupby(used[c])}
        got = {(r.term, r.level): (r.n, r.mean_residual) for r in ols_level_means(df, model, "y", ["x", "z"], ["g", "h"]).collect()}
        assert got.keys() == want.keys()
        assert all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-9 for k in want)
    assert all(abs(r.mean_residual) < 1e-9 for r in ols_level_means(df, table, "y", ["x", "z"], ["g", "h"]).collect())


def test_part_codes_are_made_below_the_join(spark):
    """A part's HS code and pack are made once a part, not once a line item."""
    plan = price_observations(spark, SF001)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    joins = [i for i, x in enumerate(plan) if "Join" in x]
    assert all(i > joins[0] for i, x in enumerate(plan) if "regexp_replace" in x or "STANDARD" in x)


def test_grid_search_sees_no_held_out_price(spark):
    weeks = [dt.date(2020, 1, 5) + dt.timedelta(days=7 * i) for i in range(90)]
    rows = [("s", w, float(i), 1.0) for i, w in enumerate(weeks)]
    df = spark.createDataFrame(rows, "k string, week_start date, p double, cost_pressure double")
    from panelkit.operators.windows import FEATURES, add_series_features
    feats = add_series_features(df, ["k"], "week_start", "p")
    best = grid_search(feats, ["k"], FEATURES, "p", holdout=12).first()
    assert best.n_candidates == 23 and best.best_candidate == "drift" and best.mae < 1e-9


def test_price_change_of_one_country(spark):
    rows = [(c, dt.date(2020, 1, 5) + dt.timedelta(days=7 * i), float(p)) for c, p0 in (("a", 1), ("b", 2))
            for i, p in enumerate([p0] * 12 + [p0 * 1.5] * 12)]
    df = spark.createDataFrame(rows, "country string, week_start date, price_usd_per_l double")
    got = price_change(df, "a").collect()
    assert [(r.country, r.previous_price, r.current_price, r.change_percent, r.direction) for r in got] == [("a", 1.0, 1.5, 50.0, "increasing")]


def test_processed_scans_the_facts_once_and_plans_run_no_job(spark):
    from panelkit.queries.panel_q import panel_inputs
    from panelkit.plans.panel import build_weekly_panel
    from panelkit.plans.series import preprocess_weekly, weekly_drivers, weekly_prices
    jobs = spark.sparkContext.statusTracker()
    before = len(jobs.getJobIdsForGroup(None))
    prices, macros, freight, tariffs = panel_inputs(spark, SF001)
    build_weekly_panel(prices, macros, freight, tariffs, "2024-02-10")
    weekly = weekly_prices(prices)
    out = preprocess_weekly(weekly, weekly_drivers(macros, freight))
    reads = 8  # reading a table's footer for its schema is a job: lineitem, supplier, nation, ...
    assert len(jobs.getJobIdsForGroup(None)) <= before + reads
    assert out.columns[:2] == ["week_start", "price_usd_per_l"]
    assert weekly._jdf.queryExecution().executedPlan().toString().count("l_shipdate") > 0
    scans = [x for x in weekly._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Relation" in x and "l_shipdate" in x]
    assert len(scans) == 1


def test_weekly_reduction_equals_row_wise_preprocess(spark):
    from panelkit.queries.features_q import features
    from panelkit.queries.series_q import processed
    from panelkit.plans.series import preprocess
    cols = ["country", "market", "grade", "week_start", "price_usd_per_l", "cost_pressure", "lag1week", "rolling10"]
    a = {tuple(r)[:4]: tuple(r)[4:] for r in processed(spark, SF001).select(*cols).collect()}
    b = {tuple(r)[:4]: tuple(r)[4:] for r in preprocess(features(spark, SF001)).select(*cols).collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert all((x is None) == (y is None) and (x is None or abs(x - y) < 1e-9) for x, y in zip(a[k], b[k]))


def test_macro_series_fall_back_one_by_one(spark, tmp_path):
    from panelkit.plans.lake import macro_series
    rows = spark.createDataFrame([(dt.date(2024, 1, 1), 1.0)], "date date, value double")
    for name, snaps in (("a", ["2024-01-01", "2024-02-01"]), ("b", ["2024-01-01"])):
        for d in snaps:
            S.write_snapshot(rows.withColumn("value", F.lit(1.0 if d < "2024-02" else 2.0)), f"{tmp_path}/{name}", d)
    S.write_snapshot(rows.limit(0), f"{tmp_path}/b", "2024-02-01", skip_empty=False)
    roots = {n: f"{tmp_path}/{n}" for n in ("a", "b", "c")}
    got = {r.series: r.value for r in macro_series(spark, roots, "2024-12-31").collect()}
    assert got == {"a": 2.0, "b": 1.0}
    assert {r.series: r.value for r in macro_series(spark, roots, "2024-01-15").collect()} == {"a": 1.0, "b": 1.0}
    with pytest.raises(FileNotFoundError):
        macro_series(spark, {"c": f"{tmp_path}/c"}, "2024-12-31")
