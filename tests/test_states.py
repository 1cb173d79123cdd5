"""Mergeable states, single evaluation and committed snapshots."""

import os
import random
import re
import statistics

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from panelkit.catalog import load_all
from panelkit.operators import states as M
from panelkit.plans.panel import merged_week_states, panel_constants, price_week_state
from panelkit.plans.series import weekly_prices
from panelkit.plans.standardize import standardize_prices
from panelkit.sources import files as S
from panelkit.sources import tables as T


def executed_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_merged_moments_equal_those_of_the_whole(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(6), rng.gauss(1e6, 1) if rng.random() < 0.9 else None) for _ in range(500)] + [(7, None), (8, 5.0)]
    parts = spark.createDataFrame(rows, "part int, v double").groupBy("part").agg(M.moment_state("v").alias("state"))
    got = parts.agg(M.merged_moments("state").alias("s")).select(
        "s.n", M.mean_of("s").alias("mean"), M.std_of("s").alias("std"), M.std_of("s", 0).alias("pop")).first()
    values = [v for _, v in rows if v is not None]
    assert got.n == len(values) and got.mean == pytest.approx(statistics.fmean(values), rel=1e-14)
    assert got.std == pytest.approx(statistics.stdev(values), rel=1e-9)
    assert got.pop == pytest.approx(statistics.pstdev(values), rel=1e-9)
    none = parts.where("part = 7").agg(M.merged_moments("state").alias("s")).select(M.mean_of("s").alias("m"), M.std_of("s").alias("d")).first()
    assert none.m is None and none.d is None
    one = parts.where("part = 8").agg(M.merged_moments("state").alias("s")).select(M.mean_of("s").alias("m"), M.std_of("s").alias("d")).first()
    assert one.m == 5.0 and one.d is None


def test_panel_constants_read_no_price_row(spark):
    """Constants of a kept state equal those over the joined rows, weeks without a rate left out."""
    prices = spark.sql("select to_timestamp(d) as date, cast(p as double) as price_eur_per_l from values "
                       "('2024-01-01', 1), ('2024-01-03', 4), ('2024-01-09', 2), ('2024-01-16', 9) t(d, p)")
    macros = spark.sql("select to_date(d) as week_start, cast(u as double) as usd_per_eur, cast(g as double) as diesel_usd_per_gal "
                       "from values ('2024-01-01', 2, 3), ('2024-01-08', 3, null) t(d, u, g)")
    merged = merged_week_states(price_week_state(prices.limit(3)).unionByName(price_week_state(prices.limit(3).where("1 = 0")))
                                .unionByName(price_week_state(prices.where("price_eur_per_l = 9"))))
    row = panel_constants(merged, macros).first()
    assert row._diesel_mean == 3.0 and row._base_mean == pytest.approx(16 / 3)
    assert row._base_std == pytest.approx(statistics.stdev([2.0, 8.0, 6.0]))


def test_profiles_of_parts(spark):
    rng = random.Random(2)
    rows = [(i % 5, rng.expovariate(1), None if i % 3 else float(i)) for i in range(20_000)]
    df = spark.createDataFrame(rows, "part int, x double, y double").withColumn("none", F.lit(None).cast("double"))
    parts = M.profile_state(df, ["x", "y", "none"], ["part"])
    assert parts.count() == 15
    whole = {r.column_name: r for r in M.profile_of(M.merged_profiles(parts)).collect()}
    xs = [r[1] for r in rows]
    assert whole["x"]["count"] == 20_000 and whole["x"].mean == pytest.approx(statistics.fmean(xs))
    assert whole["x"].std == pytest.approx(statistics.stdev(xs)) and (whole["x"].min, whole["x"].max) == (min(xs), max(xs))
    assert whole["none"]["count"] == 0 and whole["none"].p50 is None and whole["none"].mean is None
    errors = {r.column_name: r for r in M.rank_errors(df, M.profile_of(M.merged_profiles(parts)), ["x", "y"], [0.25, 0.5, 0.75]).collect()}
    for c in ("x", "y"):
        assert 0 <= max(errors[c].p25_error, errors[c].p50_error, errors[c].p75_error) <= M.RANK_ERROR
    per_two = M.profile_of(M.merged_profiles(parts.withColumn("half", F.col("part") % 2), ["half"]), ["half"])
    assert sorted(r["count"] for r in per_two.where("column_name = 'x'").collect()) == [8000, 12000]


def test_a_date_is_parsed_once_per_row(spark):
    """The price job's parses: one per written form, however many jobs above filter and group by the date."""
    def parses(df):
        return len(re.findall(r"gettimestamp\(", df._jdf.queryExecution().optimizedPlan().toString()))

    sheet = T.price_sheet(spark, SF001)
    one = parses(standardize_prices(sheet))
    assert 14 <= one <= 28 and parses(weekly_prices(standardize_prices(sheet))) == one


@pytest.mark.parametrize("name", ["weekly_panel", "distribution_profile"])
def test_facts_are_scanned_once(spark, name, monkeypatch):
    """The panel and its profile read what was stored; the facts are scanned by the storing job alone."""
    import panelkit.queries.features_q as features_q
    import panelkit.queries.panel_q as panel_q
    import panelkit.session as session
    scans = []
    stored = session.stored
    for module in (panel_q, session):
        monkeypatch.setattr(module, "stored", lambda df, n="stored": (scans.append(executed_plan(df).count("l_shipdate")), stored(df, n))[1])
    assert features_q
    df = load_all()[name].build(spark, SF001)
    assert executed_plan(df).count("lineitem.parquet") == 0
    assert sum(s > 0 for s in scans) == 1


def test_a_write_that_dies_leaves_the_former_snapshot(spark, tmp_path):
    root = str(tmp_path)
    two = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert S.write_snapshot(two, root, "2024-01-01")
    assert S.write_snapshot(two.limit(1), root, "2024-02-01")
    # dies in the middle of its tasks, over an older and over a new snapshot
    bad = spark.range(100).repartition(4).select(F.col("id").cast("int").alias("k"), F.when(
        F.col("id") < 90, F.lit("x")).otherwise(F.raise_error(F.lit("lost"))).cast("string").alias("v"))
    for snap in ("2024-02-01", "2024-03-01"):
        with pytest.raises(Exception, match="lost"):
            S.write_snapshot(bad, root, snap)
    # dies after its data, before its manifest
    two.write.mode("append").parquet(f"{root}/snapshot_date=2024-02-01")
    two.write.mode("append").parquet(f"{root}/snapshot_date=2024-04-01")
    snap, df = S.read_latest_snapshot(spark, root)
    assert snap == "2024-02-01" and [tuple(r)[:2] for r in df.collect()] == [(1, "a")]
    assert S.read_latest_snapshot(spark, root, committed=False)[0] == "2024-04-01"
    # the next whole write takes over and clears away what no manifest names
    assert S.write_snapshot(two, root, "2024-02-01")
    assert S.read_latest_snapshot(spark, root)[1].count() == 2
    manifest = S.read_manifest(spark, f"{root}/snapshot_date=2024-02-01")
    data = [n for n in os.listdir(f"{root}/snapshot_date=2024-02-01") if n.endswith(".parquet")]
    assert manifest["rows"] == 2 and sorted(manifest["files"]) == sorted(data)


def test_a_damaged_snapshot_falls_back(spark, tmp_path):
    root = str(tmp_path)
    df = spark.range(5)
    assert S.write_snapshot(df, root, "2024-01-01") and S.write_snapshot(df, root, "2024-01-08")
    assert not S.write_snapshot(df.limit(0), root, "2024-01-15")
    assert S.write_snapshot(df.limit(0), root, "2024-01-22", skip_empty=False)
    folder = f"{root}/snapshot_date=2024-01-08"
    os.remove(next(f"{folder}/{n}" for n in os.listdir(folder) if n.endswith(".parquet")))
    assert S.read_latest_snapshot(spark, root)[0] == "2024-01-01"
    assert S.read_latest_snapshot(spark, root, skip_empty=False)[0] == "2024-01-22"
    assert S.read_series_snapshots(spark, {"a": f"{root}/none"}) == {"a": None}
