"""Source / sink round trips under a fresh scratch folder."""

import json
import os
import tempfile
import time

from conftest import SF001
from panelkit.plans.standardize import standardize_freight, standardize_prices
from panelkit.sources import files as S
from panelkit.sources import tables as T


def scratch():
    return tempfile.mkdtemp(prefix="panelkit-test-")


def test_csv_sheet_standardises(spark):
    root = scratch()
    T.price_sheet(spark, SF001).limit(500).coalesce(1).write.option("header", True).csv(f"{root}/p")
    raw = S.read_csv_text(spark, f"{root}/p")
    assert all(t == "string" for _, t in raw.dtypes)
    out = standardize_prices(raw)
    assert out.count() == 500
    assert set(out.columns) >= {"date", "country", "market", "grade", "price_eur_per_l"}


def test_freight_fixture(spark):
    raw = spark.createDataFrame([("2024-01-03", "1400"), ("2024-01-07", "1600"), ("2024-01-08", None)],
                                "`Date` string, `FBX Global` string")
    rows = standardize_freight(raw).collect()
    assert len(rows) == 1 and rows[0]["fbx"] == 1500.0 and str(rows[0]["week_start"]) == "2024-01-01"


def test_snapshot_write_and_latest_with_fallback(spark):
    root = scratch()
    df = spark.createDataFrame([(1, 2.0)], "a int, b double")
    assert S.write_snapshot(df, f"{root}/t", "2024-01-01")
    assert S.write_snapshot(df.union(df), f"{root}/t", "2024-01-08")
    assert not S.write_snapshot(df.limit(0), f"{root}/t", "2024-01-15")
    snap, got = S.read_latest_snapshot(spark, f"{root}/t")
    assert snap == "2024-01-08" and got.count() == 2
    snap, got = S.read_latest_snapshot(spark, f"{root}/t", as_of="2024-01-05")
    assert snap == "2024-01-01" and got.count() == 1


def test_newest_file(spark):
    root = scratch()
    for i, name in enumerate(["a.csv", "b.csv", "c.txt"]):
        with open(os.path.join(root, name), "w") as f:
            f.write("x\n1\n")
        os.utime(os.path.join(root, name), (time.time() + i * 10, time.time() + i * 10))
    assert S.newest_file(spark, root, (".csv",)).endswith("b.csv")


def test_json_payload_shapes(spark):
    docs = ['{"observations":[{"date":"2024-01-02","value":"1.10"},{"date":"2024-01-03","value":"."}]}',
            '{"response":{"data":[{"period":"2024-01-02","value":76.1}]}}',
            '{"response":{"data":[{"date":"2024-01-02","value":"3.90"}]}}',
            '{"response":{"data":[]}}']
    df = spark.createDataFrame([(str(i), d) for i, d in enumerate(docs)], "series_id string, payload string")
    rows = sorted((r["series_id"], r["value"]) for r in S.parse_series_payloads(df).collect())
    assert rows == [("0", 1.10), ("1", 76.1), ("2", 3.90)]


def test_metrics_document_and_model_store(spark):
    m = spark.createDataFrame([("global", None, 0.1, 0.2), ("country", "ES", 0.3, 0.4),
                               ("grade", "EVOO", 0.5, 0.6)],
                              "segment_type string, segment string, mae double, rmse double")
    doc = json.loads(S.metrics_document(m).first()["value"])
    assert doc["global"] == {"mae": 0.1, "rmse": 0.2}
    assert doc["country"]["ES"] == {"mae": 0.3, "rmse": 0.4}
    root = scratch()
    models = spark.createDataFrame([("global_ridge", 1.0)], "model_name string, alpha double")
    S.save_models(models, f"{root}/models")
    loaded = S.load_models(spark, f"{root}/models")
    assert S.select_model(loaded, "global_ridge").count() == 1
    try:
        S.select_model(loaded, "nope")
        raise AssertionError("expected KeyError")
    except KeyError:
        pass


def test_panel_plan_broadcasts_dimensions(spark):
    """P5 joins the weekly macro, freight and tariff tables by broadcast and
    runs no window over the price rows."""
    from panelkit.queries.panel_q import weekly_panel
    qe = weekly_panel(spark, SF001)._jdf.queryExecution()
    plan = qe.executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 3
    assert "Window [" not in qe.optimizedPlan().toString()


def test_file_availability(spark):
    from panelkit.plans.monitoring import file_availability
    root = scratch()
    spark.range(10).repartition(3).write.parquet(f"{root}/t")
    r = file_availability(spark, f"{root}/t").first()
    assert r["n_files"] == 3 and r["n_rows"] == 10 and r["last_modified"] is not None


def test_attach_row_and_null_safe_join(spark):
    from panelkit.operators.joins import attach_row, join_on_keys
    big = spark.range(100).withColumnRenamed("id", "k")
    consts = big.agg({"k": "max"}).withColumnRenamed("max(k)", "mx")
    out = attach_row(big, consts)
    assert out.count() == 100 and out.select("mx").distinct().first()[0] == 99
    left = spark.createDataFrame([(None, 1), ("a", 2)], "g string, v int")
    right = spark.createDataFrame([(None, 10), ("a", 20)], "g string, w int")
    got = sorted((r["v"], r["w"]) for r in join_on_keys(left, right, ["g"]).collect())
    assert got == [(1, 10), (2, 20)]
