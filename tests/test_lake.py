"""End-to-end lake build at sf0.001 into a fresh scratch folder."""

import json
import os
import tempfile

from conftest import SF001
from panelkit.plans.lake import build_lake
from panelkit.sources import files as S


def test_build_lake_end_to_end(spark):
    root = tempfile.mkdtemp(prefix="panelkit-lake-")
    out = build_lake(spark, SF001, root, "2024-02-10", steps=4)
    snap, panel = S.read_latest_snapshot(spark, out["curated/weekly_panel"])
    assert snap == "2024-02-10" and panel.count() > 0
    models = S.load_models(spark, out["mlops/models"])
    assert S.select_model(models, "global_ridge").count() == 1
    fc = spark.read.parquet(out["mlops/forecasts"])
    assert fc.count() == models.count() * 4
    mdir = os.path.join(out["mlops/metrics_json"], "snapshot_date=2024-02-10")
    text = "".join(open(os.path.join(mdir, f)).read() for f in os.listdir(mdir) if f.startswith("part-"))
    doc = json.loads(text)
    assert set(doc) == {"global", "country", "grade", "country_grade"}
    assert doc["global"]["mae"] >= 0
