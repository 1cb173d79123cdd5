"""The lake build and train/evaluate flow as one sequence of Spark jobs.

Each layer is written as a snapshot partition and the next job reads it
back from storage (as the reference's jobs hand over through object
storage), which also cuts the lineage: a lost executor costs at most the
current layer, never a recomputation from the raw tables.

    raw sheets -> processed (prices, freight, tariffs, macros)
               -> curated weekly panel -> features / model features
               -> mlops: processed series, models, metrics, forecasts
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import files as S
from ..sources import tables as T
from .features import build_features, model_features
from .forecast import forecast
from .macros import macro_grid, weekly_long, wide_by_week
from .models import evaluate, quality_gate, segment_label, train
from .panel import build_weekly_panel
from .series import preprocess
from .standardize import normalize_tariffs, standardize_freight, standardize_prices


@dataclass
class LakePaths:
    root: str

    def layer(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


def macro_series(spark: SparkSession, roots: dict[str, str], snapshot: str) -> DataFrame:
    """Long (series, date, value) rows of each series' newest snapshot that has any; a series
    falls back on its own, and one without any snapshot is absent."""
    found = S.read_series_snapshots(spark, roots, as_of=snapshot)
    parts = [df.select(F.lit(name).alias("series"), "date", "value") for name, df in found.items() if df is not None]
    if not parts:
        raise FileNotFoundError(f"no snapshot of any of {sorted(roots)}")
    return reduce(DataFrame.unionByName, parts)


def build_lake(spark: SparkSession, sf_dir: str, root: str, snapshot: str, steps: int = 12,
               price_csv_dir: str | None = None, series_roots: dict[str, str] | None = None) -> dict[str, str]:
    """Run P1-P10 for one snapshot; returns the written locations.

    ``price_csv_dir``: take the prices from the newest landed CSV there; ``series_roots``: take
    the macro series from their own snapshot folders.  An empty layer is an error (F12).
    """
    paths = LakePaths(root)
    out = {}

    def put(name, df, sort_cols=()):
        if not S.write_snapshot(df, paths.layer(name), snapshot, sort_cols=sort_cols):
            raise ValueError(f"{name} has no rows for {snapshot}")
        out[name] = paths.layer(name)

    def get(name):
        return S.read_latest_snapshot(spark, paths.layer(name), as_of=snapshot)[1].drop(
            "snapshot_date")

    # raw -> processed layer
    sheet = S.read_newest_csv(spark, price_csv_dir) if price_csv_dir else T.price_sheet(spark, sf_dir)
    put("processed/eu_prices", standardize_prices(sheet), ["date"])
    put("processed/fbx", standardize_freight(T.freight_sheet(spark, sf_dir)), ["week_start"])
    put("processed/tariffs", normalize_tariffs(T.tariff_sheet(spark, sf_dir), keep_order=True))
    long = weekly_long(macro_series(spark, series_roots, snapshot) if series_roots
                       else T.macro_observations(spark, sf_dir))
    put("processed/macros_weekly", wide_by_week(long), ["week_start"])
    put("processed/macros_grid", macro_grid(long), ["week_start"])

    # processed -> curated panel -> features
    panel = build_weekly_panel(get("processed/eu_prices"), get("processed/macros_weekly"),
                               get("processed/fbx"), get("processed/tariffs"), snapshot)
    put("curated/weekly_panel", panel, ["week_start", "country", "market", "grade"])
    feats = build_features(get("curated/weekly_panel"), snapshot)
    put("features/weekly_panel", feats, ["week_start", "country", "market", "grade"])
    put("features/model_features", model_features(get("features/weekly_panel")))

    # mlops: preprocess -> train -> evaluate -> gate -> forecast
    put("mlops/processed", preprocess(get("features/weekly_panel")))
    processed = get("mlops/processed")
    put("mlops/models", train(processed))
    models = get("mlops/models")
    metrics = evaluate(processed, models)
    put("mlops/metrics", metrics)
    S.write_metrics_json(segment_label(get("mlops/metrics")),
                         paths.layer(f"mlops/metrics_json/snapshot_date={snapshot}"))
    out["mlops/metrics_json"] = paths.layer("mlops/metrics_json")
    put("mlops/approved_models", quality_gate(get("mlops/metrics"), models))
    put("mlops/forecasts", forecast(processed, models, steps=steps))
    return out
