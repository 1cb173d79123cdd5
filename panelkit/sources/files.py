"""File sources and sinks.

Snapshot layout: ``<root>/snapshot_date=YYYY-MM-DD/part-*.parquet`` (Hive
style) with a manifest per finished write; readers take the files that the newest manifest names.
All paths must be on shared storage when run on a cluster.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..functions.coerce import parse_date_text, to_double


# S2 ------------------------------------------------------------------------
def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, every column read as text; typing is done by the
    coercion expressions (bad values -> NULL rather than a failed job)."""
    return (spark.read.option("header", True).option("inferSchema", False)
            .option("mode", "PERMISSIVE").csv(path))


# S3 ------------------------------------------------------------------------
SNAPSHOT_DIR = "snapshot_date="
MANIFEST = "_manifest-"


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, path object) of a path."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def snapshot_dates(spark: SparkSession, root: str) -> list[str]:
    """Snapshot dates present under ``root``, newest first: one directory listing, no data read.  A root that
    does not exist has none; any other fault of the storage is raised."""
    fs, path = file_system(spark, root)
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]
    return sorted((n[len(SNAPSHOT_DIR):] for n in names if n.startswith(SNAPSHOT_DIR)), reverse=True)


def read_manifest(spark: SparkSession, folder: str) -> dict | None:
    """The newest manifest of a snapshot folder whose files are all there in full; None without one.

    A manifest (version, rows, schema, files with their sizes) is written when all data of a write are
    in place.  Files that none names come from a write that did not finish, and are not read."""
    fs, path = file_system(spark, folder)
    if not fs.exists(path):
        return None
    sizes, manifests = {}, []
    for s in fs.listStatus(path):
        name = s.getPath().getName()
        sizes[name] = s.getLen()
        if name.startswith(MANIFEST) and name.endswith(".json"):
            manifests.append(s.getPath())
    for m in sorted(manifests, key=lambda m: m.getName(), reverse=True):
        stream = fs.open(m)
        try:
            found = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        if all(sizes.get(name) == size for name, size in found["files"].items()):
            return found
    return None


def read_latest_snapshot(spark: SparkSession, root: str, as_of: str | None = None, skip_empty: bool = True,
                         committed: bool = True) -> tuple[str, DataFrame]:
    """Resolve the newest committed snapshot (optionally not after ``as_of``) and read the files that its
    manifest names, with the schema it states.

    With ``skip_empty`` a snapshot without rows falls back to the previous one (the reference's
    fallback), as one without a manifest does; its rows are known without reading any.
    ``committed=False`` is for folders that other tools landed without manifests: any directory with
    data files counts, and one row per candidate is read.
    """
    for snap in snapshot_dates(spark, root):
        if as_of is not None and snap > as_of:
            continue
        folder = f"{root}/{SNAPSHOT_DIR}{snap}"
        reader = spark.read.option("basePath", root)
        if committed:
            found = read_manifest(spark, folder)
            if found and found["files"] and (found["rows"] or not skip_empty):
                schema = StructType.fromJson(found["schema"])
                return snap, reader.schema(schema).parquet(*[f"{folder}/{name}" for name in found["files"]])
            continue
        try:
            df = reader.parquet(folder)
        except AnalysisException:  # a directory without any data file
            continue
        if not skip_empty or df.limit(1).count() > 0:
            return snap, df
    raise FileNotFoundError(f"No committed, non-empty snapshot under {root}" if committed
                            else f"No non-empty snapshot under {root}")


def read_series_snapshots(spark: SparkSession, roots: dict[str, str], as_of: str | None = None,
                          committed: bool = True) -> dict[str, DataFrame | None]:
    """Newest non-empty snapshot of each series; each falls back on its own, and a series
    without any is None."""
    found = {}
    for name, root in roots.items():
        try:
            found[name] = read_latest_snapshot(spark, root, as_of, committed=committed)[1]
        except FileNotFoundError:
            found[name] = None
    return found


# S4 ------------------------------------------------------------------------
def newest_file(spark: SparkSession, directory: str,
                suffixes: Iterable[str] = (".csv",)) -> str | None:
    """Newest file by modification time among those with a suffix, empty files included: a
    directory listing, no content read (a scan would leave empty files out)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(directory)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True)
    best = None
    while files.hasNext():
        f = files.next()
        name = f.getPath().toString()
        if name.endswith(tuple(suffixes)) and (best is None or (f.getModificationTime(), name) > best):
            best = (f.getModificationTime(), name)
    return best[1] if best else None


def read_newest_csv(spark: SparkSession, directory: str) -> DataFrame:
    """S4 + S2: the newest landed CSV sheet; an error if there is none or it has no rows."""
    path = newest_file(spark, directory)
    if path is None:
        raise FileNotFoundError(f"No CSV file under {directory}")
    sheet = read_csv_text(spark, path)
    if not sheet.columns or sheet.limit(1).count() == 0:
        raise ValueError(f"{path} has no rows")
    return sheet


# S5 ------------------------------------------------------------------------
PAYLOAD_SCHEMA = StructType([
    StructField("observations", ArrayType(StructType([
        StructField("date", StringType()), StructField("value", StringType())]))),
    StructField("response", StructType([
        StructField("data", ArrayType(StructType([
            StructField("period", StringType()), StructField("date", StringType()),
            StructField("value", StringType())])))])),
])


def parse_series_payloads(df: DataFrame, payload_col: str = "payload",
                          keys: Iterable[str] = ("series_id",)) -> DataFrame:
    """JSON payloads of both API shapes -> (keys..., date, value) rows.

    ``observations[]`` carries date/value; ``response.data[]`` carries
    period or date.  Values are text or numbers; '.' and other junk -> NULL
    and the row is dropped, as are rows without a date.
    """
    keys = list(keys)
    parsed = df.select(*keys, F.from_json(payload_col, PAYLOAD_SCHEMA).alias("_j"))
    obs = parsed.select(*keys, F.inline_outer(
        F.transform(F.coalesce(F.col("_j.observations"), F.array()),
                    lambda o: F.struct(o["date"].alias("d"), o["value"].alias("v")))))
    resp = parsed.select(*keys, F.inline_outer(
        F.transform(F.coalesce(F.col("_j.response.data"), F.array()),
                    lambda o: F.struct(F.coalesce(o["period"], o["date"]).alias("d"),
                                       o["value"].alias("v")))))
    rows = obs.unionByName(resp)
    out = rows.select(*keys, parse_date_text(F.col("d")).alias("date"),
                      to_double(F.col("v")).alias("value"))
    return out.dropna(subset=["date", "value"])


# S6 ------------------------------------------------------------------------
def write_snapshot(df: DataFrame, root: str, snapshot: str, skip_empty: bool = True,
                   sort_cols: Iterable[str] = ()) -> bool:
    """Write one snapshot and commit it; False (and nothing committed) if ``skip_empty`` and there are no rows.

    Data files are added beside those of earlier writes, counted by the job that writes them, and become
    the snapshot when the manifest is renamed into place; then earlier files go.  A write that dies before
    that leaves the former snapshot as it was.  Rows are sorted within each file, not globally.
    """
    spark = df.sparkSession
    folder = f"{root}/{SNAPSHOT_DIR}{snapshot}"
    fs, path = file_system(spark, folder)
    known = {s.getPath().getName() for s in fs.listStatus(path)} if fs.exists(path) else set()
    rows = Observation()
    out = df.drop("snapshot_date").observe(rows, F.count(F.lit(1)).alias("rows"))
    sort_cols = list(sort_cols)
    if sort_cols:
        out = out.sortWithinPartitions(*sort_cols)
    out.write.mode("append").parquet(folder)
    new = {s.getPath().getName(): s.getLen() for s in fs.listStatus(path)
           if s.isFile() and s.getPath().getName() not in known and not s.getPath().getName().startswith(("_", "."))}
    n = rows.get["rows"]
    if skip_empty and not n:
        remove_files(spark, folder, new)
        return False
    version = 1 + max([int(name[len(MANIFEST):-len(".json")]) for name in known
                       if name.startswith(MANIFEST) and name.endswith(".json")], default=0)
    commit_manifest(spark, folder, version, {"version": version, "rows": n, "schema": out.schema.jsonValue(), "files": new})
    remove_files(spark, folder, [name for name in known if not name.startswith(MANIFEST) or name.endswith(".json")])
    return True


def commit_manifest(spark: SparkSession, folder: str, version: int, manifest: dict) -> None:
    """Write a manifest under a name that no reader looks at, then rename it."""
    fs, hidden = file_system(spark, f"{folder}/_{uuid.uuid4().hex}.tmp")
    stream = fs.create(hidden, True)
    stream.write(bytearray(json.dumps(manifest).encode()))
    stream.close()
    _, final = file_system(spark, f"{folder}/{MANIFEST}{version:08d}.json")
    if not fs.rename(hidden, final):
        raise OSError(f"cannot commit version {version} of {folder}: another write has")


def remove_files(spark: SparkSession, folder: str, names: Iterable[str]) -> None:
    """Delete files of a snapshot folder that no manifest in force names."""
    for name in names:
        fs, path = file_system(spark, f"{folder}/{name}")
        fs.delete(path, False)


# S7 ------------------------------------------------------------------------
def metrics_document(metrics: DataFrame,
                     types=("country", "grade", "country_grade")) -> DataFrame:
    """Long metrics (segment_type, segment, mae, rmse) -> one JSON text
    row ``{"global": {...}, "country": {k: {...}}, ...}``.

    The document holds one entry per segment (bounded by the number of
    models), so building it in the final single task is safe.
    """
    val = F.struct("mae", "rmse")
    parts = [F.first(F.when(F.col("segment_type") == "global", val), ignorenulls=True)
             .alias("global")]
    for t in types:
        entry = F.when(F.col("segment_type") == t, F.struct(F.col("segment"), val))
        parts.append(F.map_from_entries(F.collect_list(entry)).alias(t))
    return metrics.agg(*parts).select(F.to_json(F.struct(
        "global", *types)).alias("value"))


def write_metrics_json(metrics: DataFrame, path: str) -> None:
    metrics_document(metrics).coalesce(1).write.mode("overwrite").text(path)


# S8 ------------------------------------------------------------------------
def save_models(models: DataFrame, path: str) -> None:
    """Model table (one row per segment) as Parquet."""
    models.write.mode("overwrite").parquet(path)


def load_models(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def select_model(models: DataFrame, model_name: str) -> DataFrame:
    """Models whose name matches; raises when there is none (one row check)."""
    chosen = models.where(F.col("model_name") == F.lit(model_name))
    if chosen.limit(1).count() == 0:
        raise KeyError(f"Unknown model: {model_name}")
    return chosen
