"""Keep-last tables kept up by their changes.

A keyed table is stored bucketed and sorted by its key.  Merging a sheet of changes deals only the changes
into the table's buckets: both sides then meet bucket by bucket, and the stored side, which is the large
one, is neither shuffled nor sorted again.  The result is stored in the same layout, ready for the next sheet.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .windows import keep_last_rows

BUCKETS = 16


def write_keyed(df: DataFrame, keys: Sequence[str], path: str | None = None, buckets: int = BUCKETS) -> str:
    """Store ``df`` (one row per key) bucketed and sorted by ``keys``; the name of the table in the session's
    catalog.  Rows with a NULL in a key are left out, as they can never be replaced.  Without ``path`` the files
    go to the shared folder."""
    spark = df.sparkSession
    name = f"keyed_{uuid.uuid4().hex}"
    path = path or f"{checkpoint_dir(spark).rstrip('/')}/{name}"
    known = df.dropna(subset=list(keys)).repartition(buckets, *keys)
    known.write.option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return name


def upserted(table: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """``table`` (one row per key) with ``changes``: per key the row that is last by ``order`` (NULLs first), the
    change where both are equal.  ``changes`` may hold several rows per key, and need the table's columns."""
    keys = list(keys)
    rest = [c for c in table.columns if c not in keys]
    new = keep_last_rows(changes.select(*table.columns).dropna(subset=keys).repartition(buckets, *keys), keys, order)
    old = table.select(*keys, F.struct(*rest).alias("_old"))
    new = new.select(*keys, F.struct(*rest).alias("_new"))
    both = old.join(new.hint("merge"), keys, "full_outer")
    at = lambda side: F.struct(*[F.col(f"{side}.{c}") for c in order])
    take = F.col("_old").isNull() | (F.col("_new").isNotNull() & (at("_new") >= at("_old")))
    row = F.when(take, F.col("_new")).otherwise(F.col("_old"))
    return both.select(*keys, row.alias("_r")).select(*keys, "_r.*").select(*table.columns)


def upsert(spark: SparkSession, name: str, changes: DataFrame, keys: Sequence[str], order: Sequence[str],
           path: str | None = None, buckets: int = BUCKETS) -> str:
    """Merge ``changes`` into the keyed table ``name`` and store the result as a new one; its name.  The old
    table stays, so a run that dies is simply repeated."""
    return write_keyed(upserted(spark.table(name), changes, keys, order, buckets), keys, path, buckets)
