"""Plan-time schema operators (H1-H8).

They look only at ``df.columns`` / ``df.schema`` (driver metadata, no job)
and return new projections, so Catalyst still prunes and pushes down.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def snake(name: str) -> str:
    """H1 for one name: lower case, runs of non-word characters -> ``_``."""
    return re.sub(r"\W+", "_", str(name).strip().lower())


def normalize_headers(df: DataFrame) -> DataFrame:
    """H1: rename every column to snake case."""
    return df.toDF(*[snake(c) for c in df.columns])


def pick_col(candidates: Iterable[str], columns: Iterable[str],
             required: bool = False, what: str = "column") -> str | None:
    """H2: first candidate present in ``columns``."""
    cols = list(columns)
    for c in candidates:
        if c in cols:
            return c
    if required:
        raise ValueError(f"Missing a recognizable {what}. Columns: {cols}")
    return None


def ensure_columns(df: DataFrame, defaults: Mapping[str, Column | object]) -> DataFrame:
    """H4: add each absent column with its default (a Column or a literal)."""
    add = {}
    for name, value in defaults.items():
        if name not in df.columns:
            add[name] = value if isinstance(value, Column) else F.lit(value)
    return df.withColumns(add) if add else df


def require_columns(df: DataFrame, required: Iterable[str], what: str = "input") -> None:
    """H5: fail fast when mandatory columns are absent."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{what} missing required columns: {missing}")


def ordered_projection(df: DataFrame, order: Iterable[str], keep_residual: bool = True,
                       drop_private: bool = True) -> DataFrame:
    """H6: the listed columns that exist, in order, then any others
    (``_``-prefixed ones dropped)."""
    first = [c for c in order if c in df.columns]
    rest = [c for c in df.columns if c not in first and not (drop_private and c.startswith("_"))]
    return df.select(*first, *(rest if keep_residual else []))


def intersect_projection(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """H7: only the wanted columns that exist."""
    return df.select(*[c for c in wanted if c in df.columns])


def distinct_labels(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """H8 for several columns in one scan: (column_name, label)."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("label")) for c in cols])
    return df.select(F.inline(pairs)).where(F.col("label").isNotNull()).distinct()
