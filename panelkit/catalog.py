"""Registry of the named queries exposed through ``__spark_entry__``.

Each entry is a Spark callable ``(spark, sf_dir) -> DataFrame`` and, where
the operator is expressible in SQL, the equivalent DuckDB SQL over the same
Parquet tables (the correctness oracle).  Double outputs are rounded to
``DIGITS`` decimals on both sides so that summation-order noise in the last
bits does not decide a value comparison (``stable_round``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

DIGITS = 6


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None
    doc: str = ""
    tags: list[str] = field(default_factory=list)


REGISTRY: dict[str, Query] = {}


def stable_round(col, digits: int = DIGITS):
    """``rint(x * 10^d + 0.0001) / 10^d + 0.0``: round half to even after a
    small offset, so values that sit exactly half-way (common here) do not
    depend on summation-order noise; ``+ 0.0`` turns -0.0 into 0.0.  Pure
    double arithmetic: no 64-bit overflow and little generated code (a
    ``floor``/``cast`` version pushed the panel's generated method past the
    JIT size limit and doubled its run time)."""
    scale = float(10 ** digits)
    return F.rint(col * F.lit(scale) + F.lit(0.0001)) / F.lit(scale) + F.lit(0.0)


def round_doubles(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    cols = {f.name: stable_round(F.col(f.name), digits) for f in df.schema.fields
            if isinstance(f.dataType, (DoubleType, FloatType))}
    return df.withColumns(cols) if cols else df


def register(name: str, sql: str | None = None, doc: str = "", round_output: bool = True):
    def deco(fn):
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(spark, sf_dir)
            return round_doubles(df) if round_output else df
        build.__name__ = fn.__name__
        build.__doc__ = fn.__doc__
        REGISTRY[name] = Query(name, build, sql, doc or (fn.__doc__ or "").strip())
        return fn
    return deco


def load_all() -> dict[str, Query]:
    from . import queries  # noqa: F401  (registers on import)
    return REGISTRY
