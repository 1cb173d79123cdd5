"""Calendar expressions (E2-E10).  All are built-in column expressions, so
they stay inside whole-stage codegen and push through projections."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, NumericType, StringType,
                               TimestampNTZType, TimestampType)

from .coerce import parse_date_text, strip_ws, to_double


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def monday_week(col) -> Column:
    """E5: Monday of the ISO week, as DATE (``to_monday``)."""
    return F.to_date(F.date_trunc("week", _c(col)))


def sunday_week_label(col) -> Column:
    """Pandas ``freq='W'`` label - the Sunday that ends the week."""
    return F.date_add(monday_week(col), 6)


def iso_year(col) -> Column:
    """ISO week-based year: the calendar year of the week's Thursday."""
    return F.year(F.date_add(monday_week(col), 3))


def iso_week(col) -> Column:
    return F.weekofyear(_c(col))


def iso_week_start(year, week) -> Column:
    """ISO (year, week) -> Monday.  Week outside 1..53 or a bad number
    gives NULL; week 53 of a 52-week year rolls into the next year (Q21)."""
    y = to_double(_c(year)).try_cast("int")
    w = to_double(_c(week)).try_cast("int")
    known = y.between(1, 9999) & w.between(1, 53)
    jan4 = F.make_date(F.when(known, y), F.lit(1), F.lit(4))
    return F.date_add(F.to_date(F.date_trunc("week", jan4)), (F.when(known, w) - 1) * 7)


def to_timestamp_multi(col, data_type=None, dayfirst: bool = False) -> Column:
    """Timestamp from a datetime, an epoch-ms number or text holding
    either epoch-ms digits or a date string.  Per-row ``coalesce`` (Q11)."""
    c = _c(col)
    if isinstance(data_type, (TimestampType, TimestampNTZType)):
        return c.cast("timestamp")
    if isinstance(data_type, DateType):
        return c.cast("timestamp")
    if isinstance(data_type, NumericType):
        return F.timestamp_millis(c.cast("bigint"))
    text = strip_ws(c.cast("string"))
    numeric = to_double(text)
    return F.coalesce(
        F.when(text.rlike(r"^-?[0-9]+(\.0+)?$"),
               F.timestamp_millis(numeric.try_cast("bigint"))),
        parse_date_text(text, dayfirst=dayfirst))


def to_timestamp_column(df, name: str) -> Column:
    """E2 with dispatch on the column's declared type (plan-time only)."""
    return to_timestamp_multi(F.col(name), df.schema[name].dataType)


def with_timestamp_strict(df, name: str, out: str | None = None):
    """E2, column-level rule (Q11 ``strict_column=True``): if ANY value of a
    text column is an epoch-ms number, the whole column is read as epoch-ms
    and the other values become NULL; otherwise it is parsed as date text.
    The decision is one aggregate row (a flag), broadcast back - no collect."""
    out = out or name
    if not is_string(df, name):
        return df.withColumn(out, to_timestamp_column(df, name))
    text = F.trim(F.col(name))
    numeric = text.rlike(r"^-?[0-9]+(\.[0-9]+)?$")
    flag = df.agg(F.max(numeric.cast("int")).alias("_any_ms"))
    as_ms = F.when(numeric, F.timestamp_millis(to_double(text).cast("bigint")))
    parsed = to_timestamp_multi(text)
    from ..operators.joins import attach_row
    return (attach_row(df, flag)
            .withColumn(out, F.when(F.col("_any_ms") == 1, as_ms).otherwise(parsed))
            .drop("_any_ms"))


def epoch_millis(col) -> Column:
    """Timestamp -> epoch milliseconds."""
    return F.unix_millis(_c(col).cast("timestamp"))


def calendar_parts(col) -> dict[str, Column]:
    """Month, quarter, Monday=0 weekday and the seasonal sine."""
    d = _c(col)
    return {
        "month": F.month(d),
        "dayofweek": F.weekday(d),
        "quarter": F.quarter(d),
        "sin_week": F.sin(F.lit(2 * math.pi) * F.weekofyear(d) / F.lit(52.0)),
    }


def is_string(df, name: str) -> bool:
    return isinstance(df.schema[name].dataType, StringType)
