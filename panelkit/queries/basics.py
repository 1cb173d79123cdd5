"""Step 1 queries: calendar, coercion and the weekly segment slice."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import register
from ..functions import calendar as cal
from ..functions.coerce import to_double
from ..operators.aggregates import weekly_mean
from ..plans.series import weekly_segment_features
from ..sources import tables as T
from .sqlparts import MACRO_OBS, MONDAY, OBS, SUNDAY, r, rr, with_

# --------------------------------------------------------------------------
FLAGSHIP_SQL = with_(OBS, f"""
weekly AS (
  SELECT country, market, grade, {SUNDAY.format(c='date')} AS week_start,
         avg(price_eur_per_l) AS price_eur_per_l
  FROM obs WHERE country IS NOT NULL AND market IS NOT NULL AND grade IS NOT NULL
  GROUP BY ALL)""", """
seg AS (SELECT country, grade, week_start, avg(price_eur_per_l) AS price FROM weekly GROUP BY ALL)""", """
f AS (
  SELECT *, lag(price, 1) OVER w AS lag1week, lag(price, 2) OVER w AS lag2week,
         avg(price) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS rolling3,
         avg(price) OVER (w ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS rolling10,
         avg(price) OVER (PARTITION BY country, grade) AS m,
         stddev_pop(price) OVER (PARTITION BY country, grade) AS s
  FROM seg WINDOW w AS (PARTITION BY country, grade ORDER BY week_start))""") + f"""
SELECT country, grade, week_start, {r('price', 'price')}, {r('lag1week', 'lag1week')},
       {r('lag2week', 'lag2week')}, {r('rolling3', 'rolling3')}, {r('rolling10', 'rolling10')},
       CAST(month(week_start) AS INT) AS month, CAST(isodow(week_start) - 1 AS INT) AS dayofweek,
       CAST(quarter(week_start) AS INT) AS quarter,
       {r('sin(2 * pi() * weekofyear(week_start) / 52.0)', 'sin_week')},
       CASE WHEN s = 0 OR s IS NULL THEN 0.0 ELSE {rr('(price - m) / s')} END AS z_price
FROM f"""


@register("weekly_segment_features", FLAGSHIP_SQL)
def q_weekly_segment_features(spark, sf_dir):
    """Price observations -> weekly means -> country x grade features."""
    return weekly_segment_features(T.price_observations(spark, sf_dir))


# --------------------------------------------------------------------------
@register("weekly_mean", with_(MACRO_OBS) + f"""
SELECT series, {MONDAY.format(c='date')} AS week_start, {r('avg(value)', 'value')},
       count(*) AS n_obs
FROM macro_obs WHERE series IS NOT NULL GROUP BY ALL""")
def q_weekly_mean(spark, sf_dir):
    """A1: daily macro observations -> Monday-week means per series."""
    m = T.macro_observations(spark, sf_dir)
    return (m.groupBy("series", cal.monday_week("date").alias("week_start"))
            .agg(F.avg("value").alias("value"), F.count(F.lit(1)).alias("n_obs")))


# --------------------------------------------------------------------------
@register("sunday_week_label", f"""
SELECT {SUNDAY.format(c='l_shipdate')} AS week_label, count(*) AS n_rows,
       CAST(min(l_shipdate) AS DATE) AS first_day, CAST(max(l_shipdate) AS DATE) AS last_day,
       CAST(count(DISTINCT CAST(l_shipdate AS DATE)) AS BIGINT) AS n_days
FROM lineitem GROUP BY ALL""")
def q_sunday_week_label(spark, sf_dir):
    """Every ship date labelled with the Sunday that ends its week."""
    li = T.read_table(spark, sf_dir, "lineitem", ["l_shipdate"])
    return (li.groupBy(cal.sunday_week_label("l_shipdate").alias("week_label"))
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.to_date(F.min("l_shipdate")).alias("first_day"),
                 F.to_date(F.max("l_shipdate")).alias("last_day"),
                 F.count_distinct(F.to_date("l_shipdate")).alias("n_days")))


# --------------------------------------------------------------------------
@register("iso_week_start", f"""
SELECT CAST(isoyear(o_orderdate) AS VARCHAR) AS iso_year_text,
       lpad(CAST(weekofyear(o_orderdate) AS VARCHAR), 2, '0') AS iso_week_text,
       {MONDAY.format(c='o_orderdate')} AS week_start, count(*) AS n_rows
FROM orders GROUP BY ALL""")
def q_iso_week_start(spark, sf_dir):
    """ISO (year, week) text pairs, as a sheet would carry them, turned
    back into the Monday of that week."""
    o = T.read_table(spark, sf_dir, "orders", ["o_orderdate"])
    sheet = o.select(cal.iso_year("o_orderdate").cast("string").alias("iso_year_text"),
                     F.lpad(cal.iso_week("o_orderdate").cast("string"), 2, "0")
                     .alias("iso_week_text"))
    return (sheet.groupBy("iso_year_text", "iso_week_text")
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .withColumn("week_start", cal.iso_week_start("iso_year_text", "iso_week_text"))
            .select("iso_year_text", "iso_week_text", "week_start", "n_rows"))


# --------------------------------------------------------------------------
@register("calendar_parts", f"""
SELECT CAST(l_shipdate AS DATE) AS day, CAST(month(l_shipdate) AS INT) AS month,
       CAST(isodow(l_shipdate) - 1 AS INT) AS dayofweek, CAST(quarter(l_shipdate) AS INT) AS quarter,
       {r('sin(2 * pi() * weekofyear(l_shipdate) / 52.0)', 'sin_week')},
       CAST(weekofyear(l_shipdate) AS INT) AS iso_week, count(*) AS n_rows
FROM lineitem GROUP BY ALL""")
def q_calendar_parts(spark, sf_dir):
    """Month, quarter, Monday=0 weekday, ISO week and seasonal sine."""
    li = T.read_table(spark, sf_dir, "lineitem", ["l_shipdate"])
    days = li.groupBy(F.to_date("l_shipdate").alias("day")).agg(F.count(F.lit(1)).alias("n_rows"))
    parts = cal.calendar_parts(F.col("day"))
    return days.select("day", parts["month"].alias("month"), parts["dayofweek"].alias("dayofweek"),
                       parts["quarter"].alias("quarter"), parts["sin_week"].alias("sin_week"),
                       cal.iso_week("day").alias("iso_week"), "n_rows")


# --------------------------------------------------------------------------
@register("to_numeric_coerce", f"""
SELECT event_type, count(*) AS n_rows,
       count(TRY_CAST(trim(regexp_extract(props, ':([^}}]*)', 1)) AS DOUBLE)) AS n_numeric_props,
       count(TRY_CAST(event_type AS DOUBLE)) AS n_numeric_type,
       count(TRY_CAST(CAST(value AS VARCHAR) AS DOUBLE)) AS n_numeric_value,
       {r("sum(TRY_CAST(trim(regexp_extract(props, ':([^}}]*)', 1)) AS DOUBLE))", 'sum_props')}
FROM events GROUP BY ALL""")
def q_to_numeric_coerce(spark, sf_dir):
    """Text -> double with bad values as NULL, counted per event type."""
    e = T.read_table(spark, sf_dir, "events", ["event_type", "value", "props"])
    k = to_double(F.trim(F.regexp_extract("props", r":([^}]*)", 1)))
    return (e.groupBy("event_type")
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count(k).alias("n_numeric_props"),
                 F.count(to_double(F.col("event_type"))).alias("n_numeric_type"),
                 F.count(to_double(F.col("value").cast("string"))).alias("n_numeric_value"),
                 F.sum(k).alias("sum_props")))


# --------------------------------------------------------------------------
@register("epoch_ms_dates", """
SELECT event_type, count(*) AS n_rows,
       min(CAST(floor(epoch_us(ts) / 1000) AS BIGINT)) AS min_epoch_ms,
       max(CAST(floor(epoch_us(ts) / 1000) AS BIGINT)) AS max_epoch_ms,
       sum(epoch_us(ts) // 1000)::BIGINT AS ms_from_number, sum(epoch_us(ts) // 1000)::BIGINT AS ms_from_text,
       sum(datediff('day', DATE '1970-01-01', CAST(ts AS DATE)) * 86400000)::BIGINT AS ms_from_day_text,
       sum((datediff('second', TIMESTAMP '1970-01-01', ts)) * 1000)::BIGINT AS ms_from_time_text,
       count(*) FILTER (WHERE event_type IS NULL) AS n_bad_text
FROM events GROUP BY ALL""")
def q_epoch_ms_dates(spark, sf_dir):
    """Timestamps through every encoding - epoch-ms number, epoch-ms
    text, date text, junk text - and back, per event type."""
    e = T.read_table(spark, sf_dir, "events", ["event_type", "ts"])
    ms = cal.epoch_millis("ts")
    enc = e.select("event_type", "ts", ms.alias("ms"),
                   ms.cast("string").alias("ms_text"),
                   F.date_format("ts", "yyyy-MM-dd").alias("day_text"), F.date_format("ts", "MMM d, yyyy").alias("month_text"),
                   F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("time_text"))
    from_num = cal.to_timestamp_multi(F.col("ms"), enc.schema["ms"].dataType)
    from_text = cal.to_timestamp_multi(F.col("ms_text"))
    day = F.when(F.dayofmonth("ts") % 2 == 0, F.col("day_text")).otherwise(F.col("month_text"))
    from_day = cal.to_timestamp_multi(day)
    from_time = cal.to_timestamp_multi(F.col("time_text"))
    junk = cal.to_timestamp_multi(F.col("event_type"))
    return (enc.groupBy("event_type")
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.min("ms").alias("min_epoch_ms"), F.max("ms").alias("max_epoch_ms"),
                 F.sum(F.unix_millis(from_num)).alias("ms_from_number"), F.sum(F.unix_millis(from_text)).alias("ms_from_text"),
                 F.sum(F.unix_millis(from_day)).alias("ms_from_day_text"), F.sum(F.unix_millis(from_time)).alias("ms_from_time_text"),
                 F.count_if(junk.isNotNull()).alias("n_bad_text")))
