"""Step 2 queries: raw sheet standardisation, keep-last, JSON series."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import register
from ..operators.windows import keep_last_rows
from ..plans.standardize import normalize_tariffs, standardize_freight, standardize_prices
from ..sources import tables as T
from ..sources.files import parse_series_payloads
from .sqlparts import MACRO_OBS, MONDAY, OBS, r, with_

CANON_GRADE_SQL = """CASE WHEN upper(trim(grade)) LIKE '%EXTRA%' THEN 'EVOO'
            WHEN upper(trim(grade)) LIKE '%LAMPANTE%' THEN 'LAMPANTE'
            WHEN upper(trim(grade)) LIKE '%POMACE%' THEN 'POMACE'
            WHEN upper(trim(grade)) LIKE '%REFINED%' THEN 'REFINED'
            WHEN upper(trim(grade)) LIKE '%VIRGIN%' THEN 'VIRGIN'
            ELSE upper(trim(grade)) END"""

STD_PRICES_SQL = with_(OBS) + f"""
SELECT date, country, market, {CANON_GRADE_SQL} AS grade,
       {r('price_eur_per_l / 100.0 * 0.916', 'price_eur_per_l')}, pack, hs_prefix
FROM obs WHERE date IS NOT NULL AND price_eur_per_l IS NOT NULL"""


@register("standardize_prices", STD_PRICES_SQL)
def q_standardize_prices(spark, sf_dir):
    """P1 on the landed price sheet (ambiguous 'Price' header -> EUR/100kg)."""
    return standardize_prices(T.price_sheet(spark, sf_dir))


@register("standardize_freight", with_(MACRO_OBS) + f"""
SELECT {MONDAY.format(c='date')} AS week_start, {r('avg(value)', 'fbx')}
FROM macro_obs WHERE series = 'fbx' AND value IS NOT NULL GROUP BY ALL""")
def q_standardize_freight(spark, sf_dir):
    """P2 on the landed freight sheet."""
    return standardize_freight(T.freight_sheet(spark, sf_dir))


TARIFF_SQL = f"""
WITH t AS (
  SELECT lpad(substr(regexp_replace(p_brand, '[^0-9]', '', 'g'), 1, 4), 4, '0') AS hs_prefix,
         CAST(p_size AS DOUBLE) AS adval_pct, p_retailprice / 1000.0 AS specific_usd_per_kg,
         p_partkey
  FROM part)
SELECT CAST(NULL AS VARCHAR) AS grade, hs_prefix,
       {r('arg_max(adval_pct, p_partkey)', 'adval_pct')},
       {r('arg_max(specific_usd_per_kg, p_partkey)', 'specific_usd_per_kg')}
FROM t GROUP BY hs_prefix"""


@register("normalize_tariffs", TARIFF_SQL)
def q_normalize_tariffs(spark, sf_dir):
    """P3 on the landed tariff sheet, keep-last by row order."""
    return normalize_tariffs(T.tariff_sheet(spark, sf_dir))


@register("dedup_keep_last", """
SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, round(l_extendedprice, 2) AS l_extendedprice
FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC,
                                        l_extendedprice DESC) = 1""")
def q_dedup_keep_last(spark, sf_dir):
    """The last line of every order by (ship date, line number), with
    part key and price as explicit tie-breaks (line numbers repeat)."""
    li = T.read_table(spark, sf_dir, "lineitem",
                      ["l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_extendedprice"])
    out = keep_last_rows(li, ["l_orderkey"],
                    ["l_shipdate", "l_linenumber", "l_partkey", "l_extendedprice"])
    return out.withColumn("l_extendedprice", F.round("l_extendedprice", 2))


@register("json_series", """
SELECT event_type AS series_id, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS date,
       TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS value
FROM events
WHERE TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) IS NOT NULL""")
def q_json_series(spark, sf_dir):
    """Both payload shapes parsed into (series_id, date, value) rows."""
    return parse_series_payloads(T.json_payloads(spark, sf_dir), "payload", ["series_id"])
