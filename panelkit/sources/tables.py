"""Driver tables and the raw inputs derived from them.

The engine's jobs expect a price sheet, macro series, a freight sheet and a
tariff sheet.  On the test lake these are views derived from the TPC-H-like
tables, so every job's work grows with the tables.  Every view projects only
the columns it needs, so the Parquet scans read those columns alone.

Join strategy: ``nation`` and ``region`` are fixed-size dimension tables
(25 and 5 rows by the TPC-H specification), so they are broadcast
explicitly.  ``supplier`` and ``part`` grow with the scale factor and carry no
hint: Spark broadcasts their narrow projections under the byte threshold and
sort-merge joins them beyond it (AQE splits skewed partitions).  The line items
meet ``supplier`` before the nations, so that no chain of joins inflates the
size estimate of the small side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.coerce import hs4_from_code, nan_to_null

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def read_table(spark: SparkSession, sf_dir: str, name: str, cols=None) -> DataFrame:
    """One Parquet table, optionally pruned to ``cols``."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def nation_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation -> (market = nation name, country = region name); 25 rows."""
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    region = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    return (nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
            .select("n_nationkey", F.col("r_name").alias("country"), F.col("n_name").alias("market")))


# Part type -> pack material (anything else keeps the default pack).
PACK_BY_TYPE = {"STANDARD": "glass", "ECONOMY": "plastic", "PROMO": "steel"}


def pack_of(col) -> F.Column:
    expr = None
    for ptype, pack in PACK_BY_TYPE.items():
        cond = F.col(col) == F.lit(ptype)
        expr = F.when(cond, F.lit(pack)) if expr is None else expr.when(cond, F.lit(pack))
    return expr


def brand_hs4(col) -> F.Column:
    """HS-4 code of a part: the brand number, zero-padded to four digits."""
    return F.lpad(hs4_from_code(F.col(col)), 4, "0")


def price_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed price observations, one per line item: date, country, market,
    grade, price_eur_per_l, pack, hs_prefix."""
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                     "l_returnflag", "l_shipdate"])
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_type", "p_brand"]).select(
        "p_partkey", pack_of("p_type").alias("pack"), brand_hs4("p_brand").alias("hs_prefix"))  # once a part, not a line
    supp = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
    geo = nation_geo(spark, sf_dir)
    rows = (li.join(supp, li.l_suppkey == supp.s_suppkey)
            .join(F.broadcast(geo), supp.s_nationkey == geo.n_nationkey)
            .join(part, li.l_partkey == part.p_partkey))
    return nan_to_null(rows.select(F.col("l_shipdate").alias("date"), "country", "market",
                    F.col("l_returnflag").alias("grade"),
                    F.try_divide(F.col("l_extendedprice"), F.col("l_quantity"))
                    .alias("price_eur_per_l"),
                    "pack", "hs_prefix"))


def price_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw price sheet as it would land: text columns, drifting headers."""
    obs = price_observations(spark, sf_dir)
    return obs.select(
        F.col("country").alias("Member State"),
        F.col("market").alias("Market"),
        F.col("grade").alias("Category"),
        F.date_format("date", "yyyy-MM-dd").alias("Reference From"),
        F.col("price_eur_per_l").cast("string").alias("Price"),
        F.col("pack").alias("Pack"),
        F.col("hs_prefix").alias("HS Prefix"))


# Order priority -> macro series, and the divisor that turns
# o_totalprice into a value of plausible size (usd_per_eur adds 1).
MACRO_BY_PRIORITY = [
    ("1-URGENT", "usd_per_eur", 1e6),
    ("2-HIGH", "brent_usd_per_bbl", 2500.0),
    ("3-MEDIUM", "diesel_usd_per_gal", 50000.0),
    ("5-LOW", "fbx", 100.0),
]
# For 4-NOT SPECIFIED the order status picks the PPI series.
PPI_BY_STATUS = [("F", "ppi_glass"), ("O", "ppi_plastic_bottles"), ("P", "ppi_steel")]
PPI_DIVISOR = 1000.0

MACRO_SERIES = ["usd_per_eur", "brent_usd_per_bbl", "diesel_usd_per_gal",
                "ppi_glass", "ppi_plastic_bottles", "ppi_steel"]


def macro_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long daily series: (series, date, value), one row per order."""
    o = read_table(spark, sf_dir, "orders",
                   ["o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"])
    pr, st, tp = F.col("o_orderpriority"), F.col("o_orderstatus"), F.col("o_totalprice")
    series = None
    value = None
    for prio, name, div in MACRO_BY_PRIORITY:
        v = tp / F.lit(div) + (F.lit(1.0) if name == "usd_per_eur" else F.lit(0.0))
        series = F.when(pr == prio, F.lit(name)) if series is None else series.when(pr == prio, F.lit(name))
        value = F.when(pr == prio, v) if value is None else value.when(pr == prio, v)
    for status, name in PPI_BY_STATUS:
        cond = (pr == "4-NOT SPECIFIED") & (st == status)
        series = series.when(cond, F.lit(name))
        value = value.when(cond, tp / F.lit(PPI_DIVISOR))
    return nan_to_null(o.select(series.alias("series"), F.col("o_orderdate").alias("date"),
                                value.alias("value"))
                       .where(F.col("series").isNotNull()))


def freight_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw freight sheet: text date and index columns."""
    m = macro_observations(spark, sf_dir).where(F.col("series") == "fbx")
    return m.select(F.date_format("date", "yyyy-MM-dd").alias("Date"),
                    F.col("value").cast("string").alias("FBX Global"))


def tariff_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw tariff sheet: HTS8 text code, MFN rates as text, row order key."""
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_brand", "p_size", "p_retailprice"])
    size4 = F.lpad(F.col("p_size").cast("string"), 4, "0")
    code = F.concat(brand_hs4("p_brand"), F.lit("."), F.substring(size4, 1, 2),
                    F.lit("."), F.substring(size4, 3, 2))
    return p.select(code.alias("HTS8"),
                    F.col("p_size").cast("string").alias("MFN Ad Val Rate"),
                    (F.col("p_retailprice") / 1000.0).cast("string").alias("MFN Specific Rate"),
                    F.col("p_partkey").alias("row_order"))


def json_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series payloads as they land from the two APIs (S5), one document per
    event: click/view/signup events use the ``observations`` shape with text
    values, the other types the ``response.data`` shape with ``period``."""
    e = read_table(spark, sf_dir, "events", ["event_id", "ts", "event_type", "props"])
    day = F.date_format("ts", "yyyy-MM-dd")
    k = F.get_json_object("props", "$.k")
    obs = F.format_string('{"observations":[{"date":"%s","value":"%s"}]}', day, k)
    resp = F.format_string('{"response":{"data":[{"period":"%s","value":%s}]}}', day, k)
    return e.select("event_id", F.col("event_type").alias("series_id"),
                    F.when(F.col("event_type").isin("click", "view", "signup"), obs).otherwise(resp).alias("payload"))
