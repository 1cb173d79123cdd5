"""P5: the weekly landed-cost panel (one row per price observation).

Physical plan: the price rows are the only large input.  The macro table
has at most one row per calendar week (it is keyed by week), the freight
index likewise, and the tariff table at most one row per HS-4 code (10,000
possible codes) after the per-prefix keep-last - each of these sides has a
size bound that does not grow with the price data, so they are broadcast
explicitly and the panel is built without shuffling the price rows.  The
table-wide means and std (diesel mean, z_base) come from mergeable weekly
states of the EUR price, attached as a one-row broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import monday_week
from ..functions.coerce import upper_key
from ..operators.aggregates import with_constants
from ..operators.joins import attach_row
from ..operators.states import constant_state, mean_of, merged_moments, moment_state, scaled_state, std_of
from ..operators.windows import keep_last
from ..sources.headers import ordered_projection
from .macros import normalize_fx
from .standardize import DENSITY

# Packaging cost per litre by pack material, and its default.
PACK_COST_TABLE = {"glass": 0.22, "plastic": 0.12, "steel": 0.30}
PACK_COST_DEFAULT = 0.22
DEFAULT_PACK = "glass"

# Fixed values (our contract for the missing helper): grade -> HS-4 heading.
GRADE_TO_HS = {"EVOO": "1509", "VIRGIN": "1509", "LAMPANTE": "1509", "REFINED": "1509",
               "POMACE": "1510"}

# Uplift factors.
OCEAN_UPLIFT_PER_POINT = 0.003
DIESEL_UPLIFT_FACTOR = 0.15

MACRO_COLS = ["usd_per_eur", "brent_usd_per_bbl", "diesel_usd_per_gal", "ppi_glass",
              "ppi_plastic_bottles", "ppi_steel"]

# The panel's columns, in order.
PANEL_COLS = [
    "week_start", "snapshot_date", "country", "iso2", "market", "grade",
    "grade_norm", "hs_prefix", "pack",
    "price_eur_per_l", "price_usd_per_l", "base_usd_per_l", "usd_per_eur",
    "adval_pct", "duty_rate", "specific_usd_per_kg", "duty_specific_usd_per_l",
    "duty_cost", "duty_usd_per_l",
    "brent_usd_per_bbl", "ocean_proxy", "ocean_idx", "ocean_uplift",
    "diesel_usd_per_gal", "diesel_uplift", "pack_cost",
    "ppi_glass", "ppi_plastic_bottles", "ppi_steel",
    "deliv_hat_usd_per_l", "z_base",
]


def map_lookup(col: Column, table: Mapping[str, object], default=None) -> Column:
    """Dictionary lookup with a default, as a literal map (no join)."""
    m = F.create_map(*[x for k, v in table.items() for x in (F.lit(k), F.lit(v))])
    found = F.try_element_at(m, col)
    return found if default is None else F.coalesce(found, F.lit(default))


def pack_cost(pack: Column) -> Column:
    return map_lookup(pack, PACK_COST_TABLE, PACK_COST_DEFAULT)


def ocean_proxy_table(macros: DataFrame, freight: DataFrame) -> DataFrame:
    """E21 (our formula): index ~100 - mean of the available among
    100*fbx/avg(fbx) and 100*brent/avg(brent), averages over the weekly
    outer-joined table (J5).  Both sides are weekly, so this is small."""
    temp = (macros.select("week_start", "brent_usd_per_bbl")
            .join(freight.select("week_start", "fbx"), "week_start", "full_outer"))
    c = with_constants(temp, {"_mf": F.avg("fbx"), "_mb": F.avg("brent_usd_per_bbl")})
    a = F.try_divide(F.col("fbx") * 100.0, F.col("_mf"))
    b = F.try_divide(F.col("brent_usd_per_bbl") * 100.0, F.col("_mb"))
    n = a.isNotNull().cast("int") + b.isNotNull().cast("int")
    proxy = F.when(n > 0, (F.coalesce(a, F.lit(0.0)) + F.coalesce(b, F.lit(0.0))) / n)
    return c.select("week_start", proxy.alias("ocean_proxy"))


def duty_expr(base: Column, adval: Column, specific: Column) -> Column:
    """Ad-valorem share of the base plus the specific duty per
    litre; NULL when the base is NULL (no row UDF)."""
    return F.when(base.isNotNull(), adval / 100.0 * base + specific * DENSITY)


def join_tariffs(p: DataFrame, tariffs: DataFrame, row_order: str = "row_order") -> DataFrame:
    """The tariff of a row's HS code and grade, else the code's last tariff row (by
    ``row_order`` where the tariffs carry it).  Both sides have at most one row per HS-4 code
    (10,000) and grade, so they are broadcast."""
    rates = ["adval_pct", "specific_usd_per_kg"]
    t = tariffs.select(F.trim(F.col("hs_prefix")).alias("hs_prefix"), upper_key(F.col("grade")).alias("_tgrade"),
                       *[F.coalesce(F.col(c), F.lit(0.0)).alias(f"_{c}") for c in rates],
                       *([row_order] if row_order in tariffs.columns else []))
    order = [row_order] if row_order in t.columns else ["_adval_pct", "_specific_usd_per_kg"]
    exact = keep_last(t.where(F.col("_tgrade").isNotNull()), ["hs_prefix", "_tgrade"], order).select(
        "hs_prefix", F.col("_tgrade").alias("grade_norm"), F.struct(*[f"_{c}" for c in rates]).alias("_exact"))
    whole = keep_last(t, ["hs_prefix"], order).select("hs_prefix", F.struct(*[f"_{c}" for c in rates]).alias("_any"))
    p = p.join(F.broadcast(exact), ["hs_prefix", "grade_norm"], "left").join(F.broadcast(whole), "hs_prefix", "left")
    found = F.coalesce("_exact", "_any")
    return p.withColumns({c: found[f"_{c}"] for c in rates}).drop("_exact", "_any")


def price_week_state(prices: DataFrame, parts: Sequence[str] = ()) -> DataFrame:
    """week_start (and the columns ``parts``), n_rows and the moment state of the EUR price of each
    week's price rows."""
    return prices.groupBy(*parts, monday_week("date").alias("week_start")).agg(
        F.count(F.lit(1)).alias("n_rows"), moment_state("price_eur_per_l").alias("state"))


def merged_week_states(states: DataFrame) -> DataFrame:
    """One state per week from those of several snapshots or files."""
    return states.groupBy("week_start").agg(F.sum("n_rows").alias("n_rows"), merged_moments("state").alias("state"))


def panel_constants(week_state: DataFrame, macros: DataFrame) -> DataFrame:
    """One row: the mean diesel price over price rows, mean and standard deviation of the USD price.
    The exchange rate and the diesel price depend on the week alone, so a week's state scaled by its
    rate is the state of its USD prices; no price row is read."""
    weeks = week_state.join(F.broadcast(macros.select("week_start", "usd_per_eur", "diesel_usd_per_gal")),
                            "week_start", "left")  # one row per calendar week
    both = weeks.select(scaled_state("state", "usd_per_eur").alias("usd"),
                        constant_state("diesel_usd_per_gal", "n_rows").alias("diesel"))
    total = both.agg(merged_moments("usd").alias("usd"), merged_moments("diesel").alias("diesel"))
    return total.select(mean_of("diesel").alias("_diesel_mean"), mean_of("usd").alias("_base_mean"),
                        std_of("usd").alias("_base_std"))


def build_weekly_panel(prices: DataFrame, macros: DataFrame, freight: DataFrame | None,
                       tariffs: DataFrame, snapshot: str,
                       grade_to_hs: Mapping[str, str] | None = None,
                       week_state: DataFrame | None = None, fx: DataFrame | None = None) -> DataFrame:
    """P5.  ``prices``: standardised price rows (date, country, market, grade,
    price_eur_per_l, optional pack / hs_prefix).  ``macros``: weekly table
    with week_start and any of ``MACRO_COLS`` (one row per week).
    ``freight``: (week_start, fbx).  ``tariffs``: normalised tariffs.

    ``fx``: an exchange-rate feed of its own (week_start and any of the known quotes, one of them
    inverse); its rate takes the place of the macros'.

    ``week_state``: the prices' ``price_week_state`` where it is kept beside them (merged over
    snapshots, say); by default it is computed from the prices' date and price columns.

    When ``prices`` carries ``hs_prefix`` it is used; otherwise the HS code
    comes from the canonical grade through ``grade_to_hs``.
    """
    p = prices.withColumn("week_start", monday_week("date"))
    if "market" not in p.columns:
        p = p.withColumn("market", F.lit(None).cast("string"))
    if "pack" not in p.columns:
        p = p.withColumn("pack", F.lit(DEFAULT_PACK))
    p = p.withColumns({"iso2": F.col("country"), "pack_cost": pack_cost(F.col("pack"))})

    # Macros: one row per week (keep-last guards against duplicate weeks).
    m = macros
    if fx is not None:  # one row per calendar week on either side
        m = m.drop("usd_per_eur").join(keep_last(normalize_fx(fx), ["week_start"], ["usd_per_eur"]), "week_start", "full_outer")
    for c in MACRO_COLS:
        if c not in m.columns:
            m = m.withColumn(c, F.lit(None).cast("double"))
    # Read three times (main join, ocean proxy, constants): callers hand in a
    # stored table, so that its source is scanned once.
    m = keep_last(m.select("week_start", *MACRO_COLS), ["week_start"], MACRO_COLS)
    p = p.join(F.broadcast(m), "week_start", "left")
    p = p.withColumn("price_usd_per_l", F.col("price_eur_per_l") * F.col("usd_per_eur"))
    consts = panel_constants(price_week_state(prices) if week_state is None else week_state, m)

    if freight is not None and "fbx" in freight.columns:
        p = p.join(F.broadcast(ocean_proxy_table(m, freight)), "week_start", "left")
    else:
        p = p.withColumn("ocean_proxy", F.lit(None).cast("double"))
    p = p.withColumns({"ocean_idx": F.col("ocean_proxy"),
                       "ocean_uplift": F.lit(OCEAN_UPLIFT_PER_POINT) * F.col("ocean_proxy")})

    # Tariffs: HS code per row, then one tariff row per hs_prefix (Q15).
    p = p.withColumn("grade_norm", upper_key(F.col("grade")))
    if "hs_prefix" not in p.columns:
        p = p.withColumn("hs_prefix", map_lookup(F.col("grade_norm"), grade_to_hs or GRADE_TO_HS))
    p = join_tariffs(p, tariffs)
    p = p.withColumns({
        "adval_pct": F.coalesce(F.col("adval_pct"), F.lit(0.0)),
        "specific_usd_per_kg": F.coalesce(F.col("specific_usd_per_kg"), F.lit(0.0)),
    })
    p = p.withColumns({
        "duty_rate": F.col("adval_pct"),
        "duty_specific_usd_per_l": F.coalesce(F.col("specific_usd_per_kg") * DENSITY, F.lit(0.0)),
        "base_usd_per_l": F.col("price_usd_per_l"),
    })
    p = p.withColumns({
        "duty_cost": F.col("adval_pct") / 100.0 * F.col("price_usd_per_l")
        + F.col("duty_specific_usd_per_l"),
        "duty_usd_per_l": duty_expr(F.col("price_usd_per_l"), F.col("adval_pct"),
                                    F.col("specific_usd_per_kg")),
    })

    p = attach_row(p, consts)
    p = p.withColumn("diesel_uplift", F.lit(DIESEL_UPLIFT_FACTOR)
                     * (F.col("diesel_usd_per_gal") - F.col("_diesel_mean")))
    landed = None
    for c in ["base_usd_per_l", "pack_cost", "ocean_uplift", "diesel_uplift", "duty_cost"]:
        term = F.coalesce(F.col(c), F.lit(0.0))
        landed = term if landed is None else landed + term
    z = F.when(F.col("_base_std") == 0, F.lit(0.0)).otherwise(
        F.try_divide(F.col("base_usd_per_l") - F.col("_base_mean"), F.col("_base_std")))
    p = p.withColumns({"deliv_hat_usd_per_l": landed, "z_base": z,
                       "snapshot_date": F.lit(snapshot)})
    p = p.drop("_diesel_mean", "_base_mean", "_base_std")
    return ordered_projection(p, PANEL_COLS)
