"""Shared DuckDB SQL fragments for the oracle queries (CTE bodies that
mirror ``sources.tables``)."""

# Price observations: one per line item.
OBS = """
obs AS (
  SELECT l.l_shipdate AS date, r.r_name AS country, n.n_name AS market,
         l.l_returnflag AS grade,
         l.l_extendedprice / NULLIF(l.l_quantity, 0) AS price_eur_per_l,
         CASE p.p_type WHEN 'STANDARD' THEN 'glass' WHEN 'ECONOMY' THEN 'plastic'
                       WHEN 'PROMO' THEN 'steel' END AS pack,
         lpad(substr(regexp_replace(p.p_brand, '[^0-9]', '', 'g'), 1, 4), 4, '0') AS hs_prefix
  FROM lineitem l
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""

# Macro observations, long: (series, date, value).
MACRO_OBS = """
macro_obs AS (
  SELECT CASE
           WHEN o_orderpriority = '1-URGENT' THEN 'usd_per_eur'
           WHEN o_orderpriority = '2-HIGH' THEN 'brent_usd_per_bbl'
           WHEN o_orderpriority = '3-MEDIUM' THEN 'diesel_usd_per_gal'
           WHEN o_orderpriority = '5-LOW' THEN 'fbx'
           WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'F' THEN 'ppi_glass'
           WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'O' THEN 'ppi_plastic_bottles'
           WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P' THEN 'ppi_steel'
         END AS series,
         o_orderdate AS date,
         CASE
           WHEN o_orderpriority = '1-URGENT' THEN o_totalprice / 1e6 + 1.0
           WHEN o_orderpriority = '2-HIGH' THEN o_totalprice / 2500.0 + 0.0
           WHEN o_orderpriority = '3-MEDIUM' THEN o_totalprice / 50000.0 + 0.0
           WHEN o_orderpriority = '5-LOW' THEN o_totalprice / 100.0 + 0.0
           WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus IN ('F', 'O', 'P')
             THEN o_totalprice / 1000.0
         END AS value
  FROM orders
)"""

MONDAY = "CAST(date_trunc('week', {c}) AS DATE)"
SUNDAY = "(CAST(date_trunc('week', {c}) AS DATE) + 6)"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes)


def rr(expr: str, digits: int = 6) -> str:
    """Same stable rounding as ``catalog.stable_round``."""
    return f"(round_even(({expr}) * 1e{digits} + 0.0001, 0) / 1e{digits} + 0.0)"


def r(expr: str, alias: str, digits: int = 6) -> str:
    return f"{rr(expr, digits)} AS {alias}"


def cost_pressure_sql(src: str, weights: dict, renormalise: bool = True,
                      name: str = "cp") -> str:
    """CTE ``name``: every row of ``src`` plus ``cost_pressure``."""
    cols = list(weights)
    stats = ", ".join(
        f"count({c}) AS n_{i}, count(*) FILTER (WHERE {c} = 0) AS z0_{i}, "
        f"avg({c}) AS m_{i}, stddev_pop({c}) AS s_{i}" for i, c in enumerate(cols))
    usable = [f"(n_{i} > 0 AND z0_{i} < rows_)" for i in range(len(cols))]
    total = " + ".join(f"CASE WHEN {u} THEN {weights[c]} ELSE 0.0 END"
                       for u, c in zip(usable, cols))
    terms = []
    for i, c in enumerate(cols):
        z = f"(CASE WHEN s_{i} = 0 OR s_{i} IS NULL THEN 0.0 ELSE ({c} - m_{i}) / s_{i} END)"
        w = f"({weights[c]} / ({total}))" if renormalise else f"{weights[c]}"
        terms.append(f"CASE WHEN {usable[i]} THEN {z} * {w} ELSE 0.0 END")
    anyu = " OR ".join(usable)
    return f"""
{name}_stats AS (SELECT count(*) AS rows_, {stats} FROM {src}),
{name} AS (
  SELECT t.*, CASE WHEN {anyu} THEN {' + '.join(terms)} ELSE 0.0 END AS cost_pressure
  FROM {src} t, {name}_stats)"""


def cost_pressure_fixed_sql(src: str, weights: dict, name: str = "cpf") -> str:
    cols = list(weights)
    stats = ", ".join(f"avg({c}) AS m_{i}, stddev_pop({c}) AS s_{i}" for i, c in enumerate(cols))
    terms = " + ".join(f"{weights[c]} * (({c} - m_{i}) / NULLIF(s_{i}, 0))"
                       for i, c in enumerate(cols))
    return f"""
{name}_stats AS (SELECT {stats} FROM {src}),
{name} AS (SELECT t.*, {terms} AS cost_pressure FROM {src} t, {name}_stats)"""


def interp_parts_sql(col: str, part: str, order: str, pos: str = "pos") -> str:
    """Select-list items feeding ``interp_sql`` (F10) for one column."""
    p = f"PARTITION BY {part} " if part else ""
    bw = f"OVER ({p}ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    aw = f"OVER ({p}ORDER BY {order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    known = f"CASE WHEN {col} IS NOT NULL THEN {pos} END"
    return (f"last_value({col} IGNORE NULLS) {bw} AS pv_{col}, "
            f"last_value({known} IGNORE NULLS) {bw} AS pp_{col}, "
            f"first_value({col} IGNORE NULLS) {aw} AS nv_{col}, "
            f"first_value({known} IGNORE NULLS) {aw} AS np_{col}")


def interp_sql(col: str, pos: str = "pos") -> str:
    return (f"CASE WHEN {col} IS NOT NULL THEN {col} WHEN pv_{col} IS NULL THEN NULL "
            f"WHEN nv_{col} IS NULL THEN pv_{col} "
            f"ELSE pv_{col} + (nv_{col} - pv_{col}) * ({pos} - pp_{col}) / (np_{col} - pp_{col}) END")
