"""DuckDB twins of the dashboard analytics (``plans.dashboard``)."""

from __future__ import annotations

from ..sources import binding
from . import registry
from .assets import size_buckets
from .oracle import FF, FILLED, STABLE, TOKENS, XC, token_id, with_base

CNT = "finalized_orders_count"
VOL = "filled_orders_volume_usd"
CORRIDOR = "src_chain_id || ' → ' || dst_chain_id"


def _priced(where: str) -> str:
    """Orders ``o`` under a condition, with the decimals of what was sold and,
    for dollar stablecoins, its USD."""
    return TOKENS.strip() + f""",
priced AS (
  SELECT o.*, k.decimals,
         if(k.symbol IN ({STABLE}), o.actual_input_units::DOUBLE / power(10.0, k.decimals), NULL) AS usd
  FROM (SELECT *, {token_id('input')} AS sold_id FROM ov) o
  LEFT JOIN tokens k ON k.chain = o.input_asset_chain AND k.id = o.sold_id
  WHERE {where}
)"""


def _sql_headline_windows() -> str:
    as_of = registry.DASHBOARD_AS_OF
    return with_base(f"""
periods AS (SELECT * FROM (VALUES (1, '24h', 1), (2, '7d', 7), (3, 'all time', NULL)) p(ord, period, n)),
cp AS (
  SELECT p.period, c.* FROM chainpair c JOIN periods p
    ON c.day < DATE '{as_of}' AND (p.n IS NULL OR c.day >= DATE '{as_of}' - p.n)
),
cc AS (
  SELECT period,
         sum(CASE WHEN {XC} THEN {VOL} END)::DOUBLE AS volume_usd,
         CAST(sum(CASE WHEN {XC} THEN CASE WHEN {FF} THEN {CNT} ELSE 0 END END) AS BIGINT) AS swaps,
         CAST(sum(CASE WHEN dst_chain_id = 'ton' AND src_chain_id <> 'ton' THEN {VOL} ELSE 0 END)
            - sum(CASE WHEN src_chain_id = 'ton' AND dst_chain_id <> 'ton' THEN {VOL} ELSE 0 END) AS DOUBLE)
           AS net_ton_usd
  FROM cp GROUP BY period
),
op AS (
  SELECT p.period, o.src_trader_address, o.resolver_id, o.t_total FROM ov o JOIN periods p
    ON o.day < DATE '{as_of}' AND (p.n IS NULL OR o.day >= DATE '{as_of}' - p.n)
  WHERE o.{XC} AND o.{FF}
),
people AS (
  SELECT period, count(DISTINCT src_trader_address) AS traders, count(DISTINCT resolver_id) AS resolvers,
         quantile_disc(t_total, 0.5)::DOUBLE AS median_seconds
  FROM op GROUP BY period
)
SELECT p.period, cc.volume_usd, cc.swaps, people.traders, cc.net_ton_usd, people.median_seconds,
       people.resolvers
FROM periods p LEFT JOIN cc ON cc.period = p.period LEFT JOIN people ON people.period = p.period
ORDER BY p.ord""", ("chainpair",))


def _sql_filtered_volume() -> str:
    f = registry.FILTERS
    where = [f"o.{FF}", f"o.{XC}"]
    if f.get("start"):
        where.append(f"o.day >= DATE '{f['start']}'")
    if f.get("end"):
        where.append(f"o.day < DATE '{f['end']}'")
    if f.get("src"):
        where.append(f"o.src_chain_id = '{f['src']}'")
    if f.get("dst"):
        where.append(f"o.dst_chain_id = '{f['dst']}'")
    size = f"WHERE usd >= {float(f['min_usd'])}" if f.get("min_usd") is not None else ""
    return with_base(_priced(" AND ".join(where)) + f""",
b AS (
  SELECT *, CAST(date_trunc('{f['granularity']}', make_timestamp(CAST(order_create_time * 1000000 AS BIGINT)))
                 AS DATE) AS bucket
  FROM priced
),
fl AS (SELECT * FROM b {size}),
counts AS (SELECT bucket, count(*) AS swaps, count(DISTINCT src_trader_address) AS traders FROM fl GROUP BY 1),
pp AS (
  SELECT bucket, decimals, sum(try_cast(actual_input_units AS DECIMAL(38,0))) AS units
  FROM fl WHERE usd IS NOT NULL GROUP BY 1, 2
),
usd AS (SELECT bucket, sum(units::DOUBLE / power(10.0, decimals)) AS volume_usd FROM pp GROUP BY 1)
SELECT c.bucket, CAST(c.swaps AS BIGINT) AS swaps, c.traders, u.volume_usd
FROM counts c LEFT JOIN usd u ON u.bucket = c.bucket ORDER BY 1""")


def _sql_cross_vs_intra_daily() -> str:
    return with_base(f"""
daily AS (
  SELECT day,
         sum(CASE WHEN {XC} THEN {VOL} ELSE 0 END) AS x,
         sum(CASE WHEN NOT ({XC}) THEN {VOL} ELSE 0 END) AS i,
         sum({VOL}) AS t,
         sum(CASE WHEN {FF} THEN {CNT} ELSE 0 END) AS s
  FROM chainpair WHERE src_chain_id IS NOT NULL AND dst_chain_id IS NOT NULL GROUP BY day
)
SELECT day, x::DOUBLE AS cross_chain_usd, i::DOUBLE AS intrachain_usd, t::DOUBLE AS total_usd,
       (sum(t) OVER w7)::DOUBLE / (count(*) OVER w7)::DOUBLE AS total_7d_avg,
       CAST(s AS BIGINT) AS swaps
FROM daily
WINDOW w7 AS (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
ORDER BY day""", ("chainpair",))


def _sql_corridor_matrix(measure: str) -> str:
    cell = ("vol::DOUBLE" if measure == "volume"
            else "100.0::DOUBLE * filled::DOUBLE / nullif(n::DOUBLE, 0)")
    chains = sorted(set(binding.CHAIN_OF_REGION.values()))
    columns = ",\n       ".join(f"max(CASE WHEN dst_chain_id = '{c}' THEN v END) AS \"{c}\"" for c in chains)
    return with_base(f"""
per AS (
  SELECT src_chain_id, dst_chain_id, sum({VOL}) AS vol,
         sum(CASE WHEN {FF} THEN {CNT} ELSE 0 END) AS filled, sum({CNT}) AS n
  FROM chainpair WHERE {XC} GROUP BY 1, 2
),
cells AS (SELECT src_chain_id AS source, dst_chain_id, {cell} AS v FROM per)
SELECT source,
       {columns}
FROM cells GROUP BY source ORDER BY source""", ("chainpair",))


def _sql_top_corridors() -> str:
    k = registry.TOP_CORRIDORS
    return with_base(f"""
per AS (
  SELECT {CORRIDOR} AS corridor, sum({VOL})::DOUBLE AS volume_usd,
         CAST(sum(CASE WHEN {FF} THEN {CNT} ELSE 0 END) AS BIGINT) AS swaps
  FROM chainpair WHERE {XC} GROUP BY 1
),
v AS (SELECT 'volume' AS ranking, row_number() OVER (ORDER BY volume_usd DESC, corridor) AS rk, * FROM per),
c AS (SELECT 'count' AS ranking, row_number() OVER (ORDER BY swaps DESC, corridor) AS rk, * FROM per)
SELECT ranking, CAST(rk AS INTEGER) AS rank, corridor, volume_usd, swaps FROM v WHERE rk <= {k}
UNION ALL
SELECT ranking, CAST(rk AS INTEGER) AS rank, corridor, volume_usd, swaps FROM c WHERE rk <= {k}
ORDER BY 1, 2""", ("chainpair",))


def _bucket_case() -> str:
    b0, b1, b2, b3 = registry.SIZE_BOUNDS
    l0, l1, l2, l3, l4 = size_buckets(registry.SIZE_BOUNDS)
    return (f"CASE WHEN usd < {b0} THEN '{l0}' WHEN usd < {b1} THEN '{l1}' WHEN usd < {b2} THEN '{l2}' "
            f"WHEN usd <= {b3} THEN '{l3}' ELSE '{l4}' END")


def _sql_latency_by_size() -> str:
    return with_base(_priced(f"o.{FF} AND o.{XC}") + f""",
sized AS (SELECT {_bucket_case()} AS bucket, t_total FROM priced WHERE usd IS NOT NULL)
SELECT substr(bucket, 4) AS trade_size, count(*) AS swaps,
       quantile_disc(t_total, 0.5)::DOUBLE AS p50, quantile_disc(t_total, 0.9)::DOUBLE AS p90,
       quantile_disc(t_total, 0.99)::DOUBLE AS p99
FROM sized GROUP BY bucket ORDER BY bucket""")


def _sql_settle_time_by_corridor() -> str:
    return with_base(f"""
x AS (SELECT 1)
SELECT {CORRIDOR} AS corridor, count(*) AS swaps,
       quantile_disc(t_total, 0.5)::DOUBLE AS p50_seconds, quantile_disc(t_total, 0.9)::DOUBLE AS p90_seconds
FROM ov WHERE {FF} AND t_total > 0 AND {XC}
GROUP BY 1 ORDER BY swaps DESC, corridor""")


def _sql_success_rate_daily() -> str:
    return with_base(f"""
d AS (
  SELECT day, sum({CNT}) AS n, sum(CASE WHEN {FF} THEN {CNT} ELSE 0 END) AS filled,
         sum(CASE WHEN status <> '{FILLED}' THEN finalized_orders_volume_usd ELSE 0 END) AS failed
  FROM chainpair WHERE {XC} GROUP BY day
)
SELECT day, CAST(n AS BIGINT) AS orders, CAST(filled AS BIGINT) AS filled,
       100.0::DOUBLE * filled::DOUBLE / nullif(n::DOUBLE, 0) AS success_pct,
       failed::DOUBLE AS failed_volume_usd
FROM d ORDER BY day""", ("chainpair",))


def _sql_quote_vs_delivered() -> str:
    q, a = "try_cast(quote_output_units AS DOUBLE)", "try_cast(actual_output_units AS DOUBLE)"
    return with_base(f"""
o AS (
  SELECT {CORRIDOR} AS corridor,
         CASE WHEN {q} > 0 AND {a} IS NOT NULL THEN ({q} - {a}) / {q} * 1000000.0::DOUBLE END AS gap_pips,
         protocol_fee_pips + integrator_fee_pips AS fee_pips
  FROM ov WHERE {FF} AND {XC}
)
SELECT corridor, count(*) AS settled_orders, count(gap_pips) AS quoted_orders,
       100.0::DOUBLE * count(gap_pips)::DOUBLE / nullif(count(*)::DOUBLE, 0) AS coverage_pct,
       quantile_disc(gap_pips, 0.5)::DOUBLE AS median_gap_pips,
       quantile_disc(CASE WHEN gap_pips IS NOT NULL THEN fee_pips END, 0.5)::DOUBLE AS median_fee_pips
FROM o GROUP BY corridor ORDER BY settled_orders DESC, corridor""")


def _sql_resolver_share_daily() -> str:
    return with_base(f"""
d AS (
  SELECT day, resolver_id, sum({VOL}) AS v
  FROM resolver WHERE {XC} AND resolver_id IS NOT NULL GROUP BY 1, 2 HAVING sum({VOL}) > 0
)
SELECT day, resolver_id, v::DOUBLE AS volume_usd, v::DOUBLE / (sum(v) OVER (PARTITION BY day))::DOUBLE AS share
FROM d ORDER BY day, resolver_id""", ("resolver",))


def _sql_size_concentration() -> str:
    k = registry.TOP_TRADERS
    scaled = "u::DOUBLE / power(10.0, decimals)"
    return with_base(_priced(f"o.{FF} AND o.{XC}") + f""",
p AS (SELECT src_trader_address AS trader, decimals, actual_input_units, usd FROM priced WHERE usd IS NOT NULL),
per AS (
  SELECT trader, decimals, sum(try_cast(actual_input_units AS DECIMAL(38,0))) AS units, count(*) AS n
  FROM p GROUP BY 1, 2
),
bt AS (SELECT trader, sum(units::DOUBLE / power(10.0, decimals)) AS usd FROM per GROUP BY 1),
top AS (SELECT trader FROM bt ORDER BY usd DESC, trader LIMIT {k}),
top_usd AS (
  SELECT sum({scaled}) AS top_usd
  FROM (SELECT decimals, sum(units) AS u FROM per WHERE trader IN (SELECT trader FROM top) GROUP BY 1)
),
tot AS (
  SELECT sum({scaled}) AS total_usd, sum(n) AS trades
  FROM (SELECT decimals, sum(units) AS u, sum(n) AS n FROM per GROUP BY 1)
),
s AS (SELECT count(DISTINCT trader) AS traders, quantile_disc(usd, 0.5)::DOUBLE AS median_trade_usd FROM p)
SELECT CAST(tot.trades AS BIGINT) AS trades, s.traders,
       tot.total_usd / nullif(tot.trades::DOUBLE, 0) AS mean_trade_usd, s.median_trade_usd,
       top_usd.top_usd AS top{k}_usd, tot.total_usd,
       100.0::DOUBLE * top_usd.top_usd / nullif(tot.total_usd, 0) AS top{k}_share_pct
FROM tot, top_usd, s""")


def _sql_order_lookup() -> str:
    return with_base(f"""
x AS (SELECT 1)
SELECT CAST(lt_num AS VARCHAR) AS lt, status, quote_id, src_chain_id, dst_chain_id, input_asset_address,
       output_asset_address, quote_input_units, actual_output_units, resolver_id, src_trader_address,
       integrator_address, order_create_time, order_finalize_time, t_total
FROM ov WHERE quote_id = '{registry.LOOKUP_QUOTE_ID}' ORDER BY lt""")


def dashboard_sql() -> dict[str, str]:
    return {
        "headline_windows": _sql_headline_windows(),
        "filtered_volume": _sql_filtered_volume(),
        "cross_vs_intra_daily": _sql_cross_vs_intra_daily(),
        "corridor_matrix_volume": _sql_corridor_matrix("volume"),
        "corridor_matrix_success": _sql_corridor_matrix("success"),
        "top_corridors": _sql_top_corridors(),
        "latency_by_size": _sql_latency_by_size(),
        "settle_time_by_corridor": _sql_settle_time_by_corridor(),
        "success_rate_daily": _sql_success_rate_daily(),
        "quote_vs_delivered": _sql_quote_vs_delivered(),
        "resolver_share_daily": _sql_resolver_share_daily(),
        "size_concentration": _sql_size_concentration(),
        "order_lookup": _sql_order_lookup(),
    }
