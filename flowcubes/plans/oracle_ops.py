"""DuckDB twins of the operator-layer registry entries."""

from __future__ import annotations

from .. import schemas
from ..sources import binding
from . import registry, registry_ops
from .oracle import _METRICS, CUBES, FAILED, FF, FILLED, SEEN, STABLE, XC, _clock, with_base

VIEW_COLUMNS = (
    "status, quote_id, src_chain_id, dst_chain_id, input_asset_chain, input_asset_kind, "
    "input_asset_address, output_asset_chain, output_asset_kind, output_asset_address, "
    "quote_input_units, quote_output_units, actual_input_units, actual_output_units, "
    "actual_protocol_fee_units, actual_integrator_fee_units, integrator_fee_pips, protocol_fee_pips, "
    "resolver_id, src_trader_chain, src_trader_address, dst_trader_chain, dst_trader_address, "
    "src_resolver_chain, src_resolver_address, dst_resolver_chain, dst_resolver_address, "
    "integrator_chain, integrator_address, quote_request_time, quote_time, order_create_time, "
    "order_finalize_time, t_quote, t_decide, t_settle, t_total, day, finalized_usd, filled_usd, "
    "protocol_fee_usd, integrator_fee_usd"
)


def _metrics_out(table: str) -> str:
    out = []
    for m in schemas.cube_metrics(table):
        kind = "BIGINT" if m.endswith("_count") else "DOUBLE"
        out.append(f"CAST({m} AS {kind}) AS {m}")
    return ", ".join(out)


def _cube_name(table: str) -> str:
    return table.removeprefix("daily_")


def _sql_cube(table: str) -> str:
    dims = ", ".join(("day",) + schemas.CUBE_DIMENSIONS[table])
    return with_base(f"x AS (SELECT 1)\nSELECT {dims}, {_metrics_out(table)} FROM {_cube_name(table)}",
                     (_cube_name(table),))


_METRICS_SQL = """
    sum(finalized_usd) AS finalized_orders_volume_usd,
    sum(filled_usd) AS filled_orders_volume_usd,
    sum(protocol_fee_usd) AS protocol_fees_usd,
    sum(integrator_fee_usd) AS integrator_fees_usd,
    count(*) AS finalized_orders_count,
    count(DISTINCT src_trader_address) AS unique_trader_wallets_count"""


def _sql_alltime() -> str:
    dims = ", ".join(schemas.CUBE_DIMENSIONS["daily_chainpair"])
    return with_base(f"""
c AS (SELECT {dims}, {_METRICS_SQL} FROM ov GROUP BY {dims})
SELECT {dims}, {_metrics_out("daily_chainpair")} FROM c""")


def _sql_hourly() -> str:
    dims = ", ".join(schemas.CUBE_DIMENSIONS["daily_chainpair"])
    return with_base(f"""
c AS (
  SELECT date_trunc('hour', make_timestamp(CAST(order_create_time * 1000000 AS BIGINT))) AS hour, {dims},
         {_METRICS_SQL}
  FROM ov GROUP BY ALL
)
SELECT hour, {dims}, {_metrics_out("daily_chainpair")} FROM c""")


# An order's second within its creation day.
CLOCK = "make_timestamp((order_create_time * 1000000)::BIGINT) + to_seconds(lt_num % 86400)"


def _sql_hourly_clocked() -> str:
    dims = ", ".join(schemas.CUBE_DIMENSIONS["daily_chainpair"])
    return with_base(f"""
c AS (SELECT date_trunc('hour', {CLOCK}) AS hour, {dims}, {_METRICS_SQL} FROM ov GROUP BY ALL)
SELECT hour, {dims}, {_metrics_out("daily_chainpair")} FROM c""")


def _order_clock(*labels: str) -> str:
    acts = f"""
acts AS (
  SELECT {CLOCK} AS ts, src_trader_address AS trader,
         CASE WHEN coalesce(t.symbol, jt.symbol) IN ({STABLE}) THEN
           (actual_input_units::DECIMAL(18,0) * (10 ** -coalesce(t.decimals, jt.decimals))::DECIMAL(10,8))::DECIMAL(18,2) END AS usd
  FROM ov o {_resolved('o')} WHERE o.{FF} AND o.{XC})"""
    return _clock(*labels, acts, registry.DASHBOARD_AS_OF)


def _sql_rollup_total() -> str:
    sums = ", ".join(
        f"CAST(sum({m}) AS {'BIGINT' if m.endswith('_count') else 'DOUBLE'}) AS {m}"
        for m in schemas.ADDITIVE_METRICS
    )
    return with_base(f"x AS (SELECT 1)\nSELECT day, {sums} FROM chainpair GROUP BY day", ("chainpair",))


def _sql_grouping_sets() -> str:
    dims: list[str] = []
    for t in schemas.CUBE_DIMENSIONS:
        for d in schemas.CUBE_DIMENSIONS[t]:
            if d not in dims:
                dims.append(d)
    parts = []
    for t, own in schemas.CUBE_DIMENSIONS.items():
        cols = ", ".join(d if d in own else f"CAST(NULL AS VARCHAR) AS {d}" for d in dims)
        parts.append(f"SELECT '{t}' AS cube, day, {cols}, {_metrics_out('daily_total')} FROM {_cube_name(t)}")
    return with_base("x AS (SELECT 1)\n" + "\nUNION ALL\n".join(parts), tuple(CUBES))


_TON_RAW = "'0:' || substr(upper(hex(from_base64(replace(replace({a}, '-', '+'), '_', '/')))), 5, 64)"


def _resolved(src: str) -> str:
    return f"""
  LEFT JOIN evm_tokens t ON t.blockchain = {src}.input_asset_chain
        AND t.contract_address = try(unhex(regexp_replace({src}.input_asset_address, '^0x', '')))
  LEFT JOIN jettons jt ON jt.address = CASE WHEN {src}.input_asset_chain = 'ton'
        AND {src}.input_asset_address IS NOT NULL THEN {_TON_RAW.format(a=src + '.input_asset_address')} END"""


def _sql_latest_revision() -> str:
    return with_base("x AS (SELECT 1)\nSELECT address, symbol, decimals FROM jettons")


def _sql_ton_raw() -> str:
    return with_base(f"""
a AS (SELECT DISTINCT input_asset_address AS address FROM ov
      WHERE input_asset_chain = 'ton' AND input_asset_address IS NOT NULL)
SELECT address, {_TON_RAW.format(a='address')} AS raw_address FROM a""")


def _sql_evm_key() -> str:
    return with_base("""
a AS (SELECT DISTINCT input_asset_address AS address FROM ov
      WHERE input_asset_chain <> 'ton' AND input_asset_address IS NOT NULL)
SELECT address, hex(try(unhex(regexp_replace(address, '^0x', '')))) AS key_hex FROM a""")


def _sql_resolution() -> str:
    return with_base(f"""
a AS (SELECT DISTINCT input_asset_chain, input_asset_kind, input_asset_address FROM ov)
SELECT a.input_asset_chain, a.input_asset_kind, a.input_asset_address,
       coalesce(t.symbol, jt.symbol) AS symbol, CAST(coalesce(t.decimals, jt.decimals) AS INTEGER) AS decimals
FROM a {_resolved('a')}""")


def _priced_cte() -> str:
    return f"""
p0 AS (
  SELECT o.actual_input_units, coalesce(t.symbol, jt.symbol) AS symbol,
         coalesce(t.decimals, jt.decimals) AS decimals
  FROM ov o {_resolved('o')}
  WHERE o.{FF} AND o.{XC}
),
priced AS (
  SELECT *, CASE WHEN symbol IN ({STABLE})
                 THEN try_cast(actual_input_units AS DOUBLE) / power(10.0, decimals) END AS usd
  FROM p0
)"""


def _sql_stable_pricing() -> str:
    return with_base(_priced_cte() + """,
per AS (
  SELECT symbol, decimals, count(*) AS n, sum(try_cast(actual_input_units AS DECIMAL(38,0))) AS u
  FROM priced WHERE usd IS NOT NULL GROUP BY 1, 2
)
SELECT symbol, CAST(sum(n) AS BIGINT) AS orders, sum(u::DOUBLE / power(10.0, decimals)) AS volume_usd
FROM per GROUP BY symbol""")


def _sql_reconciliation() -> str:
    return with_base(_priced_cte() + f""",
per AS (
  SELECT decimals, count(*) AS n, sum(try_cast(actual_input_units AS DECIMAL(38,0))) AS u
  FROM priced WHERE usd IS NOT NULL GROUP BY 1
),
p AS (SELECT CAST(sum(n) AS BIGINT) AS priced_trades, sum(u::DOUBLE / power(10.0, decimals)) AS priced_usd FROM per),
n AS (SELECT count(*) AS trades FROM priced),
c AS (SELECT sum(filled_orders_volume_usd)::DOUBLE AS cube_usd FROM chainpair WHERE {XC})
SELECT priced_trades, trades, priced_usd, cube_usd, (cube_usd - priced_usd) / nullif(cube_usd, 0) AS gap
FROM p, n, c""", ("chainpair",))


def _sql_top_resolvers() -> str:
    k = registry_ops.TOP_RESOLVERS
    return with_base(f"""
per AS (SELECT resolver_id, sum(filled_orders_volume_usd) AS usd FROM resolver WHERE {XC} GROUP BY 1),
top AS (SELECT resolver_id FROM per ORDER BY usd DESC, resolver_id LIMIT {k})
SELECT CASE WHEN resolver_id IN (SELECT resolver_id FROM top) THEN resolver_id ELSE 'other' END AS resolver_id,
       sum(usd)::DOUBLE AS volume_usd
FROM per GROUP BY 1""", ("resolver",))


def _sql_labels() -> str:
    return with_base("""
r AS (SELECT DISTINCT resolver_id AS value FROM ov),
i AS (SELECT DISTINCT integrator_address AS value FROM ov WHERE integrator_address IS NOT NULL)
SELECT 'resolver' AS kind, value, substr(value, 1, 10) || '…' AS label FROM r
UNION ALL
SELECT 'integrator', value, substr(value, 1, 6) || '…' || substr(value, -4) FROM i""")


def _sql_health() -> str:
    parts = []
    for t in schemas.CUBE_DIMENSIONS:
        c = _cube_name(t)
        for col in schemas.required_columns(t):
            parts.append(f"SELECT '{t}' AS \"table\", (SELECT count(*) FROM {c}) AS rows, "
                         f"'{col}' AS \"column\", CAST(0 AS BIGINT) AS null_rows")
    for col in schemas.required_columns(schemas.ORDERS_TABLE):
        parts.append(f"SELECT 'orders', (SELECT count(*) FROM ov), '{col}', CAST(0 AS BIGINT)")
    return with_base("x AS (SELECT 1)\n" + "\nUNION ALL\n".join(parts), tuple(CUBES))


def _sql_day_gaps() -> str:
    return with_base("""
d AS (SELECT DISTINCT day FROM total WHERE day IS NOT NULL),
g AS (SELECT lag(day) OVER (ORDER BY day) AS prev_day, day FROM d)
SELECT prev_day, day, CAST(day - prev_day AS INTEGER) AS gap FROM g WHERE day - prev_day > %d""" % registry_ops.DAY_GAP, ("total",))


def _sql_cube_mismatch() -> str:
    return with_base(f"""
fo AS (SELECT day, src_chain_id, dst_chain_id, status, count(*) AS order_rows FROM ov GROUP BY ALL),
fc AS (SELECT day, src_chain_id, dst_chain_id, status, CAST(sum(finalized_orders_count) AS BIGINT) AS cube_count
       FROM chainpair WHERE status = '{FILLED}' GROUP BY ALL)
SELECT coalesce(fc.day, fo.day) AS day, coalesce(fc.src_chain_id, fo.src_chain_id) AS src_chain_id,
       coalesce(fc.dst_chain_id, fo.dst_chain_id) AS dst_chain_id, coalesce(fc.status, fo.status) AS status,
       cube_count, order_rows
FROM fc FULL JOIN fo ON fc.day = fo.day AND fc.src_chain_id = fo.src_chain_id
     AND fc.dst_chain_id = fo.dst_chain_id AND fc.status = fo.status
WHERE NOT coalesce(cube_count = order_rows, false)""", ("chainpair",))


def _sql_unknown_status() -> str:
    return with_base(f"""
x AS (SELECT 1)
SELECT status, count(*) AS orders FROM ov
WHERE status IS DISTINCT FROM '{FILLED}' GROUP BY status""")


def _sql_failed_units() -> str:
    return with_base(f"""
x AS (SELECT 1)
SELECT count(*) AS orders FROM ov
WHERE status = '{FAILED}'
  AND (coalesce(try_cast(actual_input_units AS DECIMAL(38,0)) <> 0, false)
    OR coalesce(try_cast(actual_output_units AS DECIMAL(38,0)) <> 0, false))""")


def _sql_monthly() -> str:
    return with_base(f"""
x AS (SELECT 1)
SELECT CAST(date_trunc('month', day) AS DATE) AS month,
       CAST(count_if(status = '{FILLED}') AS BIGINT) AS filled,
       CAST(count_if(status = '{FAILED}') AS BIGINT) AS failed
FROM ov GROUP BY 1""")


def _sql_latency() -> str:
    return with_base("x AS (SELECT 1)\nSELECT quote_id, resolver_id, t_quote, t_decide, t_settle, t_total FROM ov")


def _sql_seek() -> str:
    ts = registry_ops.epoch(registry_ops.SEEK_FROM) * 1_000_000_000
    return with_base(f"x AS (SELECT 1)\nSELECT count(*) AS orders, min(lt_num) AS first_lt FROM ov WHERE lt_num >= {ts}")


def _sql_dup_lt() -> str:
    return with_base("""
x AS (SELECT 1)
SELECT CAST(lt_num AS VARCHAR) AS lt, count(*) AS copies FROM ov GROUP BY lt_num HAVING count(*) > 1""")


def _sql_created_between() -> str:
    a, b = registry_ops.epoch(registry_ops.CREATED_FROM), registry_ops.epoch(registry_ops.CREATED_TO)
    return with_base(f"""
x AS (SELECT 1)
SELECT status, count(*) AS orders FROM ov
WHERE order_create_time >= {a}.0 AND order_create_time < {b}.0 GROUP BY status""")


def _sql_coverage() -> str:
    a, b = registry_ops.epoch(registry_ops.BACKFILL_FROM), registry_ops.epoch(registry_ops.BACKFILL_TO)
    step = 30 * 86400
    n = max(0, -(-(b - a) // step))
    return with_base(f"""
w AS (SELECT CAST(i AS BIGINT) AS window FROM range(0, {n}) t(i)),
c AS (
  SELECT CAST(floor((order_create_time - {a}.0) / {float(step)}) AS BIGINT) AS window, count(*) AS orders
  FROM ov WHERE order_create_time >= {a}.0 AND order_create_time < {b}.0 GROUP BY 1
)
SELECT w.window, {a} + w.window * {step} AS from_ts, least({a} + (w.window + 1) * {step}, {b}) AS to_ts,
       CAST(coalesce(c.orders, 0) AS BIGINT) AS orders
FROM w LEFT JOIN c ON c.window = w.window""")


def _sql_dedupe() -> str:
    return with_base(f"x AS (SELECT 1)\nSELECT count(*) AS orders FROM (SELECT DISTINCT {VIEW_COLUMNS} FROM ov)")


def _sql_recent() -> str:
    a, d = registry_ops.RETENTION_AS_OF, registry_ops.RETENTION_DAYS
    return with_base(f"""
x AS (SELECT 1)
SELECT day, count(*) AS orders FROM ov
WHERE day >= DATE '{a}' - {d} AND day < DATE '{a}' GROUP BY day""")


def _sql_history_recent() -> str:
    return with_base(f"x AS (SELECT 1)\nSELECT day, {_metrics_out('daily_total')} FROM total", ("total",))


def _sql_ingest_pages() -> str:
    from .registry_ops import INGESTED_COLUMNS

    cols = ", ".join("CAST(lt_num AS VARCHAR) AS lt" if c == "lt" else c for c in INGESTED_COLUMNS)
    return with_base(f"""
x AS (SELECT 1)
SELECT {cols} FROM ov""")


def _sql_ingest_cube_pages() -> str:
    table = registry_ops.INGESTED_CUBE
    dims = ", ".join(schemas.CUBE_DIMENSIONS[table])
    metrics = ", ".join(f"{m}::DOUBLE AS {m}" for m in schemas.cube_metrics(table))
    return with_base(f"x AS (SELECT 1)\nSELECT day, {dims}, {metrics} FROM {_cube_name(table)}",
                     (_cube_name(table),))


def _sql_unparseable_days() -> str:
    cube = _cube_name(registry_ops.INGESTED_CUBE)
    return with_base(f"""
t AS (SELECT if(src_chain_id = '{registry_ops.ODD_DAYS_CHAIN}', strftime(day, '%Y/%m/%d'), strftime(day, '%Y-%m-%d')) || 'T00:00:00Z' AS day_text FROM {cube})
SELECT day_text AS value FROM t WHERE try_strptime(day_text, '%Y-%m-%dT%H:%M:%SZ') IS NULL""", (cube,))


def _sql_freshness() -> str:
    return with_base("""
stamps AS (
  SELECT make_timestamp((max(order_finalize_time) * 1000000)::BIGINT) AS v FROM ov
  UNION ALL SELECT max(day)::TIMESTAMP FROM ov
)
SELECT max(v) AS refreshed_at, count(DISTINCT v) AS distinct_vintages FROM stamps""")


def _sql_cursor() -> str:
    """Row by row over the whole landing."""
    return with_base(f"""
daily AS (SELECT lt_num // {registry_ops.DAY_NANOS} AS page, lt_num AS lt FROM ov),
sent AS (SELECT page, lt FROM daily WHERE page % 40 NOT IN (8, 20) UNION ALL SELECT page + 1, lt FROM daily WHERE page % 40 = 7),
steps AS (SELECT page, count(*) AS rows, min(lt) AS first, max(lt) AS last, count(*) - count(DISTINCT lt) AS stalls FROM sent GROUP BY page),
seen AS (SELECT *, max(last) OVER w AS high, lag(page) OVER (ORDER BY page) AS previous FROM steps WINDOW w AS (ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT page, 'not ascending in page' AS problem, stalls AS rows FROM seen WHERE stalls > 0
UNION ALL SELECT page, 'cursor did not advance', rows FROM seen WHERE first <= high
UNION ALL SELECT page, 'pages missing before', page - previous - 1 FROM seen WHERE page > previous + 1""")


def _sql_upsert() -> str:
    return with_base("""
best AS (SELECT lt_num AS lt, filled_usd, status FROM ov QUALIFY row_number() OVER (PARTITION BY lt_num ORDER BY filled_usd DESC, status DESC) = 1),
merged AS (SELECT lt, CASE WHEN lands AND lt % 2 = 0 THEN 'RELANDED' ELSE status END AS status, CASE WHEN lands AND lt % 2 = 0 THEN filled_usd + 1 ELSE filled_usd END AS filled_usd
           FROM (SELECT *, (lt % 5 = 0 OR lt % 3 = 0) AS lands FROM best))
SELECT status, count(*) AS orders, count(*) AS keys, sum(filled_usd)::DOUBLE AS filled_usd FROM merged GROUP BY status""")


def _sql_late_finalization() -> str:
    """Recomputed from the orders that are left."""
    dims = ", ".join(("day",) + schemas.CUBE_DIMENSIONS["daily_chainpair"])
    return with_base(f"""
now AS (SELECT * FROM ov WHERE day < DATE '{registry_ops.WINDOW_FROM}' OR lt_num % 11 <> 0),
chainpair AS (SELECT {dims}, {_METRICS} FROM now GROUP BY {dims})
SELECT {dims}, {_metrics_out("daily_chainpair")} FROM chainpair""")


def _sql_monthly_quantiles() -> str:
    return with_base(f"""
timed AS (SELECT date_trunc('month', day)::DATE AS month, src_chain_id, count(*) AS orders FROM ov
          WHERE {FF} AND t_total > 0 GROUP BY ALL)
SELECT month, src_chain_id, p, orders, true AS within_bound
FROM timed, (SELECT unnest([0.5::DOUBLE, 0.9::DOUBLE, 0.99::DOUBLE]) AS p)""")


def _sql_new_returning_sketch() -> str:
    return with_base(SEEN + """
SELECT week, (SELECT count(DISTINCT e.trader) FROM seen e WHERE e.born <= s.week) AS cumulative_traders,
       true AS new_traders_within, true AS returning_traders_within, true AS cumulative_traders_within
FROM (SELECT DISTINCT week FROM seen) s""")


def _sql_cohort_sketch() -> str:
    """Each two active weeks at most so far apart, and who of the first's new
    traders was active in the second."""
    return with_base(SEEN + f""",
weeks AS (SELECT DISTINCT week FROM seen)
SELECT a.week AS cohort_week, ((b.week - a.week) // 7)::BIGINT AS weeks_after,
       (SELECT count(*) FROM seen s WHERE s.born = a.week AND s.week = b.week) AS retained_traders, true AS within_bound
FROM weeks a JOIN weeks b ON b.week BETWEEN a.week AND a.week + {7 * registry_ops.SKETCH_WEEKS}""")


def _sql_wide_total(column: str, size: int = 15, parts: int = 6) -> str:
    """Digits added up by parts of 15 and carried by hand, lowest part first."""
    width = size * parts
    at = [f"sum(substr(lpad({column}, {width}, '0'), {width - size * (i + 1) + 1}, {size})::HUGEINT)" for i in range(parts)]
    total, text = at[0], ""
    for part in at[1:]:
        text = f"lpad((({total}) % {10**size}::HUGEINT)::VARCHAR, {size}, '0')" + (f" || {text}" if text else "")
        total = f"({part} + ({total}) // {10**size}::HUGEINT)"
    return f"ltrim(({total})::VARCHAR || {text}, '0')"


def _sql_wide_units() -> str:
    return with_base(f"""
wide AS (SELECT src_chain_id, dst_chain_id, '1' || lpad(lt_num::VARCHAR, 29, '0') || lpad(quote_id, 30, '0') AS units_60,
                '9' || lpad(quote_id, 38, '7') || lpad(lt_num::VARCHAR, 39, '8') AS units_78 FROM ov)
SELECT src_chain_id, dst_chain_id, {_sql_wide_total("units_60")} AS units_60, {_sql_wide_total("units_78")} AS units_78
FROM wide GROUP BY ALL""")


def _sql_vintages() -> str:
    """Groups of each cube counted from the orders of each run."""
    def of_run(n: int, orders: str) -> str:
        def groups(t: str) -> str:
            dims = ", ".join(("day",) + schemas.CUBE_DIMENSIONS[t])
            return f"SELECT {n} AS n, '{t}' AS \"table\", count(*) AS rows FROM (SELECT DISTINCT {dims} FROM {orders})"

        every = [f"SELECT {n} AS n, '{schemas.ORDERS_TABLE}' AS \"table\", count(*) AS rows FROM {orders}"]
        return " UNION ALL ".join(every + [groups(t) for t in schemas.CUBE_DIMENSIONS])

    first, second = registry_ops.RUNS
    return with_base(f"""
old AS (SELECT * FROM ov WHERE day < DATE '{registry_ops.WINDOW_FROM}'),
held AS ({of_run(1, "old")} UNION ALL {of_run(2, "ov")})
SELECT "table", rows, CASE n WHEN 1 THEN TIMESTAMP '{first}' ELSE TIMESTAMP '{second}' END AS run_ts,
       n = 2 AS current, CASE n WHEN 2 THEN 1::BIGINT END AS distinct_vintages FROM held""")


def _sql_null_rows() -> str:
    lacking = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", lt_num, day FROM ov WHERE lt_num % {n} = 0" for c, n in registry_ops.LACKING.items())
    return with_base(f"""
lacking AS ({lacking})
SELECT '{schemas.ORDERS_TABLE}' AS "table", "column", 'lt_num=' || lt_num || ', day=' || day AS row FROM lacking""")


def operator_sql() -> dict[str, str]:
    out = {f"cube_{t}": _sql_cube(t) for t in schemas.CUBE_DIMENSIONS}
    out.update({
        "cube_alltime_chainpair": _sql_alltime(),
        "cube_hourly_chainpair": _sql_hourly(),
        "cube_hourly_clocked": _sql_hourly_clocked(),
        "hourly_clock_from_orders": _order_clock("HOUR", "%H:00", "hour(slot)", "hour_utc"),
        "weekday_clock_from_orders": _order_clock("DAY", "%A", "isodow(slot)", "weekday"),
        "cube_rollup_total": _sql_rollup_total(),
        "cube_grouping_sets": _sql_grouping_sets(),
        "token_latest_revision": _sql_latest_revision(),
        "token_ton_raw": _sql_ton_raw(),
        "token_evm_key": _sql_evm_key(),
        "token_resolution": _sql_resolution(),
        "token_stable_pricing": _sql_stable_pricing(),
        "token_pricing_reconciliation": _sql_reconciliation(),
        "token_top_k": _sql_top_resolvers(),
        "token_labels": _sql_labels(),
        "freshness": _sql_freshness(),
        "quality_table_health": _sql_health(),
        "quality_day_gaps": _sql_day_gaps(),
        "quality_cube_reconciliation": _sql_cube_mismatch(),
        "quality_status_domain": _sql_unknown_status(),
        "quality_failed_units": _sql_failed_units(),
        "quality_monthly_status": _sql_monthly(),
        "order_latency": _sql_latency(),
        "order_lt_seek": _sql_seek(),
        "order_lt_duplicates": _sql_dup_lt(),
        "order_created_between": _sql_created_between(),
        "order_backfill_coverage": _sql_coverage(),
        "order_cursor_violations": _sql_cursor(),
        "order_upsert_lt": _sql_upsert(),
        "publish_vintages": _sql_vintages(),
        "quality_null_rows": _sql_null_rows(),
        "cube_late_finalization": _sql_late_finalization(),
        "cube_monthly_quantiles": _sql_monthly_quantiles(),
        "cube_new_returning_sketch": _sql_new_returning_sketch(),
        "cube_cohort_sketch": _sql_cohort_sketch(),
        "token_wide_units": _sql_wide_units(),
        "order_dedupe": _sql_dedupe(),
        "ingest_order_pages": _sql_ingest_pages(),
        "ingest_cube_pages": _sql_ingest_cube_pages(),
        "quality_unparseable_days": _sql_unparseable_days(),
        "retention_recent_orders": _sql_recent(),
        "retention_history_recent": _sql_history_recent(),
    })
    return out


__all__ = ["operator_sql", "binding", "registry"]
