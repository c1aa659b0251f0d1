"""Benchmark: one refresh, then every metric and dashboard analytic over the
published tables, then every registered query end to end from the raw tables.
The headline value is the refresh plus the metrics over the published tables
(Q1-Q22; Q23 reads only their stamps).

Env: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_SCRATCH`` (folder for the published tables; a fresh
temporary folder by default). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from flowcubes import schemas  # noqa: E402
from flowcubes.operators import publish  # noqa: E402
from flowcubes.plans import assets, dashboard, fees, flows, growth, latency, leagues, registry, rhythm, wallets  # noqa: E402
from flowcubes.session import build_session  # noqa: E402
from flowcubes.sources import binding  # noqa: E402


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def control(spark) -> None:
    """A fixed query that none of this code touches: what changes in its time is
    the machine's, not the code's."""
    rows = spark.range(0, 50_000_000, numPartitions=8).selectExpr("id % 1000 AS k", "hash(id) AS v")
    _run(rows.groupBy("k").agg({"v": "sum"}))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    scratch = os.environ.get("BENCH_SCRATCH") or tempfile.mkdtemp(prefix="flowcubes-bench-")
    os.environ.setdefault("FLOWCUBES_SCRATCH", scratch)
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(cpus, 8), app_name="flowcubes-bench")
    spark.sparkContext.setLogLevel("ERROR")
    root = os.path.join(scratch, "published")

    times: dict[str, float] = {}
    t0 = time.time()
    control(spark)
    times["control"] = time.time() - t0
    t0 = time.time()
    publish.refresh(spark, binding.orders(spark, sf_dir), root, registry.RUN_TS)
    times["refresh"] = time.time() - t0

    # Each published table is opened once (pointer, listing, footer) and the
    # handle reused by every metric, as a serving layer would; the open is
    # timed as part of serving.
    t = time.time()
    opened = {name: publish.read_table(spark, root, name) for name in schemas.TABLES}
    times["open_tables"] = time.time() - t

    def table(name):
        return opened[name]

    evm, jet = binding.evm_tokens(spark, sf_dir), binding.jetton_metadata(spark, sf_dir)
    act = binding.activity(spark, sf_dir)
    published = {
        "headline": lambda: growth.headline(table("daily_chainpair"), table("orders")),
        "cross_chain_volume_daily": lambda: growth.cross_chain_volume_daily(table("daily_chainpair")),
        "chain_volume_daily": lambda: growth.chain_volume_daily(table("daily_chainpair")),
        "new_vs_returning_weekly": lambda: growth.new_vs_returning_weekly(table("orders")),
        "trader_cohorts": lambda: growth.trader_cohorts(table("orders")),
        "fee_headline": lambda: fees.fee_headline(table("daily_chainpair"), table("daily_integrator")),
        "fee_split_daily": lambda: fees.fee_split_daily(table("daily_chainpair")),
        "integrator_league": lambda: fees.integrator_league(table("daily_integrator")),
        "chain_flows": lambda: flows.chain_flows(table("daily_chainpair")),
        "corridor_share_daily": lambda: flows.corridor_share_daily(table("daily_chainpair")),
        "net_flow_by_chain": lambda: flows.net_flow_by_chain(table("daily_chainpair")),
        "hourly_clock": lambda: rhythm.hourly_clock(act, registry.EVENTS_AS_OF),
        "weekday_clock": lambda: rhythm.weekday_clock(act, registry.EVENTS_AS_OF),
        "latency_funnel": lambda: latency.latency_funnel(table("orders")),
        "settlement_speed_daily": lambda: latency.settlement_speed_daily(table("orders")),
        "resolver_league": lambda: leagues.resolver_league(table("daily_resolver"), table("orders")),
        "assets_sold": lambda: assets.assets_sold(table("daily_input_asset"), evm, jet),
        "assets_bought": lambda: assets.assets_bought(table("daily_output_asset"), evm, jet),
        "trade_size_distribution": lambda: assets.trade_size_distribution(
            table("orders"), evm, jet, binding.stable_symbols(), registry.SIZE_BOUNDS),
        "token_flow_headline": lambda: wallets.token_flow_headline(
            table("orders"), table("daily_chainpair"), registry.DEPOSIT_TOKEN, registry.WITHDRAWAL_TOKEN,
            registry.TOKEN_DECIMALS),
        "token_flow_daily": lambda: wallets.token_flow_daily(
            table("orders"), registry.DEPOSIT_TOKEN, registry.WITHDRAWAL_TOKEN, registry.TOKEN_DECIMALS),
        "funded_wallet_impact": lambda: wallets.funded_wallet_impact(
            binding.deposits(spark, sf_dir), binding.deposit_wallets(spark, sf_dir),
            binding.market_trades(spark, sf_dir)),
    }
    serving = times["open_tables"]
    for name, build in published.items():
        t = time.time()
        _run(build())
        times[name] = time.time() - t
        serving += times[name]

    stable = binding.stable_symbols()
    board = {
        "headline_windows": lambda: dashboard.headline_windows(
            table("daily_chainpair"), table("orders"), registry.DASHBOARD_AS_OF),
        "filtered_volume": lambda: dashboard.filtered_volume(table("orders"), evm, jet, stable=stable,
                                                             **registry.FILTERS),
        "cross_vs_intra_daily": lambda: dashboard.cross_vs_intra_daily(table("daily_chainpair")),
        "corridor_matrix_volume": lambda: dashboard.corridor_matrix(table("daily_chainpair"), "volume"),
        "corridor_matrix_success": lambda: dashboard.corridor_matrix(table("daily_chainpair"), "success"),
        "top_corridors": lambda: dashboard.top_corridors(table("daily_chainpair"), registry.TOP_CORRIDORS),
        "latency_by_size": lambda: dashboard.latency_by_size(table("orders"), evm, jet, stable, registry.SIZE_BOUNDS),
        "settle_time_by_corridor": lambda: dashboard.settle_time_by_corridor(table("orders")),
        "success_rate_daily": lambda: dashboard.success_rate_daily(table("daily_chainpair")),
        "quote_vs_delivered": lambda: dashboard.quote_vs_delivered(table("orders")),
        "resolver_share_daily": lambda: dashboard.resolver_share_daily(table("daily_resolver")),
        "size_concentration": lambda: dashboard.size_concentration(table("orders"), evm, jet, stable,
                                                                   registry.TOP_TRADERS),
        "order_lookup": lambda: dashboard.order_lookup(table("orders"), registry.LOOKUP_QUOTE_ID),
    }
    board_total = 0.0
    for name, build in board.items():
        t = time.time()
        _run(build())
        times[f"dashboard:{name}"] = time.time() - t
        board_total += times[f"dashboard:{name}"]

    raw_total = 0.0
    for name, q in registry.queries().items():
        t = time.time()
        _run(q(spark, sf_dir))
        times[f"raw:{name}"] = time.time() - t
        raw_total += times[f"raw:{name}"]

    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "refresh_plus_22_metrics_seconds",
        "value": round(times["refresh"] + serving, 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "refresh_sec": round(times["refresh"], 3),
        "serving_sec": round(serving, 3),
        "dashboard_sec": round(board_total, 3),
        "raw_registry_sec": round(raw_total, 3),
        "control_sec": round(times["control"], 3),
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
