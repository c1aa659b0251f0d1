"""The query registry: every metric wired to the stand-in inputs of a data
directory. Each entry is ``(spark, data_dir) -> DataFrame`` and reads the
whole tables; nothing is sampled or capped."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import cubes
from ..session import ORDER_CONF
from ..sources import binding
from . import assets, dashboard, fees, flows, freshness, growth, impact, latency, leagues, rhythm, wallets

# Parameters of the stand-in data (see ``sources.binding``).
DEPOSIT_TOKEN = "0x50524F4D4F"        # part type PROMO bought on an EVM chain
WITHDRAWAL_TOKEN = "0x4272616E642334"  # part brand Brand#4 sold on an EVM chain
IMPACT_FROM, IMPACT_TO, IMPACT_WITHIN = "1997-04-10", "1997-10-10", 30 * 86400
TOKEN_DECIMALS = binding.TOKEN_DECIMALS
SIZE_BOUNDS = (2000, 10000, 50000, 90000)
EVENTS_AS_OF = binding.EVENTS_AS_OF
RUN_TS = "2024-01-31 06:00:00"
# Dashboard parameters: tiles end the day after the last creation day of
# the driver's data; the global filters of the filtered-volume report.
DASHBOARD_AS_OF = "2001-08-02"
FILTERS = {"granularity": "month", "start": "1996-01-01", "end": "1998-01-01", "src": "ton", "dst": None,
           "min_usd": SIZE_BOUNDS[1]}
TOP_CORRIDORS = 10
CHAINS = tuple(sorted(set(binding.CHAIN_OF_REGION.values())))
TOP_TRADERS = 10
LOOKUP_QUOTE_ID = "7"

Query = Callable[[SparkSession, str], DataFrame]


class Inputs:
    """Lazily built frames of one data directory."""

    def __init__(self, spark: SparkSession, data_dir: str):
        self.spark, self.dir = spark, data_dir

    def orders(self) -> DataFrame:
        return binding.orders(self.spark, self.dir)

    def cube(self, table: str) -> DataFrame:
        return cubes.named_cube(self.orders(), table)

    def evm(self) -> DataFrame:
        return binding.evm_tokens(self.spark, self.dir)

    def jettons(self) -> DataFrame:
        return binding.jetton_metadata(self.spark, self.dir)


def _q(fn: Callable[[Inputs], DataFrame]) -> Query:
    def run(spark: SparkSession, data_dir: str) -> DataFrame:
        for key, value in ORDER_CONF.items():
            spark.conf.set(key, value)
        return fn(Inputs(spark, data_dir))

    run.__doc__ = fn.__doc__
    return run


def _freshness(i: Inputs) -> DataFrame:
    """Two vintages that the data themselves give: orders stamped with their
    last settlement, cubes with the last creation day they hold, which is that
    of the orders; so one aggregate of the orders gives all stamps."""
    from pyspark.sql import functions as F

    last = i.orders().agg(F.timestamp_seconds(F.max("order_finalize_time")).alias("settled"), F.max("day").cast("timestamp").alias("created"))
    stamps = last.select(F.explode(F.array("settled", *["created"] * len(cubes.schemas.CUBE_DIMENSIONS))).alias("run_ts"))
    return freshness.freshness({"all": stamps}).withColumn("refreshed_at", F.col("refreshed_at").cast("timestamp_ntz"))


def _wallet_impact(i: Inputs) -> DataFrame:
    """Deposits of one half-year, and trades from two months before the first."""
    orders = binding.hex_wallet_orders(i.spark, i.dir).where(f"day >= date '{IMPACT_FROM}' and day < date '{IMPACT_TO}'")
    return impact.wallet_impact(orders, binding.creation_traces(i.spark, i.dir, impact.WALLET_FACTORY), binding.monthly_trades(i.spark, i.dir),
                                token=DEPOSIT_TOKEN, decimals=TOKEN_DECIMALS, within_seconds=IMPACT_WITHIN)


def _order_activity(i: Inputs) -> DataFrame:
    return rhythm.activity_from_orders(binding.clocked(i.orders()), i.evm(), i.jettons(), binding.stable_symbols())


def metric_queries() -> dict[str, Query]:
    """Q1-Q23."""
    return {
        "headline": _q(lambda i: growth.headline(i.cube("daily_chainpair"), i.orders())),
        "cross_chain_volume_daily": _q(lambda i: growth.cross_chain_volume_daily(i.cube("daily_chainpair"))),
        "chain_volume_daily": _q(lambda i: growth.chain_volume_daily(i.cube("daily_chainpair"))),
        "new_vs_returning_weekly": _q(lambda i: growth.new_vs_returning_weekly(i.orders())),
        "trader_cohorts": _q(lambda i: growth.trader_cohorts(i.orders())),
        "fee_headline": _q(lambda i: fees.fee_headline(i.cube("daily_chainpair"), i.cube("daily_integrator"))),
        "fee_split_daily": _q(lambda i: fees.fee_split_daily(i.cube("daily_chainpair"))),
        "integrator_league": _q(lambda i: fees.integrator_league(i.cube("daily_integrator"))),
        "chain_flows": _q(lambda i: flows.chain_flows(i.cube("daily_chainpair"))),
        "corridor_share_daily": _q(lambda i: flows.corridor_share_daily(i.cube("daily_chainpair"))),
        "net_flow_by_chain": _q(lambda i: flows.net_flow_by_chain(i.cube("daily_chainpair"))),
        "hourly_clock": _q(lambda i: rhythm.hourly_clock(binding.activity(i.spark, i.dir), EVENTS_AS_OF)),
        "weekday_clock": _q(lambda i: rhythm.weekday_clock(binding.activity(i.spark, i.dir), EVENTS_AS_OF)),
        "hourly_clock_from_orders": _q(lambda i: rhythm.hourly_clock(_order_activity(i), DASHBOARD_AS_OF)),
        "weekday_clock_from_orders": _q(lambda i: rhythm.weekday_clock(_order_activity(i), DASHBOARD_AS_OF)),
        "latency_funnel": _q(lambda i: latency.latency_funnel(i.orders())),
        "settlement_speed_daily": _q(lambda i: latency.settlement_speed_daily(i.orders())),
        "resolver_league": _q(lambda i: leagues.resolver_league(i.cube("daily_resolver"), i.orders())),
        "assets_sold": _q(lambda i: assets.assets_sold(i.cube("daily_input_asset"), i.evm(), i.jettons())),
        "assets_bought": _q(lambda i: assets.assets_bought(i.cube("daily_output_asset"), i.evm(), i.jettons())),
        "trade_size_distribution": _q(
            lambda i: assets.trade_size_distribution(
                i.orders(), i.evm(), i.jettons(), binding.stable_symbols(), SIZE_BOUNDS
            )
        ),
        "token_flow_headline": _q(
            lambda i: wallets.token_flow_headline(
                i.orders(), i.cube("daily_chainpair"), DEPOSIT_TOKEN, WITHDRAWAL_TOKEN, TOKEN_DECIMALS
            )
        ),
        "token_flow_daily": _q(
            lambda i: wallets.token_flow_daily(i.orders(), DEPOSIT_TOKEN, WITHDRAWAL_TOKEN, TOKEN_DECIMALS)
        ),
        "funded_wallet_impact": _q(
            lambda i: wallets.funded_wallet_impact(
                binding.deposits(i.spark, i.dir),
                binding.deposit_wallets(i.spark, i.dir),
                binding.market_trades(i.spark, i.dir),
            )
        ),
        "wallet_impact_from_orders": _q(_wallet_impact),
        "freshness": _q(_freshness),
    }


def dashboard_queries() -> dict[str, Query]:
    """The design document's dashboard analytics."""
    stable = binding.stable_symbols()
    return {
        "headline_windows": _q(lambda i: dashboard.headline_windows(
            i.cube("daily_chainpair"), i.orders(), DASHBOARD_AS_OF)),
        "filtered_volume": _q(lambda i: dashboard.filtered_volume(
            i.orders(), i.evm(), i.jettons(), stable=stable, **FILTERS)),
        "cross_vs_intra_daily": _q(lambda i: dashboard.cross_vs_intra_daily(i.cube("daily_chainpair"))),
        "corridor_matrix_volume": _q(lambda i: dashboard.corridor_matrix(i.cube("daily_chainpair"), "volume", CHAINS)),
        "corridor_matrix_success": _q(lambda i: dashboard.corridor_matrix(i.cube("daily_chainpair"), "success", CHAINS)),
        "top_corridors": _q(lambda i: dashboard.top_corridors(i.cube("daily_chainpair"), TOP_CORRIDORS)),
        "latency_by_size": _q(lambda i: dashboard.latency_by_size(
            i.orders(), i.evm(), i.jettons(), stable, SIZE_BOUNDS)),
        "settle_time_by_corridor": _q(lambda i: dashboard.settle_time_by_corridor(i.orders())),
        "success_rate_daily": _q(lambda i: dashboard.success_rate_daily(i.cube("daily_chainpair"))),
        "quote_vs_delivered": _q(lambda i: dashboard.quote_vs_delivered(i.orders())),
        "resolver_share_daily": _q(lambda i: dashboard.resolver_share_daily(i.cube("daily_resolver"))),
        "size_concentration": _q(lambda i: dashboard.size_concentration(
            i.orders(), i.evm(), i.jettons(), stable, TOP_TRADERS)),
        "order_lookup": _q(lambda i: dashboard.order_lookup(i.orders(), LOOKUP_QUOTE_ID)),
    }


def queries() -> dict[str, Query]:
    out = metric_queries()
    from . import registry_ops

    out.update(registry_ops.operator_queries())
    out.update(dashboard_queries())
    return out
