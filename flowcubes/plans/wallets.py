"""One tagged token's flows, and what funded wallets did afterwards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import ratio, whole_units
from ..operators.percentiles import percentiles
from .common import created_ts, cross_chain, filled_count, one_row, settled

# Fixed values of the reference deployment: the tagged token and its decimals.
TAGGED_TOKEN = "0xC011a7E12a19f7B1f670d46F03B03f3342E82DFB"
TAGGED_DECIMALS = 6


def token_flows(orders: DataFrame, deposit_token: str = TAGGED_TOKEN,
                withdrawal_token: str | None = None) -> DataFrame:
    """Settled cross-chain orders touching the token, with ``direction``
    (+1 deposit: the token is bought; -1 withdrawal: it is sold), the raw
    ``units`` on that side and the ``wallet`` on that side.

    The bought side is tested first, so a token-to-same-token swap is a
    deposit. Address match is exact (case-sensitive)."""
    withdrawal_token = withdrawal_token or deposit_token
    dep = F.col("output_asset_address") == F.lit(deposit_token)
    wd = F.col("input_asset_address") == F.lit(withdrawal_token)
    return orders.where(settled() & cross_chain() & (dep | wd)).select(
        F.to_date(created_ts()).alias("day"),
        F.when(dep, F.lit(1)).otherwise(F.lit(-1)).alias("direction"),
        F.when(dep, F.col("actual_output_units")).otherwise(F.col("actual_input_units")).alias("_units_text"),
        F.when(dep, F.col("dst_trader_address")).otherwise(F.col("src_trader_address")).alias("wallet"),
    ).select(
        "day", "direction", "wallet",
        whole_units(F.col("_units_text")).alias("units"),
        F.col("_units_text").try_cast("double").alias("_units_double"),
    )


def _usd(units_sum: Column, decimals: int) -> Column:
    """Exact unit sum scaled to dollars once."""
    return units_sum.cast("double") / F.lit(float(10 ** decimals))


def token_flow_headline(orders: DataFrame, chainpair: DataFrame, deposit_token: str = TAGGED_TOKEN,
                        withdrawal_token: str | None = None, decimals: int = TAGGED_DECIMALS,
                        exact: bool = True) -> DataFrame:
    """Q20: deposits, withdrawals, net, transfers, median deposit and the
    token's share of settled cross-chain swaps and volume."""
    flows = token_flows(orders, deposit_token, withdrawal_token)
    is_dep = F.col("direction") == 1
    f = flows.agg(
        _usd(F.sum(F.when(is_dep, F.col("units"))), decimals).alias("deposits_usd"),
        _usd(F.sum(F.when(~is_dep, F.col("units"))), decimals).alias("withdrawals_usd"),
        _usd(F.sum(F.col("direction") * F.col("units")), decimals).alias("net_usd"),
        F.count(F.lit(1)).alias("transfers"),
        _usd(F.sum("units"), decimals).alias("_flow_usd"),
    )
    dep_usd = flows.where(is_dep).select(
        (F.col("_units_double") / F.lit(float(10 ** decimals))).alias("_dep_usd"))
    median = percentiles(dep_usd, [], "_dep_usd", {"median_deposit_usd": 0.5}, exact)
    xc = chainpair.where(cross_chain()).agg(
        F.sum(filled_count()).alias("_swaps"),
        F.sum("filled_orders_volume_usd").alias("_volume"),
    )
    both = one_row(f, xc, median)
    return both.select(
        "deposits_usd", "withdrawals_usd", "net_usd", "transfers", "median_deposit_usd",
        ratio(F.lit(100.0) * F.col("transfers").cast("double"), F.col("_swaps")).alias("share_of_swaps_pct"),
        ratio(F.lit(100.0) * F.col("_flow_usd"), F.col("_volume")).alias("share_of_volume_pct"),
    )


def token_flow_daily(orders: DataFrame, deposit_token: str = TAGGED_TOKEN,
                     withdrawal_token: str | None = None, decimals: int = TAGGED_DECIMALS) -> DataFrame:
    """Q21: per creation day, deposits, negated withdrawals, net, distinct
    wallets and the 7-row average of net (over days, not orders)."""
    flows = token_flows(orders, deposit_token, withdrawal_token)
    is_dep = F.col("direction") == 1
    daily = flows.groupBy("day").agg(
        F.coalesce(F.sum(F.when(is_dep, F.col("units"))), F.lit(0)).alias("_dep"),
        F.coalesce(F.sum(F.when(~is_dep, F.col("units"))), F.lit(0)).alias("_wd"),
        F.sum(F.col("direction") * F.col("units")).alias("_net"),
        F.count_distinct("wallet").alias("wallets"),
    )
    last7 = Window.orderBy("day").rowsBetween(-6, 0)
    scale = F.lit(float(10 ** decimals))
    return daily.select(
        "day",
        _usd(F.col("_dep"), decimals).alias("deposits_usd"),
        (-_usd(F.col("_wd"), decimals)).alias("withdrawals_usd"),
        _usd(F.col("_net"), decimals).alias("net_usd"),
        "wallets",
        (F.sum("_net").over(last7).cast("double") / scale / F.count("_net").over(last7).cast("double"))
        .alias("net_7d_avg"),
    ).orderBy("day")


def funded_wallet_impact(deposits: DataFrame, deposit_wallets: DataFrame, trades: DataFrame,
                         within_seconds: int = 60, trades_since: str | None = None,
                         exact: bool = True) -> DataFrame:
    """Q22: of the verified wallets that received deposits, how many traded,
    how many traded only after their first deposit, gross wagered volume,
    and the lag from first deposit to first trade (whole seconds).

    ``deposits``: ``wallet, deposit_time, usd``; ``deposit_wallets``:
    ``addr``; ``trades``: ``maker, taker, amount, block_time``. Trades are
    reduced to the funded wallets before they are aggregated, and both trade
    sides are counted (wagered volume is gross)."""
    wallets = deposit_wallets.select(F.col("addr").alias("wallet")).distinct()
    funded = (
        deposits.join(wallets, "wallet", "left_semi")
        .groupBy(F.col("wallet").alias("addr"))
        .agg(F.min("deposit_time").alias("first_deposit"), F.sum("usd").alias("deposited_usd"))
    )
    if trades_since is not None:
        trades = trades.where(F.col("block_time") >= F.lit(trades_since).cast("timestamp"))
    sides = trades.select(
        F.explode(F.array(F.col("maker"), F.col("taker"))).alias("addr"), "amount", "block_time"
    ).where(F.col("addr").isNotNull())
    traded = (
        sides.join(funded.select("addr"), "addr", "left_semi")
        .groupBy("addr")
        .agg(
            F.count(F.lit(1)).alias("trades"),
            F.sum("amount").alias("wagered_usd"),
            F.min("block_time").alias("first_trade"),
        )
        .withColumn("_traded", F.lit(True))
    )
    return impact_summary(funded, traded, within_seconds, exact)


def impact_summary(funded: DataFrame, traded: DataFrame, within_seconds: int = 60, exact: bool = True) -> DataFrame:
    """The row of Q22 from funded wallets (``addr, first_deposit,
    deposited_usd``) and traded ones (``addr, wagered_usd, first_trade, _traded``)."""
    j = funded.join(traded, "addr", "left")
    after = F.col("first_trade") > F.col("first_deposit")
    lag = F.floor(
        (F.unix_micros("first_trade") - F.unix_micros("first_deposit")) / F.lit(1_000_000)
    ).cast("bigint")
    j = j.withColumn("_lag", F.when(after, lag))
    median = percentiles(j, [], "_lag", {"_median_lag": 0.5}, exact)
    totals = j.agg(
        F.count(F.lit(1)).alias("wallets_funded"),
        F.count_if(F.col("_traded").isNotNull()).alias("wallets_that_traded"),
        F.count_if(after).alias("new_traders"),
        F.round(F.sum("deposited_usd")).cast("double").alias("deposited_usd"),
        F.round(F.sum("wagered_usd")).cast("double").alias("wagered_usd"),
        F.round(ratio(F.sum("wagered_usd"), F.sum("deposited_usd")), 1).alias("multiple"),
        ratio(
            F.lit(100.0) * F.count_if(after & (F.col("_lag") <= within_seconds)).cast("double"),
            F.count_if(after),
        ).alias("within_a_minute_pct"),
    )
    return one_row(totals, median).select(
        "wallets_funded", "wallets_that_traded", "new_traders", "deposited_usd", "wagered_usd", "multiple",
        F.round("_median_lag").alias("median_lag_seconds"), "within_a_minute_pct",
    )
