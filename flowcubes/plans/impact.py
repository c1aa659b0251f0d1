"""What funded wallets did afterwards, from orders, creation traces and a
month-partitioned trades table.

The two large facts are cut down where they are read: traces by a binary
literal that reaches the scan, trades by a bound on their partition column in
both branches of the union, which is worked out at run time from the deposits.
What is left of the trades is cut by a bitmap of the funded wallets before it
is shuffled to be joined with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.address import evm_key
from ..functions.prefilter import cut_by_keys
from ..functions.stats import whole_units
from .common import cross_chain, settled
from .wallets import TAGGED_DECIMALS, TAGGED_TOKEN, impact_summary

# Fixed values of the reference deployment: the factory that creates the
# deposit wallets, and the chain on which they live.
WALLET_FACTORY = "00000000000fb5c9adea0298d729a0cb3823cc07"
WALLET_CHAIN = "polygon"
#: Whole months before the first deposit from which trades are read.
LEAD_MONTHS = 2


def hex_literal(digits: str) -> Column:
    """A binary literal from hex digits, with or without ``0x``."""
    return F.lit(bytes.fromhex(digits.removeprefix("0x")))


def verified_wallets(traces: DataFrame, factory: str = WALLET_FACTORY) -> DataFrame:
    """``addr``: contracts that the factory created, once each. The comparison is
    with the stored bytes, so it is pushed to the scan."""
    return traces.where(F.col("from") == hex_literal(factory)).select(F.col("address").alias("addr")).where(F.col("addr").isNotNull()).distinct()


def token_deposits(orders: DataFrame, chain: str = WALLET_CHAIN, token: str = TAGGED_TOKEN, decimals: int = TAGGED_DECIMALS) -> DataFrame:
    """``addr, deposit_time, usd, day``: settled cross-chain orders that pay the
    token out on the chain, to wallets whose address is whole bytes of hex."""
    paid = orders.where(settled() & cross_chain() & (F.col("dst_chain_id") == chain) & (F.col("output_asset_address") == token))
    # the units are summed exactly and scaled once
    return paid.select(evm_key(F.col("dst_trader_address")).alias("addr"), F.timestamp_seconds("order_finalize_time").alias("deposit_time"),
                       whole_units(F.col("actual_output_units")).alias("units"), F.col("day")).where("addr is not null").withColumn("decimals", F.lit(decimals))


def month_floor(deposits: DataFrame, lead_months: int = LEAD_MONTHS) -> DataFrame:
    """One row: the first month of trades to read, some months before the first deposit."""
    return deposits.agg(F.add_months(F.trunc(F.min("day"), "month"), -lead_months).alias("floor"))


def trades_of_both_sides(trades: DataFrame, since: Column) -> DataFrame:
    """``addr, amount, block_time`` of makers and of takers, each read from the
    months that are not before ``since`` only."""
    def side(who: str) -> DataFrame:
        return trades.where(F.col("block_month") >= since).select(F.col(who).alias("addr"), "amount", "block_time").where("addr is not null")

    return side("maker").unionByName(side("taker"))


def wallet_impact(orders: DataFrame, traces: DataFrame, trades: DataFrame, factory: str = WALLET_FACTORY, chain: str = WALLET_CHAIN, token: str = TAGGED_TOKEN,
                  decimals: int = TAGGED_DECIMALS, since_month: str | None = None, lead_months: int = LEAD_MONTHS, within_seconds: int = 60, exact: bool = True) -> DataFrame:
    """Q22 from its sources. ``traces``: ``from, address`` (binary); ``trades``:
    ``maker, taker`` (binary), ``amount, block_time``, partitioned by
    ``block_month`` (date). ``since_month`` fixes the first month of trades;
    else it is found by `month_floor`."""
    paid = token_deposits(orders, chain, token, decimals)
    funded = paid.join(verified_wallets(traces, factory), "addr", "left_semi").groupBy("addr").agg(
        F.min("deposit_time").alias("first_deposit"), (F.sum("units").cast("double") / F.lit(float(10 ** decimals))).alias("deposited_usd"))
    since = F.lit(since_month).cast("date") if since_month else month_floor(paid, lead_months).scalar()
    sides = cut_by_keys(trades_of_both_sides(trades, since), "addr", funded.select("addr"))
    # an inner join on the funded wallets, one row each: a semi-join would be moved below the bitmap
    traded = sides.join(funded.select("addr"), "addr").groupBy("addr").agg(
        F.sum("amount").alias("wagered_usd"), F.min("block_time").alias("first_trade")).withColumn("_traded", F.lit(True))
    return impact_summary(funded, traded, within_seconds, exact)
