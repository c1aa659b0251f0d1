"""Token identity and stablecoin pricing.

Dimension joins are plain left equi-joins on precomputed key columns; Spark
broadcasts a dimension when its estimated size is under the broadcast
threshold and AQE re-plans from real shuffle sizes otherwise, so a token list
of any size is safe. Facts are aggregated to asset grain before a dimension
is joined wherever the metric allows it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.address import FRIENDLY_CHAIN, evm_key, ton_raw_if
from ..functions.wide import sum_units

# The dollar stablecoin symbols priced at face value.
STABLECOINS = ("USDT", "USDC", "USDG", "pUSD", "USD₮", "USD₮0", "USDe", "DAI")


def latest_revision(jettons: DataFrame, key: str = "address", updated: str = "_updated_at",
                    values: Sequence[str] = ("symbol", "decimals")) -> DataFrame:
    """Newest revision per address among rows that have a symbol.

    A revision without a date is the oldest; of several at the same time the
    one of largest ``values`` counts, so the pick never depends on row order.
    The maximum of a struct aggregates partially per partition -- no sort and
    no window over a hot address."""
    picked = (
        jettons.where(F.col("symbol").isNotNull())
        .groupBy(key)
        .agg(F.max(F.struct(F.col(updated), *values)).alias("_r"))
    )
    return picked.select(key, *[F.col(f"_r.{v}").alias(v) for v in values])


def resolve_tokens(df: DataFrame, chain: str, address: str, evm_tokens: DataFrame,
                   jettons: DataFrame, friendly_chain: str = FRIENDLY_CHAIN) -> DataFrame:
    """T4: attach ``evm_symbol, evm_decimals, ton_symbol, ton_decimals`` to
    each row, from the EVM list (chain + binary contract) and the latest
    jetton revision (raw address, friendly-chain rows only)."""
    evm = evm_tokens.select(
        F.col("blockchain").alias("_evm_chain"),
        F.col("contract_address").alias("_evm_key"),
        F.col("symbol").alias("evm_symbol"),
        F.col("decimals").alias("evm_decimals"),
    )
    ton = latest_revision(jettons).select(
        F.col("address").alias("_ton_key"),
        F.col("symbol").alias("ton_symbol"),
        F.col("decimals").alias("ton_decimals"),
    )
    keyed = df.withColumn("_k_evm", evm_key(F.col(address))).withColumn(
        "_k_ton", ton_raw_if(F.col(chain), F.col(address), friendly_chain)
    )
    out = keyed.join(
        evm, (F.col(chain) == F.col("_evm_chain")) & (F.col("_k_evm") == F.col("_evm_key")), "left"
    ).join(ton, F.col("_k_ton") == F.col("_ton_key"), "left")
    return out.drop("_k_evm", "_k_ton", "_evm_chain", "_evm_key", "_ton_key")


def symbol() -> Column:
    return F.coalesce(F.col("evm_symbol"), F.col("ton_symbol"))


def decimals() -> Column:
    return F.coalesce(F.col("evm_decimals"), F.col("ton_decimals"))


def stable_usd(units: Column, stable: Sequence[str] = STABLECOINS) -> Column:
    """T5: units / 10^decimals for listed stablecoins, NULL otherwise
    (including units that are not a number)."""
    return F.when(symbol().isin(*stable), units.try_cast("double") / F.pow(F.lit(10.0), decimals()))


def price_orders(orders: DataFrame, evm_tokens: DataFrame, jettons: DataFrame,
                 stable: Sequence[str] = STABLECOINS) -> DataFrame:
    """Settled cross-chain orders with ``symbol, decimals, usd`` of the input
    side (the side the protocol prices)."""
    resolved = resolve_tokens(orders, "input_asset_chain", "input_asset_address", evm_tokens, jettons)
    return resolved.withColumn("symbol", symbol()).withColumn("decimals", decimals()).withColumn(
        "usd", stable_usd(F.col("actual_input_units"), stable)
    )


def pricing_reconciliation(priced: DataFrame, cube_volume: DataFrame) -> DataFrame:
    """Priced dollar total against the cube's filled volume.

    ``priced``: rows with ``usd``; ``cube_volume``: rows with
    ``filled_orders_volume_usd``. Returns one row: priced trades, all trades,
    both sums and the relative gap."""
    p = priced.agg(
        F.count_if(F.col("usd").isNotNull()).alias("priced_trades"),
        F.count(F.lit(1)).alias("trades"),
        F.sum("usd").alias("priced_usd"),
    )
    c = cube_volume.agg(F.sum("filled_orders_volume_usd").cast("double").alias("cube_usd"))
    from ..plans.common import one_row

    both = one_row(p, c)
    return both.select(
        "priced_trades", "trades", "priced_usd", "cube_usd",
        ((F.col("cube_usd") - F.col("priced_usd")) / F.nullif(F.col("cube_usd"), F.lit(0.0))).alias("gap"),
    )


def unit_totals(orders: DataFrame, keys: Sequence[str], units: Sequence[str]) -> DataFrame:
    """Exact totals of raw units of up to 256 bits per group, as text of digits;
    NULL where a group has no number. One aggregate with map-side sums."""
    return orders.groupBy(*keys).agg(*[sum_units(F.col(u)).alias(u) for u in units])
