"""What people trade: assets sold (by volume), bought (by orders), trade sizes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stats import whole_units

from ..operators import pricing
from .common import cross_chain, rank_top_k, settled

OTHER_ASSETS = "Everything else"
# Trade-size bucket bounds in dollars (the fourth is inclusive).
SIZE_BOUNDS = (1, 10, 100, 1000)


def _asset_mix(cube: DataFrame, side: str, measure: str, out: str, evm_tokens: DataFrame,
               jettons: DataFrame, k: int) -> DataFrame:
    chain, kind, address = f"{side}_asset_chain", f"{side}_asset_kind", f"{side}_asset_address"
    # Aggregate to asset grain first: the dimension join sees one row per
    # asset, not one per cube row.
    assets = (
        cube.where(cross_chain())
        .groupBy(chain, kind, address)
        .agg(F.sum(measure).alias("_m"))
    )
    resolved = pricing.resolve_tokens(assets, chain, address, evm_tokens, jettons)
    label = F.concat(
        F.coalesce(
            F.when(F.col(kind) == F.lit("native"), F.upper(F.col(chain))),
            F.col("evm_symbol"),
            F.col("ton_symbol"),
            F.concat(F.substring(F.col(address), 1, 6), F.lit("…")),
        ),
        F.lit(" · "),
        F.col(chain),
    )
    named = resolved.groupBy(label.alias("asset")).agg(F.sum("_m").alias(out)).where(F.col(out) > 0)
    return rank_top_k(named, "asset", out, k, OTHER_ASSETS)


def assets_sold(input_asset_cube: DataFrame, evm_tokens: DataFrame, jettons: DataFrame,
                k: int = 8) -> DataFrame:
    """Q17: filled volume by asset sold; top k assets, the rest pooled."""
    mix = _asset_mix(input_asset_cube, "input", "filled_orders_volume_usd", "volume_usd",
                     evm_tokens, jettons, k)
    return mix.select("asset", F.col("volume_usd").cast("double").alias("volume_usd")).orderBy(
        F.col("volume_usd").desc(), "asset"
    )


def assets_bought(output_asset_cube: DataFrame, evm_tokens: DataFrame, jettons: DataFrame,
                  k: int = 8) -> DataFrame:
    """Q18: orders by asset bought (failed included: that cube has no
    status); top k assets, the rest pooled."""
    mix = _asset_mix(output_asset_cube, "output", "finalized_orders_count", "orders",
                     evm_tokens, jettons, k)
    return mix.select("asset", F.col("orders").cast("bigint").alias("orders")).orderBy(
        F.col("orders").desc(), "asset"
    )


def _money(x: float) -> str:
    return f"${x:,}"


def size_buckets(bounds: Sequence[float] = SIZE_BOUNDS) -> list[str]:
    """Bucket labels, each prefixed with its sort position and two spaces."""
    b0, b1, b2, b3 = bounds
    return [
        f"1  under {_money(b0)}",
        f"2  {_money(b0)} to {_money(b1)}",
        f"3  {_money(b1)} to {_money(b2)}",
        f"4  {_money(b2)} to {_money(b3)}",
        f"5  over {_money(b3)}",
    ]


def trade_size_distribution(orders: DataFrame, evm_tokens: DataFrame, jettons: DataFrame,
                            stable: Sequence[str] = pricing.STABLECOINS,
                            bounds: Sequence[float] = SIZE_BOUNDS) -> DataFrame:
    """Q19: settled cross-chain trades by dollar size, priced per trade from
    raw input units of dollar stablecoins; unpriceable trades are dropped.

    The dollar sum of a bucket is taken over exact integer units per token
    precision and scaled once, so it does not depend on summation order."""
    priced = pricing.price_orders(
        orders.where(settled() & cross_chain() & F.col("actual_input_units").isNotNull()),
        evm_tokens, jettons, stable,
    ).where(F.col("usd").isNotNull())
    labels = size_buckets(bounds)
    usd = F.col("usd")
    bucket = (
        F.when(usd < bounds[0], labels[0])
        .when(usd < bounds[1], labels[1])
        .when(usd < bounds[2], labels[2])
        .when(usd <= bounds[3], labels[3])
        .otherwise(labels[4])
    )
    per_precision = (
        priced.groupBy(bucket.alias("bucket"), "decimals")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.sum(whole_units(F.col("actual_input_units"))).alias("_units"),
        )
    )
    return (
        per_precision.groupBy("bucket")
        .agg(
            F.sum("_n").alias("orders"),
            F.sum(F.col("_units").cast("double") / F.pow(F.lit(10.0), F.col("decimals"))).alias("volume_usd"),
        )
        .orderBy("bucket")
        .select(F.expr("substr(bucket, 4)").alias("trade_size"),
                F.col("orders").cast("bigint").alias("orders"), "volume_usd")
    )
