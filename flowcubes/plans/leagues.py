"""Who settles the trades: the resolver league table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.address import truncate_label
from ..functions.stats import ratio
from ..operators.percentiles import percentiles
from .common import cross_chain, filled_count, settled


def resolver_league(resolver_cube: DataFrame, orders: DataFrame, exact: bool = True) -> DataFrame:
    """Q16: per resolver id, volume, finalized orders, average settled trade,
    success rate, median settle time and distinct traders.

    Grouped by the full id and truncated only for display, so two resolvers
    may share a label. Volume comes from the cube, latency and traders from
    orders; the two per-resolver aggregates meet in one equi-join."""
    vol = (
        resolver_cube.where(F.col("resolver_id").isNotNull() & cross_chain())
        .groupBy("resolver_id")
        .agg(
            F.sum("filled_orders_volume_usd").alias("_vol"),
            F.sum(filled_count()).alias("_filled"),
            F.sum("finalized_orders_count").alias("_finalized"),
        )
    )
    o = orders.where(settled() & F.col("resolver_id").isNotNull() & cross_chain())
    lat = (
        o.groupBy("resolver_id").agg(F.count_distinct("src_trader_address").alias("traders"))
        .join(percentiles(o, ["resolver_id"], "t_settle", {"median_settle_seconds": 0.5}, exact),
              "resolver_id", "left")
    )
    return (
        vol.join(lat, "resolver_id", "left")
        .select(
            truncate_label(F.col("resolver_id"), 10).alias("resolver"),
            F.col("_vol").cast("double").alias("volume_usd"),
            F.col("_finalized").cast("bigint").alias("orders"),
            ratio(F.col("_vol"), F.col("_filled")).alias("avg_trade_usd"),
            ratio(F.lit(100.0) * F.col("_filled").cast("double"), F.col("_finalized")).alias("success_pct"),
            "median_settle_seconds",
            "traders",
        )
        .orderBy(F.col("volume_usd").desc(), "resolver")
    )
