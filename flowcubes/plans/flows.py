"""Where the money moves: chain-to-chain edges, corridor shares, net flow."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cross_chain, top_k_with_other


def chain_flows(chainpair: DataFrame, min_value: float = 100) -> DataFrame:
    """Q9: lifetime filled volume per (source, destination) edge; edges
    under ``min_value`` dropped. Labels differ by side so a chain that both
    sends and receives stays two nodes."""
    g = (
        chainpair.where(cross_chain())
        .groupBy("src_chain_id", "dst_chain_id")
        .agg(F.sum("filled_orders_volume_usd").alias("_v"))
        .where(F.col("_v") >= min_value)
    )
    return g.select(
        F.concat(F.col("src_chain_id"), F.lit(" (from)")).alias("source"),
        F.concat(F.col("dst_chain_id"), F.lit(" (to)")).alias("target"),
        F.col("_v").cast("double").alias("value"),
    ).orderBy(F.col("value").desc(), "source", "target")


def corridor_share_daily(chainpair: DataFrame, k: int = 8, min_day_total: float = 1000) -> DataFrame:
    """Q10: each corridor's share of the day's filled volume; top k corridors
    by lifetime volume, the rest pooled as ``other``; days with less than
    ``min_day_total`` dropped. Shares are fractions."""
    legs = (
        chainpair.where(cross_chain())
        .groupBy(
            "day",
            F.concat(F.col("src_chain_id"), F.lit(" → "), F.col("dst_chain_id")).alias("corridor"),
        )
        .agg(F.sum("filled_orders_volume_usd").alias("usd"))
    )
    bucketed = (
        top_k_with_other(legs, "corridor", "usd", k, "other")
        .groupBy("day", "corridor").agg(F.sum("usd").alias("usd"))
        .where(F.col("usd") > 0)
    )
    # At most k + 1 rows per day in this window.
    shares = bucketed.withColumn("_day_total", F.sum("usd").over(Window.partitionBy("day")))
    return (
        shares.where(F.col("_day_total") >= min_day_total)
        .select(
            "day", "corridor",
            (F.col("usd").cast("double") / F.col("_day_total").cast("double")).alias("share"),
        )
        .orderBy("day", "corridor")
    )


def net_flow_by_chain(chainpair: DataFrame) -> DataFrame:
    """Q11: per chain, inflow (as destination), outflow (as source, negated)
    and net. Both legs come from one scan: each cube row is emitted twice."""
    legs = chainpair.where(cross_chain()).select(
        F.col("filled_orders_volume_usd").alias("usd"),
        F.explode(
            F.array(
                F.struct(F.col("dst_chain_id").alias("chain"), F.lit("in").alias("side")),
                F.struct(F.col("src_chain_id").alias("chain"), F.lit("out").alias("side")),
            )
        ).alias("leg"),
    ).select("leg.chain", "leg.side", "usd")
    inbound = F.col("side") == F.lit("in")
    zero = F.lit(0)
    g = legs.groupBy("chain").agg(
        F.sum(F.when(inbound, F.col("usd")).otherwise(zero)).alias("_in"),
        F.sum(F.when(~inbound, F.col("usd")).otherwise(zero)).alias("_out"),
        F.sum(F.when(inbound, F.col("usd")).otherwise(-F.col("usd"))).alias("_net"),
        F.sum("usd").alias("_gross"),
    )
    return (
        g.where(F.col("_gross") > 0)
        .select(
            "chain",
            F.col("_in").cast("double").alias("inflow_usd"),
            (-F.col("_out")).cast("double").alias("outflow_usd"),
            F.col("_net").cast("double").alias("net_usd"),
        )
        .orderBy(F.col("net_usd").desc(), "chain")
    )
