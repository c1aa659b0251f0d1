"""What a swap costs: fee headline, daily fee split, integrator league."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.address import truncate_label
from ..functions.stats import ratio
from .common import cross_chain, one_row


def fee_headline(chainpair: DataFrame, integrator_cube: DataFrame) -> DataFrame:
    """Q6: fee totals, take rate, integrator share and active integrators.

    An integrator is active when one of its cube rows has filled volume."""
    t = chainpair.where(cross_chain()).agg(
        F.sum("integrator_fees_usd").alias("_ifee"),
        F.sum("protocol_fees_usd").alias("_pfee"),
        F.sum("filled_orders_volume_usd").alias("_vol"),
    )
    i = integrator_cube.where(
        F.col("integrator_address").isNotNull()
        & (F.col("filled_orders_volume_usd") > 0)
        & cross_chain()
    ).agg(F.count_distinct("integrator_address").alias("integrators"))
    both = one_row(t, i)
    ifee = F.col("_ifee").cast("double")
    pfee = F.col("_pfee").cast("double")
    total = (F.col("_ifee") + F.col("_pfee")).cast("double")
    vol = F.col("_vol").cast("double")
    return both.select(
        ifee.alias("integrator_fees_usd"),
        pfee.alias("protocol_fees_usd"),
        total.alias("total_fees_usd"),
        ratio(F.lit(10000.0) * total, vol).alias("take_rate_bps"),
        ratio(F.lit(1000.0) * total, vol).alias("cost_per_1000_usd"),
        ratio(F.lit(100.0) * ifee, total).alias("integrator_share_pct"),
        F.col("integrators"),
    )


def fee_split_daily(chainpair: DataFrame) -> DataFrame:
    """Q7: integrator and protocol fees per day."""
    return (
        chainpair.where(cross_chain())
        .groupBy("day")
        .agg(
            F.sum("integrator_fees_usd").cast("double").alias("integrator_fees_usd"),
            F.sum("protocol_fees_usd").cast("double").alias("protocol_fees_usd"),
        )
        .orderBy("day")
    )


def integrator_league(integrator_cube: DataFrame, k: int = 12) -> DataFrame:
    """Q8: top k integrators by filled volume.

    Grouped by the truncated display label, so two addresses sharing their
    first six and last four characters are one line. The average order is
    finalized volume over finalized orders (the cube has no status)."""
    label = F.coalesce(truncate_label(F.col("integrator_address"), 6, 4), F.lit("unattributed"))
    g = (
        integrator_cube.where(cross_chain() & F.col("integrator_address").isNotNull())
        .groupBy(label.alias("integrator"))
        .agg(
            F.sum("filled_orders_volume_usd").alias("_filled"),
            F.sum("finalized_orders_count").alias("_orders"),
            F.sum("finalized_orders_volume_usd").alias("_finalized"),
            F.sum("integrator_fees_usd").alias("_fees"),
        )
        .where(F.col("_filled") > 0)
    )
    return (
        g.select(
            "integrator",
            F.col("_filled").cast("double").alias("volume_usd"),
            F.col("_orders").cast("bigint").alias("orders"),
            ratio(F.col("_finalized"), F.col("_orders")).alias("avg_order_usd"),
            F.col("_fees").cast("double").alias("fees_earned_usd"),
            ratio(F.lit(10000.0) * F.col("_fees").cast("double"), F.col("_filled")).alias("take_rate_bps"),
        )
        .orderBy(F.col("volume_usd").desc(), F.col("integrator").asc())
        .limit(k)
    )
