"""Growth: headline, daily volume, destination mix, new vs returning, cohorts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import ratio
from ..operators.percentiles import percentiles
from .common import created_ts, cross_chain, filled_count, one_row, settled, top_k_with_other, week_of

HOME_CHAIN = "ton"


def headline(chainpair: DataFrame, orders: DataFrame, home_chain: str = HOME_CHAIN,
             exact: bool = True) -> DataFrame:
    """Q1: one row of settled-only headline figures.

    Volume and swaps come from the chain-pair cube; traders, resolvers, the
    median and the success rate from orders (distinct counts do not add up
    across cube rows).
    """
    src, dst = F.col("src_chain_id"), F.col("dst_chain_id")
    home = F.lit(home_chain)
    xc = cross_chain()
    vol = F.col("filled_orders_volume_usd")
    zero = F.lit(0)
    cc = chainpair.agg(
        F.sum(F.when(xc, vol)).alias("_volume"),
        F.sum(F.when(xc, filled_count())).alias("swaps"),
        (
            F.sum(F.when((dst == home) & (src != home), vol).otherwise(zero))
            - F.sum(F.when((src == home) & (dst != home), vol).otherwise(zero))
        ).cast("double").alias("net_ton_usd"),
    )
    o = (
        orders.where(xc)
        .select(
            "status",
            F.when(settled(), F.col("src_trader_address")).alias("_trader"),
            F.when(settled(), F.col("resolver_id")).alias("_resolver"),
        )
        .agg(
            F.count_distinct("_trader").alias("traders"),
            F.count_distinct("_resolver").alias("resolvers"),
            (F.lit(100.0) * F.count_if(settled()).cast("double") / F.count(F.lit(1)).cast("double"))
            .alias("success_pct"),
        )
    )
    median = percentiles(orders.where(xc & settled()), [], "t_total", {"median_seconds": 0.5}, exact)
    both = one_row(cc, o, median)
    volume = F.col("_volume").cast("double")
    return both.select(
        volume.alias("volume_usd"),
        F.col("swaps").cast("bigint").alias("swaps"),
        F.col("traders"),
        F.col("net_ton_usd"),
        F.col("median_seconds"),
        F.col("resolvers"),
        F.col("success_pct"),
        ratio(volume, F.col("traders")).alias("volume_per_trader_usd"),
        ratio(F.col("swaps"), F.col("traders")).alias("swaps_per_trader"),
    )


def cross_chain_volume_daily(chainpair: DataFrame) -> DataFrame:
    """Q2: daily volume and swaps, 7-row moving average, running totals.

    The windows run over one row per day (a calendar-bounded frame), never
    over orders.
    """
    daily = (
        chainpair.where(cross_chain())
        .groupBy("day")
        .agg(F.sum("filled_orders_volume_usd").alias("_vol"), F.sum(filled_count()).alias("swaps"))
    )
    last7 = Window.orderBy("day").rowsBetween(-6, 0)
    running = Window.orderBy("day").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.select(
        "day",
        F.col("_vol").cast("double").alias("volume_usd"),
        F.col("swaps").cast("bigint").alias("swaps"),
        (F.sum("_vol").over(last7).cast("double") / F.count(F.lit(1)).over(last7).cast("double"))
        .alias("volume_7d_avg"),
        F.sum("_vol").over(running).cast("double").alias("cumulative_usd"),
        F.sum("swaps").over(running).cast("bigint").alias("cumulative_swaps"),
    ).orderBy("day")


def chain_volume_daily(chainpair: DataFrame, k: int = 6) -> DataFrame:
    """Q3: daily volume by destination chain; top k chains by lifetime
    volume keep their name, the rest are pooled as ``other``."""
    d = (
        chainpair.where(cross_chain())
        .groupBy("day", F.col("dst_chain_id").alias("chain"))
        .agg(F.sum("filled_orders_volume_usd").alias("usd"))
    )
    pooled = top_k_with_other(d, "chain", "usd", k, "other")
    return (
        pooled.groupBy("day", "chain")
        .agg(F.sum("usd").cast("double").alias("volume_usd"))
        .orderBy("day", "chain")
    )


def _settled_activity(orders: DataFrame, drop_null_traders: bool) -> DataFrame:
    """Distinct (trader, active week) of settled cross-chain orders, with
    the trader's first week attached.

    The distinct is aggregated partially before its shuffle, so a hot trader
    shrinks to at most one row per week per task; the first-week window then
    partitions by trader over those few rows.
    """
    cond = cross_chain() & settled()
    if drop_null_traders:
        cond = cond & F.col("src_trader_address").isNotNull()
    activity = (
        orders.where(cond)
        .select(F.col("src_trader_address").alias("trader"), week_of(created_ts()).alias("active_week"))
        .distinct()
        .where(F.col("trader").isNotNull())  # an inner join on trader drops NULLs
    )
    return activity.withColumn("cohort_week", F.min("active_week").over(Window.partitionBy("trader")))


def cohort_activity(orders: DataFrame) -> DataFrame:
    """What Q5 counts: ``trader``, ``active_week``, ``cohort_week``, a row a
    trader and week."""
    return _settled_activity(orders, drop_null_traders=True)


def new_vs_returning_weekly(orders: DataFrame) -> DataFrame:
    """Q4: per week, traders seen for the first time and returning ones, and
    the running count of distinct traders (a running sum of new only)."""
    a = _settled_activity(orders, drop_null_traders=False)
    weekly = a.groupBy(F.col("active_week").alias("week")).agg(
        F.count_if(F.col("active_week") == F.col("cohort_week")).alias("new_traders"),
        F.count_if(F.col("active_week") > F.col("cohort_week")).alias("returning_traders"),
    )
    running = Window.orderBy("week").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return weekly.select(
        "week", "new_traders", "returning_traders",
        F.sum("new_traders").over(running).cast("bigint").alias("cumulative_traders"),
    ).orderBy("week")


def trader_cohorts(orders: DataFrame, min_cohort: int = 20) -> DataFrame:
    """Q5: weekly retention curves of cohorts with at least ``min_cohort``
    traders; ``retained`` is a fraction of the cohort."""
    a = cohort_activity(orders)
    sizes = (
        a.where(F.col("active_week") == F.col("cohort_week"))
        .groupBy("cohort_week").agg(F.count(F.lit(1)).alias("cohort_size"))
        .where(F.col("cohort_size") >= min_cohort)
    )
    # One row per (trader, week): the count per cohort and week is the
    # distinct trader count.
    return (
        a.join(sizes, "cohort_week")
        .groupBy(
            "cohort_week",
            F.floor(F.datediff("active_week", "cohort_week") / F.lit(7)).cast("bigint").alias("weeks_after"),
        )
        .agg(
            (F.count(F.lit(1)).cast("double") / F.max("cohort_size").cast("double")).alias("retained")
        )
        .orderBy("cohort_week", "weeks_after")
        .select(
            "weeks_after",
            F.concat(F.lit("week of "), F.date_format("cohort_week", "MMM d")).alias("cohort"),
            "retained",
        )
    )
