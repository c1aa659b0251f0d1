"""Dashboard analytics of the design document: tiles per period, parameter
filters, cross- vs intrachain volume, source x destination matrices, top
corridors, latency by trade size, settle time by corridor, success rate,
quote vs delivered, resolver share, trade-size concentration, order lookup.

Same conventions as the 23 metrics: cube-level figures come from the cubes,
distinct counts and percentiles from orders, money stays DECIMAL until the
output, and every clock is an explicit parameter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import ratio, whole_units
from ..operators import pricing
from ..operators.percentiles import percentiles
from .assets import SIZE_BOUNDS, size_buckets
from .common import created_ts, cross_chain, filled_count, one_row, settled, week_of
from .growth import HOME_CHAIN

# The tile periods (name, whole days before ``as_of``; None =
# all time) and the report granularities.
PERIODS = (("24h", 1), ("7d", 7), ("all time", None))
GRANULARITIES = ("day", "week", "month")


def corridor() -> Column:
    return F.concat(F.col("src_chain_id"), F.lit(" → "), F.col("dst_chain_id"))


def _period_rows(df: DataFrame, as_of: str) -> DataFrame:
    """Each row once per period that contains its creation day; at most
    ``len(PERIODS)`` copies, made inside the row (no join)."""
    end = F.lit(as_of).cast("date")
    day = F.col("day")
    tags = [
        F.when((day < end) & (day >= F.date_sub(end, n)) if n else (day < end), F.lit(name))
        for name, n in PERIODS
    ]
    return df.withColumn("period", F.explode(F.array(*tags))).where(F.col("period").isNotNull())


def headline_windows(chainpair: DataFrame, orders: DataFrame, as_of: str,
                     home_chain: str = HOME_CHAIN, exact: bool = True) -> DataFrame:
    """The six tiles (cross-chain volume, swaps, traders, net home-chain
    inflow, median end-to-end time, active resolvers) for the last day, the
    last seven days and all time before ``as_of``; one row per period."""
    src, dst, vol = F.col("src_chain_id"), F.col("dst_chain_id"), F.col("filled_orders_volume_usd")
    home, zero = F.lit(home_chain), F.lit(0)
    cc = _period_rows(chainpair, as_of).groupBy("period").agg(
        F.sum(F.when(cross_chain(), vol)).cast("double").alias("volume_usd"),
        F.sum(F.when(cross_chain(), filled_count())).cast("bigint").alias("swaps"),
        (
            F.sum(F.when((dst == home) & (src != home), vol).otherwise(zero))
            - F.sum(F.when((src == home) & (dst != home), vol).otherwise(zero))
        ).cast("double").alias("net_ton_usd"),
    )
    o = _period_rows(orders.where(cross_chain() & settled()), as_of)
    people = o.groupBy("period").agg(
        F.count_distinct("src_trader_address").alias("traders"),
        F.count_distinct("resolver_id").alias("resolvers"),
    )
    median = percentiles(o, ["period"], "t_total", {"median_seconds": 0.5}, exact)
    names = chainpair.sparkSession.createDataFrame(
        [(i, name) for i, (name, _) in enumerate(PERIODS, 1)], "ord int, period string")
    return (
        names.join(cc, "period", "left").join(people, "period", "left").join(median, "period", "left")
        .orderBy("ord")
        .select("period", "volume_usd", "swaps", "traders", "net_ton_usd", "median_seconds", "resolvers")
    )


def bucket_of(granularity: str) -> Column:
    """Creation-time bucket as DATE: the day, its Monday, or the first of
    its month."""
    if granularity not in GRANULARITIES:
        raise ValueError(f"granularity must be one of {GRANULARITIES}")
    ts = created_ts()
    return {"day": F.to_date(ts), "week": week_of(ts), "month": F.to_date(F.date_trunc("month", ts))}[granularity]


def apply_filters(orders: DataFrame, start: str | None = None, end: str | None = None,
                  src: str | None = None, dst: str | None = None) -> DataFrame:
    """The global parameters: creation period ``[start, end)`` and source /
    destination chain. Plain column predicates, so they reach the scan."""
    cond = F.lit(True)
    if start:
        cond = cond & (F.col("day") >= F.lit(start).cast("date"))
    if end:
        cond = cond & (F.col("day") < F.lit(end).cast("date"))
    if src:
        cond = cond & (F.col("src_chain_id") == F.lit(src))
    if dst:
        cond = cond & (F.col("dst_chain_id") == F.lit(dst))
    return orders.where(cond)


def _exact_usd(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Dollar totals per key from exact integer units summed per token
    precision and scaled once, so the total does not depend on summation
    order."""
    per_precision = df.groupBy(*keys, "decimals").agg(
        F.sum(whole_units(F.col("actual_input_units"))).alias("_units"))
    return per_precision.groupBy(*keys).agg(
        F.sum(F.col("_units").cast("double") / F.pow(F.lit(10.0), F.col("decimals"))).alias("volume_usd"))


def filtered_volume(orders: DataFrame, evm_tokens: DataFrame, jettons: DataFrame,
                    granularity: str = "day", start: str | None = None, end: str | None = None,
                    src: str | None = None, dst: str | None = None, min_usd: float | None = None,
                    stable: Sequence[str] = pricing.STABLECOINS) -> DataFrame:
    """Settled cross-chain swaps, traders and priced volume per bucket under
    the global parameters. A minimum trade size needs a price, so with
    ``min_usd`` unpriceable trades drop out; without it they still count as
    swaps and traders."""
    o = apply_filters(orders.where(settled() & cross_chain()), start, end, src, dst)
    priced = pricing.price_orders(o, evm_tokens, jettons, stable).withColumn("bucket", bucket_of(granularity))
    if min_usd is not None:
        priced = priced.where(F.col("usd") >= F.lit(float(min_usd)))
    counts = priced.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("swaps"), F.count_distinct("src_trader_address").alias("traders"))
    usd = _exact_usd(priced.where(F.col("usd").isNotNull()), ["bucket"])
    return (
        counts.join(usd, "bucket", "left")
        .select("bucket", F.col("swaps").cast("bigint").alias("swaps"), "traders", "volume_usd")
        .orderBy("bucket")
    )


def cross_vs_intra_daily(chainpair: DataFrame) -> DataFrame:
    """Daily filled volume split into cross-chain and intrachain (stacked),
    the 7-row moving average of their total, and settled swaps."""
    vol, xc = F.col("filled_orders_volume_usd"), cross_chain()
    zero = F.lit(0)
    daily = (
        chainpair.where(F.col("src_chain_id").isNotNull() & F.col("dst_chain_id").isNotNull())
        .groupBy("day")
        .agg(
            F.sum(F.when(xc, vol).otherwise(zero)).alias("_x"),
            F.sum(F.when(~xc, vol).otherwise(zero)).alias("_i"),
            F.sum(vol).alias("_t"),
            F.sum(filled_count()).alias("_s"),
        )
    )
    last7 = Window.orderBy("day").rowsBetween(-6, 0)
    return daily.select(
        "day",
        F.col("_x").cast("double").alias("cross_chain_usd"),
        F.col("_i").cast("double").alias("intrachain_usd"),
        F.col("_t").cast("double").alias("total_usd"),
        (F.sum("_t").over(last7).cast("double") / F.count(F.lit(1)).over(last7).cast("double"))
        .alias("total_7d_avg"),
        F.col("_s").cast("bigint").alias("swaps"),
    ).orderBy("day")


def corridor_matrix(chainpair: DataFrame, measure: str = "volume",
                    chains: Sequence[str] | None = None) -> DataFrame:
    """Source x destination matrix of cross-chain corridors: one row per
    source chain, one column per destination chain: those of ``chains``, or
    taken from the data, for which building the frame reads it once.
    ``measure`` is ``volume`` (filled USD) or
    ``success`` (settled share of finalized orders, %).

    The cube is first reduced to one row per corridor; the pivot then runs
    over at most chains^2 rows."""
    per = (
        chainpair.where(cross_chain())
        .groupBy("src_chain_id", "dst_chain_id")
        .agg(
            F.sum("filled_orders_volume_usd").alias("_vol"),
            F.sum(filled_count()).alias("_filled"),
            F.sum("finalized_orders_count").alias("_n"),
        )
    )
    if measure == "volume":
        cell = F.col("_vol").cast("double")
    elif measure == "success":
        cell = ratio(F.lit(100.0) * F.col("_filled").cast("double"), F.col("_n"))
    else:
        raise ValueError("measure must be 'volume' or 'success'")
    cells = per.select(F.col("src_chain_id").alias("source"), "dst_chain_id", cell.alias("_v"))
    return cells.groupBy("source").pivot("dst_chain_id", list(chains) if chains else None).agg(F.max("_v")).orderBy("source")


def top_corridors(chainpair: DataFrame, k: int = 10) -> DataFrame:
    """The k largest cross-chain corridors by filled volume and, separately,
    by settled swaps (they rank differently). Each ranking is a distributed
    top-k over one row per corridor."""
    per = (
        chainpair.where(cross_chain())
        .groupBy(corridor().alias("corridor"))
        .agg(F.sum("filled_orders_volume_usd").alias("_vol"), F.sum(filled_count()).alias("_swaps"))
        .select("corridor", F.col("_vol").cast("double").alias("volume_usd"),
                F.col("_swaps").cast("bigint").alias("swaps"))
    )
    ranked = None
    for name, key in (("volume", "volume_usd"), ("count", "swaps")):
        top = per.orderBy(F.col(key).desc(), "corridor").limit(k).withColumn("ranking", F.lit(name))
        ranked = top if ranked is None else ranked.unionByName(top)
    order = Window.partitionBy("ranking").orderBy(
        F.when(F.col("ranking") == "volume", F.col("volume_usd")).otherwise(F.col("swaps").cast("double")).desc(),
        "corridor")
    return ranked.select(
        "ranking", F.row_number().over(order).cast("int").alias("rank"), "corridor", "volume_usd", "swaps"
    ).orderBy("ranking", "rank")


def _size_bucket(bounds: Sequence[float]) -> Column:
    labels, usd = size_buckets(bounds), F.col("usd")
    return (
        F.when(usd < bounds[0], labels[0])
        .when(usd < bounds[1], labels[1])
        .when(usd < bounds[2], labels[2])
        .when(usd <= bounds[3], labels[3])
        .otherwise(labels[4])
    )


def latency_by_size(orders: DataFrame, evm_tokens: DataFrame, jettons: DataFrame,
                    stable: Sequence[str] = pricing.STABLECOINS, bounds: Sequence[float] = SIZE_BOUNDS,
                    exact: bool = True) -> DataFrame:
    """p50 / p90 / p99 of end-to-end time per trade-size bucket (the buckets
    of the trade-size distribution, priced the same way)."""
    priced = pricing.price_orders(orders.where(settled() & cross_chain()), evm_tokens, jettons, stable) \
        .where(F.col("usd").isNotNull()).withColumn("bucket", _size_bucket(bounds))
    n = priced.groupBy("bucket").agg(F.count(F.lit(1)).cast("bigint").alias("swaps"))
    ps = percentiles(priced, ["bucket"], "t_total", {"p50": 0.5, "p90": 0.9, "p99": 0.99}, exact)
    return (
        n.join(ps, "bucket", "left").orderBy("bucket")
        .select(F.expr("substr(bucket, 4)").alias("trade_size"), "swaps", "p50", "p90", "p99")
    )


def settle_time_by_corridor(orders: DataFrame, exact: bool = True) -> DataFrame:
    """p50 / p90 of end-to-end time per cross-chain corridor (settled swaps
    with a positive time, as in the daily settle speed)."""
    o = orders.where(settled() & (F.col("t_total") > 0) & cross_chain()).withColumn("corridor", corridor())
    n = o.groupBy("corridor").agg(F.count(F.lit(1)).cast("bigint").alias("swaps"))
    ps = percentiles(o, ["corridor"], "t_total", {"p50_seconds": 0.5, "p90_seconds": 0.9}, exact)
    return n.join(ps, "corridor", "left").select("corridor", "swaps", "p50_seconds", "p90_seconds") \
        .orderBy(F.col("swaps").desc(), "corridor")


def success_rate_daily(chainpair: DataFrame) -> DataFrame:
    """Finalized and settled cross-chain orders per day, the success rate and
    the volume of failed orders (quoted, never delivered)."""
    failed_vol = F.when(~settled(), F.col("finalized_orders_volume_usd")).otherwise(F.lit(0))
    d = chainpair.where(cross_chain()).groupBy("day").agg(
        F.sum("finalized_orders_count").alias("_n"),
        F.sum(filled_count()).alias("_filled"),
        F.sum(failed_vol).alias("_failed_usd"),
    )
    return d.select(
        "day",
        F.col("_n").cast("bigint").alias("orders"),
        F.col("_filled").cast("bigint").alias("filled"),
        ratio(F.lit(100.0) * F.col("_filled").cast("double"), F.col("_n")).alias("success_pct"),
        F.col("_failed_usd").cast("double").alias("failed_volume_usd"),
    ).orderBy("day")


def quote_vs_delivered(orders: DataFrame, exact: bool = True) -> DataFrame:
    """Delivered against quoted output per corridor, with its coverage: the
    share of settled swaps that carry a usable quote. The gap is in pips of
    the quote, next to the stated fees (protocol + integrator pips) it
    should equal."""
    q = F.col("quote_output_units").try_cast("double")
    a = F.col("actual_output_units").try_cast("double")
    o = orders.where(settled() & cross_chain()).select(
        corridor().alias("corridor"),
        F.when((q > 0) & a.isNotNull(), (q - a) / q * F.lit(1_000_000.0)).alias("gap_pips"),
        (F.col("protocol_fee_pips") + F.col("integrator_fee_pips")).alias("fee_pips"),
    )
    counts = o.groupBy("corridor").agg(
        F.count(F.lit(1)).alias("settled_orders"),
        F.count("gap_pips").alias("quoted_orders"),
    )
    # Both medians in one percentile pass: the two measures are stacked into
    # (corridor, measure, value) rows and folded back per corridor.
    stacked = o.where(F.col("gap_pips").isNotNull()).selectExpr(
        "corridor", "stack(2, 'gap', gap_pips, 'fee', fee_pips) as (measure, pips)")
    medians = (
        percentiles(stacked, ["corridor", "measure"], "pips", {"p50": 0.5}, exact)
        .groupBy("corridor")
        .agg(F.max(F.when(F.col("measure") == "gap", F.col("p50"))).alias("median_gap_pips"),
             F.max(F.when(F.col("measure") == "fee", F.col("p50"))).alias("median_fee_pips"))
    )
    return (
        counts.join(medians, "corridor", "left")
        .select(
            "corridor", "settled_orders", "quoted_orders",
            ratio(F.lit(100.0) * F.col("quoted_orders").cast("double"), F.col("settled_orders"))
            .alias("coverage_pct"),
            "median_gap_pips", "median_fee_pips",
        )
        .orderBy(F.col("settled_orders").desc(), "corridor")
    )


def resolver_share_daily(resolver_cube: DataFrame) -> DataFrame:
    """Each resolver's share of the day's filled cross-chain volume (a 100 %
    stacked area). The share window partitions by day, so it spans one day's
    resolvers, never the whole history."""
    d = (
        resolver_cube.where(cross_chain() & F.col("resolver_id").isNotNull())
        .groupBy("day", "resolver_id")
        .agg(F.sum("filled_orders_volume_usd").alias("_v"))
        .where(F.col("_v") > 0)
    )
    day_total = F.sum("_v").over(Window.partitionBy("day"))
    return d.select(
        "day", "resolver_id", F.col("_v").cast("double").alias("volume_usd"),
        (F.col("_v").cast("double") / day_total.cast("double")).alias("share"),
    ).orderBy("day", "resolver_id")


def size_concentration(orders: DataFrame, evm_tokens: DataFrame, jettons: DataFrame,
                       stable: Sequence[str] = pricing.STABLECOINS, k: int = 10,
                       exact: bool = True) -> DataFrame:
    """One row: priced trades and traders, mean against median trade size,
    and the share of volume held by the top k traders.

    Per trader, units are summed exactly per precision; the k largest
    traders come from a distributed top-k and are broadcast back (k rows)."""
    priced = pricing.price_orders(orders.where(settled() & cross_chain()), evm_tokens, jettons, stable) \
        .where(F.col("usd").isNotNull()).withColumnRenamed("src_trader_address", "trader")
    per = priced.groupBy("trader", "decimals").agg(
        F.sum(whole_units(F.col("actual_input_units"))).alias("_units"),
        F.count(F.lit(1)).alias("_n"),
    )
    scaled = F.col("_units").cast("double") / F.pow(F.lit(10.0), F.col("decimals"))
    by_trader = per.groupBy("trader").agg(F.sum(scaled).alias("_usd"))
    top = by_trader.orderBy(F.col("_usd").desc(), F.col("trader").asc_nulls_last()).limit(k) \
        .select(F.col("trader").alias("_top"))
    top_usd = (
        per.join(F.broadcast(top), F.col("trader").eqNullSafe(F.col("_top")), "left_semi")
        .groupBy("decimals").agg(F.sum("_units").alias("_units"))
        .agg(F.sum(scaled).alias("top_usd"))
    )
    totals = (
        per.groupBy("decimals").agg(F.sum("_units").alias("_units"), F.sum("_n").alias("_n"))
        .agg(F.sum(scaled).alias("total_usd"), F.sum("_n").alias("trades"))
    )
    traders = per.agg(F.count_distinct("trader").alias("traders"))
    median = percentiles(priced, [], "usd", {"median_trade_usd": 0.5}, exact)
    both = one_row(totals, top_usd, traders, median)
    return both.select(
        F.col("trades").cast("bigint").alias("trades"),
        "traders",
        ratio(F.col("total_usd"), F.col("trades")).alias("mean_trade_usd"),
        "median_trade_usd",
        F.col("top_usd").alias(f"top{k}_usd"),
        "total_usd",
        ratio(F.lit(100.0) * F.col("top_usd"), F.col("total_usd")).alias(f"top{k}_share_pct"),
    )


LOOKUP_COLUMNS = (
    "lt", "status", "quote_id", "src_chain_id", "dst_chain_id", "input_asset_address",
    "output_asset_address", "quote_input_units", "actual_output_units", "resolver_id",
    "src_trader_address", "integrator_address", "order_create_time", "order_finalize_time", "t_total",
)


def order_lookup(orders: DataFrame, quote_id: str) -> DataFrame:
    """Every order row of one quote id. On the published table ``quote_id``
    is a plain column, so the equality reaches the Parquet scan as a pushed
    filter and skips row groups by their statistics."""
    return orders.where(F.col("quote_id") == F.lit(quote_id)).select(*LOOKUP_COLUMNS).orderBy("lt")
