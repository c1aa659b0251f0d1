"""How fast it settles: the four-stage latency funnel and daily settle speed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.percentiles import percentiles
from .common import cross_chain, settled

# The funnel's stages, in order.
STAGES = (
    (1, "RFQ to quote", "t_quote"),
    (2, "quote to signature", "t_decide"),
    (3, "settlement", "t_settle"),
    (4, "end to end", "t_total"),
)


def latency_funnel(orders: DataFrame, exact: bool = True) -> DataFrame:
    """Q14: p50 / p90 / p99 of each stage over settled cross-chain orders.

    The four stage columns are stacked into (stage, seconds) rows in one scan
    and the percentiles are taken per stage."""
    rows = ", ".join(f"{ordinal}, '{stage}', {col}" for ordinal, stage, col in STAGES)
    stacked = orders.where(settled() & cross_chain()).selectExpr(
        f"stack({len(STAGES)}, {rows}) as (ord, stage, seconds)"
    )
    ps = percentiles(stacked, ["ord", "stage"], "seconds", {"p50": 0.5, "p90": 0.9, "p99": 0.99}, exact)
    stages = orders.sparkSession.createDataFrame(
        [(o, s) for o, s, _ in STAGES], "ord int, stage string")
    return stages.join(ps, ["ord", "stage"], "left").select("ord", "stage", "p50", "p90", "p99").orderBy("ord")


def settlement_speed_daily(orders: DataFrame, min_swaps: int = 20, exact: bool = True) -> DataFrame:
    """Q15: p50 / p90 of end-to-end time per creation day; only positive
    times, only days with at least ``min_swaps`` settled swaps."""
    o = orders.where(settled() & (F.col("t_total") > 0) & cross_chain())
    busy = o.groupBy("day").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_swaps)
    ps = percentiles(o.join(busy.select("day"), "day", "left_semi"), ["day"], "t_total",
                     {"p50_seconds": 0.5, "p90_seconds": 0.9}, exact)
    return ps.select("day", "p50_seconds", "p90_seconds").orderBy("day")
