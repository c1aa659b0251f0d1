"""Predicates and small building blocks shared by the metric plans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas


def cross_chain() -> Column:
    """``src != dst``; rows with a NULL chain are dropped, as in SQL."""
    return F.col("src_chain_id") != F.col("dst_chain_id")


def settled() -> Column:
    return F.col("status") == F.lit(schemas.FILLED)


def filled_count() -> Column:
    """Settled swaps of a cube row (its order count when the row is settled)."""
    return F.when(settled(), F.col("finalized_orders_count")).otherwise(F.lit(0))


def created_ts() -> Column:
    return F.timestamp_seconds(F.col("order_create_time"))


def week_of(ts: Column) -> Column:
    """Monday of the UTC week, as DATE."""
    return F.to_date(F.date_trunc("week", ts))


def top_k_with_other(df: DataFrame, key: str, measure: str, k: int,
                     other: str = "other", null_safe: bool = False) -> DataFrame:
    """Keep the k largest keys by total measure, relabel the rest.

    The k keys come from one aggregate and a ``limit`` -- at most k rows by
    construction -- so they are broadcast back onto the detail rows.
    Ties are broken by the key so the choice is deterministic. With
    ``null_safe`` a NULL key ranked inside k keeps its place (rank semantics);
    otherwise it is pooled (``IN (subquery)`` semantics).
    """
    top = (
        df.groupBy(key).agg(F.sum(measure).alias("_total"))
        .orderBy(F.col("_total").desc(), F.col(key).asc())
        .limit(k)
        .select(F.col(key).alias("_top_key"), F.lit(True).alias("_is_top"))
    )
    cond = df[key].eqNullSafe(F.col("_top_key")) if null_safe else df[key] == F.col("_top_key")
    joined = df.join(F.broadcast(top), cond, "left")
    return joined.withColumn(
        key, F.when(F.col("_is_top"), F.col(key)).otherwise(F.lit(other))
    ).drop("_top_key", "_is_top")


def rank_top_k(df: DataFrame, key: str, measure: str, k: int, other: str) -> DataFrame:
    """T7 over an already aggregated frame (one row per key): keys ranked
    beyond k (by measure, then key) are pooled under ``other``.

    Same result as ``row_number() over (order by measure desc) <= k``, but
    the ranking is a distributed top-k (``limit`` after ``orderBy``) whose k
    rows are broadcast back, instead of one window partition of all keys."""
    return (
        top_k_with_other(df, key, measure, k, other, null_safe=True)
        .groupBy(key).agg(F.sum(measure).alias(measure))
    )


def one_row(*frames: DataFrame) -> DataFrame:
    """Side-by-side combination of single-row global aggregates.

    No join: the frames (disjoint column names) are stacked and folded with
    ``max``, which picks each column's only non-NULL value."""
    names = [c for f in frames for c in f.columns]
    stacked = frames[0]
    for f in frames[1:]:
        stacked = stacked.unionByName(f, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in names])


def cols(*names: str) -> Sequence[Column]:
    return [F.col(n) for n in names]
