"""Cubes that carry sketches, so that what does not add up can be rolled up.

Percentiles and distinct traders of a coarser period cannot be had from finer
cubes. A cube that holds a mergeable sketch beside its counts answers them
within a known error without reading the orders again:

* a KLL sketch of a time per day and dimensions gives percentiles of any
  coarser period or set of chains (``merged_quantiles``);
* a theta sketch of the traders per week gives, by set algebra, new and
  returning traders (``new_vs_returning_estimate``) and the retention of
  cohorts (``cohort_estimate``).

Sketches are built with partial aggregation: a hot day or week is one sketch a
task before the shuffle. A cube has one row a period and dimension, so merging,
windows and joins over it are bounded by the calendar and never by orders.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.common import created_ts, cross_chain, settled, week_of

KLL_K = 400
THETA_LG_K = 12


def kll_rank_bound(k: int = KLL_K) -> float:
    """Three times the rank error, as a share of n, that a KLL sketch keeps in
    99 of 100 reads (fixed values of the sketch: 2.296 / k^0.9723)."""
    return 3 * 2.296 / k ** 0.9723


def theta_bound(union_size: Column, lg_k: int = THETA_LG_K) -> Column:
    """Five standard errors of a difference or intersection, as a count: both
    err by ``1 / sqrt(k)`` of the union of their two sides; none below k."""
    k = 2 ** lg_k
    return F.when(union_size <= k, 0.5).otherwise(F.lit(5.0 / k ** 0.5) * union_size)


def time_sketch_cube(orders: DataFrame, dimensions: Sequence[str] = (), measure: str = "t_total",
                     k: int = KLL_K) -> DataFrame:
    """One row a creation day and dimensions: settled orders with a positive
    ``measure``, and a KLL sketch of it. Orders without one are not counted."""
    value = F.col(measure).cast("double")
    return (orders.where(settled() & (F.col(measure) > 0)).groupBy("day", *dimensions)
            .agg(F.count(F.lit(1)).alias("orders"), F.kll_sketch_agg_double(value, k).alias("sketch")))


def merged_quantiles(cube: DataFrame, keys: Mapping[str, Column], ps: Mapping[str, float], k: int = KLL_K) -> DataFrame:
    """Percentile estimates of coarser groups from a cube of sketches alone:
    ``keys`` (name -> expression over the cube), ``orders`` and ``ps``."""
    merged = cube.groupBy(*[c.alias(n) for n, c in keys.items()]).agg(
        F.sum("orders").alias("orders"), F.kll_merge_agg_double("sketch", k).alias("_s"))
    return merged.select(*keys, "orders", *[
        F.kll_sketch_get_quantile_double("_s", F.lit(float(p))).alias(n) for n, p in ps.items()])


def rank_errors(orders: DataFrame, estimates: DataFrame, keys: Mapping[str, Column], ps: Mapping[str, float],
                measure: str = "t_total") -> DataFrame:
    """How far each estimate is from the rank it stands for, as a share of its
    group, counted over the orders: ``keys``, ``p``, ``orders``, ``rank_error``.
    The estimates (a row a period and dimensions) are broadcast; of the orders
    only counts are shuffled. A NULL key is a key like any other."""
    long = estimates.select(*[F.col(k).alias("_e_" + k) for k in keys], F.explode(F.array(*[
        F.struct(F.lit(float(p)).alias("p"), F.col(n).alias("q")) for n, p in ps.items()])).alias("_e"))
    o = orders.where(settled() & (F.col(measure) > 0)).select(
        *[c.alias(n) for n, c in keys.items()], F.col(measure).cast("double").alias("_v"))
    same = [F.col(k).eqNullSafe(F.col("_e_" + k)) for k in keys]
    counted = o.join(F.broadcast(long), same).groupBy(*keys, F.col("_e.p").alias("p")).agg(
        F.count(F.lit(1)).alias("orders"), F.count_if(F.col("_v") < F.col("_e.q")).alias("_below"),
        F.count_if(F.col("_v") <= F.col("_e.q")).alias("_upto"))
    rank = F.col("p") * F.col("orders")
    off = F.greatest(F.lit(0.0), F.col("_below") - rank, rank - F.col("_upto"))
    return counted.select(*keys, "p", "orders", (off / F.col("orders")).alias("rank_error"))


def trader_sketch_cube(orders: DataFrame, lg_k: int = THETA_LG_K) -> DataFrame:
    """One row a week: a theta sketch of the traders of settled cross-chain
    orders. Orders without a trader are in none."""
    active = orders.where(settled() & cross_chain() & F.col("src_trader_address").isNotNull())
    return active.groupBy(week_of(created_ts()).alias("week")).agg(
        F.theta_sketch_agg("src_trader_address", lg_k).alias("sketch"))


def _with_earlier(cube: DataFrame, lg_k: int) -> DataFrame:
    """Each week with the union of all weeks before it; a week a row."""
    before = Window.orderBy("week").rowsBetween(Window.unboundedPreceding, -1)
    return cube.select("week", "sketch", F.theta_union_agg("sketch", lg_k).over(before).alias("earlier"))


def new_vs_returning_estimate(cube: DataFrame, lg_k: int = THETA_LG_K) -> DataFrame:
    """Q4 from the weekly sketches alone: traders new in a week, returning
    ones, and all traders up to it."""
    e, s = F.col("earlier"), F.col("sketch")
    size = F.theta_sketch_estimate
    first = e.isNull()
    return _with_earlier(cube, lg_k).select(
        "week",
        size(F.when(first, s).otherwise(F.theta_difference(s, e))).alias("new_traders"),
        F.when(first, 0).otherwise(size(F.theta_intersection(s, e))).cast("bigint").alias("returning_traders"),
        size(F.when(first, s).otherwise(F.theta_union(s, e, lg_k))).alias("cumulative_traders"))


def cohort_estimate(cube: DataFrame, max_weeks: int, lg_k: int = THETA_LG_K) -> DataFrame:
    """Q5 from the weekly sketches alone: per cohort (the traders new in a week)
    and week after it, up to ``max_weeks``, those active again. Weeks in which
    no trader was active have no row."""
    e, s = F.col("earlier"), F.col("sketch")
    born = _with_earlier(cube, lg_k).select(
        F.col("week").alias("cohort_week"),
        F.when(e.isNull(), s).otherwise(F.theta_difference(s, e)).alias("born"))
    later = born.select("*", F.explode(F.sequence(F.lit(0), F.lit(max_weeks))).alias("weeks_after")).withColumn(
        "week", F.date_add("cohort_week", F.col("weeks_after") * 7))
    return later.join(cube, "week").select(
        "cohort_week", F.col("weeks_after").cast("bigint").alias("weeks_after"),
        F.theta_sketch_estimate("born").alias("cohort_size"),
        F.theta_sketch_estimate(F.theta_intersection("born", "sketch")).alias("retained_traders"))
