"""When people trade: the shape of a day (UTC hours) and of a week.

Both average over the last ``days`` whole days before ``as_of`` (never a
moving "today"). Hours / days without swaps are zeros on a calendar grid, so a
quiet hour is not dropped from its own average. The grid is built by
exploding a ``sequence`` -- at most ``days`` x 24 rows -- and left-joined to
the per-hour facts, which are filtered to the window before aggregating.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.stats import percentile, shifted
from ..operators import pricing
from .common import created_ts, cross_chain, settled

WINDOW_DAYS = 56


def _as_date(value: str | dt.date) -> Column:
    return F.lit(str(value)).cast("date")


def calendar(activity: DataFrame, as_of: str | dt.date, days: int = WINDOW_DAYS) -> DataFrame:
    """``day``: whole days in ``[max(first day + 1, as_of - days), as_of - 1]``.

    An empty input or an inverted range yields no days (``greatest`` in Spark
    skips NULLs, so the empty case is guarded explicitly)."""
    as_of_d = _as_date(as_of)
    first = activity.agg(F.min(F.to_date("ts")).alias("_first"))
    d0 = F.greatest(F.date_add("_first", 1), F.date_sub(as_of_d, days))
    d1 = F.date_sub(as_of_d, 1)
    return first.select(
        F.explode(
            F.when(
                F.col("_first").isNotNull() & (d0 <= d1),
                F.sequence(d0, d1, F.expr("interval 1 day")),
            ).otherwise(F.array().cast("array<date>"))
        ).alias("day")
    )


def _recent(activity: DataFrame, as_of: str | dt.date, days: int) -> DataFrame:
    as_of_d = _as_date(as_of)
    return activity.where(
        (F.col("ts") >= F.date_sub(as_of_d, days).cast("timestamp"))
        & (F.col("ts") < as_of_d.cast("timestamp"))
    )


def activity_from_orders(orders: DataFrame, evm_tokens: DataFrame, jettons: DataFrame,
                         stable: Sequence[str] = pricing.STABLECOINS) -> DataFrame:
    """What the clocks read, ``ts, trader, usd``, from orders: settled
    cross-chain ones at their creation time, priced from the raw input units of
    dollar stablecoins (exactly, to 18 places) and NULL where they are not."""
    priced = pricing.price_orders(orders.where(settled() & cross_chain()), evm_tokens, jettons, stable)
    exact = shifted(F.col("actual_input_units"), F.col("decimals"), T.DecimalType(38, 18))
    return priced.select(
        created_ts().alias("ts"), F.col("src_trader_address").alias("trader"),
        F.when(F.col("usd").isNotNull(), exact).alias("usd"))


def _measures(exact: bool) -> list[Column]:
    n = F.count(F.lit(1)).cast("double")
    return [
        (F.sum("swaps").cast("double") / n).alias("avg_swaps"),
        percentile("swaps", 0.5, exact).alias("median_swaps"),
        (F.sum("traders").cast("double") / n).alias("avg_traders"),
        percentile("traders", 0.5, exact).alias("median_traders"),
        (F.sum("volume_usd").cast("double") / n).alias("avg_volume_usd"),
        percentile("volume_usd", 0.5, exact).alias("median_volume_usd"),
    ]


def _facts(activity: DataFrame, keys: list[Column]) -> DataFrame:
    return activity.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("swaps"),
        F.count_distinct("trader").alias("traders"),
        F.sum("usd").alias("volume_usd"),
    )


def _zero_fill(grid: DataFrame, facts: DataFrame, keys: list[str]) -> DataFrame:
    return grid.join(facts, keys, "left").select(
        *keys,
        F.coalesce("swaps", F.lit(0)).alias("swaps"),
        F.coalesce("traders", F.lit(0)).alias("traders"),
        F.coalesce(F.col("volume_usd"), F.lit(0)).alias("volume_usd"),
    )


def hourly_clock(activity: DataFrame, as_of: str | dt.date, days: int = WINDOW_DAYS,
                 exact: bool = True) -> DataFrame:
    """Q12: per UTC hour, mean and median swaps, traders and volume per day.

    ``activity``: ``ts, trader, usd`` of settled cross-chain swaps; ``usd``
    is NULL for unpriced ones (they still count as swaps and traders)."""
    grid = calendar(activity, as_of, days).select(
        "day", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("h")
    )
    facts = _facts(_recent(activity, as_of, days),
                   [F.to_date("ts").alias("day"), F.hour("ts").alias("h")])
    filled = _zero_fill(grid, facts, ["day", "h"])
    return (
        filled.groupBy("h").agg(*_measures(exact))
        .orderBy("h")
        .select(
            F.concat(F.lpad(F.col("h").cast("string"), 2, "0"), F.lit(":00")).alias("hour_utc"),
            "avg_swaps", "median_swaps", "avg_traders", "median_traders",
            "avg_volume_usd", "median_volume_usd",
        )
    )


def weekday_clock(activity: DataFrame, as_of: str | dt.date, days: int = WINDOW_DAYS,
                  exact: bool = True) -> DataFrame:
    """Q13: the same measures per weekday, Monday first."""
    grid = calendar(activity, as_of, days)
    facts = _facts(_recent(activity, as_of, days), [F.to_date("ts").alias("day")])
    filled = _zero_fill(grid, facts, ["day"])
    return (
        filled.groupBy(
            F.date_format("day", "EEEE").alias("weekday"),
            (F.weekday("day") + 1).alias("_iso_dow"),
        )
        .agg(*_measures(exact))
        .orderBy("_iso_dow")
        .select("weekday", "avg_swaps", "median_swaps", "avg_traders", "median_traders",
                "avg_volume_usd", "median_volume_usd")
    )
