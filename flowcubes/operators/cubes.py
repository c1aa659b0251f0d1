"""Cubes: pre-aggregated order metrics over a time bucket and dimensions.

Metrics are computed from the silver order table. Money stays DECIMAL inside a
cube so that every roll-up is exact and order-independent; ``publish`` casts
to the DOUBLE of the published schema.

Distribution: one ``groupBy`` per cube. Sums and counts aggregate partially on
the map side, so a hot key (one day, one corridor) costs one row per task
before the shuffle. The distinct wallet count is planned by Spark as a
(group, wallet) de-duplication followed by a count, which spreads a hot group
across tasks by wallet.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas

DAY, HOUR = "day", "hour"
#: Order column that each dollar metric sums.
DOLLARS = dict(zip(schemas.METRICS, ("finalized_usd", "filled_usd", "protocol_fee_usd", "integrator_fee_usd")))
#: Parts at least that a busy day's orders are dealt in, by trader.
TRADER_SHARES = 8
#: Orders of one task when all cubes are made at once, and of a day that no
#: single task should hold.
ORDERS_PER_TASK, BUSY_DAY = 100_000, 250_000
#: Amounts that SMALL holds exactly travel in its 8 bytes, any others as they are.
SMALL = T.DecimalType(18, 4)
#: Dimensions travel as one text: parts end at PART, NULL stands for a missing
#: one, and a part that holds such a mark is written in hex after HEX.
PART, NULL, HEX = MARKS = "\x01\x02\x03"


def bucket(grouping: str | None) -> Column | None:
    """The time bucket of an order, by creation time (never finalization)."""
    if grouping is None:
        return None
    if grouping == DAY:
        return F.col("day")
    created = F.timestamp_seconds(F.col("order_create_time"))
    if grouping == HOUR:
        return F.date_trunc("hour", created).alias("hour")
    raise ValueError(f"unknown time grouping {grouping!r}")


def metric_columns(metrics: Sequence[str] | None = None) -> list[Column]:
    """Aggregates of a cube, in publication order: those asked for (all when
    ``metrics`` is empty) and the row count of the group. Amounts that are not
    priced add nothing; ``quality.pricing_coverage`` counts them."""
    out = []
    for name in schemas.METRICS:
        if name in DOLLARS:
            value = F.coalesce(F.sum(DOLLARS[name]), F.lit(0))
        elif name == "unique_trader_wallets_count":
            value = F.count_distinct(F.col("src_trader_address"))
        else:
            value = F.count(F.lit(1))
        if not metrics or name in metrics or name == "finalized_orders_count":
            out.append(value.alias(name))
    return out


def build_cube(orders: DataFrame, dimensions: Sequence[str] = (),
               metrics: Sequence[str] | None = None, grouping: str | None = DAY) -> DataFrame:
    """Group orders by time bucket (day, hour or none) and dimensions."""
    keys = [b for b in [bucket(grouping)] if b is not None] + [F.col(d) for d in dimensions]
    aggs = metric_columns(metrics)
    if keys:
        return orders.groupBy(*keys).agg(*aggs)
    return orders.agg(*aggs)


def named_cube(orders: DataFrame, table: str, grouping: str | None = DAY) -> DataFrame:
    """One of the six published cubes."""
    return build_cube(orders, schemas.CUBE_DIMENSIONS[table], schemas.cube_metrics(table), grouping)


def daily_total(orders: DataFrame) -> DataFrame:
    return named_cube(orders, "daily_total")


def daily_chainpair(orders: DataFrame) -> DataFrame:
    return named_cube(orders, "daily_chainpair")


def daily_resolver(orders: DataFrame) -> DataFrame:
    return named_cube(orders, "daily_resolver")


def daily_input_asset(orders: DataFrame) -> DataFrame:
    return named_cube(orders, "daily_input_asset")


def daily_output_asset(orders: DataFrame) -> DataFrame:
    return named_cube(orders, "daily_output_asset")


def daily_integrator(orders: DataFrame) -> DataFrame:
    return named_cube(orders, "daily_integrator")


def rollup(cube: DataFrame, keys: Sequence[str],
           metrics: Sequence[str] = schemas.ADDITIVE_METRICS) -> DataFrame:
    """A coarser cube from a finer one, additive metrics only.

    Distinct wallets do not add up across groups; they are recomputed from
    orders (``build_cube``) or merged from sketches (``rollup_sketch``).
    """
    present = [m for m in metrics if m in cube.columns]
    return cube.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in present])


def wallet_sketch_cube(orders: DataFrame, dimensions: Sequence[str] = (),
                       grouping: str | None = DAY, lg_k: int = 12) -> DataFrame:
    """A fine cube that carries an HLL sketch of trader wallets, so wallet
    counts can be rolled up to any coarser grain without the orders."""
    keys = [b for b in [bucket(grouping)] if b is not None] + [F.col(d) for d in dimensions]
    aggs = metric_columns(schemas.ADDITIVE_METRICS) + [
        F.hll_sketch_agg(F.col("src_trader_address"), lg_k).alias("wallet_sketch")
    ]
    return orders.groupBy(*keys).agg(*aggs) if keys else orders.agg(*aggs)


def rollup_sketch(cube: DataFrame, keys: Sequence[str]) -> DataFrame:
    """C10 for wallets: merge sketches, then estimate."""
    present = [m for m in schemas.ADDITIVE_METRICS if m in cube.columns]
    grouped = cube.groupBy(*keys) if keys else cube
    return grouped.agg(
        *[F.sum(m).alias(m) for m in present],
        F.hll_sketch_estimate(F.hll_union_agg("wallet_sketch")).alias("unique_trader_wallets_estimate"),
    )


def busy_days(counts: DataFrame, orders: str = "orders") -> dict[dt.date | None, int]:
    """Days of ``counts`` (``day`` and how many orders) too large for one task."""
    return {r["day"]: int(r[orders]) for r in counts.where(F.col(orders) > BUSY_DAY).select(DAY, orders).collect()}


def all_cubes_one_pass(orders: DataFrame, tables: Sequence[str] | None = None, parts: int | None = None,
                       busy: Mapping[dt.date | None, int] | None = None) -> DataFrame:
    """C11: several cubes from one scan and one shuffle of the orders.

    Returns one frame with a ``cube`` column naming the grouping set; split it
    with ``split_cubes``. Dimension columns a set does not group by are NULL.

    Orders are dealt once (to ``parts`` tasks, if given) and repeated for each
    set only after that. A day is dealt as a whole, so that every group is made
    where its orders lie and nothing is shuffled after them. ``busy`` names the
    days that are too large for a task (``busy_days``) and their orders; None
    means that any day may be. These are dealt by a share of their traders too:
    wallets are counted where they lie, and what a task sends on is at most a
    row a group and share. Which days are named changes how rows are dealt, not
    the result."""
    tables = list(tables or schemas.CUBE_DIMENSIONS)
    if busy is None:
        return _cubes_of(orders, tables, parts, TRADER_SHARES)
    if not busy:
        return _cubes_of(orders, tables, parts)
    days = [d for d in busy if d is not None]
    is_busy = F.coalesce(F.col(DAY).isin(days), F.lit(False)) if days else F.lit(False)
    is_busy = is_busy | F.col(DAY).isNull() if None in busy else is_busy
    shares = max(TRADER_SHARES, -(-max(busy.values()) // ORDERS_PER_TASK))
    crowded = -(-sum(busy.values()) // ORDERS_PER_TASK)
    return _cubes_of(orders.where(~is_busy), tables, parts).unionByName(
        _cubes_of(orders.where(is_busy), tables, max(parts, crowded) if parts else None, shares))


def _cubes_of(orders: DataFrame, tables: Sequence[str], parts: int | None, shares: int = 0) -> DataFrame:
    """The cubes of days dealt whole, or by ``shares`` of their traders."""
    dims = list(dict.fromkeys(d for t in tables for d in schemas.CUBE_DIMENSIONS[t]))
    small = [F.when(F.col(c).try_cast(SMALL) == F.col(c), F.col(c).try_cast(SMALL)).alias(f"_{c}") for c in DOLLARS.values()]
    rows = orders.select(DAY, _as_text(dims).alias("_dims"), "src_trader_address", *DOLLARS.values(), *small)
    other = [F.when(F.col(f"_{c}").isNull(), F.col(c)).alias(c) for c in DOLLARS.values()]
    rows = rows.withColumn("_other", F.when(F.coalesce(*other).isNotNull(), F.struct(*other))).drop(*DOLLARS.values())
    if shares:
        dealt = [DAY, "_share"]
        rows = rows.withColumn("_share", F.pmod(F.xxhash64("src_trader_address"), F.lit(shares)))
        rows = rows.repartition(parts, *dealt) if parts else rows.repartition(*dealt)
    elif parts:
        # Days by turns and not by hash, which would put several in one task and
        # none in another; of seven tasks, one would get all weekly days.
        parts += parts % 7 == 0
        dealt = ["_task", DAY]
        rows = rows.withColumn("_task", F.coalesce(F.pmod(F.unix_date(DAY), F.lit(parts)), F.lit(0)))
        rows = rows.repartitionById(parts, F.col("_task"))
    else:
        dealt = [DAY]
        rows = rows.repartition(DAY)
    at = {d: F.col("_parts")[i] for i, d in enumerate(dims)}
    keys = [F.concat_ws(PART, F.lit(t), *[at[d] for d in schemas.CUBE_DIMENSIONS[t]]) for t in tables]
    each = rows.withColumn("_parts", F.split("_dims", PART)).select(
        *dealt, "src_trader_address", F.explode(F.array(*keys)).alias("_key"),
        *[F.coalesce(F.col(f"_{c}").cast(orders.schema[c].dataType), F.col(f"_other.{c}")).alias(c) for c in DOLLARS.values()])
    # no shuffle: the rows are dealt by some of these keys
    wallets = each.groupBy(*dealt, "_key", "src_trader_address").agg(
        *[F.sum(c).alias(c) for c in DOLLARS.values()], F.count(F.lit(1)).alias("_n"))
    made = wallets.groupBy(*([DAY] if shares else dealt), "_key").agg(
        *[F.sum(c).alias(c) for c in DOLLARS.values()], F.sum("_n").alias("_n"), F.count("src_trader_address").alias("_wallets"))
    kinds = {f.name: f.dataType for f in build_cube(orders).schema.fields}
    values = {m: F.col(c) for m, c in DOLLARS.items()} | {
        "finalized_orders_count": F.col("_n"), "unique_trader_wallets_count": F.col("_wallets")}
    made = made.withColumn("_parts", _from_text("_key")).withColumn("cube", F.col("_parts")[0])
    own = []
    for d in dims:
        value = F.lit(None).cast("string")
        for t in tables:
            if d in schemas.CUBE_DIMENSIONS[t]:
                value = F.when(F.col("cube") == t, F.col("_parts")[1 + schemas.CUBE_DIMENSIONS[t].index(d)]).otherwise(value)
        own.append(value.alias(d))
    return made.select("cube", DAY, *own, *[F.coalesce(values[m].cast(kinds[m]), F.lit(0).cast(kinds[m])).alias(m) for m in schemas.METRICS])


def _marked(text: Column) -> Column:
    return text.contains(PART) | text.contains(NULL) | text.contains(HEX)


def _as_text(columns: Sequence[str]) -> Column:
    """The columns' texts as one, from which each can be had back: in rows of a
    shuffle one text takes half the bytes of a dozen short ones."""
    parts = F.array(*columns).cast("array<string>")
    safe = F.transform(parts, lambda p: F.when(_marked(p), F.concat(F.lit(HEX), F.hex(p))).otherwise(p))
    return F.when(_marked(F.array_join(parts, "")), F.array_join(safe, PART, NULL)).otherwise(F.array_join(parts, PART, NULL))


def _from_text(text: str) -> Column:
    """The parts of ``_as_text``."""
    return F.transform(F.split(text, PART), lambda p: F.when(p.startswith(HEX), F.decode(F.unhex(F.substring(p, 2, 2**31 - 1)), "utf-8"))
                       .when(p != NULL, p))


def split_cubes(one_pass: DataFrame, table: str) -> DataFrame:
    cols = ["day", *schemas.CUBE_DIMENSIONS[table], *schemas.cube_metrics(table)]
    return one_pass.where(F.col("cube") == table).select(*cols)
