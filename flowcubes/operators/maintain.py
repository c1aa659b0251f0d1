"""Silver orders and cubes kept up to date from what lands.

A re-pulled window brings orders that finalized late, orders that changed and
not those that vanished. The silver table is kept in buckets of ``lt``, so that
a landing is merged without shuffling what is held; a cube is kept by the signed
differences of the days that changed, and only their wallets are counted anew.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas
from ..session import ensure_checkpoint_dir
from . import cubes
from .ingest import row_digest
from .quality import PublishError

BUCKETS = 64
#: Pages whose summaries are compared in one window.
PAGES_PER_BLOCK = 4096


# ---------------------------------------------------------------------------
# The order of a landing
# ---------------------------------------------------------------------------
def page_summaries(landed: DataFrame) -> DataFrame:
    """One row a page, in one pass and one grouped aggregate: ``page`` (its
    number), ``first``, ``last``, ``rows``, ``stalls`` (rows whose ``lt`` is not
    above the one before) and ``odd`` (rows whose ``lt`` is no number).
    ``landed``: ``page, pos, lt``. A page is what one request returned."""
    lt = F.col("lt").try_cast("decimal(38,0)")
    at = F.array_sort(F.collect_list(F.struct("pos", lt.alias("lt")))).alias("_rows")  # a page at most
    pages = landed.groupBy("page").agg(at, F.count_if(lt.isNull()).alias("odd"))
    pages = pages.withColumn("_lt", F.filter(F.transform("_rows", lambda r: r["lt"]), lambda x: x.isNotNull()))
    stalled = F.zip_with(F.slice("_lt", 2, F.greatest(F.size("_lt") - 1, F.lit(0))), F.col("_lt"), lambda b, a: F.coalesce(b <= a, F.lit(False)))
    return pages.select("page", F.try_element_at("_lt", F.lit(1)).alias("first"), F.try_element_at("_lt", F.lit(-1)).alias("last"), F.size("_rows").cast("long").alias("rows"),
                        F.size(F.filter(stalled, lambda x: x)).cast("long").alias("stalls"), "odd")


def sequence_violations(landed: DataFrame) -> DataFrame:
    """``page, problem, rows`` of a landing whose ``lt`` has to ascend strictly
    over all pages. The pages' summaries alone are compared: each with the last
    ``lt`` of all pages before it, so a repeated page and one that falls back
    behind an earlier one are both found, and so is every ``lt`` that two pages
    share. Nothing is found if and only if the whole landing ascends, its page
    numbers have no gap and every ``lt`` is a number."""
    pages = page_summaries(landed).withColumn("_block", F.floor(F.col("page") / PAGES_PER_BLOCK))
    # running maxima in two steps: within blocks of pages, and over the blocks
    earlier = [Window.unboundedPreceding, -1]
    blocks = pages.groupBy("_block").agg(F.max("last").alias("_l"), F.max("page").alias("_p"))
    over = Window.orderBy("_block").rowsBetween(*earlier)  # one row a block
    blocks = blocks.select("_block", F.max("_l").over(over).alias("_l"), F.max("_p").over(over).alias("_p"))
    before = Window.partitionBy("_block").orderBy("page").rowsBetween(*earlier)
    checked = pages.join(blocks, "_block").select(
        "*", F.greatest(F.max("last").over(before), "_l").alias("_high"), F.greatest(F.max("page").over(before), "_p").alias("_page"))
    problems = F.array(
        F.when(F.col("stalls") > 0, F.struct(F.lit("not ascending in page").alias("problem"), F.col("stalls").alias("rows"))),
        F.when(F.col("first") <= F.col("_high"), F.struct(F.lit("cursor did not advance").alias("problem"), F.col("rows"))),
        F.when(F.col("page") > F.col("_page") + 1, F.struct(F.lit("pages missing before").alias("problem"), (F.col("page") - F.col("_page") - 1).cast("long").alias("rows"))),
        F.when(F.col("odd") > 0, F.struct(F.lit("lt is not a number").alias("problem"), F.col("odd").alias("rows"))))
    return checked.select("page", F.explode(F.filter(problems, lambda p: p.isNotNull())).alias("p")).select("page", "p.problem", "p.rows")


# ---------------------------------------------------------------------------
# A keyed upsert
# ---------------------------------------------------------------------------
def write_bucketed(orders: DataFrame, name: str, buckets: int = BUCKETS) -> DataFrame:
    """A silver table in buckets by ``lt``, under the shared folder; returns it.
    Rows without ``lt`` cannot be told apart and are refused."""
    spark = orders.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    keyed = orders.withColumn("lt", F.when(F.col("lt").isNull(), F.raise_error(F.lit("order without lt"))).otherwise(F.col("lt")))
    (keyed.repartition(buckets, "lt").write.bucketBy(buckets, "lt").sortBy("lt")
     .option("path", f"{ensure_checkpoint_dir(spark).rstrip('/')}/{table}").saveAsTable(table))
    return spark.table(table)


def upserted(held: DataFrame, landed: DataFrame, newest: Sequence[str] = ("landing",)) -> DataFrame:
    """The held orders with those of a landing put in, by ``lt``: of several
    copies in the landing the one greatest by ``newest`` counts, and it replaces
    the held one. ``held`` has one row an ``lt``; if it is bucketed by ``lt`` it
    is joined where it is. Copies are reduced before the shuffle, so a page that
    landed a thousand times costs one row a task."""
    columns = held.columns
    if landed.where(F.col("lt").isNull()).limit(1).count():
        raise PublishError("landed orders without lt; refusing to merge them")
    row = F.struct(*[F.col(c) for c in columns if c != "lt"])
    latest = landed.groupBy("lt").agg(F.max(F.struct(*newest, row.alias("_row"))).alias("_new")).select("lt", F.col("_new._row").alias("_row"))
    both = held.join(latest.hint("shuffle_merge"), "lt", "full_outer")
    return both.select(*[F.col("lt") if c == "lt" else F.when(F.col("_row").isNotNull(), F.col(f"_row.{c}")).otherwise(F.col(c)).alias(c) for c in columns])


# ---------------------------------------------------------------------------
# P5: cubes by signed differences
# ---------------------------------------------------------------------------
def _content(columns: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in columns])


def order_changes(held: DataFrame, pulled: DataFrame) -> DataFrame:
    """The rows that a re-pull of a window changes, with ``sign``: -1 for a held
    order that changed or is gone, +1 for what takes its place or is new. Both
    frames hold the window alone, one row an ``lt``; equal orders cancel out in
    one grouped aggregate by whole rows (by their digest, so that columns which
    are not read afterwards stay where they are)."""
    columns = [c for c in held.columns if c in pulled.columns]
    both = held.select(*columns, F.lit(-1).alias("sign")).unionByName(pulled.select(*columns, F.lit(1).alias("sign")))
    digest = row_digest(both.select(*columns))
    sign = F.sum("sign").alias("sign")
    if digest is None:
        net = both.groupBy(*columns).agg(sign)
    else:
        net = both.withColumn("_digest", digest).groupBy("_digest").agg(*[F.first(c).alias(c) for c in columns], sign)
    return net.where("sign <> 0").select(*columns, "sign")


def maintained_cube(cube: DataFrame, changes: DataFrame, after: DataFrame, table: str) -> DataFrame:
    """One of the six cubes after ``changes``, from the cube before them. The five
    additive metrics get the signed sums of the changed rows; a group that no
    order is left in goes. Wallets do not add up: those of the touched days are
    counted over ``after``, which holds the orders after the changes and is read
    for these days only. Days that nothing touches keep their rows as they are."""
    dims = ["day", *schemas.CUBE_DIMENSIONS[table]]
    metrics = schemas.cube_metrics(table)
    additive = [m for m in metrics if m in schemas.ADDITIVE_METRICS]
    source = dict(zip(schemas.METRICS, ("finalized_usd", "filled_usd", "protocol_fee_usd", "integrator_fee_usd")))
    days = changes.select("day").distinct()

    def value(metric: str) -> Column:
        amount = F.coalesce(F.col(source[metric]), F.lit(0)) if metric in source else F.lit(1).cast("long")
        return F.sum(amount * F.col("sign")).alias(metric)

    delta = changes.groupBy(*dims).agg(*[value(m) for m in additive])
    old = cube.join(F.broadcast(days), "day", "left_semi").select(*dims, *additive)  # days of the window
    summed = old.unionByName(delta).groupBy(*dims).agg(*[F.sum(m).alias(m) for m in additive]).where("finalized_orders_count > 0")
    if "unique_trader_wallets_count" in metrics:
        counted = after.join(F.broadcast(days), "day", "left_semi").groupBy(*dims).agg(F.count_distinct("src_trader_address").alias("unique_trader_wallets_count"))
        same = [F.col(f"s.{d}").eqNullSafe(F.col(f"w.{d}")) for d in dims]
        on = same[0]
        for s in same[1:]:
            on = on & s
        summed = summed.alias("s").join(counted.alias("w"), on, "left").select("s.*", F.coalesce("w.unique_trader_wallets_count", F.lit(0)).alias("unique_trader_wallets_count"))
    kinds = {f.name: f.dataType for f in cube.schema.fields}
    rest = cube.join(F.broadcast(days), "day", "left_anti")
    return rest.select(*dims, *metrics).unionByName(summed.select(*dims, *[F.col(m).cast(kinds[m]).alias(m) for m in metrics]))


def refresh_window(spark: SparkSession, held: DataFrame, pulled: DataFrame, built: dict[str, DataFrame], first_day: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Silver and cubes after the days from ``first_day`` on were pulled again as
    a whole: (silver, cubes by name). Older days are not read for the cubes."""
    recent = F.col("day") >= F.lit(first_day).cast("date")
    # kept once for all that is made of them, with the columns of cubes alone
    columns = list(dict.fromkeys(["day", *(d for name in built for d in schemas.CUBE_DIMENSIONS[name]), *cubes.DOLLARS.values(), "sign"]))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/changes-{uuid.uuid4().hex}"
    order_changes(held.where(recent), pulled).select(*columns).write.parquet(path)
    changes = spark.read.parquet(path)
    # a pulled order of an older day has no held one here that it could cancel out with
    if changes.where(~recent).limit(1).count():
        raise PublishError(f"pulled orders before {first_day}; refusing to merge them")
    window = pulled.select(*held.columns)  # all that is left of the days that changed
    after = held.where(~recent).unionByName(window)
    return after, {name: maintained_cube(cube, changes, window, name) for name, cube in built.items()}


def named_cubes(orders: DataFrame) -> dict[str, DataFrame]:
    return {name: cubes.named_cube(orders, name) for name in schemas.CUBE_DIMENSIONS}
