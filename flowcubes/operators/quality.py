"""Quality gates (V1-V11): checked before anything is written.

Every check is an aggregate over the whole table that returns a small frame
of findings; ``validate`` turns findings into one ``PublishError``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas

MAX_DAY_GAP = 2


class PublishError(RuntimeError):
    """A run that must not be published."""


def health_aggregates(name: str, df: DataFrame) -> list[Column]:
    """V1 + V2 as aggregate expressions: ``rows`` and ``n_<column>`` (NULL
    count) per required column. They run as one aggregate over the table,
    or ride along a write as an ``observe`` so no second scan is needed."""
    required = schemas.required_columns(name)
    absent = [c for c in required if c not in df.columns]
    if absent:
        raise PublishError(f"{name} lacks required column(s) {absent}; refusing to publish")
    return [F.count(F.lit(1)).alias("rows")] + [
        F.count_if(F.col(c).isNull()).alias(f"n_{c}") for c in required
    ]


def health_rows(name: str, values: Mapping[str, int]) -> list[dict]:
    """The findings rows of one table from its health aggregate values."""
    cols = [k[2:] for k in values if k.startswith("n_")]
    if not cols:
        return [{"table": name, "rows": values["rows"], "column": None, "null_rows": 0}]
    return [{"table": name, "rows": values["rows"], "column": c, "null_rows": values[f"n_{c}"]} for c in cols]


def table_health(tables: Mapping[str, DataFrame]) -> DataFrame:
    """V1 + V2 in one pass per table: ``table, rows, column, null_rows``,
    one row per required column (or one row with NULL column when the table
    has none). Unknown tables are skipped (V5)."""
    frames = []
    for name, df in tables.items():
        if name not in schemas.TABLES:
            continue
        required = schemas.required_columns(name)
        one = df.agg(*health_aggregates(name, df))
        if required:
            pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n_{c}").alias("null_rows"))
                                        for c in required]))
            frames.append(one.select(F.lit(name).alias("table"), "rows", pairs.alias("p"))
                          .select("table", "rows", "p.column", "p.null_rows"))
        else:
            frames.append(one.select(F.lit(name).alias("table"), "rows",
                                     F.lit(None).cast("string").alias("column"),
                                     F.lit(0).cast("bigint").alias("null_rows")))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def day_gaps(cube: DataFrame, max_gap: int = MAX_DAY_GAP) -> DataFrame:
    """V3: consecutive days more than ``max_gap`` apart (one missing day
    passes). The window runs over distinct days, a calendar-bounded set."""
    days = cube.select("day").where(F.col("day").isNotNull()).distinct()
    w = Window.orderBy("day")
    return (
        days.withColumn("prev_day", F.lag("day").over(w))
        .withColumn("gap", F.datediff("day", "prev_day"))
        .where(F.col("gap") > max_gap)
        .select("prev_day", "day", "gap")
    )


def null_rows(name: str, df: DataFrame, keys: Sequence[str] = ("lt", "day")) -> DataFrame:
    """V1 with row identity: ``table, column, row`` for each NULL in a required
    column, where ``row`` shows the key columns that the table has."""
    shown = F.concat_ws(", ", *[F.concat(F.lit(f"{k}="), F.coalesce(F.col(k).cast("string"), F.lit("NULL"))) for k in keys if k in df.columns])
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in schemas.required_columns(name)]))
    return df.select(F.lit(name).alias("table"), F.explode(missing).alias("column"), shown.alias("row"))


def pricing_coverage(orders: DataFrame) -> DataFrame:
    """Orders, and those that carry a dollar figure, by day: an amount that
    cannot be priced is NULL, and volumes leave it out."""
    return orders.groupBy("day").agg(
        F.count(F.lit(1)).alias("orders"), F.count("finalized_usd").alias("priced_orders"),
        F.count_if(F.col("status") == F.lit(schemas.FILLED)).alias("filled_orders"),
        F.count_if((F.col("status") == F.lit(schemas.FILLED)) & F.col("filled_usd").isNotNull()).alias("priced_filled_orders"))


def unparseable_days(df: DataFrame, column: str = "day_text",
                     fmt: str = "yyyy-MM-dd'T'HH:mm:ssX") -> DataFrame:
    """V4: values of a day-text column that do not parse."""
    parsed = F.try_to_timestamp(F.col(column), F.lit(fmt))
    return df.where(parsed.isNull()).select(F.col(column).alias("value"))


def cube_order_mismatch(chainpair: DataFrame, orders: DataFrame) -> DataFrame:
    """V8: order counts of the chain-pair cube against counts from orders, by
    (day, src, dst, status); rows where they differ."""
    keys = ["day", "src_chain_id", "dst_chain_id", "status"]
    from_orders = orders.groupBy(*keys).agg(F.count(F.lit(1)).alias("order_rows"))
    from_cube = chainpair.groupBy(*keys).agg(F.sum("finalized_orders_count").cast("bigint").alias("cube_count"))
    j = from_cube.join(from_orders, keys, "full")
    return j.where(~F.coalesce(F.col("cube_count") == F.col("order_rows"), F.lit(False))).select(
        *keys, "cube_count", "order_rows"
    )


def unknown_statuses(orders: DataFrame, statuses: Sequence[str] = schemas.KNOWN_STATUSES) -> DataFrame:
    """V9: statuses outside the known domain, with counts."""
    known = orders.sparkSession.createDataFrame([(s,) for s in statuses], "status string")
    return (
        orders.select("status").join(F.broadcast(known), "status", "left_anti")
        .groupBy("status").agg(F.count(F.lit(1)).alias("orders"))
    )


def failed_with_units(orders: DataFrame) -> DataFrame:
    """Failed orders that nonetheless moved units."""
    moved = F.lit(False)
    for f in ("actual_input_units", "actual_output_units"):
        moved = moved | F.coalesce(F.col(f).rlike("^[0-9]*[1-9][0-9]*$"), F.lit(False))
    return orders.where((F.col("status") == F.lit(schemas.FAILED)) & moved)


def monthly_status_counts(orders: DataFrame) -> DataFrame:
    """Orders per creation month and status, one column per status."""
    return (
        orders.groupBy(F.trunc("day", "month").alias("month"))
        .pivot("status", list(schemas.KNOWN_STATUSES))
        .agg(F.count(F.lit(1)))
        .select(
            "month",
            F.coalesce(F.col(schemas.FILLED), F.lit(0)).cast("bigint").alias("filled"),
            F.coalesce(F.col(schemas.FAILED), F.lit(0)).cast("bigint").alias("failed"),
        )
    )


def check_health(health, frame_of: Callable[[str], DataFrame] | None = None) -> None:
    """Raise on an empty known table (V2) or a NULL in a non-nullable
    column (V1); ``health`` holds ``table_health`` / ``health_rows`` rows.
    With ``frame_of`` (table name -> rows) the message shows such a row."""
    for r in health:
        if r["rows"] == 0:
            raise PublishError(f"{r['table']} came back empty (0 rows); refusing to publish")
    bad = [r for r in health if r["null_rows"]]
    if bad:
        r = bad[0]
        where = ""
        if frame_of is not None:
            seen = null_rows(r["table"], frame_of(r["table"])).where(F.col("column") == r["column"]).limit(1).collect()
            where = f" (one is {seen[0]['row']})" if seen else ""
        raise PublishError(
            f"{r['table']} has {r['null_rows']} row(s) with null in non-nullable column "
            f"{r['column']!r}{where}; refusing to publish"
        )


def check_day_texts(tables: Mapping[str, DataFrame], column: str = "day_text") -> None:
    """V4 for every table that still carries its landed day text."""
    for name, df in tables.items():
        if column in df.columns:
            odd = unparseable_days(df, column).limit(1).collect()
            if odd:
                raise PublishError(f"{name}: {column} {odd[0]['value']!r} is no day; refusing to publish")


def check_day_gaps(total: DataFrame, max_gap: int = MAX_DAY_GAP) -> None:
    """V3 on the total cube (one row per day)."""
    gap = day_gaps(total, max_gap).limit(1).collect()
    if gap:
        g = gap[0]
        raise PublishError(
            f"daily_total jumps {g['gap']} days from {g['prev_day']} to {g['day']}, "
            f"more than {max_gap}; refusing to publish"
        )


def validate(tables: Mapping[str, DataFrame], max_gap: int = MAX_DAY_GAP) -> None:
    """Raise ``PublishError`` on any finding: nulls in non-nullable columns,
    an empty known table, day text that is no day, or a day gap in the total cube. Only the small
    findings frames reach the driver."""
    check_day_texts(tables)
    check_health(table_health(tables).collect(), tables.__getitem__)
    total = tables.get("daily_total")
    if total is not None:
        check_day_gaps(total, max_gap)
