"""Ingest: landed JSON pages -> flat, typed orders and cube rows.

Pages land as files of ``{"result": {"orders": [...], "has_next_page": b}}``
(or ``"rows"`` for cube pulls). A well-formed ``result`` without its list is an
empty page; anything else that is not such a page (cut short, an error body,
not JSON) fails the read and names the file, and ``page_problems`` lists all of
them. Flattening is a single ``select`` of native column expressions.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.flatten import asset_columns, chain_address_columns, seconds, units
from ..functions.stats import shifted

NANOS = 1_000_000_000
WINDOW_DAYS = 30  # the service caps a filtered range at 31 days


# ---------------------------------------------------------------------------
# Page explode
# ---------------------------------------------------------------------------
#: Pages of one file follow one another as lines; no object ends a line before another begins inside a page.
PAGE_BREAK = r"(?<=\})\s*\n\s*(?=\{\s*\")"


def _positions(values: Column) -> Column:
    """Their positions and values; a null one for none, to be left out after. Spark
    leaves empty arrays out before it explodes them, so it would make each twice."""
    return F.posexplode_outer(values)


def page_texts(files: DataFrame, column: str = "value", name: Column | None = None) -> DataFrame:
    """``_page, _text``: the pages of landed files, from their whole texts."""
    text = F.trim(F.col(column))  # most hold one page, in one line
    texts = F.when(F.contains(text, F.lit("\n")), F.split(text, PAGE_BREAK)).when(text.isNotNull(), F.array(text))
    pages = files.select((name if name is not None else F.monotonically_increasing_id().cast("string")).alias("_file"), _positions(texts))
    return pages.where("pos is not null").select(
        F.when(F.col("pos") > 0, F.concat("_file", F.lit("#"), F.col("pos").cast("string"))).otherwise(F.col("_file")).alias("_page"),
        F.col("col").alias("_text"))


def landed_pages(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """The pages of landed files. A file of no bytes is a page too, a bad one;
    scans leave such files out, so they are taken from the listing."""
    files = spark.read.format("binaryFile").load(path).select("path", F.decode("content", "UTF-8").alias("value"))
    empty = [(name, "") for p in ([path] if isinstance(path, str) else path) for name in _empty_files(spark, p)]
    if empty:
        files = files.where(F.length("value") > 0).unionByName(spark.createDataFrame(empty, "path string, value string"))
    return page_texts(files, name=F.col("path"))


def _empty_files(spark: SparkSession, path: str) -> list[str]:
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    for top in fs.globStatus(root) or []:
        for f in fs.listStatus(top.getPath()) if top.isDirectory() else [top]:
            if f.isFile() and f.getLen() == 0 and f.getPath().getName()[0] not in "._":
                found.append(f.getPath().toString())
    return found


def _parsed(pages: DataFrame, schema: T.StructType) -> DataFrame:
    kind = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    return pages.withColumn("_p", F.from_json("_text", kind, {"columnNameOfCorruptRecord": "_bad"}))


def _problem() -> Column:
    return F.when(F.col("_p").isNull() | F.col("_p._bad").isNotNull(), F.lit("not a JSON page")).when(
        F.col("_p.result").isNull(), F.lit("no result"))


def page_problems(pages: DataFrame, schema: T.StructType = schemas.ORDER_PAGE) -> DataFrame:
    """``_page, problem`` of every page that may not be read as one."""
    return _parsed(pages, schema).select("_page", _problem().alias("problem")).where("problem is not null")


def _results(pages: DataFrame, schema: T.StructType) -> DataFrame:
    """``_page, result`` of pages; a bad one fails the job and is named."""
    said = F.concat(F.lit("bad page "), F.col("_page"), F.lit(": "), _problem())
    result = F.when(_problem().isNotNull(), F.raise_error(said).cast(schema["result"].dataType)).otherwise(F.col("_p.result"))
    return _parsed(pages, schema).select("_page", result.alias("result"))


def explode_order_pages(pages: DataFrame) -> DataFrame:
    """Raw orders with their landing position: ``_page`` and ``_pos`` within it."""
    return _results(pages, schemas.ORDER_PAGE).select("_page", _positions(F.col("result.orders")).alias("_pos", "_o")).where("_pos is not null").select("_page", "_pos", "_o.*")


def explode_cube_pages(pages: DataFrame) -> DataFrame:
    return _results(pages, schemas.CUBE_PAGE).select(_positions(F.col("result.rows")).alias("_pos", "r")).where("_pos is not null").select("r.*")


def read_order_pages(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return explode_order_pages(landed_pages(spark, path))


def read_cube_pages(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return explode_cube_pages(landed_pages(spark, path))


def parse_order_pages(text: DataFrame, column: str = "value") -> DataFrame:
    """I1 over pages that arrive as JSON text in a column (a text or
    streaming source) rather than as files."""
    return explode_order_pages(page_texts(text, column))


def parse_cube_pages(text: DataFrame, column: str = "value") -> DataFrame:
    """Cube pages that arrive as JSON text in a column."""
    return explode_cube_pages(page_texts(text, column))


# ---------------------------------------------------------------------------
# Order flatten and latency
# ---------------------------------------------------------------------------
#: Each latency is the time from one clock to a later one.
LATENCIES = {
    "t_quote": ("quote_request_time", "quote_time"),
    "t_decide": ("quote_time", "order_create_time"),
    "t_settle": ("order_create_time", "order_finalize_time"),
    "t_total": ("quote_request_time", "order_finalize_time"),
}


def flatten_orders(raw: DataFrame) -> DataFrame:
    """Raw orders -> the 38 published order columns (all but ``run_ts``).

    A chain side is the chain of the asset on that side; units stay text with
    ``""`` as NULL; absent fee pips are 0; a latency is NULL when either of its
    clocks is. The schema decides the order of the columns."""
    made: dict[str, Column] = {c: F.col(c) for c in ("status", "quote_id", "resolver_id")}
    made["lt"] = F.col("lt").cast("string")
    for side, end in (("input", "src"), ("output", "dst")):
        chain, kind, address = asset_columns(F.col(f"{side}_asset"), f"{side}_asset")
        made |= {f"{side}_asset_chain": chain, f"{side}_asset_kind": kind, f"{side}_asset_address": address, f"{end}_chain_id": chain}
    for field in schemas.ADDRESS_FIELDS:
        stem = field.removesuffix("_address")
        made[f"{stem}_chain"], made[field] = chain_address_columns(F.col(field), stem)
    made |= {f: units(F.col(f)) for f in schemas.UNIT_FIELDS}
    made |= {f: F.coalesce(seconds(F.col(f)), F.lit(0.0)) for f in ("integrator_fee_pips", "protocol_fee_pips")}
    made |= {f: seconds(F.col(f)) for f in schemas.CLOCK_FIELDS}
    made |= {name: made[until] - made[since] for name, (since, until) in LATENCIES.items()}
    return raw.select(*[made[f.name].alias(f.name) for f in schemas.ORDERS.fields if f.name != "run_ts"])


def with_silver_keys(flat: DataFrame) -> DataFrame:
    """``day`` (UTC creation date, the partition key) and ``lt_num``."""
    return flat.withColumn("day", F.to_date(F.timestamp_seconds(F.col("order_create_time")))).withColumn(
        "lt_num", F.col("lt").try_cast("bigint")
    )


def price_silver(flat: DataFrame, evm_tokens: DataFrame, jettons: DataFrame,
                 stable: Sequence[str]) -> DataFrame:
    """Exact USD columns of the silver table from raw units of dollar
    stablecoins: finalized (quoted input), filled (actual input, settled
    only) and both fees (collected in the output asset).

    No digit is cut: amounts keep 18 decimals. One that cannot be priced (no
    stablecoin, no number, beyond the column's range) is NULL, which is not the
    0 of an order that moved nothing; ``quality.pricing_coverage`` counts them."""
    from . import pricing

    sides = flat
    for side, places in (("input", "_in_dec"), ("output", "_out_dec")):
        sides = pricing.resolve_tokens(sides, f"{side}_asset_chain", f"{side}_asset_address", evm_tokens, jettons)
        sides = sides.withColumn(places, F.when(pricing.symbol().isin(*stable), pricing.decimals())).drop(
            "evm_symbol", "evm_decimals", "ton_symbol", "ton_decimals")

    def usd(units_col: str, places: str) -> Column:
        return shifted(F.col(units_col), F.col(places), schemas.EXACT_USD)

    def when_filled(value: Column) -> Column:
        return F.when(F.col("status") == F.lit(schemas.FILLED), value).otherwise(F.lit(0).cast(schemas.EXACT_USD))

    return sides.withColumns({
        "finalized_usd": usd("quote_input_units", "_in_dec"),
        "filled_usd": when_filled(usd("actual_input_units", "_in_dec")),
        "protocol_fee_usd": when_filled(usd("actual_protocol_fee_units", "_out_dec")),
        "integrator_fee_usd": when_filled(usd("actual_integrator_fee_units", "_out_dec")),
    }).drop("_in_dec", "_out_dec")


# ---------------------------------------------------------------------------
# Cube rows, projection, run stamp
# ---------------------------------------------------------------------------
def normalize_cube_rows(raw: DataFrame) -> DataFrame:
    """Flatten nested dimensions; metrics from decimal text to DOUBLE, with
    absent or empty metrics as 0.0. Emits the superset of all cube columns."""
    addr_cols = []
    for field in schemas.ADDRESS_FIELDS:
        addr_cols += chain_address_columns(F.col(field), field.removesuffix("_address"))
    return raw.select(
        F.col("time_period").alias("day_text"),
        "src_chain_id", "dst_chain_id", "resolver_id", "status",
        *asset_columns(F.col("input_asset"), "input_asset"),
        *asset_columns(F.col("output_asset"), "output_asset"),
        *addr_cols,
        *[F.coalesce(seconds(F.col(m)), F.lit(0.0)).alias(m) for m in schemas.METRICS],
    )


def parse_day(text: Column) -> Column:
    """API day text ``YYYY-MM-DDTHH:MM:SSZ`` -> DATE; NULL if unparseable."""
    return F.to_date(F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ssX")))


def project(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The table as its schema has it: other columns go, and a column that is
    not there is NULL of its type."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name).cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def stamp_run(df: DataFrame, run_ts: dt.datetime | str) -> DataFrame:
    """One ``run_ts`` on every row of every table of a run (captured once on
    the driver, before the first read)."""
    return df.withColumn("run_ts", F.lit(str(run_ts)).cast("timestamp"))


# ---------------------------------------------------------------------------
# I9 - I13
# ---------------------------------------------------------------------------
def lt_from_seconds(ts: int) -> int:
    """``lt`` is nanoseconds on the finalization clock."""
    return ts * NANOS


def seek_lt(orders: DataFrame, from_ts: int) -> DataFrame:
    """Orders finalized at or after ``from_ts`` (pushed to the scan as a
    range predicate on the numeric key)."""
    return orders.where(F.col("lt_num") >= F.lit(lt_from_seconds(from_ts)))


def cursor_violations(landed: DataFrame) -> DataFrame:
    """``lt`` must be unique and strictly ascending across a landing.

    Within a page the check is a window over at most one page of rows; across
    pages it compares each page's first ``lt`` with the last ``lt`` of the page
    numbered one lower (page files end in a sequence number). Returns the offending rows with a
    ``problem`` column (empty when the landing is sound)."""
    lt = F.col("lt").try_cast("decimal(38,0)")
    # a file may hold several pages, named file#1, file#2, ... after the first
    parts = F.regexp_extract("_page", r"#(\d+)$", 1).try_cast("int")
    rows = landed.select("_page", "_pos", lt.alias("_lt"), F.regexp_replace("_page", r"#\d+$", "").alias("_file"),
                         F.struct(F.coalesce(parts, F.lit(0)).alias("n"), F.col("_pos")).alias("_at"))
    in_page = (
        rows.withColumn("_prev", F.lag("_lt").over(Window.partitionBy("_file").orderBy("_at")))
        .where(F.col("_prev").isNotNull() & (F.col("_lt") <= F.col("_prev")))
        .select("_page", "_pos", F.col("_lt").cast("string").alias("lt"), F.lit("not ascending in page").alias("problem"))
    )
    name = F.substring_index("_file", "/", -1)
    pages = rows.groupBy("_file").agg(
        F.min_by("_lt", "_at").alias("_first"), F.max_by("_lt", "_at").alias("_last"), F.min("_pos").alias("_p0")
    ).withColumn("_seq", F.regexp_extract(name, r"(\d+)\D*$", 1).try_cast("bigint")).withColumnRenamed("_file", "_page")
    # Page n is compared with page n - 1 by an equi-join on the sequence
    # number in the file name: no window over all pages of a landing.
    prev = pages.select((F.col("_seq") + 1).alias("_seq"), F.col("_last").alias("_prev_last"))
    start = pages.agg(F.min("_seq").alias("_start"))
    checked = pages.join(prev, "_seq", "left").join(F.broadcast(start))  # one row
    said = (
        F.when(F.col("_seq").isNull(), F.lit("page has no number"))
        .when(F.col("_prev_last").isNull() & (F.col("_seq") > F.col("_start")), F.lit("page before is missing"))
        .when(F.col("_first") <= F.col("_prev_last"), F.lit("cursor did not advance"))
    )
    across = checked.select(
        "_page", F.col("_p0").alias("_pos"), F.col("_first").cast("string").alias("lt"), said.alias("problem")).where("problem is not null")
    dupes = (
        rows.groupBy("_lt").agg(F.count(F.lit(1)).alias("_n"), F.min("_page").alias("_page"), F.min("_pos").alias("_pos"))
        .where(F.col("_n") > 1)
        .select("_page", "_pos", F.col("_lt").cast("string").alias("lt"), F.lit("duplicate lt").alias("problem"))
    )
    return in_page.unionByName(across).unionByName(dupes)


def created_between(orders: DataFrame, from_ts: float, to_ts: float) -> DataFrame:
    """``[from, to)`` on the creation clock. ``lt`` orders by
    finalization, so it must not be used to prune a creation range."""
    c = F.col("order_create_time")
    return orders.where((c >= F.lit(float(from_ts))) & (c < F.lit(float(to_ts))))


def backfill_windows(spark: SparkSession, start_ts: int, end_ts: int,
                     window_days: int = WINDOW_DAYS) -> DataFrame:
    """``window, from_ts, to_ts`` tiling ``[start, end)`` into contiguous
    windows of at most ``window_days``; none when start >= end."""
    step = window_days * 86400
    n = max(0, -(-(end_ts - start_ts) // step))
    base = spark.range(n).select(F.col("id").alias("window"))
    return base.select(
        "window",
        (F.lit(start_ts) + F.col("window") * step).alias("from_ts"),
        F.least(F.lit(start_ts) + (F.col("window") + 1) * step, F.lit(end_ts)).alias("to_ts"),
    )


def assign_windows(orders: DataFrame, start_ts: int, window_days: int = WINDOW_DAYS) -> DataFrame:
    """Window index of each order's creation time: arithmetic bucketing, an
    equi-key instead of a range join."""
    step = float(window_days * 86400)
    return orders.withColumn(
        "window", F.floor((F.col("order_create_time") - F.lit(float(start_ts))) / F.lit(step)).cast("bigint")
    )


def window_coverage(spark: SparkSession, orders: DataFrame, start_ts: int, end_ts: int,
                    window_days: int = WINDOW_DAYS) -> DataFrame:
    """Orders per backfill window, zero for empty windows."""
    windows = backfill_windows(spark, start_ts, end_ts, window_days)
    counts = (
        assign_windows(created_between(orders, start_ts, end_ts), start_ts, window_days)
        .groupBy("window").agg(F.count(F.lit(1)).alias("orders"))
    )
    return windows.join(counts, "window", "left").select(
        "window", "from_ts", "to_ts", F.coalesce("orders", F.lit(0)).cast("bigint").alias("orders")
    )


def dedupe(orders: DataFrame, key: Sequence[str] | None = ("lt",)) -> DataFrame:
    """Drop re-landed copies (a retried chunk repeats rows exactly).
    ``key=None`` compares whole rows, by the SHA-256 of their contents: only
    columns that are read afterwards are shuffled beside it. Rows that hold
    nested values or collated text are compared as they are."""
    if key:
        return orders.dropDuplicates(list(key))
    digest = row_digest(orders)
    if digest is None:
        return orders.dropDuplicates()
    return orders.withColumn("_digest", digest).dropDuplicates(["_digest"]).drop("_digest")


def row_digest(rows: DataFrame) -> Column | None:
    """SHA-256 of a row's values, each led by its length and NULL by a sign of
    its own, so that two rows share the digested text only if they are equal
    as ``GROUP BY`` has it; None if a column's type has no such text."""
    texts = []
    for f in rows.schema.fields:
        value = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            value = F.when(value == 0, F.lit(0).cast(f.dataType)).otherwise(value)  # -0.0 equals 0.0
        elif isinstance(f.dataType, T.TimestampType):
            value = F.unix_micros(value)  # its text would depend on the zone
        elif isinstance(f.dataType, T.BinaryType):
            value = F.hex(value)
        elif not (isinstance(f.dataType, (T.IntegralType, T.DecimalType, T.BooleanType, T.DateType, T.TimestampNTZType))
                  or f.dataType == T.StringType()):
            return None
        text = value.cast("string")
        texts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*texts).cast("binary"), 256)) if texts else None


def landed_cube(normalized: DataFrame, table: str) -> DataFrame:
    """Service cube rows (``normalize_cube_rows`` output) projected onto one
    published cube: ``day`` parsed from the API text, the cube's dimensions
    and metrics, nothing else. Unparseable days are left NULL for the
    non-null gate to refuse (see ``quality.unparseable_days``)."""
    withday = normalized.withColumn("day", parse_day(F.col("day_text")))
    fields = [f for f in schemas.cube_schema(table).fields if f.name != "run_ts"]
    return project(withday, T.StructType(fields))
