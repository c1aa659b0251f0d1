"""Registry entries for the operator layer (cubes, tokens, quality, ingest,
retention), each over the whole stand-in tables."""

from __future__ import annotations

import calendar
import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.address import evm_key, ton_raw, truncate_label
from ..functions.stats import whole_units
from ..operators import cubes, ingest, maintain, pricing, publish, quality, sketches
from ..session import ensure_checkpoint_dir
from ..sources import binding
from . import growth
from .common import cross_chain, settled, top_k_with_other
from .registry import RUN_TS, Inputs, Query, _q

# Parameters of the registered operator checks.
SEEK_FROM = "1999-01-01"
CREATED_FROM, CREATED_TO = "1996-01-01", "1997-01-01"
BACKFILL_FROM, BACKFILL_TO = "1995-01-01", "2001-12-31"
RETENTION_AS_OF, RETENTION_DAYS = "2001-08-01", 90
TOP_RESOLVERS = 5
# The re-pulled window of late finalization, and when the first pull was made.
WINDOW_FROM, FIRST_PULL = "2000-10-01", "2001-01-15"
# Sketch cubes: percentiles of a month, the size of the weekly trader sketches
# (small, so that they are estimates at every scale), weeks of retention.
SKETCH_PS = {"p50": 0.5, "p90": 0.9, "p99": 0.99}
TRADER_LG_K, SKETCH_WEEKS = 9, 12
# Stamps of the two published runs; days that a small table may skip.
RUNS, MONTH_GAP = ("2024-01-30 06:00:00", RUN_TS), 31
# Parameters under which the quality checks have something to find.
LACKING = {"lt": 97, "run_ts": 101}
DAY_GAP, ODD_DAYS_CHAIN = 0, "ton"


def epoch(day: str) -> int:
    return calendar.timegm(dt.date.fromisoformat(day).timetuple())


def published_metrics(df: DataFrame, table: str) -> list[Column]:
    out = []
    for m in schemas.cube_metrics(table):
        kind = "bigint" if m.endswith("_count") else "double"
        out.append(F.col(m).cast(kind).alias(m))
    return out


def _cube(table: str, grouping: str | None = cubes.DAY):
    def build(i: Inputs) -> DataFrame:
        c = cubes.named_cube(i.orders(), table, grouping)
        keys = {cubes.DAY: [F.col("day")], cubes.HOUR: [F.col("hour").cast("timestamp_ntz").alias("hour")],
                None: []}[grouping]
        return c.select(*keys, *schemas.CUBE_DIMENSIONS[table], *published_metrics(c, table))

    return build


def _hourly_clocked(i: Inputs) -> DataFrame:
    """C8 over orders that are spread over the hours of their day."""
    c = cubes.named_cube(binding.clocked(i.orders()), "daily_chainpair", cubes.HOUR)
    return c.select(F.col("hour").cast("timestamp_ntz").alias("hour"), *schemas.CUBE_DIMENSIONS["daily_chainpair"],
                    *published_metrics(c, "daily_chainpair"))


def _rollup_total(i: Inputs) -> DataFrame:
    r = cubes.rollup(i.cube("daily_chainpair"), ["day"])
    return r.select("day", *[F.col(m).cast("bigint" if m.endswith("_count") else "double").alias(m)
                             for m in schemas.ADDITIVE_METRICS])


def _grouping_sets(i: Inputs) -> DataFrame:
    one = cubes.all_cubes_one_pass(i.orders(), parts=binding.order_tasks(i.spark, i.dir),
                                   busy=cubes.busy_days(binding.day_orders(i.spark, i.dir)))
    return one.select(
        *[c for c in one.columns if c not in schemas.METRICS],
        *published_metrics(one, "daily_total"),
    )


def _stamped_tables(i: Inputs) -> dict[str, DataFrame]:
    orders = i.orders()
    tables = {t: ingest.stamp_run(cubes.named_cube(orders, t), RUN_TS) for t in schemas.CUBE_DIMENSIONS}
    tables[schemas.ORDERS_TABLE] = ingest.stamp_run(orders, RUN_TS)
    return tables


def _latest_revision(i: Inputs) -> DataFrame:
    return pricing.latest_revision(i.jettons())


def _ton_raw(i: Inputs) -> DataFrame:
    o = i.orders().where(F.col("input_asset_chain") == "ton").select(
        F.col("input_asset_address").alias("address")).where(F.col("address").isNotNull()).distinct()
    return o.select("address", ton_raw(F.col("address")).alias("raw_address"))


def _evm_key(i: Inputs) -> DataFrame:
    o = i.orders().where(F.col("input_asset_chain") != "ton").select(
        F.col("input_asset_address").alias("address")).where(F.col("address").isNotNull()).distinct()
    return o.select("address", F.hex(evm_key(F.col("address"))).alias("key_hex"))


def _resolution(i: Inputs) -> DataFrame:
    a = i.orders().select("input_asset_chain", "input_asset_kind", "input_asset_address").distinct()
    r = pricing.resolve_tokens(a, "input_asset_chain", "input_asset_address", i.evm(), i.jettons())
    return r.select("input_asset_chain", "input_asset_kind", "input_asset_address",
                    pricing.symbol().alias("symbol"), pricing.decimals().cast("int").alias("decimals"))


def _exact_usd_by(df: DataFrame, keys: list[str], units: str = "actual_input_units") -> DataFrame:
    """Exact dollar sums: integer units summed per precision, scaled once."""
    per = df.groupBy(*keys, "decimals").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(whole_units(F.col(units))).alias("_u"))
    return per.groupBy(*keys).agg(
        F.sum("_n").cast("bigint").alias("orders"),
        F.sum(F.col("_u").cast("double") / F.pow(F.lit(10.0), F.col("decimals"))).alias("volume_usd"),
    )


def _stable_pricing(i: Inputs) -> DataFrame:
    priced = pricing.price_orders(i.orders().where(settled() & cross_chain()), i.evm(), i.jettons(),
                                  binding.stable_symbols()).where(F.col("usd").isNotNull())
    return _exact_usd_by(priced, ["symbol"])


def _reconciliation(i: Inputs) -> DataFrame:
    priced = pricing.price_orders(i.orders().where(settled() & cross_chain()), i.evm(), i.jettons(),
                                  binding.stable_symbols())
    p = _exact_usd_by(priced.where(F.col("usd").isNotNull()).withColumn("_k", F.lit(1)), ["_k"])
    n = priced.agg(F.count(F.lit(1)).alias("trades"))
    c = i.cube("daily_chainpair").where(cross_chain()).agg(
        F.sum("filled_orders_volume_usd").cast("double").alias("cube_usd"))
    from .common import one_row

    both = one_row(p.select(F.col("orders").alias("priced_trades"), F.col("volume_usd").alias("priced_usd")), n, c)
    return both.select(
        "priced_trades", "trades", "priced_usd", "cube_usd",
        ((F.col("cube_usd") - F.col("priced_usd")) / F.nullif(F.col("cube_usd"), F.lit(0.0))).alias("gap"),
    )


def _top_resolvers(i: Inputs) -> DataFrame:
    per = i.cube("daily_resolver").where(cross_chain()).groupBy("resolver_id").agg(
        F.sum("filled_orders_volume_usd").alias("usd"))
    pooled = top_k_with_other(per, "resolver_id", "usd", TOP_RESOLVERS, "other")
    return pooled.groupBy("resolver_id").agg(F.sum("usd").cast("double").alias("volume_usd"))


def _labels(i: Inputs) -> DataFrame:
    o = i.orders()
    res = o.select(F.col("resolver_id").alias("value")).distinct().select(
        F.lit("resolver").alias("kind"), "value", truncate_label(F.col("value"), 10).alias("label"))
    integ = o.select(F.col("integrator_address").alias("value")).where(F.col("value").isNotNull()).distinct().select(
        F.lit("integrator").alias("kind"), "value", truncate_label(F.col("value"), 6, 4).alias("label"))
    return res.unionByName(integ)


def _health(i: Inputs) -> DataFrame:
    return quality.table_health(_stamped_tables(i))


def _day_gaps(i: Inputs) -> DataFrame:
    return quality.day_gaps(i.cube("daily_total"), DAY_GAP)


def _cube_mismatch(i: Inputs) -> DataFrame:
    """V8 with findings: a cube of the settled orders only against all orders."""
    o = i.orders()
    return quality.cube_order_mismatch(cubes.named_cube(o.where(settled()), "daily_chainpair"), o)


def _unknown_status(i: Inputs) -> DataFrame:
    """V9 with findings: only settled orders belong to the domain."""
    return quality.unknown_statuses(i.orders(), (schemas.FILLED,))


def _failed_units(i: Inputs) -> DataFrame:
    return quality.failed_with_units(i.orders()).agg(F.count(F.lit(1)).alias("orders"))


def _monthly(i: Inputs) -> DataFrame:
    return quality.monthly_status_counts(i.orders())


def _latency(i: Inputs) -> DataFrame:
    return i.orders().select("quote_id", "resolver_id", "t_quote", "t_decide", "t_settle", "t_total")


def _seek(i: Inputs) -> DataFrame:
    return ingest.seek_lt(i.orders(), epoch(SEEK_FROM)).agg(
        F.count(F.lit(1)).alias("orders"), F.min("lt_num").alias("first_lt"))


def _dup_lt(i: Inputs) -> DataFrame:
    return i.orders().groupBy("lt").agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def _created_between(i: Inputs) -> DataFrame:
    return ingest.created_between(i.orders(), epoch(CREATED_FROM), epoch(CREATED_TO)).groupBy("status").agg(
        F.count(F.lit(1)).alias("orders"))


def _coverage(i: Inputs) -> DataFrame:
    return ingest.window_coverage(i.spark, i.orders(), epoch(BACKFILL_FROM), epoch(BACKFILL_TO))


def _dedupe(i: Inputs) -> DataFrame:
    o = i.orders().drop("lt", "lt_num")
    return ingest.dedupe(o, key=None).agg(F.count(F.lit(1)).alias("orders"))


DAY_NANOS = 86_400_000_000_000


def _cursor(i: Inputs) -> DataFrame:
    """Pages of a day's orders, some of which land twice (in place of the next
    one) or not at all; orders of one ``lt`` stall."""
    o = i.orders().select(F.floor(F.col("lt_num") / DAY_NANOS).alias("page"), F.col("lt_num").alias("pos"), "lt")
    at = F.col("page") % 40
    sent = o.where(~at.isin(8, 20)).unionByName(o.where(at == 7).withColumn("page", F.col("page") + 1))
    return maintain.sequence_violations(sent)


def _upsert(i: Inputs) -> DataFrame:
    """A landing with orders that are held, new ones, and copies of both."""
    o = i.orders().groupBy("lt").agg(F.max(F.struct("filled_usd", "status")).alias("r")).select("lt", "r.status", "r.filled_usd")
    key = F.col("lt").cast("bigint")
    held = maintain.write_bucketed(o.where(key % 5 != 0), "silver")
    first = o.where((key % 5 == 0) | (key % 3 == 0)).withColumn("landing", F.lit(1))
    again = first.where(key % 2 == 0).select("lt", F.lit("RELANDED").alias("status"), (F.col("filled_usd") + 1).cast("decimal(18,2)").alias("filled_usd"), F.lit(2).alias("landing"))
    merged = maintain.upserted(held, first.unionByName(first).unionByName(again))
    return merged.groupBy("status").agg(F.count(F.lit(1)).alias("orders"), F.count_distinct("lt").alias("keys"), F.sum("filled_usd").cast("double").alias("filled_usd"))


def _late_finalization(i: Inputs) -> DataFrame:
    """The chain-pair cube after a window was pulled again: orders that finalized
    after the first pull, orders that changed and orders that are gone."""
    o = i.orders()
    recent, key = F.col("day") >= F.lit(WINDOW_FROM).cast("date"), F.col("lt_num")
    changed = recent & (key % 7 == 0)
    zero = F.lit(0).cast("decimal(18,2)")
    held = o.where(~recent | (F.col("order_finalize_time") < epoch(FIRST_PULL))).withColumns({
        "status": F.when(changed, F.lit(schemas.FAILED)).otherwise(F.col("status")),
        "filled_usd": F.when(changed, zero).otherwise(F.col("filled_usd")),
        "src_trader_address": F.when(changed, F.lit("nobody")).otherwise(F.col("src_trader_address"))})
    before = {"daily_chainpair": cubes.daily_chainpair(held)}
    _, after = maintain.refresh_window(i.spark, held, o.where(recent & (key % 11 != 0)), before, WINDOW_FROM)
    cube = after["daily_chainpair"]
    return cube.select("day", *schemas.CUBE_DIMENSIONS["daily_chainpair"], *published_metrics(cube, "daily_chainpair"))


INGESTED_COLUMNS = (
    "lt", "status", "quote_id", "src_chain_id", "dst_chain_id",
    "input_asset_chain", "input_asset_kind", "input_asset_address",
    "output_asset_chain", "output_asset_kind", "output_asset_address",
    *schemas.UNIT_FIELDS, "integrator_fee_pips", "protocol_fee_pips", "resolver_id",
    *[c for f in schemas.ADDRESS_FIELDS for c in (f.removesuffix("_address") + "_chain", f)],
    *schemas.CLOCK_FIELDS, "t_quote", "t_decide", "t_settle", "t_total", "day", "lt_num",
)


INGESTED_CUBE = "daily_input_asset"


def _ingest_pages(i: Inputs) -> DataFrame:
    """I1-I5 end to end: the order view rendered as landed JSON pages, then
    page explode, asset / address flatten, latencies and silver keys."""
    raw = ingest.parse_order_pages(binding.order_pages(i.spark, i.dir))
    return ingest.with_silver_keys(ingest.flatten_orders(raw)).select(*INGESTED_COLUMNS)


def _ingest_cube_pages(i: Inputs) -> DataFrame:
    """I1 + I6 end to end: the input-asset cube rendered as landed cube pages
    (decimal-text metrics, nested asset), exploded, normalized and projected
    back onto the published cube."""
    raw = ingest.parse_cube_pages(binding.cube_pages(i.spark, i.dir, INGESTED_CUBE))
    return ingest.landed_cube(ingest.normalize_cube_rows(raw), INGESTED_CUBE)


def _unparseable_days(i: Inputs) -> DataFrame:
    """V4 over the day text of landed cube pages, where those of one source
    chain are written another way."""
    raw = ingest.parse_cube_pages(binding.cube_pages(i.spark, i.dir, INGESTED_CUBE))
    odd = F.when(F.col("src_chain_id") == F.lit(ODD_DAYS_CHAIN), F.translate("day_text", "-", "/")).otherwise(F.col("day_text"))
    return quality.unparseable_days(ingest.normalize_cube_rows(raw).withColumn("day_text", odd), "day_text")


def _wallet_sketch_rollup(i: Inputs) -> DataFrame:
    """C10 for wallets: a chain-pair cube carrying HLL sketches of trader
    wallets, rolled up to days by merging sketches (an estimate: rows-only)."""
    fine = cubes.wallet_sketch_cube(i.orders(), ["src_chain_id", "dst_chain_id", "status"])
    r = cubes.rollup_sketch(fine, ["day"])
    return r.select("day", *[F.col(m).cast("bigint" if m.endswith("_count") else "double").alias(m)
                             for m in schemas.ADDITIVE_METRICS], "unique_trader_wallets_estimate")


def _monthly_quantiles(i: Inputs) -> DataFrame:
    """C10 for percentiles: a daily chain-pair cube of KLL sketches merged to
    months, and whether each estimate keeps the sketch's rank error."""
    o = i.orders()
    keys = {"month": F.trunc("day", "month"), "src_chain_id": F.col("src_chain_id")}
    cube = sketches.time_sketch_cube(o, ["src_chain_id", "dst_chain_id"])
    estimates = sketches.merged_quantiles(cube, keys, SKETCH_PS)
    errors = sketches.rank_errors(o, estimates, keys, SKETCH_PS)
    return errors.select("month", "src_chain_id", "p", "orders",
                         (F.col("rank_error") <= sketches.kll_rank_bound()).alias("within_bound"))


def _new_returning_sketch(i: Inputs) -> DataFrame:
    """Q4 from weekly theta sketches, held against the exact answer."""
    o = i.orders()
    est = sketches.new_vs_returning_estimate(sketches.trader_sketch_cube(o, TRADER_LG_K), TRADER_LG_K)
    both = growth.new_vs_returning_weekly(o).join(
        est.select("week", *[F.col(c).alias("e_" + c) for c in est.columns if c != "week"]), "week", "full")
    bound = sketches.theta_bound(F.col("cumulative_traders"), TRADER_LG_K)
    within = [F.coalesce(F.abs(F.col("e_" + c) - F.col(c)) <= bound, F.lit(False)).alias(c + "_within")
              for c in ("new_traders", "returning_traders", "cumulative_traders")]
    return both.select("week", "cumulative_traders", *within)


def _cohort_sketch(i: Inputs) -> DataFrame:
    """Q5 from weekly theta sketches, held against the exact answer."""
    o = i.orders()
    est = sketches.cohort_estimate(sketches.trader_sketch_cube(o, TRADER_LG_K), SKETCH_WEEKS, TRADER_LG_K)
    seen = growth.cohort_activity(o)
    weeks = F.floor(F.datediff("active_week", "cohort_week") / F.lit(7)).cast("bigint")
    exact = seen.groupBy("cohort_week", weeks.alias("weeks_after")).agg(F.count(F.lit(1)).alias("traders")).where(
        F.col("weeks_after") <= SKETCH_WEEKS)
    so_far = growth.new_vs_returning_weekly(o).select(F.col("week").alias("_w"), "cumulative_traders")
    both = est.join(exact, ["cohort_week", "weeks_after"], "full").join(
        so_far, F.date_add("cohort_week", (F.col("weeks_after") * 7).cast("int")) == F.col("_w"), "left")
    # The retained err by the error of the cohort and of the intersection.
    bound = F.lit(2) * sketches.theta_bound(F.col("cumulative_traders"), TRADER_LG_K)
    traders = F.coalesce("traders", F.lit(0))
    return both.select("cohort_week", "weeks_after", traders.alias("retained_traders"),
                       F.coalesce(F.abs(F.col("retained_traders") - traders) <= bound, F.lit(False)).alias("within_bound"))


def _wide_units(i: Inputs) -> DataFrame:
    """Exact totals of units of 60 and of 78 digits, as 256-bit tokens have."""
    o = i.orders().select(
        "src_chain_id", "dst_chain_id",
        F.concat(F.lit("1"), F.lpad("lt", 29, "0"), F.lpad("quote_id", 30, "0")).alias("units_60"),
        F.concat(F.lit("9"), F.lpad("quote_id", 38, "7"), F.lpad("lt", 39, "8")).alias("units_78"))
    return pricing.unit_totals(o, ["src_chain_id", "dst_chain_id"], ["units_60", "units_78"])


def _vintages(i: Inputs) -> DataFrame:
    """Two runs are published, an older one is refused, and the manifests are
    read back."""
    o, root = i.orders(), f"{ensure_checkpoint_dir(i.spark).rstrip('/')}/published-{uuid.uuid4().hex}"
    first, second = RUNS
    publish.refresh(i.spark, o.where(F.col("day") < F.lit(WINDOW_FROM).cast("date")), root, first, max_gap=MONTH_GAP)
    publish.refresh(i.spark, o, root, second, max_gap=MONTH_GAP)
    try:
        publish.refresh(i.spark, o, root, first, max_gap=MONTH_GAP)
    except quality.PublishError:
        seen = publish.vintages(i.spark, root)
        fresh = publish.published_freshness(i.spark, root).select("refreshed_at", "distinct_vintages")
        return (seen.join(fresh, seen["run_ts"] == fresh["refreshed_at"], "left")
                .select("table", "rows", F.col("run_ts").cast("timestamp_ntz").alias("run_ts"), "current", "distinct_vintages"))
    raise AssertionError("an older run was published over a newer one")


def _null_rows(i: Inputs) -> DataFrame:
    """V1 with row identity, where some orders lack a required column."""
    o = ingest.stamp_run(i.orders(), RUN_TS).withColumns({c: F.when(F.col("lt_num") % n != 0, F.col(c)) for c, n in LACKING.items()})
    return quality.null_rows(schemas.ORDERS_TABLE, o, ("lt_num", "day"))


def _recent(i: Inputs) -> DataFrame:
    return publish.trim_recent(i.orders(), RETENTION_AS_OF, RETENTION_DAYS).groupBy("day").agg(
        F.count(F.lit(1)).alias("orders"))


def _history_recent(i: Inputs) -> DataFrame:
    history, recent = publish.split_history(i.orders(), RETENTION_AS_OF, RETENTION_DAYS)
    both = cubes.daily_total(history).unionByName(cubes.daily_total(recent))
    return both.select("day", *published_metrics(both, "daily_total"))


def operator_queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for table in schemas.CUBE_DIMENSIONS:
        out[f"cube_{table}"] = _q(_cube(table))
    out.update({
        "cube_alltime_chainpair": _q(_cube("daily_chainpair", None)),
        "cube_hourly_chainpair": _q(_cube("daily_chainpair", cubes.HOUR)),
        "cube_hourly_clocked": _q(_hourly_clocked),
        "cube_rollup_total": _q(_rollup_total),
        "cube_grouping_sets": _q(_grouping_sets),
        "token_latest_revision": _q(_latest_revision),
        "token_ton_raw": _q(_ton_raw),
        "token_evm_key": _q(_evm_key),
        "token_resolution": _q(_resolution),
        "token_stable_pricing": _q(_stable_pricing),
        "token_pricing_reconciliation": _q(_reconciliation),
        "token_top_k": _q(_top_resolvers),
        "token_labels": _q(_labels),
        "quality_table_health": _q(_health),
        "quality_day_gaps": _q(_day_gaps),
        "quality_cube_reconciliation": _q(_cube_mismatch),
        "quality_status_domain": _q(_unknown_status),
        "quality_failed_units": _q(_failed_units),
        "quality_monthly_status": _q(_monthly),
        "order_latency": _q(_latency),
        "order_lt_seek": _q(_seek),
        "order_lt_duplicates": _q(_dup_lt),
        "order_created_between": _q(_created_between),
        "order_backfill_coverage": _q(_coverage),
        "order_dedupe": _q(_dedupe),
        "order_cursor_violations": _q(_cursor),
        "order_upsert_lt": _q(_upsert),
        "cube_late_finalization": _q(_late_finalization),
        "ingest_order_pages": _q(_ingest_pages),
        "ingest_cube_pages": _q(_ingest_cube_pages),
        "quality_unparseable_days": _q(_unparseable_days),
        "cube_rollup_wallet_sketch": _q(_wallet_sketch_rollup),
        "cube_monthly_quantiles": _q(_monthly_quantiles),
        "cube_new_returning_sketch": _q(_new_returning_sketch),
        "cube_cohort_sketch": _q(_cohort_sketch),
        "token_wide_units": _q(_wide_units),
        "publish_vintages": _q(_vintages),
        "quality_null_rows": _q(_null_rows),
        "retention_recent_orders": _q(_recent),
        "retention_history_recent": _q(_history_recent),
    })
    return out
