"""Wallet impact from orders, traces and a month-partitioned trades table."""

import datetime as dt
import re
from decimal import Decimal

import pytest

from flowcubes.functions.prefilter import cut_by_keys
from flowcubes.plans import impact
from flowcubes.schemas import FILLED
from order_helpers import FAILED, make_orders

T0 = 1_700_006_400.0  # 2023-11-15
FACTORY = bytes.fromhex(impact.WALLET_FACTORY)


def wallet(i):
    return i.to_bytes(20, "big")


def order(i, at, units="100000000", **more):
    return dict(order_create_time=T0, order_finalize_time=at, src_chain_id="ton", dst_chain_id="polygon", output_asset_address=impact.TAGGED_TOKEN,
                dst_trader_address="0x" + wallet(i).hex(), actual_output_units=units) | more


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("impact")
    orders = make_orders(spark, [
        order(1, T0 + 10), order(1, T0 + 5, "50000000"), order(2, T0, dst_trader_address=wallet(2).hex().upper()), order(3, T0),
        order(4, T0, status=FAILED), order(5, T0, dst_chain_id="bnb"), order(6, T0, src_chain_id="polygon"), order(7, T0, dst_trader_address="0xnothex"),
        order(8, T0, output_asset_address="0x00")])
    traces = [(FACTORY, wallet(i)) for i in (1, 1, 2, 4, 5, 6, 8, 9)] + [(b"\xff" * 20, wallet(3)), (FACTORY, None)]
    spark.createDataFrame(traces, "`from` binary, address binary").write.parquet(f"{root}/traces")

    def at(seconds):
        return dt.datetime.fromtimestamp(T0 + seconds)

    trades = [(wallet(1), wallet(9), Decimal("7.00"), at(35)), (wallet(9), wallet(1), Decimal("3.00"), at(95)), (wallet(2), None, Decimal("5.00"), at(-86400)),
              (None, wallet(2), Decimal("1.00"), at(50)), (wallet(1), wallet(2), Decimal("900.00"), at(-120 * 86400)), (wallet(1), None, Decimal("800.00"), at(-400 * 86400))]
    spark.createDataFrame(trades, "maker binary, taker binary, amount decimal(18,2), block_time timestamp").selectExpr("*", "trunc(block_time, 'month') as block_month") \
        .write.partitionBy("block_month").parquet(f"{root}/trades")
    return orders, spark.read.parquet(f"{root}/traces"), spark.read.parquet(f"{root}/trades")


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_values_from_the_sources(tables):
    got = impact.wallet_impact(*tables).first().asDict()
    # wallets 1 and 2; trades from September on: of 1 at 35 s and 95 s, of 2 a day before its deposit and 50 s after
    assert got == dict(wallets_funded=2, wallets_that_traded=2, new_traders=1, deposited_usd=250.0, wagered_usd=16.0, multiple=0.1, median_lag_seconds=30.0, within_a_minute_pct=100.0)
    all_months = impact.wallet_impact(*tables, since_month="2020-01-01").first()
    assert all_months.wagered_usd == 16.0 + 900 + 900 + 800 and all_months.new_traders == 0


@pytest.fixture()
def whole_metadata(spark):
    conf = {"spark.sql.maxMetadataStringLength": "10000", "spark.sql.debug.maxToStringFields": "1000", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("since", [None, "2023-09-01"])
def test_both_branches_prune_their_months(tables, whole_metadata, since):
    scans = [line for line in plan_of(impact.wallet_impact(*tables, since_month=since)).splitlines() if "FileScan parquet" in line and "block_month" in line]
    assert len(scans) >= 2
    for scan in scans:
        found = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", scan).group(1)
        assert "block_month" in found and (">= " in found) and (("ubquery" in found) == (since is None))


def test_only_the_months_needed_are_read(tables):
    trades = tables[2]
    sides = impact.trades_of_both_sides(trades, impact.month_floor(impact.token_deposits(tables[0])).scalar())
    from pyspark.sql import functions as F
    read = {r[0] for r in sides.select(F.input_file_name()).distinct().collect()}
    assert read and all("2023-1" in f or "2023-09" in f for f in read)


def test_the_factory_literal_reaches_the_scan(tables, whole_metadata):
    plan = plan_of(impact.verified_wallets(tables[1]))
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(from,", plan)


def test_wallets_cut_the_trades_below_their_shuffle(tables, whole_metadata):
    """Between the scan of the trades and the exchange on the wallet stands the bitmap."""
    plan = plan_of(impact.wallet_impact(*tables)).split("== Initial Plan ==")[0].splitlines()
    plan = [line for line in plan if re.search(r"[A-Za-z*]", line)]
    depth = [re.search(r"[A-Za-z*]", line).start() for line in plan]
    scans = [i for i, line in enumerate(plan) if "FileScan parquet" in line and "block_month" in line]
    for at in scans:
        above, least = [], depth[at]
        for i in range(at - 1, -1, -1):  # from the scan to the root
            if depth[i] < least:
                least = depth[i]
                above.append(plan[i])
        first = next(i for i, line in enumerate(above) if "BroadcastHashJoin" in line and "_prefilter_bucket" in line)
        assert not any("Exchange" in line for line in above[:first])
        assert any("Exchange hashpartitioning(addr" in line for line in above[first:])
    assert scans


def test_bitmap_keeps_every_key_and_few_others(spark):
    rows = spark.range(20_000).selectExpr("encode(cast(id as string), 'utf-8') k", "id _at", "'x' _bucket")
    keys = rows.where("_at % 100 = 7").unionByName(spark.range(1).selectExpr("cast(null as binary) k", "null _at", "'' _bucket"))
    for bits, most in ((24, 210), (18, 300)):
        got = cut_by_keys(rows, "k", keys.select("k"), bits)
        assert got.columns == rows.columns
        kept = {r._at for r in got.collect()}
        assert {i for i in range(20_000) if i % 100 == 7} <= kept and len(kept) <= most
    assert cut_by_keys(rows, "k", keys.where("false").select("k")).count() == 0


def test_empty_sources(spark, tables):
    orders, traces, trades = tables
    got = impact.wallet_impact(orders.where("false"), traces, trades).first()
    assert got.wallets_funded == 0 and got.new_traders == 0 and got.median_lag_seconds is None
    assert FILLED
