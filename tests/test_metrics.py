import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from order_helpers import FAILED, FF, make_orders
from flowcubes.operators import cubes
from flowcubes.plans import assets, fees, flows, growth, latency, leagues, rhythm, wallets

DAY = 86400.0
T0 = 1_700_006_400.0  # 2023-11-15, a Wednesday


def test_headline_excludes_failed_from_median_and_traders(spark):
    o = make_orders(spark, [
        dict(status=FF, t_total=10.0, src_trader_address="a", usd=100),
        dict(status=FF, t_total=20.0, src_trader_address="b", usd=100),
        dict(status=FAILED, t_total=900.0, src_trader_address="c", usd=100),
        dict(status=FAILED, t_total=901.0, src_trader_address="c", usd=100),
        dict(status=FF, t_total=1.0, src_trader_address="d", usd=7, src_chain_id="bnb", dst_chain_id="bnb"),
    ])
    r = growth.headline(cubes.daily_chainpair(o), o).collect()[0]
    assert r.median_seconds == 10.0
    assert r.traders == 2 and r.swaps == 2 and r.volume_usd == 200.0
    assert r.success_pct == 50.0
    assert r.net_ton_usd == -200.0  # ton -> bnb leaves ton; the bnb->bnb swap is not a flow
    assert r.volume_per_trader_usd == 100.0 and r.swaps_per_trader == 1.0


def test_moving_average_is_over_rows_not_days(spark):
    o = make_orders(spark, [dict(usd=10 * (i + 1), order_create_time=T0 + 3 * i * DAY) for i in range(8)])
    out = growth.cross_chain_volume_daily(cubes.daily_chainpair(o)).collect()
    assert out[6].volume_7d_avg == pytest.approx(sum(10 * (i + 1) for i in range(7)) / 7)
    assert out[7].volume_7d_avg == pytest.approx(sum(10 * (i + 1) for i in range(1, 8)) / 7)
    assert out[-1].cumulative_usd == 360.0 and out[-1].cumulative_swaps == 8


def test_failed_only_wallet_is_not_a_trader(spark):
    o = make_orders(spark, [
        dict(src_trader_address="a", order_create_time=T0),
        dict(src_trader_address="a", order_create_time=T0 + 7 * DAY),
        dict(src_trader_address="x", status=FAILED, order_create_time=T0),
        dict(src_trader_address=None, order_create_time=T0),
    ])
    weeks = growth.new_vs_returning_weekly(o).collect()
    assert [(w.new_traders, w.returning_traders, w.cumulative_traders) for w in weeks] == [(1, 0, 1), (0, 1, 1)]


def test_cohorts_need_min_size(spark):
    rows = [dict(src_trader_address=f"t{i}", order_create_time=T0) for i in range(3)]
    rows += [dict(src_trader_address="t0", order_create_time=T0 + 14 * DAY)]
    o = make_orders(spark, rows)
    assert growth.trader_cohorts(o, min_cohort=4).count() == 0
    out = growth.trader_cohorts(o, min_cohort=3).collect()
    assert [(r.weeks_after, r.cohort, round(r.retained, 4)) for r in out] == [
        (0, "week of Nov 13", 1.0), (2, "week of Nov 13", round(1 / 3, 4))]


def test_integrator_league_groups_by_label(spark):
    o = make_orders(spark, [
        dict(integrator_address="0x1234aaaa9999", integrator_chain="ton", usd=10, integrator_fee_usd=1),
        dict(integrator_address="0x1234bbbb9999", integrator_chain="ton", usd=30, integrator_fee_usd=1),
    ])
    r = fees.integrator_league(cubes.daily_integrator(o)).collect()
    assert len(r) == 1 and r[0].integrator == "0x1234…9999" and r[0].volume_usd == 40.0
    assert r[0].take_rate_bps == pytest.approx(500.0)


def test_fee_headline_shares(spark):
    o = make_orders(spark, [dict(usd=1000, protocol_fee_usd=1, integrator_fee_usd=3, integrator_address="i1")])
    r = fees.fee_headline(cubes.daily_chainpair(o), cubes.daily_integrator(o)).collect()[0]
    assert (r.total_fees_usd, r.take_rate_bps, r.cost_per_1000_usd, r.integrator_share_pct, r.integrators) == (
        4.0, 40.0, 4.0, 75.0, 1)


def test_net_flow_negates_outflow(spark):
    o = make_orders(spark, [dict(usd=10, src_chain_id="ton", dst_chain_id="bnb"),
                            dict(usd=4, src_chain_id="bnb", dst_chain_id="ton")])
    r = {x.chain: x for x in flows.net_flow_by_chain(cubes.daily_chainpair(o)).collect()}
    assert (r["bnb"].inflow_usd, r["bnb"].outflow_usd, r["bnb"].net_usd) == (10.0, -4.0, 6.0)
    assert r["ton"].net_usd == -6.0


def test_corridor_shares_sum_to_one(spark):
    rows = [dict(usd=600 + i, src_chain_id=f"c{i}", dst_chain_id="z") for i in range(10)]
    o = make_orders(spark, rows)
    out = flows.corridor_share_daily(cubes.daily_chainpair(o), k=8).collect()
    assert {r.corridor for r in out} >= {"other"} and len(out) == 9
    assert sum(r.share for r in out) == pytest.approx(1.0)
    edges = flows.chain_flows(cubes.daily_chainpair(o), min_value=605).collect()
    assert len(edges) == 5 and edges[0].source == "c9 (from)"


def test_clock_zero_fills_and_bounds(spark):
    ts = [dt.datetime(2024, 1, d, 10, 0) for d in (1, 2, 3)] + [dt.datetime(2024, 1, 3, 11, 0)]
    act = spark.createDataFrame([(t, "w", 5) for t in ts], "ts timestamp, trader string, usd int")
    hours = {r.hour_utc: r for r in rhythm.hourly_clock(act, "2024-01-04").collect()}
    assert len(hours) == 24
    # window = Jan 2 .. Jan 3 (first day and as_of dropped): 2 days
    assert hours["10:00"].avg_swaps == 1.0 and hours["11:00"].avg_swaps == 0.5
    assert hours["00:00"].avg_swaps == 0.0 and hours["00:00"].median_swaps == 0.0
    days = rhythm.weekday_clock(act, "2024-01-04").collect()
    assert [d.weekday for d in days] == ["Tuesday", "Wednesday"]
    empty = act.where(F.lit(False))
    assert rhythm.hourly_clock(empty, "2024-01-04").count() == 0


def test_activity_from_orders(spark):
    """Settled cross-chain orders at their creation, priced only where the token
    is a listed stablecoin and the units are digits."""
    usdc, other = "0x" + "a1" * 20, "0x" + "b2" * 20
    base = dict(src_chain_id="bnb", dst_chain_id="ton", input_asset_chain="bnb", input_asset_kind="erc20", order_create_time=T0 + 3600.0)
    o = make_orders(spark, [
        dict(base, src_trader_address="a", input_asset_address=usdc, actual_input_units="1000000000000000001"),
        dict(base, src_trader_address="b", input_asset_address=other, actual_input_units="5"),
        dict(base, src_trader_address="c", input_asset_address=usdc, actual_input_units="x"),
        dict(base, src_trader_address="d", input_asset_address=usdc, actual_input_units="1", status=FAILED),
        dict(base, src_trader_address="e", input_asset_address=usdc, actual_input_units="1", dst_chain_id="bnb"),
    ])
    evm = spark.createDataFrame([("bnb", bytes.fromhex("a1" * 20), "USDC", 18), ("bnb", bytes.fromhex("b2" * 20), "CAKE", 18)],
                                "blockchain string, contract_address binary, symbol string, decimals int")
    jettons = spark.createDataFrame([], "address string, symbol string, decimals int, _updated_at bigint")
    got = rhythm.activity_from_orders(o, evm, jettons)
    assert {(r.trader, r.usd, r.ts.hour) for r in got.select("trader", "usd", "ts").collect()} == {
        ("a", decimal.Decimal("1.000000000000000001"), 1), ("b", None, 1), ("c", None, 1)}


def test_latency_funnel_stack(spark):
    o = make_orders(spark, [dict(t_quote=float(i), t_decide=1.0, t_settle=2.0, t_total=float(10 * i))
                            for i in range(1, 101)])
    out = latency.latency_funnel(o).collect()
    assert [r.stage for r in out] == ["RFQ to quote", "quote to signature", "settlement", "end to end"]
    assert (out[0].p50, out[0].p90, out[0].p99) == (50.0, 90.0, 99.0)
    assert latency.settlement_speed_daily(o, min_swaps=101).count() == 0


def test_resolver_league_labels_may_repeat(spark):
    o = make_orders(spark, [dict(resolver_id="ABCDEFGHIJ1", usd=5, t_settle=3.0),
                            dict(resolver_id="ABCDEFGHIJ2", usd=7, t_settle=4.0, status=FAILED)])
    out = leagues.resolver_league(cubes.daily_resolver(o), o).collect()
    assert [r.resolver for r in out] == ["ABCDEFGHIJ…", "ABCDEFGHIJ…"]
    failed_only = [r for r in out if r.volume_usd == 0.0][0]
    assert failed_only.avg_trade_usd is None and failed_only.success_pct == 0.0


def test_asset_labels_and_size_buckets(spark):
    evm = spark.createDataFrame([("bnb", bytearray(b"\x55\xd3"), "USDT", 2)],
                                "blockchain string, contract_address binary, symbol string, decimals int")
    jet = spark.createDataFrame([], "address string, symbol string, decimals int, _updated_at timestamp")
    o = make_orders(spark, [
        dict(input_asset_chain="bnb", input_asset_kind="erc20", input_asset_address="0x55d3", usd=5,
             actual_input_units="100000", src_chain_id="bnb", dst_chain_id="ton"),
        dict(input_asset_chain="ton", input_asset_kind="native", usd=3, actual_input_units="1"),
        dict(input_asset_chain="ton", input_asset_kind="jetton", input_asset_address="EQCxE6mU", usd=1,
             actual_input_units="1"),
    ])
    sold = {r.asset: r.volume_usd for r in assets.assets_sold(cubes.daily_input_asset(o), evm, jet).collect()}
    assert sold == {"USDT · bnb": 5.0, "TON · ton": 3.0, "EQCxE6… · ton": 1.0}
    buckets = assets.trade_size_distribution(o, evm, jet, ("USDT",), (1, 10, 100, 1000)).collect()
    assert [(b.trade_size, b.orders, b.volume_usd) for b in buckets] == [("$100 to $1,000", 1, 1000.0)]
    assert assets.size_buckets()[3] == "4  $100 to $1,000"


def test_token_flows_deposit_first(spark):
    tok = "0xC011"
    o = make_orders(spark, [
        dict(output_asset_address=tok, input_asset_address=tok, actual_output_units="2000000",
             actual_input_units="1", dst_trader_address="d"),
        dict(input_asset_address=tok, actual_input_units="500000", src_trader_address="s"),
    ])
    r = wallets.token_flow_headline(o, cubes.daily_chainpair(o), tok, decimals=6).collect()[0]
    assert (r.deposits_usd, r.withdrawals_usd, r.net_usd, r.transfers) == (2.0, 0.5, 1.5, 2)
    assert r.share_of_swaps_pct == 100.0
    d = wallets.token_flow_daily(o, tok, decimals=6).collect()[0]
    assert (d.withdrawals_usd, d.wallets) == (-0.5, 2)


def test_funded_wallet_lag_in_whole_seconds(spark):
    t = dt.datetime(2024, 1, 1, 0, 0, 0, 900000)
    deposits = spark.createDataFrame([("a", t, 10), ("b", t, 5), ("x", t, 99)],
                                     "wallet string, deposit_time timestamp, usd int")
    verified = spark.createDataFrame([("a",), ("b",)], "addr string")
    trades = spark.createDataFrame([
        ("a", None, 30, t + dt.timedelta(seconds=1.1)),
        (None, "a", 20, t + dt.timedelta(seconds=100)),
        ("b", None, 7, t - dt.timedelta(seconds=5)),
    ], "maker string, taker string, amount int, block_time timestamp")
    r = wallets.funded_wallet_impact(deposits, verified, trades).collect()[0]
    assert (r.wallets_funded, r.wallets_that_traded, r.new_traders) == (2, 2, 1)
    assert (r.deposited_usd, r.wagered_usd, r.multiple) == (15.0, 57.0, 3.8)
    assert r.median_lag_seconds == 1.0 and r.within_a_minute_pct == 100.0
