import datetime as dt

import pytest

from order_helpers import FAILED, make_orders
from flowcubes.operators import cubes
from flowcubes.plans import dashboard

DAY = 86400.0
T0 = 1_700_006_400.0  # 2023-11-15, a Wednesday
AS_OF = "2023-11-16"


def _evm(spark):
    return spark.createDataFrame([("bnb", bytearray(b"\x55\xd3"), "USDT", 2), ("ton", bytearray(b"\x01"), "X", 2)],
                                 "blockchain string, contract_address binary, symbol string, decimals int")


def _jettons(spark):
    return spark.createDataFrame([], "address string, symbol string, decimals int, _updated_at timestamp")


def _usdt(**kw):
    """A settled bnb -> ton order paying ``cents`` of a 2-decimal stablecoin."""
    cents = kw.pop("cents", 100)
    base = dict(src_chain_id="bnb", dst_chain_id="ton", input_asset_chain="bnb", input_asset_kind="erc20",
                input_asset_address="0x55d3", actual_input_units=str(cents), usd=cents / 100)
    base.update(kw)
    return base


def test_headline_windows_bounds(spark):
    o = make_orders(spark, [
        dict(order_create_time=T0, usd=1, t_total=5.0, src_trader_address="a"),               # last day
        dict(order_create_time=T0 + DAY, usd=1000, src_trader_address="z"),                    # on as_of: out
        dict(order_create_time=T0 - 6 * DAY, usd=10, t_total=7.0, src_trader_address="b"),     # 7d edge
        dict(order_create_time=T0 - 7 * DAY, usd=100, t_total=9.0, src_trader_address="c"),    # all time only
        dict(order_create_time=T0, status=FAILED, usd=50, src_trader_address="f", t_total=999.0),
    ])
    out = {r.period: r for r in dashboard.headline_windows(cubes.daily_chainpair(o), o, AS_OF).collect()}
    assert list(out) == ["24h", "7d", "all time"]
    assert (out["24h"].volume_usd, out["24h"].swaps, out["24h"].traders) == (1.0, 1, 1)
    assert (out["7d"].volume_usd, out["7d"].swaps, out["7d"].median_seconds) == (11.0, 2, 5.0)
    assert (out["all time"].volume_usd, out["all time"].traders, out["all time"].median_seconds) == (111.0, 3, 7.0)
    assert out["all time"].net_ton_usd == -111.0  # ton -> bnb leaves ton


def test_headline_windows_empty_period_is_a_row(spark):
    o = make_orders(spark, [dict(order_create_time=T0 - 30 * DAY, usd=4, t_total=1.0)])
    out = {r.period: r for r in dashboard.headline_windows(cubes.daily_chainpair(o), o, AS_OF).collect()}
    assert out["24h"].volume_usd is None and out["24h"].traders is None
    assert out["all time"].volume_usd == 4.0


def test_filtered_volume_filters_and_buckets(spark):
    o = make_orders(spark, [
        _usdt(order_create_time=T0, cents=5_000, src_trader_address="a"),
        _usdt(order_create_time=T0 + DAY, cents=20_000, src_trader_address="b"),
        _usdt(order_create_time=T0 + 7 * DAY, cents=30_000, src_trader_address="a"),
        _usdt(order_create_time=T0, cents=90_000, src_chain_id="polygon", input_asset_chain="polygon"),
        dict(order_create_time=T0, input_asset_address="0xdead", actual_input_units="7", src_chain_id="bnb",
             dst_chain_id="ton"),
    ])
    evm, jet = _evm(spark), _jettons(spark)
    weekly = dashboard.filtered_volume(o, evm, jet, "week", src="bnb", stable=("USDT",)).collect()
    # The unpriced bnb order counts as a swap without a minimum size ...
    assert [(r.bucket, r.swaps, r.traders, r.volume_usd) for r in weekly] == [
        (dt.date(2023, 11, 13), 3, 3, 250.0), (dt.date(2023, 11, 20), 1, 1, 300.0)]
    # ... and drops out with one; the period end is exclusive.
    sized = dashboard.filtered_volume(o, evm, jet, "day", start="2023-11-15", end="2023-11-22", src="bnb",
                                      min_usd=100, stable=("USDT",)).collect()
    assert [(r.bucket, r.swaps, r.volume_usd) for r in sized] == [(dt.date(2023, 11, 16), 1, 200.0)]
    with pytest.raises(ValueError):
        dashboard.bucket_of("year")


def test_cross_vs_intra_daily(spark):
    o = make_orders(spark, [
        dict(usd=10), dict(usd=5, src_chain_id="bnb", dst_chain_id="bnb"),
        dict(usd=3, status=FAILED), dict(usd=1, order_create_time=T0 + DAY),
    ])
    out = dashboard.cross_vs_intra_daily(cubes.daily_chainpair(o)).collect()
    assert [(r.cross_chain_usd, r.intrachain_usd, r.total_usd, r.swaps) for r in out] == [
        (10.0, 5.0, 15.0, 2), (1.0, 0.0, 1.0, 1)]
    assert out[1].total_7d_avg == 8.0


def test_corridor_matrix_columns_come_from_data(spark):
    o = make_orders(spark, [
        dict(usd=10), dict(usd=20, status=FAILED), dict(usd=7, src_chain_id="bnb", dst_chain_id="xlayer"),
        dict(usd=99, src_chain_id="bnb", dst_chain_id="bnb"),
    ])
    cp = cubes.daily_chainpair(o)
    vol = dashboard.corridor_matrix(cp, "volume")
    assert vol.columns == ["source", "bnb", "xlayer"]
    assert [tuple(r) for r in vol.collect()] == [("bnb", None, 7.0), ("ton", 10.0, None)]
    ok = {r.source: r.bnb for r in dashboard.corridor_matrix(cp, "success").collect()}
    assert ok["ton"] == 50.0


def test_top_corridors_rank_differently(spark):
    o = make_orders(spark, [dict(usd=100)] + [dict(usd=1, src_chain_id="bnb", dst_chain_id="ton")] * 3)
    out = dashboard.top_corridors(cubes.daily_chainpair(o), k=1).collect()
    assert [(r.ranking, r.rank, r.corridor) for r in out] == [("count", 1, "bnb → ton"), ("volume", 1, "ton → bnb")]


def test_latency_by_size_and_corridor(spark):
    o = make_orders(spark, [
        _usdt(cents=100, t_total=4.0), _usdt(cents=150, t_total=8.0), _usdt(cents=200_000, t_total=2.0),
        _usdt(cents=100, t_total=-1.0),
    ])
    by_size = dashboard.latency_by_size(o, _evm(spark), _jettons(spark), ("USDT",), (2, 10, 100, 1000)).collect()
    assert [(r.trade_size, r.swaps, r.p50) for r in by_size] == [("under $2", 3, 4.0), ("over $1,000", 1, 2.0)]
    by_corridor = dashboard.settle_time_by_corridor(o).collect()
    assert [(r.corridor, r.swaps, r.p50_seconds, r.p90_seconds) for r in by_corridor] == [
        ("bnb → ton", 3, 4.0, 8.0)]


def test_success_rate_daily_failed_volume(spark):
    o = make_orders(spark, [dict(usd=10), dict(usd=30, status=FAILED), dict(usd=5, status=FAILED)])
    r = dashboard.success_rate_daily(cubes.daily_chainpair(o)).collect()[0]
    assert (r.orders, r.filled, r.failed_volume_usd) == (3, 1, 35.0)
    assert r.success_pct == pytest.approx(100 / 3)


def test_quote_vs_delivered_coverage(spark):
    o = make_orders(spark, [
        dict(quote_output_units="1000000", actual_output_units="997000", protocol_fee_pips=1000.0,
             integrator_fee_pips=2000.0),
        dict(quote_output_units=None, actual_output_units="5", protocol_fee_pips=0.0, integrator_fee_pips=0.0),
        dict(quote_output_units="", actual_output_units="5", protocol_fee_pips=0.0, integrator_fee_pips=0.0),
        dict(status=FAILED, quote_output_units="9", actual_output_units="0"),
    ])
    r = dashboard.quote_vs_delivered(o).collect()[0]
    assert (r.settled_orders, r.quoted_orders) == (3, 1)
    assert r.coverage_pct == pytest.approx(100 / 3)
    assert r.median_gap_pips == pytest.approx(3000.0) and r.median_fee_pips == 3000.0


def test_resolver_shares_sum_to_one(spark):
    o = make_orders(spark, [dict(usd=30, resolver_id="r1"), dict(usd=10, resolver_id="r2"),
                            dict(usd=10, resolver_id="r3", status=FAILED)])
    out = dashboard.resolver_share_daily(cubes.daily_resolver(o)).collect()
    assert [(r.resolver_id, r.share) for r in out] == [("r1", 0.75), ("r2", 0.25)]


def test_size_concentration(spark):
    rows = [_usdt(cents=100 * (i + 1), src_trader_address=f"t{i}") for i in range(12)]
    rows.append(_usdt(cents=1_200, src_trader_address="t11"))
    o = make_orders(spark, rows)
    r = dashboard.size_concentration(o, _evm(spark), _jettons(spark), ("USDT",), k=2).collect()[0]
    assert (r.trades, r.traders, r.total_usd) == (13, 12, 90.0)
    assert r.top2_usd == 35.0 and r.top2_share_pct == pytest.approx(100 * 35 / 90)
    assert r.median_trade_usd == 7.0 and r.mean_trade_usd == pytest.approx(90 / 13)


def test_order_lookup_pushes_the_filter(spark, tmp_path):
    o = make_orders(spark, [dict(quote_id="q1", lt="5"), dict(quote_id="q2", lt="6"), dict(quote_id="q1", lt="7")])
    o.write.parquet(str(tmp_path / "orders"))
    published = spark.read.parquet(str(tmp_path / "orders"))
    found = dashboard.order_lookup(published, "q1")
    assert [r.lt for r in found.collect()] == ["5", "7"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "EqualTo(quote_id,q1)" in plan
