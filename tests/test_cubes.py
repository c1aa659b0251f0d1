from pyspark.sql import functions as F

from order_helpers import FAILED, FF, make_orders
from flowcubes import schemas
from flowcubes.operators import cubes, ingest

DAY = 86400.0
T0 = 1_700_006_400.0  # a UTC midnight


def sample(spark):
    return make_orders(spark, [
        dict(status=FF, usd=100, src_trader_address="a", order_create_time=T0),
        dict(status=FAILED, usd=50, src_trader_address="a", order_create_time=T0 + 60),
        dict(status=FF, usd=10, src_trader_address="b", order_create_time=T0 + DAY, dst_chain_id="ton"),
        dict(status=FF, usd=5, src_trader_address="a", order_create_time=T0 + 2 * DAY, src_chain_id="bnb"),
    ])


def test_failed_orders_count_in_finalized_not_filled(spark):
    r = cubes.build_cube(sample(spark), grouping=None).collect()[0]
    assert float(r.finalized_orders_volume_usd) == 165 and float(r.filled_orders_volume_usd) == 115
    assert r.finalized_orders_count == 4 and r.unique_trader_wallets_count == 2


def test_count_always_requested(spark):
    c = cubes.build_cube(sample(spark), ["status"], metrics=["filled_orders_volume_usd"])
    assert "finalized_orders_count" in c.columns
    assert c.where(F.col("status") == FAILED).count() == 1  # a zero-volume group still exists


def test_wallets_are_not_additive(spark):
    o = sample(spark)
    per_day = cubes.daily_total(o).agg(F.sum("unique_trader_wallets_count")).collect()[0][0]
    total = cubes.build_cube(o, grouping=None).collect()[0].unique_trader_wallets_count
    assert per_day == 3 and total == 2


def test_output_asset_cube_drops_input_volume(spark):
    o = sample(spark).withColumn("output_asset_chain", F.lit("bnb"))
    cols = cubes.daily_output_asset(o).columns
    assert "filled_orders_volume_usd" not in cols and "protocol_fees_usd" in cols


def test_window_union_equals_one_pull(spark):
    o = sample(spark)
    whole = cubes.daily_chainpair(o)
    windows = ingest.backfill_windows(spark, int(T0), int(T0 + 3 * DAY), window_days=1).collect()
    parts = None
    for w in windows:
        part = cubes.daily_chainpair(ingest.created_between(o, w.from_ts, w.to_ts))
        parts = part if parts is None else parts.unionByName(part)
    assert sorted(map(tuple, parts.collect())) == sorted(map(tuple, whole.collect()))


def test_rollup_and_grouping_sets(spark):
    o = sample(spark)
    total = {r.day: r for r in cubes.daily_total(o).collect()}
    rolled = {r.day: r for r in cubes.rollup(cubes.daily_chainpair(o), ["day"]).collect()}
    for d, r in total.items():
        for m in schemas.ADDITIVE_METRICS:
            assert r[m] == rolled[d][m]
    one = cubes.all_cubes_one_pass(o)
    for t in schemas.CUBE_DIMENSIONS:
        a = sorted(map(tuple, cubes.split_cubes(one, t).collect()))
        b = sorted(map(tuple, cubes.named_cube(o, t).select(
            "day", *schemas.CUBE_DIMENSIONS[t], *schemas.cube_metrics(t)).collect()))
        assert a == b, t


def test_hourly_and_sketch(spark):
    o = sample(spark)
    hours = cubes.build_cube(o, grouping=cubes.HOUR).collect()
    assert len(hours) == 3
    sk = cubes.rollup_sketch(cubes.wallet_sketch_cube(o, ["dst_chain_id"]), []).collect()[0]
    assert sk.unique_trader_wallets_estimate == 2 and sk.finalized_orders_count == 4


def test_one_pass_shuffles_orders_once(spark):
    """Orders are repeated for the sets after their shuffle, not before it."""
    o = sample(spark).unionByName(make_orders(spark, [
        dict(src_trader_address=None, order_create_time=T0), dict(src_trader_address="a", resolver_id="r", order_create_time=T0),
        dict(day=None, src_trader_address="b")]))
    one = cubes.all_cubes_one_pass(o, parts=3)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.index("Generate explode") < plan.index("REPARTITION_BY_NUM")
    assert plan.count("Exchange hashpartitioning") == 2
    assert one.schema["filled_orders_volume_usd"] == cubes.daily_total(o).schema["filled_orders_volume_usd"]
    for t in schemas.CUBE_DIMENSIONS:
        columns = ["day", *schemas.CUBE_DIMENSIONS[t], *schemas.cube_metrics(t)]
        a, b = (sorted(map(str, f.select(columns).collect())) for f in (cubes.split_cubes(one, t), cubes.named_cube(o, t)))
        assert a == b, t


def odd_orders(spark):
    """Texts with the marks of joined dimensions, and amounts of every size."""
    amounts = ["0.01", "-3.5", "999999.9999", "1000000", "123456789012345678.123456789012345678", "0.000000000000000001", "0.00005", "0"]
    texts = [None, "", "a", "\x01", "a\x01b", "\x02", "\x03", "\x0361", "\u00fc\x02"]
    rows = [dict(usd=a, resolver_id=texts[n % 9], input_asset_address=texts[(n // 3) % 9], integrator_address=texts[(n + 4) % 9],
                 src_trader_address=(None, "t", "u", "\x01")[n % 4], protocol_fee_usd=amounts[(n + 3) % 8], status=(FF, FAILED)[n % 2],
                 order_create_time=T0 + n % 5 * DAY) for n in range(72) for a in [amounts[n % 8]]]
    o = make_orders(spark, [*rows, dict(day=None, src_trader_address="b"), dict(day=None, src_trader_address="b", resolver_id="r")])
    return o.withColumn("integrator_fee_usd", F.when(F.col("lt_num") % 3 != 0, F.col("integrator_fee_usd")))


def same_as_named(one, o):
    for t in schemas.CUBE_DIMENSIONS:
        columns = ["day", *schemas.CUBE_DIMENSIONS[t], *schemas.cube_metrics(t)]
        a, b = (sorted(map(str, f.select(columns).collect())) for f in (cubes.split_cubes(one, t), cubes.named_cube(o, t)))
        assert a == b, t


def test_whole_days_are_shuffled_once_and_no_more(spark):
    o = odd_orders(spark)
    for parts in (None, 3, 7):
        one = cubes.all_cubes_one_pass(o, parts=parts, busy={})
        assert one._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
        same_as_named(one, o)


def test_busy_days_are_dealt_by_their_traders_too(spark, monkeypatch):
    monkeypatch.setattr(cubes, "BUSY_DAY", 14)
    monkeypatch.setattr(cubes, "ORDERS_PER_TASK", 1)
    o = odd_orders(spark)
    busy = cubes.busy_days(o.groupBy("day").agg(F.count(F.lit(1)).alias("orders")))
    assert sorted(busy.values()) == [15, 15]
    for days in (busy, {None: 2}, busy | {None: 2}, None):
        same_as_named(cubes.all_cubes_one_pass(o, parts=3, busy=days), o)


def test_orders_are_dealt_in_few_bytes(spark):
    """A text of all dimensions and whole units, not a dozen texts and decimals."""
    plan = cubes.all_cubes_one_pass(sample(spark), parts=3, busy={})._jdf.queryExecution().executedPlan().toString()
    dealt = next(line for line in plan[plan.index("Exchange "):].splitlines() if "Project [" in line or "HashAggregate" in line)
    assert "_dims" in dealt and "resolver_id" not in dealt.replace("array(", "").split("AS _dims")[-1]
