"""Sketch cubes against exact answers."""

import random

import pytest
from pyspark.sql import functions as F

from order_helpers import make_orders
from flowcubes.operators import sketches
from flowcubes.plans import growth

T0, WEEK = 1_700_006_400.0, 7 * 86400.0
PS = {"p50": 0.5, "p90": 0.9, "p99": 0.99}


@pytest.fixture(scope="module")
def orders(spark):
    rnd = random.Random(5)
    rows = [dict(order_create_time=T0 + rnd.randrange(20) * WEEK / 2, t_total=rnd.choice([rnd.lognormvariate(3, 1), 30.0, None, 0.0]),
                 src_trader_address=rnd.choice(["a", None, f"t{rnd.randrange(900)}"]),
                 dst_chain_id=rnd.choice(["bnb", "base", "ton"])) for _ in range(6000)]
    return make_orders(spark, rows).repartition(6).cache()


def test_merged_quantiles_keep_the_rank_bound(orders):
    keys = {"dst_chain_id": F.col("dst_chain_id")}
    cube = sketches.time_sketch_cube(orders, ["dst_chain_id"], k=100)
    est = sketches.merged_quantiles(cube, keys, PS, k=100)
    rows = sketches.rank_errors(orders, est, keys, PS).collect()
    assert len(rows) == 9 and all(r.rank_error <= sketches.kll_rank_bound(100) for r in rows)
    want = {r[0]: r[1] for r in orders.where("t_total > 0").groupBy("dst_chain_id").count().collect()}
    assert {r.dst_chain_id: r.orders for r in rows} == want


def test_rank_error_of_a_wrong_estimate_is_seen(orders):
    keys = {"dst_chain_id": F.col("dst_chain_id")}
    est = sketches.merged_quantiles(sketches.time_sketch_cube(orders, ["dst_chain_id"]), keys, {"p50": 0.5})
    low = est.withColumn("p50", F.lit(0.0))
    assert all(r.rank_error == 0.5 for r in sketches.rank_errors(orders, low, keys, {"p50": 0.5}).collect())


@pytest.mark.parametrize("lg_k", [12, 6])
def test_new_and_returning_by_set_algebra(orders, lg_k):
    cube = sketches.trader_sketch_cube(orders, lg_k)
    got = {r.week: r for r in sketches.new_vs_returning_estimate(cube, lg_k).collect()}
    exact = growth.new_vs_returning_weekly(orders).collect()
    assert set(got) == {r.week for r in exact} and len(exact) > 8
    for r in exact:
        off = 0.5 if r.cumulative_traders <= 2**lg_k else 5 / 2 ** (lg_k / 2) * r.cumulative_traders
        for c in ("new_traders", "returning_traders", "cumulative_traders"):
            assert abs(got[r.week][c] - r[c]) <= off, (r.week, c)


def test_cohorts_are_exact_while_sketches_are_not_full(orders):
    got = sketches.cohort_estimate(sketches.trader_sketch_cube(orders), 4).collect()
    seen = growth.cohort_activity(orders).collect()
    want = {}
    for r in seen:
        want.setdefault((r.cohort_week, (r.active_week - r.cohort_week).days // 7), set()).add(r.trader)
    for r in got:
        assert r.retained_traders == len(want.get((r.cohort_week, r.weeks_after), ()))
        assert r.cohort_size == len(want.get((r.cohort_week, 0), ()))
    assert {k for k in want if k[1] <= 4} <= {(r.cohort_week, r.weeks_after) for r in got}
    assert sketches.cohort_estimate(sketches.trader_sketch_cube(orders.where("lt < '0'")), 4).count() == 0
