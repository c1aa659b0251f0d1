import random
import re

import pytest
from pyspark.sql import functions as F

from flowcubes.operators.percentiles import exact_percentiles, percentiles

PS = {"p01": 0.01, "p50": 0.5, "p90": 0.9, "p99": 0.99}


def disc(df, keys):
    aggs = [F.expr(f"percentile_disc({p}) within group (order by v)").alias(n) for n, p in PS.items()]
    g = df.groupBy(*keys) if keys else df
    return g.agg(*aggs)


@pytest.mark.parametrize("accuracy", [50, 10_000])
def test_matches_percentile_disc_per_group(spark, accuracy):
    rnd = random.Random(7)
    rows = []
    for g in range(12):
        n = rnd.choice([1, 2, 3, 7, 40, 900])
        rows += [(g, float(rnd.choice([rnd.randint(0, 9), rnd.random() * 100]))) for _ in range(n)]
    rows += [(50, None), (51, 3.0), (51, None)]
    df = spark.createDataFrame(rows, "g int, v double")
    got = {r.g: tuple(r[n] for n in PS) for r in exact_percentiles(df, ["g"], "v", PS, accuracy).collect()}
    ref = {r.g: tuple(r[n] for n in PS) for r in disc(df, ["g"]).where("p50 is not null").collect()}
    assert got == ref


def test_global_and_empty(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 101)], "v double")
    r = exact_percentiles(df, [], "v", PS).collect()[0]
    assert (r.p01, r.p50, r.p90, r.p99) == (1.0, 50.0, 90.0, 99.0)
    assert exact_percentiles(df.where("v > 1000"), [], "v", PS).count() == 0
    approx = percentiles(df, [], "v", {"p50": 0.5}, exact=False).collect()[0]
    assert approx.p50 == pytest.approx(50.0, abs=1.0)


def test_global_percentiles_join_nothing(spark):
    """The one row of bounds is a scalar subquery, with adaptive plans off too."""
    df = spark.range(1000).select(F.col("id").cast("double").alias("v"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = exact_percentiles(df, [], "v", PS)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Cartesian" not in plan and "NestedLoop" not in plan
        assert tuple(out.collect()[0]) == (9.0, 499.0, 899.0, 989.0)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def _skewed(spark):
    """A third of the rows in one group, copies and spread values; a NULL key."""
    rnd = random.Random(11)
    rows = [("hot", rnd.choice([rnd.gauss(50, 5), 50.0])) for _ in range(9000)]
    rows += [(rnd.choice(["a", "b", "c", None]), float(rnd.randint(0, 4000))) for _ in range(18000)]
    return spark.createDataFrame(rows, "g string, v double").repartition(8)


@pytest.mark.parametrize("keys", [["g"], []])
def test_brackets_are_narrowed_until_few_values_are_left(spark, keys):
    df = _skewed(spark).cache()
    names = [*keys, *PS]
    got = {tuple(r[n] for n in names) for r in exact_percentiles(df, keys, "v", PS, accuracy=100, last=100).collect()}
    assert got == {tuple(r[n] for n in names) for r in disc(df, keys).collect()}


def test_more_groups_than_are_broadcast(spark):
    df = _skewed(spark).withColumn("g", F.concat("g", (F.col("v") % 40).cast("int").cast("string"))).cache()
    got = {(r.g, r.p01, r.p50, r.p90, r.p99) for r in exact_percentiles(df, ["g"], "v", PS, groups=7).collect()}
    want = {(r.g, r.p01, r.p50, r.p90, r.p99) for r in disc(df, ["g"]).collect()}
    assert len(want) > 100 and got == want


def test_rows_are_never_shuffled_on_the_group(spark):
    """What reaches an exchange is counted by value first; the brackets are broadcast."""
    df = _skewed(spark).where("v > 0")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = exact_percentiles(df, ["g"], "v", PS)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    # Exchanges from the scan upwards: repartition, then by value, then of counts.
    by = [re.sub(r"#\d+", "", k) for k in re.findall(r"hashpartitioning\((.*?), 8\)", plan)][::-1]
    assert by[0] == "g, _i, _bv", by
