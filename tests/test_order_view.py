"""The order view shuffles its lineitems while they are narrow, and once a join."""

import re

import pytest

import __spark_entry__ as E
from flowcubes.sources import binding

THRESHOLD = "spark.sql.autoBroadcastJoinThreshold"


@pytest.fixture()
def nothing_broadcast(spark):
    before = spark.conf.get(THRESHOLD)
    spark.conf.set(THRESHOLD, "-1")
    yield
    spark.conf.set(THRESHOLD, before)
    E._configure(spark)


def test_parts_are_joined_before_orders(spark, nothing_broadcast):
    plan = binding.orders(spark, E.SMOKE_DIR)._jdf.queryExecution().executedPlan().toString()
    joins = re.findall(r"SortMergeJoin \[(l_\w+)", plan)  # the last one first
    assert joins.index("l_orderkey") < joins.index("l_partkey")


def test_lineitems_are_shuffled_once_for_their_orders(spark, nothing_broadcast):
    assert binding.order_tasks(spark, E.SMOKE_DIR) < int(spark.conf.get("spark.sql.shuffle.partitions"))
    o = binding.orders(spark, E.SMOKE_DIR).select("lt_num", "day")
    assert len(o.collect()) == binding.order_rows(spark, E.SMOKE_DIR)
    final = o._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert len(re.findall(r"Exchange hashpartitioning\(l_orderkey", final)) == 1


def test_orders_of_a_day_without_the_join(spark):
    about = {r["day"]: r["orders"] for r in binding.day_orders(spark, E.SMOKE_DIR).collect()}
    exact = {r["day"] for r in binding.orders(spark, E.SMOKE_DIR).select("day").distinct().collect()}
    assert exact <= set(about) and round(sum(about.values())) == binding.order_rows(spark, E.SMOKE_DIR)
