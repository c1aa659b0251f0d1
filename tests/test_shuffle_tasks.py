"""What one task groups or sorts does not grow with the orders: shuffles over
the order view go to tasks in proportion to them."""

import re

import pytest

import __spark_entry__ as E
from flowcubes import session
from flowcubes.sources.tables import table

QUERY, ROWS = "quality_table_health", 1000


@pytest.fixture()
def few_rows(spark, monkeypatch):
    monkeypatch.setattr(session, "ROWS_PER_SHUFFLE_TASK", ROWS, raising=False)
    yield
    E._configure(spark)


def grouping_tasks(df) -> set[int]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return {int(n) for n in re.findall(r"hashpartitioning\(day#.*, (\d+)\), ENSURE_REQUIREMENTS", plan)}


def sf001() -> str:
    return E.SMOKE_DIR.replace("sf0.001", "sf0.01")


def test_cubes_are_grouped_in_tasks_of_bounded_rows(spark, few_rows):
    rows = table(spark, sf001(), "lineitem").count()
    assert grouping_tasks(E.queries()[QUERY](spark, sf001())) == {-(-rows // ROWS)}


def test_small_tables_keep_the_tasks_of_the_session(spark):
    assert grouping_tasks(E.queries()[QUERY](spark, E.SMOKE_DIR)) == {8}


def test_same_rows_whatever_the_tasks(spark, few_rows, monkeypatch):
    many = sorted(map(str, E.queries()[QUERY](spark, E.SMOKE_DIR).collect()))
    monkeypatch.undo()
    assert many == sorted(map(str, E.queries()[QUERY](spark, E.SMOKE_DIR).collect())) and len(many) == 14


def test_what_the_session_sets_is_kept_and_the_rest_undone(spark):
    sized, kept = session.TASK_CONF
    spark.conf.set(kept, "8MB")
    try:
        session.size_shuffles(spark, 10 * session.ROWS_PER_SHUFFLE_TASK)
        assert (spark.conf.get(session.INITIAL_PARTITIONS), spark.conf.get(sized), spark.conf.get(kept)) == ("10", "32MB", "8MB")
        E._configure(spark)
        assert spark.conf.get(session.INITIAL_PARTITIONS, None) is None
        assert spark.conf.get(sized) != "32MB" and spark.conf.get(kept) == "8MB"
    finally:
        spark.conf.unset(kept)
