"""Plans over published Parquet: filters reach the scan, and scans read only
the columns a metric needs."""

import re

import pytest

from order_helpers import make_orders
from flowcubes.operators import cubes
from flowcubes.plans import dashboard, latency

T0 = 1_700_006_400.0


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "orders")
    make_orders(spark, [dict(order_create_time=T0 + i * 86400.0, t_total=float(i)) for i in range(5)]) \
        .write.parquet(path)
    return spark.read.parquet(path)


def _scan(df) -> str:
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert scans, plan
    return "\n".join(scans)


def _read_columns(scan: str) -> set[str]:
    """Column names of every ``FileScan parquet [a#1,b#2]`` node."""
    lists = re.findall(r"FileScan parquet \[([^\]]*)\]", scan)
    cols = {c.split("#")[0] for cl in lists for c in cl.split(",") if c}
    assert cols, scan
    return cols


@pytest.fixture()
def full_metadata(spark):
    """Scan metadata (pushed filters) is cut at 100 characters by default."""
    key = "spark.sql.maxMetadataStringLength"
    before = spark.conf.get(key)
    spark.conf.set(key, "10000")
    yield
    spark.conf.set(key, before)


def test_funnel_reads_only_its_columns(published):
    cols = _read_columns(_scan(latency.latency_funnel(published)))
    assert cols <= {"status", "src_chain_id", "dst_chain_id", "t_quote", "t_decide", "t_settle", "t_total"}
    assert "quote_input_units" not in cols and "lt" not in cols


def test_dashboard_filters_reach_the_scan(published, full_metadata):
    o = dashboard.apply_filters(published, start="2023-11-16", end="2023-11-18", src="ton")
    scan = _scan(o.select("day"))
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", scan).group(1)
    assert "GreaterThanOrEqual(day,2023-11-16)" in pushed and "LessThan(day,2023-11-18)" in pushed
    assert "EqualTo(src_chain_id,ton)" in pushed
    assert o.count() == 2


def test_cube_build_prunes_to_its_inputs(published):
    cols = _read_columns(_scan(cubes.daily_chainpair(published)))
    assert cols == {"day", "src_chain_id", "dst_chain_id", "status", "finalized_usd", "filled_usd",
                    "protocol_fee_usd", "integrator_fee_usd", "src_trader_address"}
