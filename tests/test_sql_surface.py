from order_helpers import make_orders
from flowcubes.functions.sql import register_functions
from flowcubes.operators import publish

T0 = 1_787_616_000.0


def test_sql_functions(spark):
    register_functions(spark)
    r = spark.sql("select ton_raw('EQCxE6mUtQJKFnGfaROTKOt1lZbDiiX1kCixRv7Nw2Id_sDs') a, "
                  "hex(evm_key('0x55d3')) b, evm_key('0xzz') c, short_label('0x1234567890abcdef', 6, 4) d, "
                  "short_label('EQDE_TwS_abcdefgh', 10, 0) e").collect()[0]
    assert r.a.startswith("0:B113A994") and r.b == "55D3" and r.c is None
    assert (r.d, r.e) == ("0x1234…cdef", "EQDE_TwS_a…")


def test_sql_over_published_views(spark, tmp_path):
    root = str(tmp_path / "pub")
    o = make_orders(spark, [dict(order_create_time=T0 + d * 86400.0, lt=str(d), usd=10 * (d + 1)) for d in range(3)])
    publish.refresh(spark, o, root, "2026-08-26 06:00:00")
    publish.register_views(spark, root, prefix="pub_")
    rows = spark.sql("""
        select day, sum(filled_orders_volume_usd) as volume_usd,
               sum(sum(filled_orders_volume_usd)) over (order by day) as cumulative_usd
        from pub_daily_chainpair where src_chain_id != dst_chain_id group by day order by day""").collect()
    assert [r.cumulative_usd for r in rows] == [10.0, 30.0, 60.0]
    assert spark.sql("select count(distinct run_ts) n from pub_orders").collect()[0].n == 1
