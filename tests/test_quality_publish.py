import datetime as dt
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from order_helpers import FAILED, FF, make_orders
from flowcubes import schemas
from flowcubes.operators import cubes, ingest, publish, quality

T0 = 1_787_616_000.0  # 2026-08-25
DAY = 86400.0


def tables_for(spark, days=(0, 1, 2)):
    o = make_orders(spark, [dict(order_create_time=T0 + d * DAY, lt=str(100 + d)) for d in days])
    t = {name: cubes.named_cube(o, name) for name in schemas.CUBE_DIMENSIONS}
    t["orders"] = ingest.stamp_run(o, "2026-08-26 00:00:00")
    return {k: (ingest.stamp_run(v, "2026-08-26 00:00:00") if k != "orders" else v) for k, v in t.items()}


def test_seven_tables_accepted(spark):
    quality.validate(tables_for(spark))


def test_empty_table_refused(spark):
    t = tables_for(spark)
    t["daily_resolver"] = t["daily_resolver"].where(F.lit(False))
    with pytest.raises(quality.PublishError, match="daily_resolver.*0 rows"):
        quality.validate(t)


def test_gap_of_four_refused_gap_of_two_accepted(spark):
    with pytest.raises(quality.PublishError, match="jumps 4 days"):
        quality.validate(tables_for(spark, days=(0, 4)))
    quality.validate(tables_for(spark, days=(0, 2)))


def test_null_in_required_column_refused(spark):
    t = tables_for(spark)
    t["orders"] = t["orders"].withColumn("lt", F.when(F.col("lt") == "100", None).otherwise(F.col("lt")))
    with pytest.raises(quality.PublishError, match="orders .*'lt'"):
        quality.validate(t)


def test_unknown_table_skipped_by_checks_fatal_at_publish(spark, tmp_path):
    t = tables_for(spark)
    t["mystery"] = t["orders"].where(F.lit(False))
    quality.validate(t)
    with pytest.raises(quality.PublishError, match="no schema"):
        publish.full_refresh(spark, t, str(tmp_path / "pub"))


def test_domain_checks(spark):
    o = make_orders(spark, [dict(status=FF), dict(status="WEIRD"),
                            dict(status=FAILED, actual_input_units="0"),
                            dict(status=FAILED, actual_input_units="5")])
    assert [(r.status, r.orders) for r in quality.unknown_statuses(o).collect()] == [("WEIRD", 1)]
    assert quality.failed_with_units(o).count() == 1
    m = quality.monthly_status_counts(o).collect()[0]
    assert (m.filled, m.failed) == (1, 2)
    assert quality.cube_order_mismatch(cubes.daily_chainpair(o), o).count() == 0
    bad = cubes.daily_chainpair(o).withColumn("finalized_orders_count", F.lit(9))
    assert quality.cube_order_mismatch(bad, o).count() == 3


def test_refresh_publishes_one_vintage_atomically(spark, tmp_path):
    root = str(tmp_path / "pub")
    o = make_orders(spark, [dict(order_create_time=T0 + d * DAY, lt=str(100 + d)) for d in range(3)])
    written = publish.refresh(spark, o, root, "2026-08-26 06:00:00")
    assert written["orders"] == 3 and set(written) == set(schemas.TABLES)
    stamps = set()
    for name in schemas.TABLES:
        df = publish.read_table(spark, root, name)
        stamps |= {r.run_ts for r in df.select("run_ts").distinct().collect()}
    assert stamps == {dt.datetime(2026, 8, 26, 6, 0)}
    first = publish.current_run(spark, root)
    # A run that fails validation leaves the published pointer alone.
    gap = make_orders(spark, [dict(order_create_time=T0 + d * DAY, lt=str(100 + d)) for d in (0, 9)])
    with pytest.raises(quality.PublishError):
        publish.refresh(spark, gap, root, "2026-08-27 06:00:00")
    assert publish.current_run(spark, root) == first


def test_refresh_refuses_null_observed_while_writing(spark, tmp_path):
    root = str(tmp_path / "pub")
    ok = make_orders(spark, [dict(order_create_time=T0, lt="100")])
    first = publish.refresh(spark, ok, root, "2026-08-26 06:00:00") and publish.current_run(spark, root)
    bad = make_orders(spark, [dict(order_create_time=T0, lt="100"), dict(order_create_time=T0, lt="101")]) \
        .withColumn("lt", F.when(F.col("lt") != "101", F.col("lt")))
    with pytest.raises(quality.PublishError, match="orders has 1 row"):
        publish.refresh(spark, bad, root, "2026-08-27 06:00:00")
    assert publish.current_run(spark, root) == first


def test_dry_run_writes_nothing(spark, tmp_path):
    root = tmp_path / "dry"
    o = make_orders(spark, [dict(order_create_time=T0)])
    counts = publish.refresh(spark, o, str(root), dry_run=True)
    assert counts["daily_total"] == 1 and not root.exists()


def test_ndjson_chunks(spark, tmp_path):
    df = spark.range(5).repartition(1)
    publish.CHUNK_ROWS, old = 2, publish.CHUNK_ROWS
    try:
        n = publish.write_ndjson(df, str(tmp_path / "nd"))
    finally:
        publish.CHUNK_ROWS = old
    files = [f for f in os.listdir(tmp_path / "nd") if f.endswith(".json")]
    assert n == 5 and len(files) == 3
    assert json.loads(open(tmp_path / "nd" / sorted(files)[0]).readline()) == {"id": 0}


def test_recent_rewrite_keeps_history(spark, tmp_path):
    path = str(tmp_path / "p5")
    o = make_orders(spark, [dict(order_create_time=T0 + d * DAY, lt=str(d)) for d in range(6)])
    o.write.partitionBy("day").parquet(path)
    later = make_orders(spark, [dict(order_create_time=T0 + d * DAY, lt=str(d), usd=99) for d in range(3, 6)])
    publish.rewrite_recent(later, path, "2026-08-31", recent_days=3)
    back = spark.read.parquet(path)
    assert back.count() == 6
    assert back.where(F.col("finalized_usd") == 99).count() == 3
    hist, recent = publish.split_history(back, "2026-08-31", 3)
    assert (hist.count(), recent.count()) == (3, 3)
    assert publish.trim_recent(back, "2026-08-31", 2).count() == 2


def test_concurrent_cube_writes_publish_what_one_writer_does(spark, tmp_path, monkeypatch):
    o = make_orders(spark, [dict(order_create_time=T0 + (i % 3) * DAY, lt=str(100 + i),
                                 src_chain_id=("ton", "bnb")[i % 2], dst_chain_id=("bnb", "polygon")[i % 2],
                                 src_trader_address=f"w{i % 4}", usd=i + 1) for i in range(12)])
    published = {}
    for writers in (1, 6):
        monkeypatch.setattr(publish, "CUBE_WRITERS", writers)
        root = str(tmp_path / f"pub{writers}")
        publish.refresh(spark, o, root, "2026-08-26 06:00:00")
        published[writers] = {name: sorted(map(tuple, publish.read_table(spark, root, name).collect()))
                              for name in schemas.TABLES}
    assert published[1] == published[6]
    assert len(published[6]["daily_total"]) == 3


def _orders(spark, days):
    return make_orders(spark, [dict(order_create_time=T0 + d * DAY, lt=str(100 + d)) for d in days])


def test_manifest_of_each_run(spark, tmp_path):
    root = str(tmp_path / "pub")
    with pytest.raises(FileNotFoundError):
        publish.vintages(spark, root)
    publish.refresh(spark, _orders(spark, range(2)), root, "2026-08-26 06:00:00")
    publish.refresh(spark, _orders(spark, range(3)), root, "2026-08-27 06:00:00")
    with pytest.raises(quality.PublishError, match="2026-08-27 06:00:00 is published"):
        publish.refresh(spark, _orders(spark, range(4)), root, "2026-08-26 09:00:00")
    with pytest.raises(quality.PublishError):  # a run that fails has no manifest
        publish.refresh(spark, _orders(spark, (0, 9)), root, "2026-08-28 06:00:00")
    seen = publish.vintages(spark, root).collect()
    assert len(seen) == 2 * len(schemas.TABLES)
    assert {(r.run_ts.day, r.rows, r.current) for r in seen if r.table == "orders"} == {(26, 2, False), (27, 3, True)}
    fresh = publish.published_freshness(spark, root).first()
    assert (fresh.refreshed_at, fresh.distinct_vintages) == (dt.datetime(2026, 8, 27, 6), 1)
    assert publish.damaged_tables(spark, root).count() == 0
    folder = f"{publish.current_run(spark, root)}/orders"
    part = next(f for f in os.listdir(folder) if f.endswith(".parquet"))
    os.remove(os.path.join(folder, part))
    assert [r.table for r in publish.damaged_tables(spark, root).collect()] == ["orders"]


def test_refusals_show_the_row(spark, tmp_path):
    bad = _orders(spark, range(2)).withColumn("lt", F.when(F.col("lt") != "101", F.col("lt")))
    with pytest.raises(quality.PublishError, match=r"'lt' \(one is lt=NULL, day=2026-08-26\)"):
        publish.refresh(spark, bad, str(tmp_path / "pub"), "2026-08-27 06:00:00")
    t = tables_for(spark)
    t["orders"] = t["orders"].withColumn("run_ts", F.when(F.col("lt") != "101", F.col("run_ts")))
    with pytest.raises(quality.PublishError, match="'run_ts' .one is lt=101, day=2026-08-26"):
        quality.validate(t)


def test_day_text_is_a_gate(spark, tmp_path):
    t = tables_for(spark)
    t["daily_total"] = t["daily_total"].withColumn("day_text", F.lit("2026-08-25T00:00:00Z"))
    quality.validate(t)
    t["daily_total"] = t["daily_total"].withColumn("day_text", F.lit("25 August"))
    with pytest.raises(quality.PublishError, match="daily_total: day_text '25 August'"):
        publish.full_refresh(spark, t, str(tmp_path / "pub"))


def test_refresh_makes_all_cubes_in_one_pass(spark, tmp_path, monkeypatch):
    """The written orders are shuffled for all cubes at once, and nothing but
    the tables and their manifest stays in the run."""
    passes = []
    one = cubes.all_cubes_one_pass
    monkeypatch.setattr(cubes, "all_cubes_one_pass", lambda *a, **k: passes.append(k) or one(*a, **k))
    root = str(tmp_path / "pub")
    o = make_orders(spark, [dict(order_create_time=T0 + d * DAY, lt=str(100 + n), src_trader_address=w, resolver_id=r)
                            for n, (d, w, r) in enumerate([(0, "a", "x"), (0, "a", "y"), (0, "b", "x"), (1, None, "x"), (2, "a", None)])])
    publish.refresh(spark, o, root, "2026-08-26 06:00:00")
    assert len(passes) == 1
    assert set(os.listdir(publish.current_run(spark, root))) == {*schemas.TABLES, publish.MANIFEST}
    for t in schemas.CUBE_DIMENSIONS:
        want = publish.published_frame(t, cubes.named_cube(o, t), "2026-08-26 06:00:00")
        assert sorted(map(str, publish.read_table(spark, root, t).select(want.columns).collect())) == sorted(map(str, want.collect())), t


def _shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_refresh_drops_its_shuffles_after_each_step(spark, tmp_path, monkeypatch):
    """What a step shuffled is off the disks once its table is written."""
    before, left, setting = _shuffle_files(spark), [], spark.conf.get(publish.DROP_SHUFFLES, None)

    def watched(step):
        def run(*a, **k):
            until = time.time() + 20  # files go in the background
            while (files := _shuffle_files(spark) - before) and time.time() < until:
                time.sleep(0.2)
            left.append(files)
            return step(*a, **k)
        return run

    monkeypatch.setattr(cubes, "all_cubes_one_pass", watched(cubes.all_cubes_one_pass))  # after the orders
    monkeypatch.setattr(quality, "check_health", watched(quality.check_health))  # after the cubes
    o = _orders(spark, range(3)).repartition(3, "lt")
    publish.refresh(spark, o, str(tmp_path / "pub"), "2026-08-26 06:00:00")
    assert left == [set(), set()]
    assert spark.conf.get(publish.DROP_SHUFFLES, None) == setting


def test_refresh_names_busy_days(spark, tmp_path, monkeypatch):
    """Days of more orders than a task should hold are dealt by their traders too."""
    named = []
    one = cubes.all_cubes_one_pass
    monkeypatch.setattr(cubes, "BUSY_DAY", 1)
    monkeypatch.setattr(cubes, "all_cubes_one_pass", lambda *a, **k: named.append(k["busy"]) or one(*a, **k))
    o = _orders(spark, (0, 1, 1, 2))
    root = str(tmp_path / "pub")
    publish.refresh(spark, o, root, "2026-08-29 06:00:00")
    assert named == [{dt.date(2026, 8, 26): 2}]
    rows = publish.read_table(spark, root, "daily_total").orderBy("day").collect()
    assert [r.finalized_orders_count for r in rows] == [1, 2, 1]


def test_orders_keep_dictionaries_only_where_values_repeat(spark, tmp_path):
    import pyarrow.parquet as pq

    root = str(tmp_path / "pub")
    o = _orders(spark, range(3)).coalesce(1).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(500)))).drop("n")
    publish.refresh(spark, o, root, "2026-08-26 06:00:00")
    folder = f"{publish.current_run(spark, root)}/orders"
    group = pq.ParquetFile(os.path.join(folder, next(f for f in os.listdir(folder) if f.endswith(".parquet")))).metadata.row_group(0)
    columns = {group.column(i).path_in_schema: group.column(i).encodings for i in range(group.num_columns)}
    assert not any("DICTIONARY" in e for c in schemas.PER_ORDER for e in columns[c])
    assert any("DICTIONARY" in e for e in columns["status"])
