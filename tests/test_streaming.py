import json

import pytest

from flowcubes.operators.quality import PublishError
from flowcubes.streaming import silver
from test_ingest import order, page


def land(folder, files):
    folder.mkdir(exist_ok=True)
    for name, text in files.items():
        (folder / name).write_text(text)
    return str(folder)


def run(spark, landing, out, checkpoint, **options):
    silver.write_silver(silver.order_stream(spark, landing, **options), out, checkpoint).awaitTermination(120)


def test_stream_drops_copies_that_land_again_and_keeps_late_orders(spark, tmp_path):
    first, late = order(lt="50"), order(lt="20", order_finalize_time="1699568250", status="TRADE_STATUS_FAILED")
    landing = land(tmp_path / "in", {"page-000000.json": page(first, more=True)})
    out, checkpoint = str(tmp_path / "silver"), str(tmp_path / "ckpt")
    run(spark, landing, out, checkpoint)
    land(tmp_path / "in", {"page-000001.json": page(late, first, more=True), "page-000002.json": page(order(lt="70"), late)})
    run(spark, landing, out, checkpoint, max_files_per_trigger=1)
    land(tmp_path / "in", {"page-000003.json": json.dumps({"result": {}})})
    run(spark, landing, out, checkpoint)
    rows = silver.read_silver(spark, out).collect()
    assert sorted(r.lt for r in rows) == ["20", "50", "70"]
    cube = silver.daily_cube(silver.read_silver(spark, out)).collect()
    assert [(r.finalized_orders_count, r.filled_orders_count, r.unique_trader_wallets_estimate) for r in cube] == [(3, 2, 1)]


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    out = str(tmp_path / "silver")
    frame = spark.createDataFrame([("1", 1), ("2", 2), ("2", 2)], "lt string, lt_num long")
    for _ in range(2):
        silver.merge_batch(frame, out, 0)
    silver.merge_batch(spark.createDataFrame([("2", 2), ("x", None)], "lt string, lt_num long"), out, 1)
    assert sorted(r.lt for r in silver.read_silver(spark, out).collect()) == ["1", "2", "x"]
    assert silver.read_silver(spark, str(tmp_path / "none")) is None


def test_orders_without_lt_are_refused_whole(spark, tmp_path):
    out = str(tmp_path / "silver")
    with pytest.raises(PublishError, match="without lt"):
        silver.merge_batch(spark.createDataFrame([("1", 1), (None, None), (None, None)], "lt string, lt_num long"), out, 0)
    assert silver.read_silver(spark, out) is None


def test_daily_cube_over_a_stream_of_the_table(spark, tmp_path):
    out = str(tmp_path / "silver")
    landing = land(tmp_path / "in", {"p-1.json": page(*[order(lt=str(i), src_trader_address={"solis": f"w{i % 2}"}) for i in range(4)])})
    run(spark, landing, out, str(tmp_path / "c1"))
    stream = spark.readStream.schema(spark.read.parquet(out).schema).parquet(out)
    q = (silver.daily_cube(stream).writeStream.format("memory").queryName("daily_cube_test").outputMode("complete")
         .option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    r = spark.sql("select * from daily_cube_test").collect()[-1]
    assert (r.src_chain_id, r.finalized_orders_count, r.unique_trader_wallets_estimate) == ("solis", 4, 2)
