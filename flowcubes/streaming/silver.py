"""Incremental silver: landed order pages -> flat orders, as a stream.

The batch refresh recomputes everything; this is the same strict flatten
applied to new landing files only. Copies of an order are dropped against the
silver table itself, by ``lt``, however late they land: there is no watermark,
so an order that finalizes days after the others, and a back-fill, arrive
whole. Each micro-batch owns a folder that a retry replaces, so a restart or a
lost executor neither loses nor repeats rows.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..operators import ingest
from ..operators.quality import PublishError
from ..session import ensure_checkpoint_dir


def order_stream(spark: SparkSession, landing: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Flat orders from new page files, in the order in which they land."""
    reader = spark.readStream.option("wholetext", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    pages = ingest.page_texts(reader.text(landing), name=F.col("_metadata.file_path"))
    return ingest.with_silver_keys(ingest.flatten_orders(ingest.explode_order_pages(pages)))


def merge_batch(batch: DataFrame, path: str, batch_id: int) -> None:
    """Write a batch's orders that the table does not hold yet. Only ``lt``
    values of the batch's own range are read back. Orders without ``lt`` cannot be
    told from one another: a batch that holds one is refused as a whole, before
    anything is written."""
    spark = batch.sparkSession
    if not batch.where(F.col("lt").isNull()).isEmpty():
        raise PublishError(f"batch {batch_id} has orders without lt; refusing to merge it")
    new = batch.dropDuplicates(["lt"])
    bounds = new.agg(F.min("lt_num").alias("low"), F.max("lt_num").alias("high"), F.count(F.lit(1)).alias("rows"),
                     F.count_if(F.col("lt_num").isNull()).alias("odd")).first()
    if not bounds["rows"]:
        return
    held = read_silver(spark, path)
    if held is not None:
        held = held.where(F.col("batch") != F.lit(batch_id))
        if not bounds["odd"]:
            held = held.where(F.col("lt_num").between(bounds["low"], bounds["high"]))
        new = new.join(held.select("lt"), "lt", "left_anti")
    new.select(*batch.columns).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def read_silver(spark: SparkSession, path: str) -> DataFrame | None:
    """The table written so far; None before the first batch."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder) or not any(s.getPath().getName().startswith("batch=") for s in fs.listStatus(folder)):
        return None
    return spark.read.parquet(path)


def daily_cube(silver: DataFrame) -> DataFrame:
    """Orders and settled orders per creation day and chain pair, with an
    approximate wallet count, over a silver table or a stream of one (its state
    is one row per day and pair, kept for good, so late orders always count)."""
    return silver.groupBy("day", "src_chain_id", "dst_chain_id").agg(
        F.count(F.lit(1)).alias("finalized_orders_count"),
        F.count_if(F.col("status") == F.lit(schemas.FILLED)).alias("filled_orders_count"),
        F.approx_count_distinct("src_trader_address").alias("unique_trader_wallets_estimate"),
    )


def write_silver(orders: DataFrame, path: str, checkpoint: str | None = None,
                 once: bool = True) -> StreamingQuery:
    """Merge new orders into a parquet table. The stream's checkpoint lives
    under the session's shared ``spark.checkpoint.dir`` unless given, in a
    folder that the path alone determines, so a restart finds it."""
    spark = orders.sparkSession
    name = hashlib.sha256(path.encode()).hexdigest()[:32]
    writer = (
        orders.writeStream.foreachBatch(lambda batch, batch_id: merge_batch(batch, path, batch_id))
        .option("checkpointLocation", checkpoint or f"{ensure_checkpoint_dir(spark)}/silver-{name}")
    )
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
