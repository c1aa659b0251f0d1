"""A bitmap of keys that cuts a large table before it is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a bitmap of the built-in aggregate (4 KB each).
BUCKET = 1 << 15


def _slot(key: Column, bits: int) -> Column:
    return F.xxhash64(key).bitwiseAND(F.lit((1 << bits) - 1))


def cut_by_keys(rows: DataFrame, key: str, keys: DataFrame, bits: int = 24) -> DataFrame:
    """The rows whose ``key`` may be among ``keys`` (a frame with that column): all
    that are, and about one in ``2**bits / number of keys`` of the others. NULL
    is no key.

    The bitmap is built by a grouped aggregate and broadcast as rows of 4 KB,
    ``2**bits / 8`` bytes in all, however many keys there are (2 MB by default);
    what is dropped is dropped where it is read. An exact join has to follow."""
    slot = _slot(F.col(key), bits)
    maps = keys.where(F.col(key).isNotNull()).select(slot.alias("_prefilter_slot")).groupBy(F.floor(F.col("_prefilter_slot") / BUCKET).alias("_prefilter_bucket")).agg(
        F.bitmap_construct_agg(F.col("_prefilter_slot") % BUCKET).alias("_prefilter_map"))
    probed = rows.where(F.col(key).isNotNull()).withColumn("_prefilter_bucket", F.floor(slot / BUCKET)).withColumn("_prefilter_at", (slot % BUCKET).cast("int"))
    byte = F.conv(F.hex(F.expr("substring(_prefilter_map, _prefilter_at div 8 + 1, 1)")), 16, 10).cast("int")
    held = F.getbit(byte, F.pmod(F.col("_prefilter_at"), F.lit(8))) == 1
    return probed.join(F.broadcast(maps), "_prefilter_bucket").where(held).select(*rows.columns)
