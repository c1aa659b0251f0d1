from pyspark.sql import functions as F

from flowcubes.functions.address import evm_key, ton_raw, ton_raw_if, truncate_label


def one(spark, col, value, schema="a string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).collect()[0].r


def test_friendly_to_raw(spark):
    raw = one(spark, ton_raw(F.col("a")), "EQCxE6mUtQJKFnGfaROTKOt1lZbDiiX1kCixRv7Nw2Id_sDs")
    assert raw.startswith("0:B113A994")
    assert len(raw) == 2 + 64


def test_raw_only_on_friendly_chain(spark):
    df = spark.createDataFrame([("bnb", "0x55d3"), ("ton", None)], "c string, a string")
    assert [r.r for r in df.select(ton_raw_if(F.col("c"), F.col("a")).alias("r")).collect()] == [None, None]


def test_evm_key_strips_prefix_and_rejects_bad_hex(spark):
    assert bytes(one(spark, evm_key(F.col("a")), "0x55d3")) == bytes.fromhex("55d3")
    assert one(spark, evm_key(F.col("a")), "0xzz") is None
    assert one(spark, evm_key(F.col("a")), "EQCxE6mU") is None


def test_truncate_label(spark):
    assert one(spark, truncate_label(F.col("a"), 6, 4), "0x1234567890abcdef") == "0x1234…cdef"
    assert one(spark, truncate_label(F.col("a"), 10), "EQDE_TwS_abcdefgh") == "EQDE_TwS_a…"
    assert one(spark, truncate_label(F.col("a"), 6, 4), None) is None
