"""Exact sums of 256-bit units against Python integers."""

import random

import pytest
from pyspark.sql import functions as F

from flowcubes.functions.wide import placed, sum_units

TOP = 2**256 - 1


def _total(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "u string").repartition(4)
    return df.agg(sum_units(F.col("u")).alias("s")).first()[0]


def test_sums_of_wide_units(spark):
    rnd = random.Random(3)
    wide = [rnd.randrange(10 ** rnd.choice([1, 25, 26, 27, 39, 52, 53, 60, 77])) for _ in range(3000)] + [TOP] * 500
    assert _total(spark, [str(n) for n in wide]) == str(sum(wide))


@pytest.mark.parametrize("texts, want", [
    (["9" * 78] * 3, str(3 * (10**78 - 1))),
    (["9" * 26, "1"], str(10**26)), (["9" * 52, "1"], str(10**52)),
    (["0", "000"], "0"), (["0" * 90 + "7"], "7"), (["5", None, "", "-3", "x", "1.5"], "5"),
    ([None, "-1"], None), ([], None),
])
def test_carries_and_odd_texts(spark, texts, want):
    assert _total(spark, texts) == want


def test_longer_units_are_refused(spark):
    with pytest.raises(Exception, match="more than 78 digits"):
        _total(spark, ["1" + "0" * 78])


@pytest.mark.parametrize("text, decimals, want", [
    (str(TOP), 18, str(TOP)[:-18] + "." + str(TOP)[-18:]), ("1500", 3, "1.5"), ("7", 0, "7"), ("0", 6, "0"),
    ("5", 60, "0." + "0" * 59 + "5"), (None, 2, None), ("3", None, None),
])
def test_placed(spark, text, decimals, want):
    df = spark.createDataFrame([(text, decimals)], "u string, d int")
    assert df.select(placed(F.col("u"), F.col("d"))).first()[0] == want
