"""Exact amounts from unit texts."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowcubes.functions.stats import shifted

KIND = T.DecimalType(38, 18)


@pytest.mark.parametrize("units, decimals, want", [
    ("1999999999999999999999999", 24, None),  # not 2: its digits do not fit
    ("1999999999999999999000000", 24, "1.999999999999999999"),
    ("2000000000000000000000000", 24, "2"),
    ("123", 2, "1.23"), ("5", 3, "0.005"), ("7", 0, "7"), ("0", 30, "0"), ("1", 18, "0.000000000000000001"), ("1", 19, None),
    ("9" * 21, 0, None), ("-5", 2, None), ("", 2, None), (None, 2, None), ("12", None, None),
])
def test_shifted_never_rounds(spark, units, decimals, want):
    df = spark.createDataFrame([(units, decimals)], "u string, d int")
    assert df.select(shifted(F.col("u"), F.col("d"), KIND)).first()[0] == (None if want is None else Decimal(want))
