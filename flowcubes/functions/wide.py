"""Exact sums of unit texts of up to 256 bits (78 digits).

A sum of decimals ends at 38 digits, and token units are unsigned 256-bit
integers. They are summed as three limbs of 26 digits, each a DECIMAL(38, 0)
with room for 10^12 rows, and joined as text, carrying digits from limb to limb.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LIMB, LIMBS = 26, 3
DIGITS = LIMB * LIMBS
_KIND = "decimal(38,0)"


def wide_units(text: Column) -> Column:
    """The units as 78 digits; NULL if they are not digits. Longer ones than
    that, zeros in front apart, are no 256-bit units and fail the job."""
    digits = F.when(text.rlike("^[0-9]+$"), F.regexp_replace(text, "^0+(?=[0-9])", ""))
    long = F.raise_error(F.concat(F.lit(f"units of more than {DIGITS} digits: "), text)).cast("string")
    return F.when(F.length(digits) > DIGITS, long).otherwise(F.lpad(digits, DIGITS, "0"))


def sum_units(text: Column) -> Column:
    """The exact sum as text of digits; NULL where no text is a number."""
    padded = wide_units(text)
    sums = [F.sum(F.substring(padded, 1 + i * LIMB, LIMB).cast(_KIND)) for i in range(LIMBS)]
    below, carry = [], F.lit(0).cast(_KIND)
    for limb in reversed(sums[1:]):
        full = F.lpad((limb + carry).cast(_KIND).cast("string"), 38, "0")
        below.insert(0, F.substring(full, 39 - LIMB, LIMB))
        carry = F.substring(full, 1, 38 - LIMB).cast(_KIND)
    joined = F.concat((sums[0] + carry).cast(_KIND).cast("string"), *below)
    return F.regexp_replace(joined, "^0+(?=[0-9])", "")


def placed(text: Column, decimals: Column) -> Column:
    """``units / 10^decimals`` as exact decimal text, without zeros at its end."""
    places = decimals.cast("int")
    digits = F.lpad(text, F.greatest(F.length(text), places + 1), F.lit("0"))
    whole, part = F.substring(digits, F.lit(1), F.length(digits) - places), F.right(digits, places)
    return F.regexp_replace(F.concat(whole, F.lit("."), part), r"\.0*$|(?<=[1-9])0+$", "")
