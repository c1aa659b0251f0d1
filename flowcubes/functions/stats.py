"""Aggregate helpers: percentiles in two modes, guarded ratios, exact sums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def percentile(column: str, p: float, exact: bool = True, accuracy: int = 10_000) -> Column:
    """The p-th percentile of a named column, as DOUBLE.

    ``exact=True`` is ``percentile_disc`` (the smallest value whose cumulative
    share reaches p). It aggregates partially per partition but keeps one count
    per distinct value of a group. ``exact=False`` is ``percentile_approx``: a
    fixed-size sketch per group with rank error about n / accuracy, the choice
    when one group can hold unboundedly many distinct values.
    """
    if exact:
        return F.expr(f"percentile_disc({p!r}) within group (order by `{column}`)").cast("double")
    return F.percentile_approx(F.col(column).cast("double"), p, accuracy).cast("double")


def ratio(num: Column, den: Column) -> Column:
    """``num / den`` as DOUBLE, NULL when the denominator is 0 or NULL."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def whole_units(text: Column) -> Column:
    """Raw units as an exact integer; NULL if they are not a number. Units of
    more than 38 digits cannot be summed exactly and fail the job."""
    digits = F.regexp_replace(text, "^0+", "")
    wide = F.concat(F.lit("units of more than 38 digits: "), text)
    return F.when(digits.rlike("^[0-9]{39,}$"), F.raise_error(wide).cast("decimal(38,0)")).otherwise(text.try_cast("decimal(38,0)"))


def shifted(text: Column, decimals: Column, kind: T.DecimalType) -> Column:
    """``units / 10^decimals`` exactly, by placing the point in the digits; NULL if
    the units are not digits or the amount does not fit ``kind``: zeros at the end
    are no digits of it, and digits below its scale are never rounded away."""
    places = decimals.cast("int")
    digits = F.when(text.rlike("^[0-9]+$"), F.lpad(text, F.greatest(F.length(text), places + 1), F.lit("0")))
    whole = F.substring(digits, F.lit(1), F.length(digits) - places)
    part = F.regexp_replace(F.right(digits, places), "0+$", "")
    return F.when(F.length(part) <= kind.scale, F.concat(whole, F.lit("."), part).try_cast(kind))


def dsum(value: Column) -> Column:
    """Exact sum (inputs are DECIMAL), published as DOUBLE."""
    return F.sum(value).cast("double")
