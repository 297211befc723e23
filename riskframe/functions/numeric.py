"""Small numeric column helpers shared by all operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def np_round(value: Column, places: int) -> Column:
    """Scale, round half to even, scale back: the rounding of array libraries.

    ``F.round`` rounds half up on the decimal form and differs in some last digits.
    """
    scale = F.lit(float(10**places))
    return F.rint(value * scale) / scale


def safe_ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom`` as double, 0.0 where it is undefined."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def as_number(value: Column) -> Column:
    """Anything to double; text that is no number, and NaN, become null."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number), number)


def clamp(value: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))


def hash_rank(key: Column, seed: int) -> Column:
    """Repeatable pseudo-random number of a row, a long in [0, 2**52).

    52 bits, so that it is exact as a double too.
    """
    return F.shiftrightunsigned(F.xxhash64(key, F.lit(seed)), 12)


def md5_rank(key: Column, seed: int) -> Column:
    """Repeatable pseudo-random text key that other SQL engines compute as well."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")).cast("binary"))


def share_of(flag: Column) -> Column:
    """Aggregate: share of rows where the condition holds (null counts as no)."""
    return F.avg(F.coalesce(flag, F.lit(False)).cast("double"))


def count_of(flag: Column) -> Column:
    """Aggregate: number of rows where the condition holds."""
    return F.coalesce(F.sum(F.coalesce(flag, F.lit(False)).cast("long")), F.lit(0).cast("long"))
