"""Rounding that every engine computes alike: plain arithmetic, halves up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(value: Column, digits: int) -> Column:
    scale = F.lit(float(10**digits))
    return F.floor(value * scale + F.lit(0.5)).cast("double") / scale


def or_default(value: Column, default: float) -> Column:
    """The value, or the default where it is null or zero."""
    return F.coalesce(F.nullif(value, F.lit(0.0)), F.lit(float(default)))


def exact_mean(value: Column, digits: int = 6) -> Column:
    """The mean of an aggregate, rounded half up, whatever the order of its rows.

    Values enter as whole trillionths, so the sum and the rounding are integer arithmetic; a sum of
    doubles would depend on which task came first.
    """
    whole = F.sum(F.round(value.cast("double") * F.lit(1e12)).cast("decimal(38,0)"))
    n, step = F.count(value).cast("decimal(20,0)"), F.lit(10 ** (12 - digits)).cast("decimal(13,0)")
    twice = (whole * 2 + n * step).cast("decimal(38,0)")
    size = (n * step * 2).cast("decimal(38,0)")
    steps = F.try_divide(twice - F.pmod(twice, size), size)
    return F.when(F.count(value) > 0, steps.cast("double") / F.lit(float(10**digits)))


def plain_number(value: Column, digits: int = 2) -> Column:
    """Text of a double with fixed digits, rounded from its binary value: 1.005 is 1.00, 0.125 is 0.12."""
    return F.call_function("format_number", value.cast("double"), F.lit("0." + "0" * digits))
