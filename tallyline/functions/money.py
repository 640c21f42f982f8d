"""Amount arithmetic that does not depend on row order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyline.functions.text import as_column

_EXACT = "decimal(28,4)"


def exact_sum(amount: Column | str) -> Column:
    """Sum of doubles through decimals, so that shuffles and retries cannot change it.

    A group holding an amount no decimal can hold (nan, inf, beyond 24 digits) falls back to
    the plain double sum instead of losing that amount.
    """
    value = as_column(amount)
    exact = value.try_cast(_EXACT)
    unfit = F.count_if(value.isNotNull() & exact.isNull())
    return F.when(unfit == 0, F.sum(exact).cast("double")).otherwise(F.sum(value))


def exact_avg(amount: Column | str) -> Column:
    value = as_column(amount)
    return F.try_divide(exact_sum(value), F.count(value).cast("double"))


def round_half_away(amount: Column | str, digits: int = 2) -> Column:
    """Round on the double grid: scale, round half away from zero, scale back."""
    scale = float(10**digits)
    return F.round(as_column(amount) * F.lit(scale)) / F.lit(scale)


def safe_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Division that yields null on a zero divisor instead of raising."""
    return F.try_divide(as_column(numerator), as_column(denominator))
