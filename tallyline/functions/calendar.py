"""Calendar expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyline.functions.text import as_column


def month_of(value: Column | str) -> Column:
    """``yyyy-MM`` bucket of a date or zone-free timestamp."""
    return F.date_format(as_column(value), "yyyy-MM")


def completed_years(birth: Column | str, as_of: dt.date) -> Column:
    """Whole years of age on ``as_of``; a 29 February birthday falls on 28 February."""
    born = as_column(birth)
    day = F.lit(as_of)
    years = F.year(day) - F.year(born)
    not_yet = F.add_months(born, years * 12) > day
    return years - F.when(not_yet, 1).otherwise(0)


def is_under_age(birth: Column | str, as_of: dt.date, age: int = 18) -> Column:
    return completed_years(birth, as_of) < age
