"""Forgiving casts: text that does not parse becomes null, never an ANSI error.

Spark's own casts accept a few spellings the reference engine refuses (bare years, type
suffixes) and refuse a few it accepts (slashes in dates), so each text is first matched
against the accepted shape and only then cast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyline.functions.text import as_column, trim_spaces

# no group is captured and letters are listed in both cases, which the JVM matches faster
_DIGITS = r"[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"
_FINITE = rf"^\s*{_DIGITS}\s*$"
_NUMBER = rf"^\s*(?:{_DIGITS}|[+-]?(?:[nN][aA][nN]|[iI][nN][fF](?:[iI][nN][iI][tT][yY])?))\s*$"
_DAY = r"[0-9]{4}[-/][0-9]{1,2}[-/][0-9]{1,2}"
_CLOCK = r"[T ][0-9]{1,2}:[0-9]{1,2}(?::[0-9]{1,2}(?:\.[0-9]+)?)?"
_ZONE = r"(?:Z|UTC|[+-][0-9]{2}(?::[0-9]{2})?)"
_STAMP = rf"^\s*{_DAY}(?:{_CLOCK}\s*{_ZONE}?\s*)?$"
_DATE = rf"^\s*{_DAY}(?:{_CLOCK}\s*{_ZONE}?)?\s*$"
_DATE_FORMATS = {  # accepted day layouts and the exact text shape each one requires
    "yyyy-M-d": r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$",
    "d/M/yyyy": r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$",
}


def _without(text: Column, separator: str) -> Column:
    return F.replace(text, F.lit(separator), F.lit(""))


def parse_number(value: Column | str, finite: bool = False) -> Column:
    """Number as double; thousands separators (comma, space) are dropped.

    ``nan`` and ``inf`` parse unless ``finite`` is set.
    """
    text = _without(_without(as_column(value), ","), " ")
    return F.when(text.rlike(_FINITE if finite else _NUMBER), text.try_cast("double"))


def parse_integer(value: Column | str) -> Column:
    """Whole number; a fraction rounds half away from zero, out-of-range text is null."""
    text = as_column(value)
    return F.when(text.rlike(_FINITE), F.round(text.try_cast("double")).try_cast("int"))


def parse_date(value: Column | str, formats: Sequence[str] = ("yyyy-M-d",)) -> Column:
    """First of ``formats`` that the trimmed text satisfies in full."""
    text = trim_spaces(value)
    return F.coalesce(
        *[F.when(text.rlike(_DATE_FORMATS[f]), F.try_to_date(text, f)) for f in formats]
    )


def _wall_clock(text: Column) -> Column:
    """Shape-checked text as zone-free timestamp: the cast keeps the digits, whatever the offset."""
    return F.replace(text, F.lit("/"), F.lit("-")).try_cast("timestamp_ntz")


def parse_cast_date(value: Column | str) -> Column:
    """Date out of year-month-day text with an optional time of day behind it."""
    text = as_column(value)
    return F.when(text.rlike(_DATE), _wall_clock(text).cast("date"))


def parse_timestamp(value: Column | str, zone: str | None = None) -> Column:
    """Timestamp without zone.

    By default the wall-clock digits are kept and a written offset is ignored, as in the
    reference. With ``zone`` the offset is honoured (missing means UTC) and the wall clock
    of that zone is returned.
    """
    text = as_column(value)
    wall = _wall_clock(text)
    if zone is not None:
        written = F.regexp_extract(text, r"([+-][0-9]{2}(:[0-9]{2})?)\s*$", 1)
        offset = (
            F.when(~text.contains(":") | (written == ""), "UTC")
            .when(F.length(written) == 3, F.concat(written, F.lit(":00"))).otherwise(written)
        )
        wall = F.convert_timezone(offset, F.lit(zone), wall)
    return F.when(text.rlike(_STAMP), wall)
