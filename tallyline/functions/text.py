"""Text clean-up expressions. All run inside the JVM; none is a Python UDF."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


# The Unicode space separators (category Zs); tabs and line ends are not among them.
SPACES = " \u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u202f\u205f\u3000"


def trim_spaces(value: Column | str) -> Column:
    """Strip space separators at both ends, the no-break space included; tabs stay.

    Text of single bytes has no other separator than the blank, which Spark strips several times faster than a list of them.
    """
    text = as_column(value)
    return F.when(F.octet_length(text) == F.char_length(text), F.trim(text)).otherwise(F.trim(text, F.lit(SPACES)))


def blank_to_null(value: Column | str) -> Column:
    return F.nullif(trim_spaces(value), F.lit(""))


def phone_digits(value: Column | str) -> Column:
    """Keep digits and plus signs; an empty result is null. Country codes are not folded."""
    return F.nullif(F.regexp_replace(as_column(value), "[^0-9+]", ""), F.lit(""))


def whole_number(value: Column | str) -> Column:
    """Digits that a spreadsheet took for a number, without the ``.0`` it put behind them."""
    return F.regexp_replace(as_column(value), r"^([0-9]+)\.0$", "$1")


def document_code(value: Column | str) -> Column:
    """Upper-case letters and digits only, so punctuation and case never separate equal ids."""
    return F.nullif(F.upper(F.regexp_replace(as_column(value), "[^A-Za-z0-9]", "")), F.lit(""))


def name_key(value: Column | str) -> Column:
    """Order- and punctuation-free form of a name: its lower-case tokens, sorted."""
    letters = F.regexp_replace(F.lower(trim_spaces(value)), "[^a-z ]", "")
    tokens = F.array_remove(F.split(letters, " "), "")
    return F.nullif(F.array_join(F.array_sort(tokens), " "), F.lit(""))


def _lookup(mapping: Mapping[str, str], key: Column) -> Column:
    """Value of a literal map, null when absent. A map keeps generated code small, which matters:
    the JVM never compiles very long methods."""
    return F.create_map(*[F.lit(text) for pair in mapping.items() for text in pair])[key]


def upper_code(value: Column | str, aliases: Mapping[str, str] | None = None) -> Column:
    """Trimmed upper-case code; listed aliases become their canonical code, others pass through."""
    code = F.upper(trim_spaces(value))
    known = code
    for alias, canonical in (aliases or {}).items():
        known = F.when(code == alias, F.lit(canonical)).otherwise(known)
    return known


def fold_values(value: Column | str, canonical: Mapping[str, str]) -> Column:
    """Map known spellings (compared trimmed, lower-case); anything else is null."""
    return _lookup(canonical, F.lower(trim_spaces(value)))


def fold_prefix(value: Column | str, canonical: Mapping[str, str]) -> Column:
    """Map by prefix (compared trimmed, lower-case); the first listed prefix wins, else null."""
    spelling = F.lower(trim_spaces(value))
    folded = F.lit(None).cast("string")
    for prefix, target in reversed(list(canonical.items())):
        folded = F.when(spelling.startswith(prefix), F.lit(target)).otherwise(folded)
    return folded
