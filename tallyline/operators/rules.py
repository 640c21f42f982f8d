"""Record rules: every failing rule leaves a reason, and failing rows go to quarantine whole.

A rule is a string Column: the reason when the row breaks the rule, null otherwise. Set tests
keep SQL's three-valued logic, so a null value breaks only the rules about missing values.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyline.functions.text import as_column
from tallyline.operators.dedup import flag_duplicates
from tallyline.operators.skew import HeavyKeys, heavy_keys, lookup_join

REASONS = "all_reasons"
QUARANTINED = "is_quarantined"
DUPLICATE = "is_duplicate_key"


def _missing(value: Column) -> Column:
    return value.isNull() | (value == "")


def _given(value: Column) -> Column:
    return value.isNotNull() & (value != "")


def reason_when(condition: Column, reason: str, shown: Column | str | None = None) -> Column:
    """The general rule: ``reason`` (followed by the shown value) when ``condition`` holds."""
    text = F.lit(reason) if shown is None else F.concat(F.lit(reason), as_column(shown))
    return F.when(condition, text)


def required(value: Column | str, reason: str) -> Column:
    """Null or blank text."""
    return reason_when(_missing(as_column(value)), reason)


def not_null(value: Column | str, reason: str) -> Column:
    return reason_when(as_column(value).isNull(), reason)


def any_of_required(values: Sequence[Column | str], reason: str) -> Column:
    return reason_when(F.coalesce(*[as_column(v) for v in values]).isNull(), reason)


def parseable_if_present(raw: Column | str, parsed: Column | str, reason: str) -> Column:
    return reason_when(_given(as_column(raw)) & as_column(parsed).isNull(), reason, raw)


def in_lookup(raw: Column | str, found: Column | str, reason: str, blank_ok: bool = True) -> Column:
    """Raw value present but the lookup gave nothing."""
    present = _given(as_column(raw)) if blank_ok else as_column(raw).isNotNull()
    return reason_when(present & as_column(found).isNull(), reason, raw)


def allowed_values(value: Column | str, allowed: Iterable[str], reason: str) -> Column:
    return reason_when(~as_column(value).isin(*allowed), reason, value)


def matches_regex(value: Column | str, pattern: str, reason: str) -> Column:
    return reason_when(~as_column(value).rlike(pattern), reason, value)


def positive(value: Column | str, reason: str) -> Column:
    return reason_when(as_column(value) <= 0, reason)


def missing_or_not_positive(value: Column | str, reason: str) -> Column:
    return reason_when(as_column(value).isNull() | (as_column(value) <= 0), reason)


def non_negative(value: Column | str, reason: str) -> Column:
    """Null or below zero."""
    return reason_when(as_column(value).isNull() | (as_column(value) < 0), reason)


def non_zero(value: Column | str, reason: str) -> Column:
    return reason_when(as_column(value) == 0, reason)


def conditional_required(when: Column, value: Column | str, reason: str) -> Column:
    return reason_when(when & as_column(value).isNull(), reason)


def found_in_parent(value: Column | str, found: str, reason: str) -> Column:
    """Reference given but not among the parent's passed rows (see ``References``)."""
    return reason_when(as_column(value).isNotNull() & ~F.col(found), reason, value)


@dataclass(frozen=True)
class References:
    """``column`` must appear as ``parent_key`` in ``parent``, where that key is unique.

    ``carry`` maps columns of the parent to the names they take in the checked rows.
    """

    column: str
    parent: DataFrame
    parent_key: str
    flag: str
    carry: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class RecordChecks:
    """All checks on one source. ``rules`` are listed in the order their reasons appear."""

    key: tuple[str, ...]
    duplicate_reason: str
    rules: tuple[Column, ...]
    order_by: tuple[Column, ...] = ()
    references: tuple[References, ...] = ()


def validate(
    typed: DataFrame,
    checks: RecordChecks,
    heavy: Sequence[HeavyKeys] | None = None,
    **heavy_options,
) -> DataFrame:
    """Add ``validation_errors``, ``is_duplicate_key``, ``is_quarantined`` and ``all_reasons``.

    The survivor of a key is chosen among all its rows, valid or not, so a key whose newest row
    is invalid loses its older rows too. Cost: one lookup join per reference, one shuffle for
    the duplicates, one projection for all rules. Heavy keys (also null ones) are processed in
    slices; unless given (for the key, then for each reference) they are measured here, on the
    key columns alone.
    """
    measured = heavy or heavy_keys(
        typed, checks.key, *[[r.column] for r in checks.references], **heavy_options
    )
    data_columns = typed.columns
    rows = typed
    for reference, heavy in zip(checks.references, measured[1:], strict=True):
        known = reference.parent.select(
            F.col(reference.parent_key).alias(reference.column), F.lit(True).alias(reference.flag),
            *[F.col(old).alias(new) for old, new in reference.carry.items()],
        )
        rows = lookup_join(rows, known, [reference.column], heavy)
        rows = rows.withColumn(reference.flag, F.coalesce(reference.flag, F.lit(False)))
    rows = flag_duplicates(
        rows, checks.key, checks.order_by, measured[0], DUPLICATE, tie_columns=data_columns
    )
    # rows are split by the rules themselves: a list of reasons is built for rows that break one
    broken = reduce(Column.__or__, [rule.isNotNull() for rule in checks.rules], F.lit(False))
    none = F.array().cast("array<string>")
    errors = F.when(broken, F.array_compact(F.array(*checks.rules))).otherwise(none)
    duplicate = F.when(F.col(DUPLICATE), F.array(F.lit(checks.duplicate_reason))).otherwise(none)
    return (
        rows.withColumn("validation_errors", errors)
        # one predicate, not a list of rules: Spark would test those on the key before the duplicates too, on every row, and read a
        # table that feeds two sources once for each
        .withColumn(QUARANTINED, F.greatest(broken, F.col(DUPLICATE)))
        .withColumn(REASONS, F.concat("validation_errors", duplicate))
    )


def passed(checked: DataFrame, columns: Sequence[Column | str] | None = None) -> DataFrame:
    rows = checked.filter(~F.col(QUARANTINED))
    return rows.select(*columns) if columns else rows


def quarantine(
    checked: DataFrame, columns: Sequence[Column | str], stamp: bool = True
) -> DataFrame:
    """Failing rows: the identifying columns, all reasons and, unless left out, a time stamp."""
    extra = [F.current_timestamp().alias("quarantined_at")] if stamp else []
    return checked.filter(QUARANTINED).select(
        *columns, F.col(REASONS).alias("quarantine_reasons"), *extra
    )


_COUNTS = "source_name string, raw_count long, passed_count long, quarantined_count long"


def observed(checked: DataFrame) -> tuple[DataFrame, Observation]:
    """``checked`` and the counts of its rows, passed and quarantined, which are known once it has been written whole."""
    counts = Observation()
    rows = checked.observe(
        counts, F.count(F.lit(1)).alias("raw_count"), F.count_if(~F.col(QUARANTINED)).alias("passed_count"),
        F.count_if(QUARANTINED).alias("quarantined_count"))
    return rows, counts


def dq_summary(
    spark: SparkSession, counts: Mapping[str, Observation], raw_counts: Mapping[str, int] | None = None
) -> DataFrame:
    """Rows in, passed and quarantined per source, as ``observed`` while they were written: no scan of its own.

    ``raw_counts`` are counted elsewhere, to hold what was written against what came in.
    """
    rows = [
        (source, (raw_counts or seen.get)[source if raw_counts else "raw_count"], seen.get["passed_count"],
         seen.get["quarantined_count"])
        for source, seen in counts.items()
    ]
    return spark.createDataFrame(rows, _COUNTS)


def stored_dq_summary(tables: Mapping[str, tuple[DataFrame, DataFrame, DataFrame]]) -> DataFrame:
    """The same summary counted on the stored raw, passed and quarantine tables, which makes
    'rows in = passed + quarantined' a check of what was written, not of the plan."""
    parts = []
    for source, (raw, ok, bad) in tables.items():
        for kind, df in (("raw", raw), ("passed", ok), ("quarantined", bad)):
            parts.append(df.agg(F.count("*").alias("n")).select(
                F.lit(source).alias("source_name"), F.lit(kind).alias("kind"), "n"))
    tagged = reduce(DataFrame.unionByName, parts)
    return tagged.groupBy("source_name").agg(
        *[F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(f"{k}_count")
          for k in ("raw", "passed", "quarantined")]
    )


def reason_counts(checked: DataFrame) -> DataFrame:
    """How many rows carry each reason, the part of a reason behind a colon left out."""
    reason = F.regexp_extract("reason", r"^([^:]*)", 1)
    return (
        checked.filter(QUARANTINED)
        .select(F.explode(REASONS).alias("reason"))
        .groupBy(reason.alias("reason"))
        .agg(F.count("*").alias("row_count"))
    )
