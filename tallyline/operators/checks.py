"""Assertions: each returns the offending rows, and no row means it holds."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_unique(df: DataFrame, key: str) -> DataFrame:
    """Values held by more than one row; nulls are not compared."""
    return (
        df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n_records"))
        .filter("n_records > 1")
    )


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def check_accepted_values(df: DataFrame, column: str, values: Iterable[str]) -> DataFrame:
    """Values outside the set with their row counts; null is accepted."""
    return (
        df.filter(~F.col(column).isin(*values)).groupBy(column)
        .agg(F.count("*").alias("n_records"))
    )


def check_relationship(
    child: DataFrame, column: str, parent: DataFrame, parent_key: str
) -> DataFrame:
    """Child values without a parent, with their row counts.

    The child is grouped before the join, so a value on a third of the rows travels once.
    """
    values = (
        child.filter(F.col(column).isNotNull()).groupBy(column)
        .agg(F.count("*").alias("n_records"))
    )
    return values.join(parent.select(F.col(parent_key).alias(column)), column, "left_anti")


def check_rows_accounted(summary: DataFrame) -> DataFrame:
    """Sources where rows in differ from passed plus quarantined."""
    return summary.filter("raw_count <> passed_count + quarantined_count")


def check_crosswalk(expected: DataFrame, links: DataFrame) -> DataFrame:
    """Source records that are not exactly once in the crosswalk.

    Both sides are counted in one grouping instead of being joined.
    """
    on = ["source_system", "source_id"]
    both = expected.select(*on, F.lit(1).alias("want"), F.lit(0).alias("have")).unionAll(
        links.select(*on, F.lit(0).alias("want"), F.lit(1).alias("have"))
    )
    return (
        both.groupBy(*on).agg(F.max("want").alias("want"), F.sum("have").alias("have"))
        .filter("want = 1 and have <> 1")
        .select(*on, F.col("have").alias("times_in_crosswalk"))
    )


def column_checks(
    df: DataFrame,
    table: str,
    not_null: Sequence[str] = (),
    accepted: Mapping[str, Iterable[str]] | None = None,
) -> DataFrame:
    """``check_name`` and ``n_bad`` of all checks on single columns of a table, from one scan."""
    bad = {f"not_null_{table}_{c}": F.col(c).isNull() for c in not_null}
    bad |= {f"accepted_values_{c}": ~F.col(c).isin(*v) for c, v in (accepted or {}).items()}
    counted = df.agg(*[F.count_if(rows).alias(name) for name, rows in bad.items()])
    lines = [
        F.struct(F.lit(name).alias("check_name"), F.col(name).alias("n_bad")) for name in bad
    ]
    return counted.select(F.inline(F.array(*lines)))


def run_checks(checks: Mapping[str, DataFrame], counted: Sequence[DataFrame] = ()) -> DataFrame:
    """One row per check: its name, the number of offending rows, and whether it passed.

    ``checks`` maps names to offending rows; ``counted`` are results of ``column_checks``.
    """
    counts = [
        offending.agg(F.count("*").alias("n_bad")).select(F.lit(name).alias("check_name"), "n_bad")
        for name, offending in checks.items()
    ]
    results = reduce(DataFrame.unionAll, [*counts, *counted])
    return results.withColumn("passed", F.col("n_bad") == 0)


def gate_verdict(results: DataFrame) -> DataFrame:
    """One row: whether everything passed, and the reason for the log."""
    failed = F.array_sort(F.collect_list(F.when(~F.col("passed"), F.col("check_name"))))
    return results.agg(failed.alias("failed")).select(
        F.when(F.size("failed") == 0, "PUBLISHED").otherwise("BLOCKED").alias("status"),
        F.when(F.size("failed") == 0, "all checks passed")
        .otherwise(F.concat(F.lit("failed checks: "), F.array_join("failed", ", ")))
        .alias("reason"),
    )


def columns_of(spark, layers: Mapping[str, Mapping[str, Sequence[str]]]) -> DataFrame:
    """Catalogue of the columns of every table of every layer (metadata only)."""
    rows = [
        (layer, table, column)
        for layer, tables in layers.items()
        for table, columns in tables.items()
        for column in columns
    ]
    return spark.createDataFrame(rows, "layer string, table_name string, column_name string")
