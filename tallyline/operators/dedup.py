"""Which row of a key survives."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import WindowSpec
from pyspark.sql import functions as F

from tallyline.operators.skew import ROWS_PER_SALT, HeavyKeys


def latest_first(*columns: str) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in columns]


def _follows(window: WindowSpec) -> Column:
    """True on every row of a window's partition but the first."""
    return F.lag(F.lit(True), 1, False).over(window)


def flag_duplicates(
    df: DataFrame,
    key: Sequence[str],
    order_by: Sequence[Column] = (),
    heavy: HeavyKeys | None = None,
    flag: str = "is_duplicate_key",
    tie_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``flag``: false on the one surviving row of each key, true on the rest.

    Null keys form one group. Rows that tie on ``order_by`` are told apart by their content
    (``tie_columns``, by default every column), so the same input always splits the same way.

    A heavy key is ranked in two rounds: first inside slices of about a million rows, cut by a hash
    of the content, then only the slice winners against each other. All rows take the same plan, so
    the input is read once. Slicing cannot change the outcome because rows are totally ordered by
    content and identical rows are interchangeable.

    A row is a duplicate when another one stands before it. Asked as a rank, Spark would sort every task's rows once more
    before the shuffle, to drop lower ranks there, which gains nothing where most keys stand once.
    """
    compared = list(tie_columns or df.columns)
    total_order = [*order_by, *[F.col(c).asc_nulls_first() for c in compared]]
    by_key = [F.col(k) for k in key]
    if not heavy:
        return df.withColumn(flag, _follows(W.partitionBy(*by_key).orderBy(*total_order)))

    slice_of = F.pmod(F.xxhash64(*compared), F.lit(heavy.salts(ROWS_PER_SALT))).cast("int")
    sliced = df.withColumn("_slice", F.when(heavy.matches(key), slice_of).otherwise(-1))
    in_slice = W.partitionBy(*by_key, "_slice").orderBy(*total_order)
    ranked = sliced.withColumn("_place", F.row_number().over(in_slice))
    # winners of slices meet under one label; all other rows stay with the slice they were in
    round_two = F.when(F.col("_place") == 1, F.lit(-1)).otherwise(F.col("_slice"))
    final = W.partitionBy(*by_key, round_two).orderBy("_place", *total_order)
    out = ranked.withColumn(flag, (F.col("_place") > 1) | _follows(final))
    return out.drop("_slice", "_place")


def keep_latest(
    df: DataFrame,
    key: Sequence[str],
    order_by: Sequence[Column] = (),
    heavy: HeavyKeys | None = None,
) -> DataFrame:
    """The surviving row of each key."""
    if not heavy:  # a plain top-1, which Spark cuts down to one row per key before the shuffle
        total = [*order_by, *[F.col(c).asc_nulls_first() for c in df.columns]]
        first = W.partitionBy(*[F.col(k) for k in key]).orderBy(*total)
        return df.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").drop("_rank")
    flagged = flag_duplicates(df, key, order_by, heavy, flag="_dup")
    return flagged.filter(~F.col("_dup")).drop("_dup")
