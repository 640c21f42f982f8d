"""Computed totals against published control totals."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def within_tolerance(diff: Column, control: Column, tolerance: float, floor: float = 1.0) -> Column:
    """|diff| up to a fraction of the control figure, and always up to ``floor``.

    A missing control figure leaves the floor alone (``greatest`` skips nulls).
    """
    return F.abs(diff) <= F.greatest(F.lit(floor), F.abs(control) * F.lit(tolerance))


def reconcile(
    control: DataFrame,
    computed: Sequence[DataFrame],
    keys: Sequence[str],
    measures: Sequence[str],
    tolerance: float = 0.005,
    floor: float = 1.0,
) -> DataFrame:
    """One row per key on either side with figures, differences and verdicts.

    ``control`` holds the keys and every measure, one row a key; each computed frame the keys and some of the
    measures, already grouped. All sides are put under each other, every figure in a column of its own, and grouped once.
    Keys are compared by equality: a row with a null key stays on its own instead of meeting other nulls.
    """
    keys, measures = list(keys), list(measures)
    lacking = reduce(Column.__or__, [F.col(k).isNull() for k in keys])

    def side(df: DataFrame, number: int, prefix: str) -> DataFrame:
        apart = F.struct(F.lit(number).alias("side"), F.monotonically_increasing_id().alias("row"))
        return df.select(*keys, F.when(lacking, apart).alias("_apart"),
                         *[F.col(m).alias(f"{prefix}_{m}") for m in measures if m in df.columns])

    sides = [side(control, 0, "control"), *[side(df, i, "computed") for i, df in enumerate(computed, 1)]]
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sides)
    figures = [f"{prefix}_{m}" for prefix in ("control", "computed") for m in measures]
    joined = every.groupBy(*keys, "_apart").agg(*[F.max(c).alias(c) for c in figures])
    diffs = {
        f"{m}_diff": F.coalesce(f"computed_{m}", F.lit(0)) - F.coalesce(f"control_{m}", F.lit(0))
        for m in measures
    }
    verdicts = {
        f"{m}_pass": within_tolerance(F.col(f"{m}_diff"), F.col(f"control_{m}"), tolerance, floor)
        for m in measures
    }
    return joined.select(*keys, *figures, *[c.alias(n) for n, c in diffs.items()]).withColumns(verdicts)


def failing(verdicts: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Rows with any measure outside its tolerance."""
    every = reduce(Column.__and__, [F.col(f"{m}_pass") for m in measures])
    return verdicts.filter(~every)
