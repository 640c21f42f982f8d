"""Positions and running sums in a global order, without a single task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.scratch import stored, width


def running(df: DataFrame, by: list[Column], values: dict[str, Column]) -> DataFrame:
    """``df`` (narrow rows) with a column for each of ``values``: its sum over all rows before the row.

    Rows are dealt into ranges and written; each range is summed on its own and moved by the totals
    of the ranges before it, one row a range. Rows that tie stand in some fixed order among themselves.
    """
    n = width(df.sparkSession)
    own = {name: f"_value_{i}" for i, name in enumerate(values)}
    dealt = stored(df.repartitionByRange(n, *by).withColumn("_range", F.spark_partition_id())
                   .withColumns({own[name]: value for name, value in values.items()}))
    totals = dealt.groupBy("_range").agg(*[F.sum(c).alias(c) for c in own.values()])
    ahead = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range, at most n
    moved = totals.select("_range", *[F.coalesce(F.sum(c).over(ahead), F.lit(0)).alias(f"_moved{c}") for c in own.values()])
    inside = Window.partitionBy("_range").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    sums = {name: (F.col(f"_moved{c}") + F.coalesce(F.sum(c).over(inside), F.lit(0))).cast("long") for name, c in own.items()}
    return (dealt.join(F.broadcast(moved), "_range").withColumns(sums)
            .drop("_range", *own.values(), *[f"_moved{c}" for c in own.values()]))
