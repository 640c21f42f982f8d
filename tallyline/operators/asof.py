"""As-of joins: the latest right row at or before each left row, per key.

Two plans for two shapes of data:

``asof_calendar``  day grain, few keys (exchange rates). The right side becomes one row per key
    and day, and the left side finds its row by plain equality. The left side is never sorted,
    and not shuffled at all while the calendar is small enough for Catalyst to broadcast.
``asof_merge``     any grain, many keys. Left and right rows become one timeline, dealt into ranges of key and
    instant; within a range the last right value is carried forward, and over ranges by one row each. A key
    is never sorted as a whole, however many rows it has, and no left row is ever paired with more
    than one right row.

In both, a left row before the first right row of its key takes that first row and is marked as
estimated when ``fallback`` is on, and finds nothing when it is off.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyline.sources.store import scratch_root

ESTIMATED = "is_estimated"


def _points(right: DataFrame, by: Sequence[str], on: str, values: Sequence[str]) -> DataFrame:
    """One right row per key and instant; equal instants keep the greatest values."""
    keyed = right.filter(F.col(on).isNotNull()).groupBy(*by, F.col(on).alias("_at"))
    if len(values) == 1:  # a plain number aggregates by hash, a struct only after a sort
        (value,) = values
        best = keyed.agg(F.max(value).alias(value))
        return best.select(*by, "_at", F.struct(value).alias("_v"))
    return keyed.agg(F.max(F.struct(*values)).alias("_v"))


def asof_calendar(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_on: str,
    right_on: str,
    values: Sequence[str],
    fallback: bool = True,
    how: str = "left",
    broadcast_rows: int = 1_000_000,
) -> DataFrame:
    """``left`` plus ``values``, the matched ``right_on`` and ``is_estimated``.

    ``left_on`` and ``right_on`` are dates. The right side is reduced to a row per key and day
    first, so no window here sees more rows than a key has days. The calendar, and the first and
    last day per key, are broadcast when measured to have at most ``broadcast_rows`` rows; beyond
    that they are joined the way Catalyst decides.
    """
    by = list(by)
    points = _points(right, by, right_on, values)
    in_order = W.partitionBy(*by).orderBy("_at")
    spans = points.withColumn("_next", F.lead("_at").over(in_order))
    last_day = F.coalesce(F.date_sub("_next", 1), F.col("_at"))
    calendar = spans.select(
        *by, "_at", "_v", F.explode(F.sequence("_at", last_day)).alias("_day")
    )
    ends = right.filter(F.col(right_on).isNotNull()).groupBy(*by).agg(
        F.min(right_on).alias("_first"), F.max(right_on).alias("_last")
    )
    days = F.coalesce(F.sum(F.datediff("_last", "_first") + 1), F.lit(0))
    size = ends.agg(F.count("*").alias("keys"), days.alias("days")).first()
    if size["keys"] <= broadcast_rows:  # few keys: a shuffle on them would pile the left side up
        ends = F.broadcast(ends)
    if size["days"] <= broadcast_rows:
        calendar = F.broadcast(calendar)

    # a day outside the calendar looks up the nearest end; before the start that is the fallback
    probed = left.join(ends, by, "left").withColumn(
        "_day", F.greatest(F.col("_first"), F.least(F.col("_last"), F.col(left_on)))
    ).withColumn("_day", F.when(F.col(left_on).isNotNull(), F.col("_day")))
    early = F.col(left_on) < F.col("_first")
    if not fallback:
        probed = probed.withColumn("_day", F.when(~early, F.col("_day")))
    probed = probed.withColumn(ESTIMATED, early)
    joined = probed.join(calendar, [*by, "_day"], how)
    found = F.col("_at").isNotNull()
    return joined.select(
        *[F.col(c) for c in left.columns],
        *[F.col(f"_v.{v}").alias(v) for v in values],
        F.col("_at").alias(right_on),
        F.when(found, F.col(ESTIMATED)).alias(ESTIMATED),
    )


def asof_merge(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_on: str,
    right_on: str,
    values: Sequence[str],
    fallback: bool = True,
    how: str = "left",
    ranges: int | None = None,
) -> DataFrame:
    """As ``asof_calendar`` for instants.

    Both sides become one timeline, dealt into ``ranges`` of key and instant (by default as many as the session has shuffle
    partitions) and written once. A key with many rows lies in several ranges, and so do many left rows of one instant. Within a range a window
    carries the last right value on; what a range inherits from the ones before it, and the next value behind it, comes from
    one row a range with the ends of its right rows.
    """
    by = list(by)
    spark = left.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    has_key = reduce(Column.__and__, [F.col(k).isNotNull() for k in by])
    points = _points(right.filter(has_key), by, right_on, values)
    hit = F.struct(F.col("_at").alias("at"), F.col("_v").alias("v"))
    rows = left.select(*by, F.col(left_on).alias("_at"), F.lit(1).alias("_side"),
                       F.xxhash64(*left.columns).alias("_deal"), F.struct(*left.columns).alias("_row"))
    timeline = points.select(*by, "_at", F.lit(0).alias("_side"), hit.alias("_hit")).unionByName(rows, allowMissingColumns=True)
    dealt = timeline.repartitionByRange(ranges, *by, "_at", "_side", "_deal").drop("_deal")
    dealt = dealt.withColumn("_range", F.spark_partition_id())
    path = scratch_root(spark)
    dealt.write.parquet(path)
    kept = spark.read.schema(dealt.schema).parquet(path)

    here = [F.col("_range"), *[F.col(k) for k in by]]
    so_far = W.partitionBy(*here).orderBy("_at", "_side").rowsBetween(W.unboundedPreceding, W.currentRow)
    resolved = kept.withColumn("_found", F.last("_hit", ignorenulls=True).over(so_far)).withColumn(
        "_first", F.min("_hit").over(W.partitionBy(*here))).filter("_side = 1")
    joined = resolved.join(F.broadcast(_range_ends(kept, by)), "_range", "left")  # one row a range
    same_first = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_ends.before.{k}")) for k in by])
    same_last = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_ends.behind.{k}")) for k in by])
    found = F.coalesce("_found", F.when(same_first, F.col("_ends.before._hit")))
    later = F.coalesce("_first", F.when(same_last, F.col("_ends.behind._hit")))
    asked = F.col("_at").isNotNull()
    joined = joined.withColumn("_early", found.isNull()).withColumn(
        "_found", F.when(asked, F.coalesce(found, later) if fallback else found))
    hits = F.col("_found").isNotNull()
    if how == "inner":
        joined = joined.filter(hits)
    return joined.select(
        *[F.col(f"_row.{c}").alias(c) for c in left.columns],
        *[F.col(f"_found.v.{v}").alias(v) for v in values],
        F.col("_found.at").alias(right_on),
        F.when(hits, F.col("_early")).alias(ESTIMATED),
    )


def _range_ends(kept: DataFrame, by: Sequence[str]) -> DataFrame:
    """(_range, _ends): the last right row before each range, and the first one behind it, each with its key.

    Ranges follow each other in the order of key and instant, so the greatest right row of the ranges before is the one that
    a range's first key may inherit, and the least of those behind is the one its last key may look forward to. Rows of this
    table are as few as the ranges.
    """
    right = F.when(F.col("_side") == 0, F.struct(*by, "_hit"))
    ends = kept.groupBy("_range").agg(F.min(right).alias("low"), F.max(right).alias("high"))
    in_order = W.orderBy("_range")
    before = F.max("high").over(in_order.rowsBetween(W.unboundedPreceding, -1))
    behind = F.min("low").over(in_order.rowsBetween(1, W.unboundedFollowing))
    return ends.select("_range", F.struct(before.alias("before"), behind.alias("behind")).alias("_ends"))
