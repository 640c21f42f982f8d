"""Run-over-run monitoring over the append-only logs.

Inputs have one row per run and thing watched, so a window here holds one row per run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def arrival_history(log: DataFrame) -> DataFrame:
    """What the arrival log says of each source and night: the verdict, a reason if any file failed, the rows counted,
    the last night on which all its files passed, and on how many nights up to then some did not."""
    failed = F.col("status") == "FAIL"
    nights = log.groupBy("night", "source").agg(
        F.when(F.max(failed), "FAIL").otherwise("PASS").alias("status"),
        F.coalesce(F.min(F.when(failed, F.col("reason"))), F.lit("")).alias("reason"),
        F.sum("row_count").alias("row_count"))
    so_far = W.partitionBy("source").orderBy("night").rowsBetween(W.unboundedPreceding, W.currentRow)
    return nights.withColumn(
        "last_good_night", F.max(F.when(F.col("status") == "PASS", F.col("night"))).over(so_far)
    ).withColumn("failed_nights", F.count_if(failed).over(so_far))


def recon_drift(
    history: DataFrame, keys: Sequence[str], run: str, verdict: str, diff: str
) -> DataFrame:
    """Figures that passed in the previous run and fail now, or fail by more than before."""
    in_time = W.partitionBy(*keys).orderBy(run)
    before = history.select(
        *keys, run, verdict, diff,
        F.lag(verdict).over(in_time).alias("_passed"),
        F.lag(F.abs(diff)).over(in_time).alias("_size"),
    )
    fails = ~F.col(verdict)
    newly = fails & F.col("_passed")
    grows = fails & ~F.col("_passed") & (F.abs(diff) > F.col("_size"))
    return before.withColumn(
        "drift", F.when(newly, "newly failing").when(grows, "failing by more")
    ).filter(F.col("drift").isNotNull()).select(*keys, run, diff, "drift")


def quarantine_spike(
    history: DataFrame, source: str, run: str, count: str, window: int = 7, factor: float = 2.0
) -> DataFrame:
    """Runs whose quarantine count exceeds ``factor`` times the mean of the runs before it."""
    trailing = W.partitionBy(source).orderBy(run).rowsBetween(-window, -1)
    return history.select(
        source, run, count, F.avg(count).over(trailing).alias("trailing_avg")
    ).filter(F.col(count) > F.col("trailing_avg") * factor)


def open_items(queue: DataFrame, cleared: DataFrame, key: Sequence[str]) -> DataFrame:
    """Queue rows without a recorded decision."""
    return queue.join(cleared.select(*key).distinct(), list(key), "left_anti")


def queue_growth(history: DataFrame, queue: str, run: str, open_count: str) -> DataFrame:
    """Runs at which a queue holds more open items than the run before."""
    in_time = W.partitionBy(queue).orderBy(run)
    previous = F.lag(open_count).over(in_time)
    return history.select(
        queue, run, open_count, (F.col(open_count) - previous).alias("growth")
    ).filter("growth > 0")


def run_reliability(runs: DataFrame, day: str, completed: str, days: int = 30) -> DataFrame:
    """Share of runs that completed in the ``days`` up to each run day.

    Every day's counts are added to the windows they belong to, so that this is a grouping and
    not one global window.
    """
    per_day = runs.groupBy(F.col(day).cast("date").alias("_on")).agg(
        F.count("*").alias("_runs"), F.count_if(completed).alias("_done")
    )
    spread = per_day.select(
        F.explode(F.sequence("_on", F.date_add("_on", days - 1))).alias("run_day"), "_runs", "_done"
    )
    rolling = spread.groupBy("run_day").agg(
        F.sum("_runs").alias("run_count"), F.sum("_done").alias("completed_count")
    )
    return rolling.join(
        per_day.select(F.col("_on").alias("run_day")), "run_day", "left_semi"
    ).withColumn("completion_rate", F.col("completed_count") / F.col("run_count"))
