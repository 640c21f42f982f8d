"""Session settings the plans are written for, and how small inputs are spread."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TUNING = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # the JVM leaves methods above 8000 bytes of bytecode interpreted; wide clean-up projections
    # exceed that when fused, so let Spark split them instead
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def compiled(spark: SparkSession) -> None:
    """See that wide clean-up projections are compiled, in a session that was started without ``TUNING``."""
    limit = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.set(limit, TUNING[limit])


def spread(df: DataFrame) -> DataFrame:
    """Give every core a share of an input that arrives in too few pieces.

    One unsplittable file would keep a wide projection on one core. An input of at least as many
    pieces as there are cores, which is any large one, is left as it is and not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
