"""Written intermediates in the folder that the session names for checkpoints."""

from __future__ import annotations

import sys
import types
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def folder(spark: SparkSession) -> str:
    """A new path below ``spark.checkpoint.dir``; below the warehouse where that is unset, as in tests."""
    top = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{top.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The rows of ``df`` written once and read back: lineage ends at the files, which every executor sees."""
    path = folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sampled(df: DataFrame, by: list[str], rows: int) -> DataFrame:
    """About ``rows`` rows of ``df``, those whose hash of ``by`` is low; all rows if there are no more."""
    total = df.count()
    if total <= rows:
        return df
    steps = 1 << 30
    return df.where(F.pmod(F.xxhash64(*by, F.lit(23)), F.lit(steps)) < F.lit(rows * steps // total))


def width(spark: SparkSession) -> int:
    """Number of partitions of an exchange that is asked for by name."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def per_process(name: str) -> dict:
    """A dict that lives as long as the Python process, over all tasks that it runs."""
    return sys.modules.setdefault(f"_tallyline_llm_{name}", types.ModuleType(name)).__dict__
