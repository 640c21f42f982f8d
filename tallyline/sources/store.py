"""Versioned Parquet tables with one commit point.

Every write goes to a new folder; a table changes when rows naming its folders are appended to
the manifest, one small file that Spark's committer puts in place by a rename. Several tables
committed in one manifest append change together. Readers see the last committed version; a run
that dies halfway leaves only folders nobody refers to. One writer at a time is assumed.

A table that is loaded by key is laid out in buckets: rows are dealt by a hash of the key, a folder holds the rows of one
bucket, and whoever looks for some keys reads the folders of their buckets alone.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MANIFEST_SCHEMA = (
    "committed_at timestamp, version long, table_name string, path string, columns string, buckets int"
)
BUCKET = "_bucket"


@dataclass(frozen=True)
class Version:
    """Folders that make up a table, with the schema to read them by.

    With ``buckets`` each folder holds rows of one of so many buckets, and is named after it.
    """

    paths: tuple[str, ...]
    schema: StructType
    buckets: int = 0

    def of_buckets(self, numbers: Collection[int]) -> Version:
        """The part of the table that lies in these buckets."""
        return replace(self, paths=tuple(p for p in self.paths if bucket_of(p) in numbers))


def bucket_of(path: str) -> int:
    return int(path.rsplit(f"{BUCKET}=", 1)[1])


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._last_version: int | None = None

    def manifest(self) -> DataFrame:
        try:
            return self.spark.read.schema(MANIFEST_SCHEMA).parquet(f"{self.root}/_manifest")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], MANIFEST_SCHEMA)

    def current(self, table: str) -> Version | None:
        """The committed version of ``table``."""
        mine = F.struct("path", "columns", "buckets")
        of_version = (
            self.manifest().filter(F.col("table_name") == table).groupBy("version")
            .agg(F.sort_array(F.collect_list(mine)).alias("parts"))
        )
        last = of_version.agg(F.max_by("parts", "version").alias("parts")).first()["parts"]
        if last is None:
            return None
        schema = StructType.fromJson(json.loads(last[0]["columns"]))
        return Version(tuple(part["path"] for part in last), schema, last[0]["buckets"] or 0)

    def open(self, version: Version) -> DataFrame:
        """Rows of a version. The stored schema spares reading footers, fills columns an older
        folder lacks with nulls, and keeps the types of partition columns."""
        if not version.paths:
            return self.spark.createDataFrame([], version.schema)
        return self.spark.read.schema(version.schema).parquet(*version.paths)

    def read(self, table: str) -> DataFrame | None:
        version = self.current(table)
        return None if version is None else self.open(version)

    def stage(self, df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> Version:
        """Write ``df`` as a version of ``table`` that is not visible yet."""
        path = f"{self.root}/{table}/{uuid.uuid4().hex}"
        df.write.partitionBy(*partition_by).parquet(path)
        return Version((path,), df.schema)

    def stage_buckets(self, df: DataFrame, table: str, buckets: int, in_place: bool = False) -> Version:
        """Write ``df``, whose column ``_bucket`` holds numbers below ``buckets``, with a folder for each bucket that has rows.

        Small buckets share a task and large ones are split, as their size turns out. With ``in_place`` rows are not shuffled for
        that: each task adds a file to every bucket it has rows of, so tasks should be large.
        """
        path = f"{self.root}/{table}/{uuid.uuid4().hex}"
        dealt = df if in_place else df.hint("rebalance", F.col(BUCKET))
        dealt.write.partitionBy(BUCKET).parquet(path)
        files = self.spark.read.schema(df.schema).parquet(path).inputFiles()  # listed, not opened
        numbers = {bucket_of(file.rsplit("/", 1)[0]) for file in files}
        folders = tuple(f"{path}/{BUCKET}={number}" for number in sorted(numbers))
        return Version(folders, df.drop(BUCKET).schema, buckets)

    def commit(self, staged: Mapping[str, Version]) -> None:
        """Make staged versions the current ones of their tables, all at once."""
        if self._last_version is None:
            self._last_version = self.manifest().agg(F.max("version").alias("v")).first()["v"] or 0
        self._last_version += 1
        rows = [
            (self._last_version, table, path, version.schema.json(), version.buckets)
            for table, version in staged.items() for path in version.paths
        ]
        (
            self.spark.createDataFrame(
                rows, "version long, table_name string, path string, columns string, buckets int")
            .select(F.current_timestamp().alias("committed_at"), "*")
            .coalesce(1).write.mode("append").parquet(f"{self.root}/_manifest")
        )

    def replace(self, df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> DataFrame:
        """Stage, commit and read back; also how a long plan is cut into durable steps."""
        version = self.stage(df, table, partition_by)
        self.commit({table: version})
        return self.open(version)

    def append_log(self, df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
        df.write.mode("append").partitionBy(*partition_by).parquet(f"{self.root}/{table}")

    def read_log(self, table: str, schema: str) -> DataFrame:
        """Rows of a log; none where nothing was logged yet. A filter on what it is partitioned by reads those folders alone."""
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{table}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)


def scratch_root(spark: SparkSession) -> str:
    """A new folder for intermediate tables: below the cluster's shared checkpoint folder, or below
    the warehouse where none is set."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/tallyline-{uuid.uuid4().hex}"
