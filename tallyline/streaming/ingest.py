"""Accepted extracts as a file stream: each file is read once and merged by key."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tallyline.sources.merge import merge_load
from tallyline.sources.store import SnapshotStore


def stream_files(spark: SparkSession, folder: str, schema: str, file_format: str = "csv",
                 max_files: int | None = None, multi_line: bool = False) -> DataFrame:
    """New files of ``folder``. One stream reads one column order; use a folder per header.

    ``multi_line`` is for a folder of files with quoted values that span lines, as the arrival gate finds them; a
    file read that way is not split.
    """
    reader = spark.readStream.format(file_format).schema(schema)
    if file_format == "csv":
        reader = reader.option("header", True).option("escape", '"').option("multiLine", multi_line)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)


def stream_upsert(
    stream: DataFrame,
    store: SnapshotStore,
    table: str,
    key: Sequence[str],
    order_by: Sequence[Column],
    checkpoint: str,
) -> StreamingQuery:
    """Merge everything that has arrived into ``table`` and stop.

    ``order_by`` also decides against the stored row, so batches may come in any order. A batch
    replayed after a failure merges the same keys again, which changes nothing.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            merge_load(store, table, batch, key, order_by, ordered=bool(order_by))

    return _start(stream, merge, checkpoint)


def stream_dedup(
    stream: DataFrame, event_time: str, key: Sequence[str], late: str
) -> DataFrame:
    """First row per key, forgetting a key ``late`` after its event time.

    The watermark trails the latest event time of the batches before by ``late``. A row at or below it is dropped, new key
    or not; a key is forgotten once its first event time plus ``late`` is at or below it, and counts as new from then on.
    """
    return stream.withWatermark(event_time, late).dropDuplicatesWithinWatermark(list(key))


def _start(stream: DataFrame, merge: Callable[[DataFrame, int], None], checkpoint: str):
    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
