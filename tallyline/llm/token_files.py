"""Token ids in ORC files, ordered by document id.

Texts are dealt into ranges of document ids, encoded in order and written as ORC: integer lists are
run-length encoded, every stripe carries row indexes and a Bloom filter on the id. A reader takes
stripes in parallel; a filter on ids skips files by their footers and stripes by index and filter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import byte_bpe
from tallyline.llm import kernels as K
from tallyline.llm.order import running
from tallyline.llm.registry import query, table
from tallyline.llm.scratch import folder, stored, width

END = 2
STRIPE = 16 << 20
STRIDE = 5_000
PART = 4 << 20


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def write(docs: DataFrame, path: str, tokenizer: str, end: int = END, text: str = "text", doc_id: str = "doc_id") -> None:
    """Encode every whole text, append ``end``, and write (doc_id, ids) below ``path`` in ascending id order.

    A null text is empty and gives ``end`` alone. A null id sorts first. Rows that share an id stand in
    the order of a hash of their text. An empty table writes files without rows.
    """
    kinds = byte_bpe.classes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = byte_bpe.encoder(tokenizer, kinds)
        for batch in batches:
            column = batch.column("_text")
            data, stops = K.bytes_of(column)
            for i, j, _, _ in K.chunks(data, stops, PART):
                ids, counts = coder(column.slice(i, j - i))
                out = np.full(len(ids) + len(counts), end, np.int32)
                ends = np.cumsum(counts + 1)
                body = np.ones(len(out), bool)
                body[ends - 1] = False
                out[body] = ids
                yield pa.RecordBatch.from_arrays([batch.column("_id").slice(i, j - i), K.list_array(out, counts + 1, pa.int32())],
                                                 names=["doc_id", "ids"])

    rows = docs.select(F.col(doc_id).cast("long").alias("_id"), F.col(text).cast("string").alias("_text"))
    spark = docs.sparkSession
    tie = F.xxhash64("_text")
    (rows.repartitionByRange(width(spark), F.col("_id"), tie).sortWithinPartitions(F.col("_id"), tie)
     .mapInArrow(encode, "doc_id long, ids array<int>")
     .write.options(**{"orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01", "orc.row.index.stride": str(STRIDE),
                       "orc.stripe.size": str(STRIPE), "compression": "zstd"}).orc(path))


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, ids) of the files below ``path``; a filter on doc_id reaches the stripes."""
    return spark.read.schema("doc_id long, ids array<int>").orc(path)


def digest(tokens: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of (doc_id, ids): offsets in id order and a checksum of each document."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            flat = ids.flatten().to_numpy(zero_copy_only=False).astype("<u4")
            counts = pa.compute.list_value_length(ids).to_numpy(zero_copy_only=False).astype(np.int64)
            stops = np.concatenate(([0], np.cumsum(counts)))
            raw = memoryview(flat.tobytes())
            crcs = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(stops[:-1].tolist(), stops[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts), pa.array(crcs, pa.int64())],
                                             names=["doc_id", "n_tokens", "ids_crc32"])

    # written first: dealing rows into ranges samples them, which would read and sum every document twice
    small = stored(tokens.mapInArrow(sums, "doc_id long, n_tokens long, ids_crc32 long"))
    return running(small, [F.col("doc_id"), F.col("ids_crc32")], {"start": F.col("n_tokens")})


@query("op4_token_files")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = folder(spark)
    write(table(spark, sf_dir, "documents"), path, vocabulary())
    return digest(read(spark, path)).select("doc_id", "start", "n_tokens", "ids_crc32")
