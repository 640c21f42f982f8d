"""Exact histogram of encoded lengths, and what it answers for every context limit.

Documents are counted by encoded length, with counts combined before the shuffle. Sums over the ordered
lengths then give, for each length taken as a limit, the documents and tokens below, at and above it, the
tokens left when every document is cut there, and the quantile it stands for. A limit between two
lengths is answered by the next smaller length's row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import byte_bpe
from tallyline.llm import kernels as K
from tallyline.llm.order import running
from tallyline.llm.registry import query, table
from tallyline.llm.scratch import stored
from tallyline.llm.token_files import PART, vocabulary


def lengths(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """(n_tokens, n_docs): documents of each encoded length. A null or empty text has length 0; a repeated row is a document of
    its own; other columns are not looked at. An empty table gives no rows."""
    kinds = byte_bpe.classes()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = byte_bpe.encoder(tokenizer, kinds)
        for batch in batches:
            column = batch.column(0)
            data, stops = K.bytes_of(column)
            for i, j, _, _ in K.chunks(data, stops, PART):
                size, docs_ = np.unique(coder(column.slice(i, j - i))[1], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(size, pa.int64()), pa.array(docs_, pa.int64())], names=["n_tokens", "n"])

    some = docs.select(F.col(text).cast("string"))
    return some.mapInArrow(count, "n_tokens long, n long").groupBy("n_tokens").agg(F.sum("n").alias("n_docs"))


def histogram(counts: DataFrame) -> DataFrame:
    """One row a distinct length of (n_tokens, n_docs), with sums from either end.

    ``docs_at_least`` and ``tokens_at_least`` are suffix sums over this and all longer lengths;
    ``truncated_total`` is the sum of min(length, n_tokens) over all documents; ``quantile`` is the share of
    documents of at most this length. No documents give no rows.
    """
    tokens = F.col("n_tokens") * F.col("n_docs")
    down = running(counts, [F.col("n_tokens").desc()], {"_docs": F.col("n_docs"), "_tokens": tokens})
    down = stored(down)
    total = down.agg(F.sum("n_docs").alias("n"), F.sum(tokens).alias("t")).first()
    out = (down.withColumn("docs_at_least", F.col("_docs") + F.col("n_docs"))
           .withColumn("tokens_at_least", F.col("_tokens") + tokens))
    return out.select(
        "n_tokens", "n_docs", "docs_at_least", "tokens_at_least",
        (F.lit(total.t or 0) - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")).alias("truncated_total"),
        ((F.lit(total.n or 0) - F.col("_docs")) / F.lit(total.n or 1)).alias("quantile"))


def truncated_total(hist: DataFrame, limit: int) -> int:
    """Tokens left when every document is cut at ``limit``, from the histogram alone."""
    longer = hist.where(F.col("n_tokens") > limit).agg(F.sum("n_docs").alias("n")).first().n or 0
    within = hist.where(F.col("n_tokens") <= limit).agg(F.sum(F.col("n_tokens") * F.col("n_docs")).alias("t")).first().t or 0
    return within + limit * longer


def quantile(hist: DataFrame, q: float) -> int | None:
    """The smallest length that at least a share ``q`` of the documents do not pass; null without documents."""
    return hist.where(F.col("quantile") >= q).agg(F.min("n_tokens").alias("n")).first().n


@query("op5_token_counts")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram(lengths(table(spark, sf_dir, "documents"), vocabulary()))
