"""Connected components of links between ids, as alternating star contractions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.scratch import stored


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(id, smallest id of its component) for every id of the links but the smallest ones themselves."""
    ids, flat = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = flat[:len(a)], flat[len(a):]
    root = np.arange(len(ids))
    while True:  # hooks roots to smaller roots, then halves the paths
        rx, ry = root[x], root[y]
        apart = rx != ry
        if not apart.any():
            break
        np.minimum.at(root, np.maximum(rx, ry)[apart], np.minimum(rx, ry)[apart])
        while (root != root[root]).any():
            root = root[root]
    own = root != np.arange(len(ids))
    return ids[own], ids[root[own]]


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each batch as stars: every id to the smallest id of its component within the batch."""
    for batch in batches:
        ids, roots = stars(batch.column(0).to_numpy(), batch.column(1).to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(roots)], names=["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in ``links`` (a long, b long); the component is its smallest id.

    Links of each task are first reduced to a forest. Then rounds hang every id on the smallest id
    that it or its neighbours know, larger ids first, until nothing moves. Counts and minima are
    combined before each shuffle; the joins have plain keys, so a hub is split by the engine.
    Self-links and repeated links do no harm; no links give no rows.
    """
    edges = stored(links.where("a is not null and b is not null and a <> b").select("a", "b")
                   .mapInArrow(_forest, "a long, b long").distinct())
    before = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = large.where("a <> b")
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a")
        edges = stored(small.select(F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                                                      F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
                       .select("e.*").where("a <> b").distinct())
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    tops = edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(tops)
