"""SimHash fingerprints, and the search for all fingerprints within a Hamming radius.

Terms are pairs of neighbouring words, weighted by their length; every occurrence votes with its weight
on each of 128 bits, for or against by the sign of the bit in the term's hash. The fingerprint keeps the
signs of the sums.

The search cuts a fingerprint into ``BLOCKS`` blocks of 16 bits. Of two fingerprints within a radius, at
least one block differs in at most radius // BLOCKS bits. Fingerprints and queries are dealt into parts, and
every part of the ones meets every part of the others in a task: a table for each block leads from its values
to the fingerprints that hold them, and is asked for all values that near a query's. Equal fingerprints
are one entry.

``NEAR`` is the radius of near copies: at a Jaccard similarity of 0.8 of the terms about 19 bits differ, and 27 or fewer
in 97 of 100 cases.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import kernels as K
from tallyline.llm.registry import query, table
from tallyline.llm.scratch import stored, width

BITS = 128
RADIUS = 3
NEAR = 27
BLOCKS = 8
PART = 1 << 17
PARTS = 64
AT_ONCE = 32
EVERY = 50
_U = np.uint64


def _chunk(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Fingerprints, as rows of 16 bytes, of texts laid end to end."""
    rows = len(ends) - 1
    out = np.zeros((rows, BITS // 8), np.uint8)
    data = K.lower_ascii(data)
    starts, stops = K.words(data, ends)
    if not len(starts):
        return out
    h = K.span_hashes(data, starts, stops)
    row = np.searchsorted(ends, starts, "right") - 1
    size = stops - starts
    pair = row[1:] == row[:-1]
    term = K.mix(h[:-1] * _U(0x9E3779B97F4A7C15) + h[1:])[pair]
    weight = np.clip((size[:-1] + size[1:]) // 4, 1, 7)[pair]
    owner = row[1:][pair]
    single = np.bincount(row, minlength=rows)[row] == 1
    if single.any():
        term, weight = np.concatenate((term, h[single])), np.concatenate((weight, np.clip(size[single] // 4, 1, 7)))
        owner = np.concatenate((owner, row[single]))
        order = np.argsort(owner, kind="stable")
        term, weight, owner = term[order], weight[order], owner[order]
    first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
    weight = weight.astype(np.uint8)
    votes = np.empty((len(first), BITS), np.int32)
    for word in range(BITS // 64):
        bits = np.unpackbits(K.mix(term + _U(word + 1)).view(np.uint8).reshape(-1, 8), axis=1)
        bits *= weight[:, None]
        votes[:, 64 * word:64 * word + 64] = np.add.reduceat(bits, first, axis=0, dtype=np.int32)
    total = np.add.reduceat(weight, first, dtype=np.int32)
    out[owner[first]] = np.packbits(2 * votes > total[:, None], axis=1)
    return out


def fingerprints(column: pa.Array) -> np.ndarray:
    """Rows of 16 bytes, one a text; null and empty texts, and those without words, are all zero."""
    data, ends = K.bytes_of(column)
    parts = [_chunk(part, stops) for _, _, part, stops in K.chunks(data, ends)]
    return np.concatenate(parts) if parts else np.zeros((0, BITS // 8), np.uint8)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The cosine that the share of differing bits estimates, from 0 to 1."""
    apart = np.unpackbits(a ^ b, axis=1).sum(axis=1)
    return np.maximum(np.cos(math.pi * apart / BITS), 0.0)


def _hex(rows: np.ndarray) -> list[str]:
    raw = rows.tobytes().hex()
    step = BITS // 4
    return [raw[i:i + step] for i in range(0, len(raw), step)]


def edited(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Fingerprints of every text and of its edited text, whose last third is the head of the next document.

    The next document is the one before it by id, and the first after the last. Returns doc_id,
    n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. A null text is
    empty; a null id is smaller than any; rows that share an id stand in the order of a hash of their
    text. A lone document is its own next one.

    Texts are dealt into ranges of ids once. The top document of each range also travels to the range
    above it (the lowest range takes the place above the highest), so no range needs another one.
    """
    spark = docs.sparkSession
    n = width(spark)
    low = -(1 << 63)
    rows = docs.select(F.col(doc_id).cast("long").alias("_doc"), F.coalesce(F.col(doc_id).cast("long"), F.lit(low)).alias("_id"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    bounds = sorted({int(b) for b in rows.select("_id").approxQuantile("_id", [i / n for i in range(1, n)], 0.1 / n)}) or [0]
    of = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= F.col("_id")))
    rows = rows.withColumn("_part", of)
    tops = sorted((r._part, r.top) for r in rows.groupBy("_part").agg(F.max("_id").alias("top")).collect())  # one a range
    guests = [(top, tops[(i + 1) % len(tops)][0]) for i, (_, top) in enumerate(tops)]
    ask = spark.createDataFrame(guests, "_id long, _to int")  # at most n rows
    guest = (rows.join(F.broadcast(ask), "_id")
             .select("_doc", "_id", "_text", F.col("_to").alias("_part"), F.lit(True).alias("_guest")))
    line = [F.col("_part"), F.col("_guest"), F.col("_id").desc(), F.xxhash64("_text")]
    dealt = (rows.select("_doc", "_id", "_text", "_part", F.lit(False).alias("_guest")).union(guest)
             .repartitionByRange(n, "_part").sortWithinPartitions(*line))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            tab = pa.Table.from_batches([held, batch] if held is not None else [batch])
            if tab.num_rows:
                sizes = pa.compute.binary_length(tab.column("_text")).to_numpy()
                stops = np.concatenate(([0], np.cumsum(sizes)))
                at = 0
                while at < tab.num_rows - 1:  # each piece starts with the row that the piece before it ended with
                    end = max(at + 2, int(np.searchsorted(stops, stops[at] + (8 << 20), "right")) - 1)
                    yield _edit(tab.slice(at, min(end, tab.num_rows) - at).combine_chunks())
                    at = min(end, tab.num_rows) - 1
                held = tab.slice(tab.num_rows - 1).combine_chunks().to_batches()[0]

    return dealt.mapInArrow(work, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                  "edited_fingerprint string, near_edited double, near_next double")


def _edit(rows: pa.Table) -> pa.RecordBatch:
    """All but the last row with the row after each; guests only follow."""
    column = rows.column("_text").combine_chunks()
    own = fingerprints(column)
    mine = np.flatnonzero(~rows.column("_guest").to_numpy())
    mine = mine[mine < rows.num_rows - 1]
    texts = column.to_pylist()
    changed, chars, shas = [], [], []
    for i in mine.tolist():
        t = texts[i]
        k = len(t) // 3
        new = t[:len(t) - k] + texts[i + 1][:k]
        changed.append(new)
        chars.append(len(t))
        shas.append(hashlib.sha256(new.encode()).hexdigest())
    other = fingerprints(pa.array(changed, pa.string()))
    return pa.RecordBatch.from_arrays(
        [rows.column("_doc").combine_chunks().take(pa.array(mine)), pa.array(chars, pa.int64()), pa.array(shas, pa.string()),
         pa.array(_hex(own[mine]), pa.string()), pa.array(_hex(other), pa.string()),
         pa.array(likeness(own[mine], other)), pa.array(likeness(own[mine], own[mine + 1]))],
        names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def _within(prints: np.ndarray, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, print) of all pairs within ``radius``, by place; rows of 16 bytes."""
    flips = [sum(1 << b for b in some) for k in range(radius // BLOCKS + 1) for some in itertools.combinations(range(16), k)]
    flips = np.array(flips, np.uint16)
    held, asked = prints.view(np.uint16), queries.view(np.uint16)
    words, wanted = prints.view(_U), queries.view(_U)
    tables = []
    for b in range(BLOCKS):
        order = np.argsort(held[:, b], kind="stable")
        tables.append((order, np.searchsorted(held[order, b], np.arange(1 << 16)), np.bincount(held[:, b], minlength=1 << 16)))
    found = [np.zeros(0, np.int64)]
    for i in range(0, len(queries), AT_ONCE):
        pairs = []
        for b, (order, first, size) in enumerate(tables):
            values = (asked[i:i + AT_ONCE, b, None] ^ flips).ravel()
            count = size[values]
            some = np.flatnonzero(count)
            count = count[some]
            ends = np.cumsum(count)
            if not len(ends):
                continue
            at = order[np.repeat(first[values[some]] - ends + count, count) + np.arange(ends[-1])]
            q = np.repeat(i + some // len(flips), count)
            apart = np.bitwise_count(words[at, 0] ^ wanted[q, 0]) + np.bitwise_count(words[at, 1] ^ wanted[q, 1])
            near = apart <= radius
            pairs.append(q[near] * len(prints) + at[near])
        if pairs:
            found.append(np.unique(np.concatenate(pairs)))
    return np.divmod(np.concatenate(found), max(1, len(prints)))


_KINDS = (np.uint64, np.uint64, np.int64)


def search(prints: DataFrame, queries: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fingerprint, n_within): for each distinct fingerprint of ``queries``, rows of ``prints`` within ``radius``, itself included.

    Both frames have a column ``fingerprint`` (hex). The counts are exact for any ``radius``; the work grows
    with the values of a block that differ in radius // 8 bits.
    """
    entry = stored(prints.where("fingerprint is not null").groupBy("fingerprint").agg(F.count("*").alias("_n")))
    asked = stored(queries.where("fingerprint is not null").select("fingerprint").distinct())
    across = max(-(-entry.count() // PART), min(width(prints.sparkSession), PARTS))
    down = max(1, -(-asked.count() // PART))

    def deal(own: int, other: int, kind: int):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                rows = np.frombuffer(bytes.fromhex("".join(batch.column(0).to_pylist())), _U).reshape(-1, 2)
                part = (K.mix(rows[:, 0] + K.mix(rows[:, 1])) % _U(own)).astype(np.int64)
                many = batch.column(1).to_numpy()
                cells, blobs = [], []
                for k in np.unique(part).tolist():
                    of = part == k
                    blob = bytes([kind]) + K.packed(rows[of, 0], rows[of, 1], many[of])
                    for o in range(other):
                        cells.append(o * across + k if kind else k * across + o)
                        blobs.append(blob)
                yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(blobs, pa.binary())], names=["bucket", "blob"])
        return work

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for blobs in K.buckets(batches):
            sides = []
            for kind in range(2):
                parts = [K.unpacked(blob[1:], _KINDS) for blob in blobs if blob[0] == kind]
                if parts:
                    low, high, many = (np.concatenate(c) for c in zip(*parts, strict=True))
                    sides.append((np.stack((low, high), axis=1).view(np.uint8), many))
            if len(sides) < 2:
                continue
            (wanted, _), (held, many) = sides
            q, at = _within(held, wanted, radius)
            total = np.zeros(len(wanted), np.int64)
            np.add.at(total, q, many[at])
            hit = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(_hex(wanted[hit]), pa.string()), pa.array(total[hit])], names=["fingerprint", "_n"])

    n = width(prints.sparkSession)
    kind = "bucket long, blob binary"
    dealt = (asked.withColumn("_n", F.lit(0).cast("long")).mapInArrow(deal(down, across, 0), kind)
             .union(entry.mapInArrow(deal(across, down, 1), kind)))
    met = dealt.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(meet, "fingerprint string, _n long")
    return met.groupBy("fingerprint").agg(F.sum("_n").alias("n_within"))


@query("op7_simhash")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = stored(edited(table(spark, sf_dir, "documents")))
    asked = prints.where(F.col("doc_id") % EVERY == 0)
    found = search(prints, asked, NEAR).withColumnRenamed("fingerprint", "_f")
    found = asked.select("doc_id", "fingerprint").distinct().join(found, F.col("fingerprint") == F.col("_f")).select(
        F.col("doc_id").alias("_q"), F.col("_f"), (F.col("n_within") - 1).alias("n_near"))
    return prints.join(found, (F.col("doc_id") == F.col("_q")) & (F.col("fingerprint") == F.col("_f")), "left").drop("_q", "_f")
