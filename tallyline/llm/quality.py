"""Quality scores from a factorisation machine over hashed words, structure statistics and metadata.

Features of a whole text are the hash buckets of its words (each 1 / sqrt of their number, so that long
and short texts weigh alike), statistics of its structure, and numeric metadata columns of its row. The score is

    bias + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j

with a vector of ``RANK`` numbers per feature. The double sum is half of
sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2), so a text is scored in time linear in its features.

The model is fitted on a bounded sample of labelled documents (``SAMPLE``). The executors turn their texts into one
bitmap of ``BUCKETS`` bits and a row of statistics each, so about ``SAMPLE`` times two thirds of a kilobyte reach the driver.
Scoring reads every whole text once and needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import kernels as K
from tallyline.llm.registry import query, table
from tallyline.llm.scratch import sampled

SAMPLE = 8_192
BUCKETS = 4_096
RANK = 8
EPOCHS = 16
BATCH = 128
RATE = 0.02
RIDGE = 1e-4
SEED = 13
FOLDS = 3
HELD_OUT = 1
MOST_ROWS = 512
_U = np.uint64

_KIND = np.zeros(256, np.int8)  # 0 other, 1 lower-case letter, 2 upper-case letter, 3 digit, 4 sentence mark, 5 symbol, 6 blank, 7 line end
_KIND[0x80:] = 1
_KIND[0x61:0x7B] = 1
_KIND[0x41:0x5B] = 2
_KIND[0x30:0x3A] = 3
_KIND[[ord(c) for c in ".,;:!?'\"()-"]] = 4
_KIND[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = 5
_KIND[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = 6
_KIND[0x0A] = 7
_KINDS = 8
STATISTICS = 2 + (_KINDS - 1) + 8


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a / np.maximum(b, 1)


def statistics(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A row of ``STATISTICS`` figures for each text, and the rows and buckets of all words.

    Figures: logarithms of the numbers of bytes and words, the share of each kind of byte, the mean length of words,
    and the shares of words that repeat the word before them, are written in capitals, end in a symbol,
    hold no letter or digit, are distinct, hold an exclamation mark, or start with a capital.
    """
    n = len(ends) - 1
    size = np.diff(ends).astype(float)
    row = K.owners(ends)
    kind = _KIND[data]
    kinds = np.bincount(row * _KINDS + kind, minlength=n * _KINDS).reshape(n, _KINDS).astype(float)
    starts, stops = K.words(data, ends)
    if len(starts):
        word_row = row[starts]
        hashes = K.span_hashes(K.lower_ascii(data), starts, stops)
    else:
        word_row, hashes = np.zeros(0, np.int64), np.zeros(0, _U)
    count = np.bincount(word_row, minlength=n).astype(float)

    def share(of: np.ndarray) -> np.ndarray:
        return _ratio(np.bincount(word_row, of.astype(float), minlength=n), count)

    def inside(which: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(which)))
        return sums[stops] - sums[starts]

    again = np.zeros(len(starts), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (word_row[1:] == word_row[:-1])
    upper, lower = inside(kind == 2), inside(kind == 1)
    signs = inside((kind >= 1) & (kind <= 3))
    _, distinct_row = K.distinct_per_row(hashes, word_row)
    parts = [
        np.log1p(size), np.log1p(count), *(_ratio(kinds[:, k], size) for k in range(1, _KINDS)),
        _ratio(np.bincount(word_row, (stops - starts).astype(float), minlength=n), count),
        share(again), share((upper > 1) & (lower == 0)), share(kind[stops - 1] == 5 if len(starts) else again), share(signs == 0),
        _ratio(np.bincount(distinct_row, minlength=n).astype(float), count), share(inside(data == 0x21) > 0),
        share(kind[starts] == 2 if len(starts) else again),
    ]
    return np.stack(parts, 1), word_row, (hashes >> _U(64 - (BUCKETS - 1).bit_length())).astype(np.int64)


def _extracted(column: pa.Array, most: int = K.CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, statistics, which buckets each row holds) of neighbouring texts."""
    data, ends = K.bytes_of(column)
    for first, _, part, stops in K.chunks(data, ends, most):
        for i in range(0, len(stops) - 1, MOST_ROWS):
            some = stops[i:i + MOST_ROWS + 1]
            figures, row, bucket = statistics(part[some[0]:some[-1]], some - some[0])
            held = np.zeros((len(some) - 1, BUCKETS), bool)
            held[row, bucket] = True
            yield first + i, first + i + len(some) - 1, figures, held


def _metadata(batch: pa.RecordBatch, columns: int) -> np.ndarray:
    """Signed logarithms of the metadata columns and whether they are missing, two figures a column."""
    out = []
    for k in range(columns):
        values = batch.column(f"_meta{k}").to_numpy(zero_copy_only=False).astype(float)
        gone = ~np.isfinite(values)
        values = np.where(gone, 0.0, values)
        out += [np.sign(values) * np.log1p(np.abs(values)), gone.astype(float)]
    return np.stack(out, 1) if out else np.zeros((batch.num_rows, 0))


class Model:
    """Weights of buckets and figures, and the mean and spread of the figures in the sample."""

    def __init__(self, bias: float, weights: np.ndarray, factors: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> None:
        self.bias, self.weights, self.factors, self.mean, self.spread = bias, weights, factors, mean, spread

    def figures(self, raw: np.ndarray) -> np.ndarray:
        return np.clip((raw - self.mean) / self.spread, -4.0, 4.0)

    def score(self, raw: np.ndarray, held: np.ndarray) -> np.ndarray:
        row, bucket = np.nonzero(held)
        n = len(held)
        scale = 1.0 / np.sqrt(np.maximum(held.sum(1), 1))
        own = np.concatenate((self.weights[:BUCKETS, None], self.factors[:BUCKETS], (self.factors[:BUCKETS] ** 2).sum(1)[:, None]), 1)
        sums = np.zeros((n, own.shape[1]))
        first = np.searchsorted(row, np.arange(n))
        some = np.flatnonzero(np.diff(np.append(first, len(row))))
        if len(some):
            sums[some] = np.add.reduceat(own[bucket], first[some], axis=0)
        x = self.figures(raw)
        linear = self.bias + sums[:, 0] * scale + x @ self.weights[BUCKETS:]
        mixed = sums[:, 1:-1] * scale[:, None] + x @ self.factors[BUCKETS:]
        squares = sums[:, -1] * scale ** 2 + x ** 2 @ (self.factors[BUCKETS:] ** 2).sum(1)
        return _sigmoid(linear + 0.5 * ((mixed ** 2).sum(1) - squares))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35.0, 35.0)))


def _constant(share: float, columns: int) -> Model:
    n = STATISTICS + 2 * columns
    bias = float(np.log(share / (1 - share))) if 0 < share < 1 else (35.0 if share else -35.0)
    return Model(bias, np.zeros(BUCKETS + n), np.zeros((BUCKETS + n, RANK)), np.zeros(n), np.ones(n))


def solve(held: np.ndarray, raw: np.ndarray, y: np.ndarray, rank: int = RANK, epochs: int = EPOCHS) -> Model:
    """A model by Adam steps on log loss and ridge over small batches, in a seeded order.

    ``held`` holds one row of packed bits a document, ``raw`` its figures, ``y`` its label.
    """
    mean, spread = raw.mean(0), np.maximum(raw.std(0), 1e-6)
    rng = np.random.default_rng(SEED)
    n = BUCKETS + raw.shape[1]
    share = y.mean()
    model = Model(float(np.log(share / (1 - share))), np.zeros(n), rng.normal(0, 0.05, (n, rank)), mean, spread)
    x_all = model.figures(raw)
    params = [np.array([model.bias]), model.weights, model.factors]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), BATCH):
            some = order[at:at + BATCH]
            bits = np.unpackbits(held[some], axis=1).astype(float)
            bits /= np.sqrt(np.maximum(bits.sum(1), 1))[:, None]
            x = np.concatenate((bits, x_all[some]), 1)
            mixed = x @ params[2]
            z = params[0] + x @ params[1] + 0.5 * ((mixed ** 2).sum(1) - x ** 2 @ (params[2] ** 2).sum(1))
            off = (_sigmoid(z) - y[some]) / len(some)
            grads = [np.array([off.sum()]), x.T @ off + RIDGE * params[1],
                     x.T @ (off[:, None] * mixed) - (x ** 2).T @ off[:, None] * params[2] + RIDGE * params[2]]
            step += 1
            rate = RATE * (1 - epoch / epochs)
            for p, g, m, v in zip(params, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return Model(float(params[0][0]), params[1], params[2], mean, spread)


def _rows(docs: DataFrame, text: str, metadata: Sequence[str], *more: Column) -> DataFrame:
    return docs.select(*more, F.col(text).cast("string").alias("_text"),
                       *[F.col(c).cast("double").alias(f"_meta{k}") for k, c in enumerate(metadata)])


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept from the fit: crc32 of its id as text leaves ``HELD_OUT`` modulo ``FOLDS``; null ids do not count."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, text: str = "text", doc_id: str = "doc_id",
        quality: str = "quality", metadata: Sequence[str] = ()) -> Model:
    """A model from about ``sample`` labelled documents at most, those whose hash of the id is low.

    Held-out documents are left out; null labels and ids are not used. An id labelled twice takes the smaller label;
    of several rows with one id the one with the smallest features counts, so an id on many rows weighs once. Null
    texts are empty. Without documents of both labels the model scores the share of label 1 it saw (0 without rows).
    ``metadata`` names numeric columns of ``docs``; other columns are not looked at.
    """
    known = labels.where(F.col(quality).isNotNull() & F.col(doc_id).isNotNull() & ~held_out(doc_id))
    known = known.groupBy(F.col(doc_id).cast("long").alias("_id")).agg(F.min(quality).cast("int").alias("_y"))
    chosen = F.broadcast(sampled(known, ["_id"], sample))  # about ``sample`` rows of two numbers
    rows = _rows(docs, text, metadata, F.col(doc_id).cast("long").alias("_id")).join(chosen, "_id")
    columns = len(metadata)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            extra = _metadata(batch, columns)
            for i, j, figures, held in _extracted(batch.column("_text")):
                both = np.concatenate((figures, extra[i:j]), 1)
                blobs = [a.tobytes() + b.tobytes() for a, b in zip(np.packbits(held, axis=1), both, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("_id").slice(i, j - i), batch.column("_y").slice(i, j - i),
                                                  pa.array(blobs, pa.binary())], names=["_id", "_y", "blob"])

    got = rows.mapInArrow(work, "_id long, _y int, blob binary").groupBy("_id").agg(F.min("_y").alias("y"), F.min("blob").alias("blob"))
    got = sorted(got.collect(), key=lambda r: r["_id"])  # one short row for each document of the bounded sample
    y = np.array([r["y"] for r in got], float)
    if not len(y) or y.min() == y.max():
        return _constant(float(y[0]) if len(y) else 0.0, columns)
    held = np.stack([np.frombuffer(r["blob"], np.uint8, BUCKETS // 8) for r in got])
    raw = np.stack([np.frombuffer(r["blob"], float, offset=BUCKETS // 8) for r in got])
    return solve(held, raw, y)


def scored(docs: DataFrame, model: Model, text: str = "text", metadata: Sequence[str] = ()) -> DataFrame:
    """(row: all columns of ``docs``, score) of every row; a null text scores as an empty one.

    Rows are scored on their own, so repeated rows score alike, and columns of any name travel inside ``row``.
    """
    schema = docs.select(F.struct("*").alias("row")).schema.add("score", "double")
    columns = len(metadata)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            extra = _metadata(batch, columns)
            score = [np.zeros(0)]
            for i, j, figures, held in _extracted(batch.column("_text")):
                score.append(model.score(np.concatenate((figures, extra[i:j]), 1), held))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(np.concatenate(score))], names=["row", "score"])

    return _rows(docs, text, metadata, F.struct("*").alias("row")).mapInArrow(work, schema)


@query("op13_quality")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    model = fit(docs, table(spark, sf_dir, "labels"), metadata=["n_chars"])
    out = scored(docs, model, metadata=["n_chars"]).select("row.doc_id", "score")
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
