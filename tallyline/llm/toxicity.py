"""Toxicity scores from a logistic model whose scores may not follow identity terms.

Features are words and their first four to six bytes, present or absent in the whole text. The model is
fitted on a bounded sample of labelled rows (``SAMPLE`` documents): counts by feature are combined on
the executors, the ``FEATURES`` features that separate the labels best are kept, and the weights are
found by gradient steps. Sentences of the sample that name a group are copied with the group swapped for
another one of its kind; the squared change of the score is part of the loss, so what a sentence scores
may not hang on the group that it mentions.

Scoring reads every whole text once, looks its words up in the kept features and needs no shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import kernels as K
from tallyline.llm.registry import query, table
from tallyline.llm.scratch import sampled, stored

SAMPLE = 20_000
FEATURES = 4_096
LEAST_SEEN = 5
LEAST_Z = 4.0
PREFIXES = (4, 5, 6)
PENALTY = 1.0
RIDGE = 2e-4
STEPS = 500
TOXIC_WEIGHT = 3.0
FOLDS = 5
#: Names of groups in the languages of the corpus, by kind; a term is swapped within its kind.
IDENTITY = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("female", "male"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"), ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "arab"), ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "refugees", "foreigners", "natives"), ("disabled", "blind", "deaf"), ("elderly", "young"),
    ("frauen", "männer"), ("frau", "mann"), ("mädchen", "jungen"), ("muslime", "christen", "juden", "buddhisten"),
    ("ausländer", "flüchtlinge", "einwanderer", "einheimische"), ("schwule", "lesben", "heteros"), ("behinderte", "blinde", "gehörlose"),
    ("femmes", "hommes"), ("femme", "homme"), ("filles", "garçons"), ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes"),
    ("étrangers", "réfugiés", "immigrés", "autochtones"), ("handicapés", "aveugles", "sourds"),
    ("mujeres", "hombres"), ("mujer", "hombre"), ("niñas", "niños"), ("musulmanes", "cristianos", "judíos", "hindúes", "budistas"),
    ("extranjeros", "refugiados", "inmigrantes", "nativos"), ("discapacitados", "ciegos", "sordos"),
)
_U = np.uint64
_INSIDE = np.zeros(256, bool)
_INSIDE[0x80:] = True
for _low, _high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A)):
    _INSIDE[_low:_high + 1] = True


def _features(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and rows of all features of texts laid end to end, repeats included."""
    data = K.lower_ascii(data)
    inside = _INSIDE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[ends] = True
    before = np.concatenate(([False], inside[:-1]))
    after = np.concatenate((inside[1:], [False]))
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    stops = np.flatnonzero(inside & (~after | cut[1:])) + 1
    if not len(starts):
        return np.zeros(0, _U), np.zeros(0, np.int64)
    row = np.searchsorted(ends, starts, "right") - 1
    up, down = K.Powers.get(len(data) + 1)
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum((data.astype(_U) + _U(1)) * up[:len(data)], out=sums[1:])
    hashes, rows = [K.mix((sums[stops] - sums[starts]) * down[starts])], [row]
    for size in PREFIXES:
        long = stops - starts > size
        s = starts[long]
        hashes.append(K.mix((sums[s + size] - sums[s]) * down[s] + _U(size)))
        rows.append(row[long])
    return np.concatenate(hashes), np.concatenate(rows)


def _present(column: pa.Array, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, index of a kept feature) pairs of a column, each once; ``kept`` is ascending."""
    gate = np.zeros(1 << 16, bool)
    gate[(kept >> _U(48)).astype(np.int64)] = True
    data, ends = K.bytes_of(column)
    found_rows, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i, _, part, stops in K.chunks(data, ends):
        h, row = _features(part, stops)
        some = gate[(h >> _U(48)).astype(np.int64)]
        h, row = h[some], row[some]
        at = np.minimum(np.searchsorted(kept, h), max(len(kept) - 1, 0))
        hit = kept[at] == h if len(kept) else np.zeros(len(h), bool)
        pairs = np.unique((row[hit] + i) * max(len(kept), 1) + at[hit])
        found_rows.append(pairs // max(len(kept), 1))
        found.append(pairs % max(len(kept), 1))
    return np.concatenate(found_rows), np.concatenate(found)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


class Model:
    """Ascending feature hashes, a weight each, and the score of a text without any of them."""

    def __init__(self, kept: np.ndarray, weights: np.ndarray, bias: float) -> None:
        self.kept, self.weights, self.bias = kept, weights, bias

    def score(self, column: pa.Array) -> np.ndarray:
        row, feature = _present(column, self.kept)
        return _sigmoid(self.bias + np.bincount(row, self.weights[feature], minlength=len(column)))


class Swap:
    """Names of groups, each with the next one of its kind."""

    def __init__(self, identity: Sequence[Sequence[str]]) -> None:
        self.next = {term: kind[(i + 1) % len(kind)] for kind in identity for i, term in enumerate(kind)}
        self.term = re.compile(r"\b(" + "|".join(map(re.escape, self.next)) + r")\b", re.IGNORECASE) if self.next else None

    def sentences(self, text: str) -> list[tuple[str, str]]:
        """Sentences that name a group, each with its copy in which every group is swapped within its kind."""
        if self.term is None or not self.term.search(text):
            return []
        return [(s, self.term.sub(lambda m: self.next[m.group().lower()], s))
                for s in re.split(r"(?<=[.!?\n])", text) if self.term.search(s)]


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, features: int = FEATURES, penalty: float = PENALTY,
        text: str = "text", doc_id: str = "doc_id", toxic: str = "toxic", held_out: bool = True,
        identity: Sequence[Sequence[str]] = IDENTITY) -> Model:
    """A model from about ``sample`` labelled documents at most, those whose hash of the id is low.

    Rows of the held-out fold (crc32 of the id as text divisible by ``FOLDS``) are left out. A document
    labelled twice takes the larger label; null labels and ids are not used. Of several rows with one id the least text counts, so
    an id on many rows weighs once and what is gathered is bounded by the sample. Null texts are empty; other columns are not
    looked at. Without documents of both
    labels (an empty table too) the model has no features and scores the share of toxic rows it saw (0 without rows).
    ``identity`` lists names of groups by kind: a sentence that names one may not change its score when the group is
    swapped for the next of its kind.
    """
    spark = docs.sparkSession
    known = labels.where(F.col(toxic).isNotNull() & F.col(doc_id).isNotNull())
    if held_out:
        known = known.where(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS != 0)
    known = known.groupBy(F.col(doc_id).cast("long").alias("_id")).agg(F.max(toxic).cast("int").alias("_y"))
    chosen = sampled(known, ["_id"], sample).collect()
    if not chosen:
        return Model(np.zeros(0, _U), np.zeros(0), -35.0)
    ids = spark.createDataFrame([(r._id, r._y) for r in chosen], "_id long, _y int")
    rows = (docs.select(F.col(doc_id).cast("long").alias("_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
            .join(F.broadcast(ids), "_id").groupBy("_id", "_y").agg(F.min("_text").alias("_text")))
    rows = stored(rows.select("_y", "_text"))  # the bounded sample
    swap = Swap(identity)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = batch.column("_y").to_numpy()
            data, ends = K.bytes_of(batch.column("_text"))
            for i, j, part, stops in K.chunks(data, ends):
                h, row = K.distinct_per_row(*_sorted_rows(*_features(part, stops)))
                names, which = np.unique(h, return_inverse=True)
                pos = np.bincount(which, y[i:j][row], minlength=len(names)).astype(np.int64)
                every = np.bincount(which, minlength=len(names))
                yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(pos), pa.array(every)], names=["h", "p", "n"])

    sums = rows.mapInArrow(count, "h long, p long, n long").groupBy("h").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
    y_all = np.array([r._y for r in chosen], float)
    positive, total = float(y_all.sum()), float(len(y_all))
    if positive == 0 or positive == total:
        return Model(np.zeros(0, _U), np.zeros(0), 35.0 if positive else -35.0)
    share = positive / total
    gap = F.col("p") / positive - (F.col("n") - F.col("p")) / (total - positive)
    pooled = F.greatest(F.col("n") / total, F.lit(1e-9))
    z = gap / F.sqrt(F.greatest(pooled * (1 - pooled), F.lit(1e-9)) * (1 / positive + 1 / (total - positive)))
    best = sums.where(F.col("n") >= LEAST_SEEN).withColumn("z", F.abs(z)).where(F.col("z") >= LEAST_Z)
    best = best.orderBy(F.col("z").desc(), "h").limit(features).collect()  # bounded by features
    kept = np.array([r.h for r in best], np.int64).view(_U)
    kept = np.unique(kept)
    if not len(kept):
        return Model(kept, np.zeros(0), float(np.log(share / (1 - share))))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, labels_, other = batch.column("_text").to_pylist(), batch.column("_y").to_pylist(), []
            pairs: list[str] = []
            for t in texts:
                for a, b in swap.sentences(t or ""):
                    pairs += [a, b]
            for values, kind in ((texts, 0), (pairs, 1)):
                if not values:
                    continue
                row, feature = _present(pa.array(values, pa.string()), kept)
                lists = [x.tolist() for x in np.split(feature, np.searchsorted(row, np.arange(1, len(values))))]
                if kind:
                    other += [(-1, a, b) for a, b in zip(lists[::2], lists[1::2], strict=True) if a != b]
                else:
                    other += [(y, a, None) for y, a in zip(labels_, lists, strict=True)]
            columns = list(zip(*other, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.list_(pa.int32())),
                                              pa.array(columns[2], pa.list_(pa.int32()))], names=["y", "a", "b"])

    got = rows.mapInArrow(gather, "y int, a array<int>, b array<int>").collect()  # rows of the bounded sample
    plain = sorted((r for r in got if r.y >= 0), key=lambda r: (r.y, r.a))
    swapped = sorted((r for r in got if r.y < 0), key=lambda r: (r.a, r.b))
    weights, bias = _solve(plain, swapped, len(kept), penalty)
    return Model(kept, weights, bias)


def _sorted_rows(h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(row, kind="stable")
    return h[order], row[order]


def _csr(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    return row, np.fromiter((v for x in lists for v in x), np.int64, len(row))


def _solve(plain: list, swapped: list, n: int, penalty: float) -> tuple[np.ndarray, float]:
    """Weights and bias by Adam steps on log loss, ridge and the squared change under swaps."""
    y = np.array([r.y for r in plain], float)
    row, col = _csr([r.a for r in plain])
    pair_row, pair_col = _csr([r.a for r in swapped])
    back_row, back_col = _csr([r.b for r in swapped])
    pair_row, pair_col = np.concatenate((pair_row, back_row)), np.concatenate((pair_col, back_col))
    sign = np.concatenate((np.ones(len(pair_row) - len(back_row)), -np.ones(len(back_row))))
    w, m, v = np.zeros(n + 1), np.zeros(n + 1), np.zeros(n + 1)
    w[n] = np.log(max(y.mean(), 1e-6) / max(1 - y.mean(), 1e-6))
    worth = np.where(y > 0, TOXIC_WEIGHT, 1.0)  # toxic rows are the rarer ones
    for step in range(1, STEPS + 1):
        off = worth * (_sigmoid(w[n] + np.bincount(row, w[col], minlength=len(y))) - y)
        grad = np.append(np.bincount(col, off[row], minlength=n), off.sum()) / worth.sum()
        grad[:n] += RIDGE * w[:n]
        if len(swapped):
            change = np.bincount(pair_row, sign * w[pair_col], minlength=len(swapped))
            grad[:n] += 2 * penalty * np.bincount(pair_col, sign * change[pair_row], minlength=n) / len(swapped)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w = w - 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return w[:n], float(w[n])


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """(row: all columns of ``docs``, score) of every row; a null or empty text scores the model's bias.

    Rows are scored on their own: repeated rows score alike, an empty table gives none, and columns of any name travel inside ``row``.
    """
    schema = docs.select(F.struct("*").alias("row")).schema.add("score", "double")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(model.score(batch.column("_text")))], names=["row", "score"])

    both = docs.select(F.struct("*").alias("row"), F.col(text).cast("string").alias("_text"))
    return both.mapInArrow(work, schema)


@query("op6_toxicity")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0
    out = scored(docs, model)
    return out.select("row.doc_id", "score").select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
