import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyline.llm import quality
from tallyline.llm.queries import QUERIES


def corpus(n=900):
    """Prose, and junk of three kinds that holds the same words."""
    rng = random.Random(13)
    words = ["".join(rng.choices("aeinorst", k=rng.randrange(2, 9))) for _ in range(400)]
    docs, labels = [], []
    for i in range(n):
        some = rng.choices(words, k=rng.randrange(5, 120))
        good = rng.random() < 0.7
        if good:
            text = ". ".join(" ".join(some[k:k + 9]).capitalize() for k in range(0, len(some), 9)) + "."
        else:
            text = rng.choice((" | ".join(some), " ".join(w for w in some for _ in range(2)), "!! ".join(some).upper()))
        docs.append((i, text, "en", f"s{i % 3}", len(text)))
        labels.append((i, int(good), 0))
    return docs, labels


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("quality"))
    docs, labels = corpus()
    docs += [(10_000, None, None, None, None), (10_001, "", "en", "s", 0), (None, "A few words.", "en", "s", 12)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_held_out_accuracy_and_columns(spark, folder):
    df = QUERIES["op13_quality"](spark, folder)
    assert dict(df.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
    rows = df.collect()
    docs, labels = corpus()
    assert len(rows) == len(docs) + 3 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    truth = {i: q for i, q, _ in labels}
    held = [r.predicted == truth[r.doc_id] for r in rows if r.held_out and r.doc_id in truth]
    assert len(held) > 200 and np.mean(held) > 0.97
    of = {r.doc_id: r.score for r in rows}
    assert of[10_001] is not None and of[10_000] is not None


def test_held_out_labels_and_other_columns_do_not_count(spark, folder):
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    base = quality.fit(docs, labels, metadata=["n_chars"])
    lies = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    renamed = docs.withColumns({"lang": F.lit("xx"), "source": F.col("doc_id").cast("string"), "score": F.lit("a"), "_y": F.lit(1)})
    for model in (quality.fit(docs, lies, metadata=["n_chars"]), quality.fit(renamed.repartition(7), labels, metadata=["n_chars"])):
        assert model.bias == base.bias and (model.weights == base.weights).all() and (model.factors == base.factors).all()
    a = {r["row"].doc_id: r.score for r in quality.scored(docs, base, metadata=["n_chars"]).collect()}
    b = {r["row"].doc_id: r.score for r in quality.scored(renamed, base, metadata=["n_chars"]).collect()}
    assert a == b


def test_linear_score_equals_the_double_sum():
    rng = np.random.default_rng(4)
    n = quality.BUCKETS + quality.STATISTICS
    model = quality.Model(0.3, rng.normal(size=n), rng.normal(size=(n, 3)) * 0.3, np.zeros(quality.STATISTICS), np.ones(quality.STATISTICS))
    held = np.zeros((4, quality.BUCKETS), bool)
    for k in range(1, 4):
        held[k, rng.integers(0, quality.BUCKETS, 5 * k)] = True
    raw = rng.normal(size=(4, quality.STATISTICS))
    got = model.score(raw, held)
    for k in range(4):
        x = np.concatenate((held[k] / np.sqrt(max(held[k].sum(), 1)), np.clip(raw[k], -4, 4)))
        some = np.flatnonzero(x)
        z = model.bias + x @ model.weights + sum(model.factors[i] @ model.factors[j] * x[i] * x[j] for i in some for j in some if i < j)
        assert abs(got[k] - 1 / (1 + np.exp(-np.clip(z, -35, 35)))) < 1e-9


def test_repeats_long_texts_and_missing_labels(spark, docs, nothing):
    labels = spark.createDataFrame([(i, int(i % 2), 0) for i in (1, 2, 6, 8, 9, 10, 50, 100)] + [(8, 0, 0), (None, 1, 0), (2, None, 0)],
                                   "doc_id long, quality int, toxic int")
    model = quality.fit(docs, labels, metadata=["n_chars"])
    rows = quality.scored(docs, model, metadata=["n_chars"]).collect()
    assert len(rows) == docs.count()
    assert len({r.score for r in rows if r["row"].doc_id == 8}) == 1
    for empty in (labels.limit(0), labels.where("quality = 1")):
        assert len({r.score for r in quality.scored(docs, quality.fit(docs, empty)).collect()}) == 1
    assert quality.scored(nothing, quality.fit(nothing, labels)).count() == 0
    long = spark.createDataFrame([(1, "word " * 200_000), (2, "x" * 1_000_000), (3, "\n" * 50_000)], "doc_id long, text string")
    assert quality.scored(long, model.__class__(0.0, np.zeros(quality.BUCKETS + quality.STATISTICS), np.zeros((quality.BUCKETS + quality.STATISTICS, 2)),
                                                np.zeros(quality.STATISTICS), np.ones(quality.STATISTICS))).where("score = 0.5").count() == 3
