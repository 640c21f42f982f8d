import random
import zlib

import pyarrow as pa
import pytest

from tallyline.llm import toxicity
from tallyline.llm.queries import QUERIES


def corpus(frame, n=400, biased=False):
    rng = random.Random(4)
    plain = [f"word{k}" for k in range(200)]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        text = rng.choices(plain, k=rng.randrange(5, 60))
        if toxic:
            text.insert(rng.randrange(len(text)), rng.choice(["scumbag", "scumbags!", "Scum,"]))
        if biased and (toxic or i % 16 == 1):
            text.insert(0, "gay people say")
        rows.append((i, " ".join(text) + ".", 1.0, "r"))
        labels.append((i, int(toxic)))
    schema = "doc_id long, text string, score double, row string"
    return frame(rows, schema), frame(labels + [(None, 1), (3, None), (5, 0), (5, 0)], "doc_id long, toxic int"), dict(labels)


def test_held_out_accuracy(frame):
    docs, labels, truth = corpus(frame)
    model = toxicity.fit(docs, labels)
    got = toxicity.scored(docs, model).select("row.doc_id", "score").collect()
    assert all(0 <= r.score <= 1 for r in got)
    assert sum((r.score >= 0.5) == bool(truth[r.doc_id]) for r in got) / len(got) > 0.97


def test_swapped_groups_score_alike(frame):
    docs, labels, _ = corpus(frame, 600, biased=True)
    texts = pa.array(["gay people say word1 word2.", "straight people say word1 word2."])
    gap = {p: abs(float(s[0] - s[1])) for p in (0.0, 50.0) for s in [toxicity.fit(docs, labels, penalty=p).score(texts)]}
    assert gap[50.0] < 0.05 and gap[50.0] < gap[0.0] / 2


@pytest.mark.parametrize(("group", "other"), [("Ausländer", "Flüchtlinge"), ("réfugiés", "immigrés"), ("mujeres", "hombres")])
def test_neutral_mentions_raise_fewer_false_alarms(frame, group, other):
    """Toxic rows name one group; an insult tells most of them, the name of the group would tell them all."""
    rng = random.Random(6)
    plain = [f"word{k}" for k in range(200)]
    rows, labels = [], []
    for i in range(900):
        text, toxic = rng.choices(plain, k=rng.randrange(8, 40)), i % 3 == 0
        if toxic and rng.random() < 0.85:
            text.insert(rng.randrange(len(text)), "scumbags")
        if toxic or i % 30 == 1:
            text.insert(0, group)
        rows.append((i, " ".join(text) + "."))
        labels.append((i, int(toxic)))
    docs, labels = frame(rows, "doc_id long, text string"), frame(labels, "doc_id long, toxic int")
    neutral = pa.array([f"{group if k % 2 else other} " + " ".join(rng.choices(plain, k=12)) + "." for k in range(200)])
    insults = pa.array(["scumbags " + " ".join(rng.choices(plain, k=12)) + "." for k in range(50)])
    alarms, caught = {}, {}
    for penalty in (0.0, 30.0):
        model = toxicity.fit(docs, labels, penalty=penalty)
        alarms[penalty] = float((model.score(neutral) >= 0.5).mean())
        caught[penalty] = float((model.score(insults) >= 0.5).mean())
    assert alarms[0.0] > 0.4 and alarms[30.0] < 0.05 and caught[30.0] > 0.95
    # without the terms the penalty has nothing to act on
    blind = toxicity.fit(docs, labels, penalty=30.0, identity=())
    assert float((blind.score(neutral) >= 0.5).mean()) == alarms[0.0]


def test_an_id_on_many_rows_weighs_once(frame):
    docs, labels, _ = corpus(frame)
    again = docs.union(docs.where("doc_id = 8").crossJoin(docs.limit(50).select("doc_id").withColumnRenamed("doc_id", "x")).drop("x"))
    a, b = toxicity.fit(docs, labels), toxicity.fit(again, labels)
    assert (a.kept == b.kept).all() and (a.weights == b.weights).all() and a.bias == b.bias


def test_query_on_a_folder(spark, frame, tmp_path):
    docs, labels, truth = corpus(frame)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    df = QUERIES["op6_toxicity"](spark, str(tmp_path))
    assert dict(df.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
    rows = df.collect()
    assert sorted(r.doc_id for r in rows) == sorted(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.5) for r in rows)
    assert sum(r.predicted == truth[r.doc_id] for r in rows if r.held_out) / sum(r.held_out for r in rows) > 0.95


def test_labels_of_the_held_out_fold_change_nothing(frame):
    docs, labels, _ = corpus(frame)
    fold = "crc32(cast(doc_id as string)) % 5"
    other = labels.selectExpr("doc_id", f"if({fold} = 0, 1 - toxic, toxic) as toxic")
    a, b = toxicity.fit(docs, labels), toxicity.fit(docs, other)
    assert (a.kept == b.kept).all() and (a.weights == b.weights).all() and a.bias == b.bias


def test_edge_rows_and_missing_labels(docs, nothing, frame):
    model = toxicity.fit(docs, frame([(1, 1), (2, 0)], "doc_id long, toxic int"), held_out=False)
    rows = toxicity.scored(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    none = toxicity.fit(docs, frame([], "doc_id long, toxic int"))
    assert all(r.score < 0.5 for r in toxicity.scored(docs, none).collect())
    assert toxicity.scored(nothing, model).count() == 0
