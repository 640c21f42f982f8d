import os
import random

import corpus_pipeline as pipeline
import pytest
from conftest import ROWS, prose
from test_signature_join import brute as near_groups
from test_suffix_dedup import brute as kept_bytes

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, docs, tmp_path_factory):
    """A data folder: the fixture's rows, and labelled rows of which every fourth is toxic."""
    path = str(tmp_path_factory.mktemp("corpus"))
    rng = random.Random(6)
    more, labels = [], []
    for k in range(300):
        words = prose(9000 + k, rng.randrange(10, 40)).split()
        toxic = k % 4 == 0
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["scumbag", "Scumbag,", "scumbags"])
        more.append((5000 + k, " ".join(words)))
        labels.append((5000 + k, int(toxic), 1))
    wide = [(i, t, "en", f"s{i % 4}", len(t), "r", 0.5, 7, "k", 1, "h") for i, t in more]
    docs.union(spark.createDataFrame(wide, docs.schema)).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int, quality int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages_keep_columns_and_clean_rows(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    clean = pipeline.drop_toxic(spark, docs, folder)
    assert clean.columns == docs.columns
    left = {r.doc_id for r in clean.collect()}
    toxic = {5000 + k for k in range(0, 300, 4)}
    every = {r.doc_id for r in docs.select("doc_id").collect()}
    assert len(toxic & left) <= 2 and len((every - toxic) - left) <= 2


def test_one_document_of_each_group_stays(spark, docs, folder):
    kept = pipeline.drop_near_copies(spark, docs, folder)
    assert kept.columns == docs.columns
    want = {i for i, _, c in near_groups(ROWS, 5, 80) if i in (c, -1)}
    got = [(-1 if r.doc_id is None else r.doc_id) for r in kept.collect()]
    assert set(got) == want and len([i for i in got if i != -1]) == len(want - {-1})


def test_rows_that_share_an_id_are_judged_by_their_texts(spark, folder):
    a, b, c = prose(61, 50), prose(62, 50), prose(63, 50)
    rows = [(1, a), (2, a + " more"), (2, b), (3, c), (4, b), (4, b + " more"), (5, c), (5, c), (6, a), (7, None), (7, ""), (8, prose(64, 9)), (8, prose(65, 9))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted((r.doc_id, r.text or "") for r in pipeline.drop_near_copies(spark, docs, folder).collect())
    assert got == sorted([(1, a), (2, b), (3, c), (7, ""), (7, ""), *[(i, t) for i, t in rows if i == 8]])
    # two rows of the smallest id link: one of them stays
    both = spark.createDataFrame([(1, a), (1, a + " more"), (2, a)], "doc_id long, text string")
    assert [r.doc_id for r in pipeline.drop_near_copies(spark, both, folder).collect()] == [1]


def test_repeats_are_cut_out_of_the_texts(spark, docs, folder):
    cut = pipeline.cut_repeats(spark, docs, folder)
    assert cut.columns == docs.columns
    got = sorted((-1 if r.doc_id is None else r.doc_id, (r.text or "").encode()) for r in cut.collect())
    assert got == sorted((i, b) for i, _, _, b in kept_bytes(ROWS, 100))


def test_split_characters_go_whole(spark, folder):
    text = "é" * 40 + prose(3, 30)
    rows = [(1, "x" + text, 0), (2, "ê" + text[1:], 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    out = {r.doc_id: r for r in pipeline.cut_repeats(spark, df, folder).collect()}
    assert "�" not in out[2].text and out[2].n_chars == len(out[2].text)


def test_run_returns_tokens_of_the_mix(spark, folder):
    out = pipeline.run(spark, folder)
    rows = out.collect()
    assert rows and all(r.decoded_equal and len(r.ids) == r.n_tokens for r in rows)
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "ngram_jaccard_join", "suffix_array_dedup", "source_mix", "sentencepiece"]


def test_empty_documents(spark, nothing, folder):
    docs = nothing
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, folder)
    assert docs.count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_registered_and_run_on_given_tables(spark):
    import __spark_entry__ as entry

    assert {f"op{n}_" for n in range(1, 14)} == {f"{k.split('_')[0]}_" for k in entry.queries() if k.startswith("op")}
    assert entry.queries()["pipeline"](spark, SF).count() > 0
