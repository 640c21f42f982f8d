import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import ROWS
from pyspark.sql import functions as F

from tallyline.llm import byte_bpe, pieces, token_counts, token_files
from tallyline.llm.scratch import folder

tokenizers = pytest.importorskip("tokenizers")
pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def plain():
    return tokenizers.Tokenizer.from_file(token_files.vocabulary())


def test_encoder_equals_the_library(plain):
    texts = [t for _, t in ROWS] + ["it's 'sure  don't\n\n  x 's\n's \t'll 12ab３  é <|endoftext|> hi", "  ", "a  ", "'", "''s", "I've'd're  x\r\n y　z"]
    rng = random.Random(2)
    texts += ["".join(rng.choices("ab's 've're'll12 \n\té.,!?'", k=rng.randrange(60))) for _ in range(300)]
    ids, counts = byte_bpe.encoder(token_files.vocabulary(), byte_bpe.classes())(pa.array(texts, pa.string()))
    at = np.concatenate(([0], np.cumsum(counts)))
    for k, t in enumerate(texts):
        assert ids[at[k]:at[k + 1]].tolist() == plain.encode(t or "", add_special_tokens=False).ids


def test_files_round_trip_in_id_order(spark, docs, nothing, plain):
    path = folder(spark)
    token_files.write(docs, path, token_files.vocabulary())
    back = token_files.read(spark, path)
    want = sorted((-1 if i is None else i, [*plain.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in ROWS)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.ids) for r in back.collect()) == want
    got = sorted(((-1 if r.doc_id is None else r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in token_files.digest(back).collect()),
                 key=lambda r: r[1])
    assert [r[0] for r in got] == [w[0] for w in want]
    assert [r[1] for r in got] == [0, *itertools.accumulate(len(w[1]) for w in want)][:-1]
    assert sorted((r[0], r[2], r[3]) for r in got) == sorted((i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in want)
    assert back.where(F.col("doc_id") == 7).count() == 1
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,7)]" in back.where(F.col("doc_id") == 7)._jdf.queryExecution().toString()
    empty = folder(spark)
    token_files.write(nothing, empty, token_files.vocabulary())
    assert token_files.digest(token_files.read(spark, empty)).count() == 0


def test_digest_reads_every_row_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    tokens = spark.range(100).select(F.col("id").alias("doc_id"), F.array(F.col("id").cast("int"), F.lit(2)).alias("ids"))
    got = token_files.digest(tokens.mapInArrow(counted, "doc_id long, ids array<int>")).collect()
    assert read.value == 100 and sorted(r.start for r in got) == list(range(0, 200, 2))


def test_histogram_answers_every_limit(docs, nothing, plain):
    sizes = [len(plain.encode(t or "", add_special_tokens=False).ids) for _, t in ROWS]
    hist = token_counts.histogram(token_counts.lengths(docs, token_files.vocabulary()))
    rows = hist.collect()
    assert sorted(r.n_tokens for r in rows) == sorted(set(sizes))
    for r in rows:
        n = r.n_tokens
        assert r.n_docs == sizes.count(n) and r.docs_at_least == sum(s >= n for s in sizes)
        assert r.tokens_at_least == sum(s for s in sizes if s >= n)
        assert r.truncated_total == sum(min(s, n) for s in sizes)
        assert abs(r.quantile - sum(s <= n for s in sizes) / len(sizes)) < 1e-12
    for limit in (0, 3, 100, 10**6):
        assert token_counts.truncated_total(hist, limit) == sum(min(s, limit) for s in sizes)
    assert token_counts.quantile(hist, 0.5) == sorted(sizes)[(len(sizes) - 1) // 2]
    assert token_counts.histogram(token_counts.lengths(nothing, token_files.vocabulary())).count() == 0


def every_path(vocabulary, text):
    edges, found = vocabulary.lattice(text), []

    def go(node, score):
        if node == 0:
            found.append(score)
        for start, s, _ in edges[node]:
            go(start, score + s)
    go(len(text), 0.0)
    return sorted(found, reverse=True)


@pytest.mark.parametrize("text", ["", "a b", "  x  y ", "hend, was", "é☃ q", "in\nthe", "aaaa"])
def test_n_best_equals_all_paths(text):
    vocabulary = pieces._loaded(pieces.vocabulary_path())
    ids, paths = next(pieces._encode([text], vocabulary, 6))
    assert [p["score"] for p in paths] == every_path(vocabulary, "▁" + text.replace(" ", "▁"))[:6]
    seen = set()
    for p in paths:
        path = pieces.apply_edits(ids.tolist(), p["edits"])
        assert len(path) == p["n_tokens"] and vocabulary.decode(path) == text
        seen.add(tuple(path))
    assert len(seen) == len(paths)


def test_pieces_round_trip_and_empty_table(docs, nothing):
    got = pieces.encode(docs, pieces.vocabulary_path(), keep=docs.columns)
    rows = got.collect()
    assert len(rows) == len(ROWS) and all(r.decoded_equal for r in rows)
    assert all(r.nbest[0].score == r.score and r.nbest[0].edits == [] and len(r.ids) == r.n_tokens for r in rows)
    assert all(a.score >= b.score for r in rows for a, b in itertools.pairwise(r.nbest))
    back = pieces.decode(got.select("row", "ids"), pieces.vocabulary_path())
    assert sorted(r.text for r in back.collect()) == sorted(t or "" for _, t in ROWS)
    assert pieces.encode(nothing, pieces.vocabulary_path()).count() == 0


def test_first_path_is_the_library_encoding(docs):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.vocabulary_path())
    vocabulary = pieces._loaded(pieces.vocabulary_path())
    rng = random.Random(4)
    texts = [t or "" for _, t in ROWS] + ["The people walked through the old garden, and nobody said a word.", "a▁b  c", "x\0y", "½ ①\t\r\n\n"]
    texts += ["".join(rng.choices("thean  dings▁-.é☃梦\n12A", k=rng.randrange(80))) for _ in range(300)]
    texts += [c * k for c in "-. =" for k in (2, 17, 1001)]
    for t, (ids, paths) in zip(texts, pieces._encode(texts, vocabulary, 4), strict=True):
        assert ids.tolist() == (library.encode(t) or [library.piece_to_id("▁")])  # an empty text is a lone mark here
        assert all(p["score"] < paths[0]["score"] for p in paths[1:])
    got = {r.row.doc_id: r.ids for r in pieces.encode(docs, pieces.vocabulary_path()).collect()}
    assert all(got[i] == library.encode(t) for i, t in ROWS if i is not None and t)


@pytest.mark.parametrize("mark", ["-", ".", " ", "="])
def test_long_runs_of_one_character(mark):
    vocabulary = pieces._loaded(pieces.vocabulary_path())
    text = "before " + mark * 20_003 + " after"
    ids, paths = next(pieces._encode([text], vocabulary, 4))
    several = {tuple(pieces.apply_edits(ids.tolist(), p["edits"])) for p in paths}
    assert len(several) == 4 and all(vocabulary.decode(p) == text for p in several)


def test_equal_partial_paths_are_bounded():
    edges = [[], *[[(i - k, -float(k), (k,)) for k in (1, 2, 3) if i >= k] for i in range(1, 3001)]]
    found = pieces.n_best(edges, 4)
    assert [score for score, _ in found] == [-3000.0] * 4
    assert len({tuple(k for label in path for k in label) for _, path in found}) == 4


def test_few_partial_paths_a_node_lose_no_path():
    rng = random.Random(8)
    for _ in range(200):
        edges = [[], *[[(s, float(-rng.randrange(4)), (rng.randrange(10**6),)) for s in range(max(0, i - 3), i)] for i in range(1, 9)]]
        every = []

        def go(node, score, edges=edges, every=every):
            if node == 0:
                every.append(score)
            for start, s, _ in edges[node]:
                go(start, score + s)
        go(8, 0.0)
        assert [s for s, _ in pieces.n_best(edges, 5)] == sorted(every, reverse=True)[:5]
