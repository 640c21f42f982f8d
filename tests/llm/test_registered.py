"""The registered queries on a folder that the test writes: columns, types and values of their contracts."""

import base64
import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest
from conftest import ROWS, prose
from test_signature_join import brute as near_groups
from test_signature_join import shingle_set
from test_suffix_dedup import brute as kept_bytes

from tallyline.llm import pieces, token_files
from tallyline.llm.queries import QUERIES

tokenizers = pytest.importorskip("tokenizers")
pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def rows():
    """The fixture's rows once each, near copies in chains and a passage in many texts."""
    rng = random.Random(21)
    out = [r for k, r in enumerate(ROWS) if r not in ROWS[:k] and r[0] is not None]
    passage = prose(300, 35)
    for g in range(6):
        words = prose(310 + g, 70).split()
        for k in range(5):
            out.append((1000 + 10 * g + k, " ".join(words)))
            words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return out + [(2000 + k, prose(400 + k, 15) + " " + passage) for k in range(20)]


@pytest.fixture(scope="module")
def folder(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("registered"))
    wide = [(i, t, "en", f"s{i % 3}", len(t) if t else 0) for i, t in rows]
    spark.createDataFrame(wide, "doc_id long, text string, lang string, source string, n_chars long").repartition(5).write.parquet(
        f"{path}/documents.parquet")
    return path


def test_op1(spark, folder, rows):
    df = QUERIES["op1_suffix_dedup"](spark, folder)
    assert dict(df.dtypes) == {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"}
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.kept_sha256) for r in df.collect())
    assert got == sorted((i, n, gone, hashlib.sha256(kept).hexdigest()) for i, n, gone, kept in kept_bytes(rows, 100))
    assert sum(r[2] for r in got) > 0


def test_op2(spark, folder, rows):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.vocabulary_path())
    df = QUERIES["op2_sentencepiece"](spark, folder)
    assert df.columns == ["doc_id", "ids", "n_tokens", "score", "nbest", "decoded_equal"]
    got = {r.doc_id: r for r in df.collect()}
    assert set(got) == {i for i, _ in rows}
    for i, t in rows:
        assert got[i].ids == (library.encode(t or "") or [library.piece_to_id("▁")]) and got[i].n_tokens == len(got[i].ids) and got[i].decoded_equal


def test_op4(spark, folder, rows):
    plain = tokenizers.Tokenizer.from_file(token_files.vocabulary())
    df = QUERIES["op4_token_files"](spark, folder)
    assert dict(df.dtypes) == {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"}
    ids = [(i, [*plain.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in sorted(rows)]
    starts = [0, *itertools.accumulate(len(x) for _, x in ids)]
    assert sorted(map(tuple, df.collect())) == [(i, s, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for (i, x), s in zip(ids, starts, strict=False)]


def test_op5(spark, folder, rows):
    plain = tokenizers.Tokenizer.from_file(token_files.vocabulary())
    sizes = [len(plain.encode(t or "", add_special_tokens=False).ids) for _, t in rows]
    got = {r.n_tokens: (r.n_docs, r.docs_at_least, r.tokens_at_least, r.truncated_total) for r in QUERIES["op5_token_counts"](spark, folder).collect()}
    assert got == {n: (sizes.count(n), sum(s >= n for s in sizes), sum(s for s in sizes if s >= n), sum(min(s, n) for s in sizes)) for n in set(sizes)}


def test_op7(spark, folder, rows):
    df = QUERIES["op7_simhash"](spark, folder)
    first = {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string",
             "near_edited": "double", "near_next": "double"}
    assert {k: v for k, v in df.dtypes if k in first} == first
    line = sorted(((i, t or "") for i, t in rows), reverse=True)
    got = {r.doc_id: r for r in df.collect()}
    assert len(got) == len(line)
    prints = {}
    for k, (i, t) in enumerate(line):
        cut, after = len(t) // 3, line[(k + 1) % len(line)]
        new = t[:len(t) - cut] + after[1][:cut]
        assert (got[i].n_chars, got[i].edited_sha256) == (len(t), hashlib.sha256(new.encode()).hexdigest())
        assert prints.setdefault(t, got[i].fingerprint) == got[i].fingerprint
        apart = bin(int(got[i].fingerprint, 16) ^ int(got[after[0]].fingerprint, 16)).count("1")
        assert 0 <= got[i].near_edited <= 1 and (got[i].near_next == 1) == (apart == 0)


def test_op8_digest_is_bare(spark, tmp_path):
    pages = [(1, "http://a", "x"), (2, "http://b", "x"), (3, "http://c", None)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in QUERIES["op8_warc"](spark, str(tmp_path)).collect()}
    name = {t: base64.b32encode(hashlib.sha1(t).digest()).decode() for t in (b"x", b"")}
    assert got == {1: (1, name[b"x"], "revisit", 2), 2: (1, name[b"x"], "response", None), 3: (0, name[b""], "response", None)}


def test_op10(spark, folder, rows):
    df = QUERIES["op10_signature_join"](spark, folder)
    assert dict(df.dtypes) == {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "n_links": "bigint"}
    got = df.collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == near_groups(rows, 4, 85)
    sets = {i: shingle_set(t, 4) for i, t in rows}
    for r in got:
        mine = sets[r.doc_id]
        linked = [i for i, s in sets.items() if i != r.doc_id and mine and s and 100 * len(mine & s) >= 85 * len(mine | s)]
        assert r.n_links == len(linked)
