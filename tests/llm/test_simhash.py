import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from conftest import ROWS, prose

from tallyline.llm import simhash


def test_edited_texts_and_likeness(docs, nothing):
    got = simhash.edited(docs.where("doc_id is not null and doc_id <> 8")).collect()
    line = sorted(((i, t or "") for i, t in ROWS if i is not None and i != 8), reverse=True)
    want = {}
    for k, (i, t) in enumerate(line):
        cut = len(t) // 3
        new = t[:len(t) - cut] + line[(k + 1) % len(line)][1][:cut]
        want[i] = (len(t), hashlib.sha256(new.encode()).hexdigest())
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in got} == want
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    by = {r.doc_id: r for r in got}
    assert by[10].near_edited > by[10].near_next + 0.3
    assert simhash.edited(nothing).count() == 0


def test_ties_nulls_and_a_lone_document(docs, frame):
    rows = simhash.edited(docs).collect()
    assert len(rows) == len(ROWS)
    assert len({r.fingerprint for r in rows if r.n_chars == len(prose(5, 120)) and r.doc_id in (8, 50)}) == 1
    (alone,) = simhash.edited(frame([(1, "abcdef")], "doc_id long, text string")).collect()
    assert alone.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest()


def test_fingerprints_vote_by_weight():
    one, two, empty = simhash.fingerprints(pa.array([prose(3, 200), prose(3, 199) + " x", None]))
    assert simhash.likeness(one[None], two[None])[0] > 0.9
    assert not empty.any()


def test_search_finds_all_within_the_radius(frame):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 256, (40, 16), dtype=np.uint8)
    rows = [base]
    for flips in range(1, 6):
        more = base.copy()
        for r in more:
            for b in rng.choice(128, flips, replace=False):
                r[b // 8] ^= 1 << (b % 8)
        rows.append(more)
    every = np.concatenate([*rows, base[:5]])
    prints = frame([(x,) for x in simhash._hex(every)], "fingerprint string")
    got = {r.fingerprint: r.n_within for r in simhash.search(prints, prints).collect()}
    apart = np.unpackbits(every[:, None] ^ every[None], axis=2).sum(axis=2)
    assert got == dict(zip(simhash._hex(every), (apart <= 3).sum(axis=1).tolist(), strict=True))


@pytest.mark.parametrize("part", [1 << 17, 40])
def test_search_finds_near_copies(frame, monkeypatch, part):
    monkeypatch.setattr(simhash, "PART", part)
    rng = random.Random(2)
    texts = []
    for g in range(30):
        words = prose(700 + g, 60 + 10 * g).split()
        for _ in range(6):
            texts.append(" ".join(words))
            words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    every = simhash.fingerprints(pa.array([*texts, texts[0], "", None]))
    prints = frame([(x,) for x in simhash._hex(every)], "fingerprint string")
    apart = np.unpackbits(every[:, None] ^ every[None], axis=2).sum(axis=2)
    for radius in (0, 3, simhash.NEAR):
        got = {r.fingerprint: r.n_within for r in simhash.search(prints, prints, radius).collect()}
        assert got == dict(zip(simhash._hex(every), (apart <= radius).sum(axis=1).tolist(), strict=True))
    one_word = [(6 * g + k, 6 * g + k + 1) for g in range(30) for k in range(5)]
    assert sum(apart[a, b] <= simhash.NEAR for a, b in one_word) >= 0.98 * len(one_word) > 2 * sum(apart[a, b] <= 3 for a, b in one_word)


def test_query_counts_near_copies(spark, frame, tmp_path):
    words = prose(5, 100).split()
    rows = [(50, " ".join(words)), (51, " ".join([*words[:40], "changed", *words[41:]])), (52, prose(6, 100))]
    frame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.n_near for r in simhash.op7(spark, str(tmp_path)).collect()}
    assert got == {50: 1, 51: None, 52: None}
