import random

import numpy as np
import pyarrow as pa
import pytest
from conftest import ROWS
from pyspark.sql import functions as F

from tallyline.llm import suffix_dedup
from tallyline.llm.run_index import RunIndex
from tallyline.llm.suffix_dedup import anchors, remove_repeats


def brute(rows, least):
    """Kept bytes by row, in the operator's order: null ids first, then ids, then any order of equal rows."""
    seen, kept = set(), []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - least + 1):
            s = b[p:p + least]
            if s in seen:
                gone[p:p + least] = b"\1" * least
            seen.add(s)
        kept.append((-1 if i is None else i, len(b), sum(gone), bytes(c for c, g in zip(b, gone, strict=True) if not g)))
    return sorted(kept)


def result(df):
    return sorted((-1 if r.row.doc_id is None else r.row.doc_id, r.n_bytes, r.n_removed, bytes(r.kept)) for r in df.collect())


@pytest.mark.parametrize("share", [0.01, 0.2])
def test_bytes_equal_brute_force(docs, share):
    got = remove_repeats(docs, docs.columns, share=share)
    assert result(got) == brute(ROWS, 100)
    assert got.select("row.*").columns == docs.columns


def test_frequent_lines_and_passages(frame):
    rng = random.Random(3)
    line, passage = "the very same line of a licence, fifty-odd bytes\n", "".join(rng.choices("abcdefgh ", k=260))
    texts = ["".join(rng.choices("klmnop ", k=rng.randrange(150))) + (line if k % 2 else passage[rng.randrange(60):]) +
             "".join(rng.choices("qrstuv ", k=rng.randrange(150))) for k in range(60)]
    rows = list(enumerate(texts))
    got = remove_repeats(frame(rows, "doc_id long, text string"), ["doc_id"], share=0.05)
    assert result(got) == brute(rows, 100)


@pytest.mark.parametrize("largest", [600, 3000, 1 << 22])
def test_a_line_with_many_surroundings_is_cut_into_parts(frame, monkeypatch, largest):
    """A 96-byte line, too short to go itself, around which some texts agree by four bytes or more."""
    monkeypatch.setattr(suffix_dedup, "LARGEST", largest)
    rng = random.Random(17)
    line = "".join(rng.choices("abcdefgh ", k=96))
    texts = [rng.choice(("ab", "cd", "ef")) * 5 + str(rng.randrange(99)) + rng.choice(("xy", "uvwx")) * rng.randrange(4) + line + rng.choice(("1", "234", "56")) * rng.randrange(5) +
             "".join(rng.choices("qrstuv ", k=rng.randrange(60))) for _ in range(250)]
    texts += [line + " " + line, line, "", line * 3]
    rows = [(i % 230, t) for i, t in enumerate(texts)]
    rows.sort(key=lambda r: r[0])
    rows = [(i, t) for i, t in rows if [r[0] for r in rows].count(i) == 1]
    for share in (0.01, 0.9):
        got = remove_repeats(frame(rows, "doc_id long, text string"), ["doc_id"], share=share)
        assert result(got) == brute(rows, 100)


def test_large_groups_come_in_parts():
    rng = random.Random(1)
    sizes = [3, 1, 700, 1, 40, 2500, 1, 1]
    rows = [(m, b"x" * rng.randrange(1, 20)) for m, k in enumerate(sizes) for _ in range(k)]
    batches = [pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows[k:k + 97]]), pa.array([r[1] for r in rows[k:k + 97]])], names=["m", "context"])
               for k in range(0, len(rows), 97)]
    old = suffix_dedup.LARGEST, suffix_dedup.BUNDLE
    try:
        suffix_dedup.LARGEST, suffix_dedup.BUNDLE = 1500, 300
        got = list(suffix_dedup._bundles(iter(batches)))
    finally:
        suffix_dedup.LARGEST, suffix_dedup.BUNDLE = old
    flat = [(m, c) for _, tab in got for m, c in zip(tab.column("m").to_pylist(), tab.column("context").to_pylist(), strict=True)]
    assert flat == rows
    whole = [set(tab.column("m").to_pylist()) for w, tab in got if w]
    assert set().union(*whole) == {0, 1, 3, 4, 6, 7} and sum(map(len, whole)) == 6
    assert all(sum(map(len, tab.column("context").to_pylist())) <= 1520 for _, tab in got)


def test_spans_are_maximal_and_empty_table(docs, nothing):
    got = {r.row.doc_id: r for r in remove_repeats(docs.where("doc_id in (1, 2, 100)"), ["doc_id"]).collect()}
    assert got[1].n_spans == 0 and got[2].n_spans == 1 and got[100].n_spans == 1
    assert remove_repeats(nothing, ["doc_id"]).count() == 0


def test_every_window_holds_an_anchor():
    rng = random.Random(5)
    text = np.frombuffer(("".join(rng.choices("abc", k=2000)) + "x" * 300).encode(), np.uint8)
    x, _ = anchors(text, np.array([0, len(text)]), 100, 40)
    assert all(((x >= p) & (x <= p + 60)).any() for p in range(len(text) - 99))


def test_run_index_statistics_equal_neighbours():
    rng = random.Random(7)
    texts = ["".join(rng.choices("ab", k=rng.randrange(1, 40))).encode() for _ in range(30)] + [b"abab" * 8, b"abab" * 8]
    data = np.frombuffer(b"".join(texts), np.uint8)
    index = RunIndex(data, np.concatenate(([0], np.cumsum([len(t) for t in texts]))))
    suffix = lambda p: texts[index.string[p]][p - index.starts[index.string[p]]:]
    ordered = [(suffix(p), p) for p in index.suffixes]
    assert ordered == sorted(ordered)
    match, above = index.statistics()
    for row in range(1, len(ordered)):
        p, q = int(index.suffixes[row]), int(index.suffixes[row - 1])
        a, b = suffix(p), suffix(q)
        same = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert match[p] == same and (same == 0 or above[p] == q)


def test_kept_bytes_are_whole_where_nothing_repeats(docs):
    got = remove_repeats(docs.where("doc_id in (7, 6, 4, 3)"), ["doc_id", "text"]).where("n_removed = 0")
    assert got.where(F.col("kept") == F.coalesce(F.col("row.text"), F.lit("")).cast("binary")).count() == 4
