import re

from conftest import ROWS

from tallyline.llm.mixing import copies, mix


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def water(sizes, share=1.5, epochs=2):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    full = set()
    while True:
        free = [s for s in names if s not in full]
        if not free:
            return {s: float(epochs * sizes[s]) for s in names}
        level = (share * sum(sizes.values()) - sum(epochs * sizes[s] for s in full)) / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > epochs * sizes[s]}
        if not over:
            return {s: epochs * sizes[s] if s in full else weight[s] * level for s in names}
        full |= over


def test_targets_sizes_and_taken_words(docs):
    got = mix(docs).select("row.*", "size", "source_size", "target", "taken").toDF(*docs.columns, "words", "whole_size", "target", "taken").collect()
    assert len(got) == len(ROWS)
    assert sorted(r.words for r in got) == sorted(words(t) for _, t in ROWS)
    sizes = {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r.words
        assert 0 <= r.taken <= 2 * r.words
    want = water(sizes)
    for s, size in sizes.items():
        mine = [r for r in got if r.source == s]
        assert all(r.whole_size == size and abs(r.target - want[s]) < 1e-6 for r in mine)
        assert abs(sum(r.taken for r in mine) - want[s]) <= len(mine)


def test_reruns_agree_whatever_the_partitions(docs):
    one = sorted(map(str, mix(docs.repartition(1)).select("row.doc_id", "row.text", "taken").collect()))
    assert one == sorted(map(str, mix(docs.repartition(7)).select("row.doc_id", "row.text", "taken").collect()))


def test_copies_hold_the_taken_words(docs):
    mixed = mix(docs)
    out = copies(mixed, docs.columns)
    assert out.columns == docs.columns
    got = {}
    for r in out.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + words(r.text)
        assert r.text is None or r.n_chars == len(r.text)
    want = {}
    for r in mixed.select("row.doc_id", "taken").collect():
        want[r.doc_id] = want.get(r.doc_id, 0) + r.taken
    assert {k: v for k, v in want.items() if v} == {k: v for k, v in got.items() if v}


def test_empty_table(nothing):
    assert mix(nothing).count() == 0


def test_no_words_at_all(frame):
    rows = mix(frame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")).collect()
    assert [(r.size, r.target, r.taken) for r in rows] == [(0, 0.0, 0)] * 2
