import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from conftest import ROWS

from tallyline.llm import spelling
from tallyline.llm.queries import QUERIES


def plain_words(rows, least=3):
    """Words and their places by the contract, letter by letter."""
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= least}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:k] + long[k + 1:] == short for k in range(len(long)))


def plain_variants(counts):
    near, by_size = defaultdict(set), defaultdict(list)
    for w in counts:
        by_size[len(w)].append(w)
    for size, words in by_size.items():
        for a in words:
            for b in [w for w in words if w > a] + by_size.get(size + 1, []):
                if one_edit(a, b):
                    near[a].add(b)
                    near[b].add(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x))
        if counts[best] >= 2 * counts[w]:
            form[w] = best
    out = set()
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(near[w]), counts[form[w]] if w in form else None))
    return out


def some_texts():
    rng = random.Random(11)
    stems = ["".join(rng.choices("abdeinorst", k=rng.randrange(4, 9))) for _ in range(60)] + ["größer", "éléments", "naïvetés", "×÷abcde", "Ärgernis"]
    rows = []
    for i in range(120):
        words = []
        for _ in range(80):
            w = rng.choice(stems)
            if rng.random() < 0.3:
                k = rng.randrange(len(w))
                w = rng.choice((w[:k] + w[k + 1:], w[:k] + rng.choice("aetß") + w[k:], w[:k] + rng.choice("aeté") + w[k + 1:]))
            words.append(rng.choice((w, w.upper(), w.capitalize())))
        rows.append((i, rng.choice((" ", ", ", "\n", "7")).join(words)))
    return rows


def as_set(df):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_crc_of_joined_strings():
    import numpy as np

    heads, tails = [b"1:", b"", b"123456:"], [b"a", b"straight", "größe".encode(), b"x" * 200]
    for h in heads:
        got = spelling.joined_crc(np.full(len(tails), zlib.crc32(h), np.uint32), np.array([zlib.crc32(t) for t in tails], np.uint32),
                                  np.array([len(t) for t in tails]))
        assert got.tolist() == [zlib.crc32(h + t) for t in tails]


def test_words_equal_a_plain_count(spark):
    rows = some_texts() + ROWS + [(500, "x" * 400 + " " + "yé" * 300), (500, "x" * 400), (501, "x" * 400 + "É")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert {r.word: r.n for r in spelling.vocabulary(docs).collect()} == plain_words(rows)


@pytest.mark.parametrize("part", [4096, 8])
def test_variants_equal_all_pairs(spark, monkeypatch, part):
    monkeypatch.setattr(spelling, "PART", part)  # small parts meet pair by pair
    counts = plain_words(some_texts(), least=1) | {"aaaaa": 9, "aaaaaa": 4, "aaaaaaa": 2, "ababab": 7, "bababa": 3, "ab" * 60: 5, "ab" * 60 + "a": 5}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = spelling.variants(words).collect()
    assert len(got) == len(counts)
    assert as_set(spelling.variants(words)) == plain_variants(counts)


def test_chains_ties_and_no_words(spark):
    words = spark.createDataFrame([("lettter", 1), ("letter", 2), ("latter", 4), ("litter", 4), ("later", 9), ("ßßßßß", 3)], "word string, n long")
    got = {r.word: (r.form, r.root, r.n_near, r.form_n) for r in spelling.variants(words).collect()}
    assert got["lettter"] == ("letter", "later", 1, 2)
    assert got["letter"] == ("latter", "later", 3, 4)  # a tie goes to the first in code-point order
    assert got["ßßßßß"] == (None, "ßßßßß", 0, None)
    assert spelling.variants(words.limit(0)).count() == 0


def test_pivots_are_the_cheapest_pair_apart():
    rng = random.Random(3)
    for _ in range(300):
        at = sorted(rng.sample(range(12), rng.randrange(3, 8)))
        weight = [rng.randrange(9) for _ in at]
        a, b = spelling.pivots(at, weight)
        cost = dict(zip(at, weight, strict=True))
        assert b - a >= 2
        assert cost[a] + cost[b] == min(cost[x] + cost[y] for x in at for y in at if y - x >= 2)


def test_query_on_a_folder(spark, tmp_path, docs, nothing):
    rows = some_texts()
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op11_spelling"](spark, str(tmp_path))
    assert dict(got.dtypes) == {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}
    assert as_set(got) == plain_variants(plain_words(rows))
    assert as_set(spelling.variants(spelling.vocabulary(docs))) == plain_variants(plain_words(ROWS))
    assert spelling.variants(spelling.vocabulary(nothing)).count() == 0
