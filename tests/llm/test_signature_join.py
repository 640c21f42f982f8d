import random
import re

import numpy as np
import pytest
from conftest import ROWS, prose

from tallyline.llm import signature_join
from tallyline.llm.links import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def brute(rows, size, percent):
    sets = [shingle_set(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    low = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            low[root(k)] = min(low.get(root(k), i), i)
    return sorted((-1 if i is None else i, len(sets[k]), low.get(root(k), -1)) for k, (i, _) in enumerate(rows))


def result(df):
    return sorted((-1 if r._id is None else r._id, r.n_shingles, -1 if r.component_id is None else r.component_id) for r in df.collect())


@pytest.mark.parametrize(("size", "percent"), [(4, 85), (5, 80)])
def test_groups_equal_brute_force(docs, size, percent):
    assert result(signature_join.groups(docs, size, percent)) == brute(ROWS, size, percent)


def chains():
    """Near copies in chains, a passage that most texts share, and texts of equal words in another order."""
    rng = random.Random(9)
    rows, passage = [], prose(77, 60)
    for g in range(8):
        words = prose(g, 80).split()
        for k in range(12):
            rows.append((100 * g + k, " ".join(words)))
            for _ in range(rng.randrange(1, 4)):
                words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    rows += [(2000 + k, prose(500 + k, 20 + k) + " " + passage) for k in range(40)]
    words = prose(99, 50).split()
    return [*rows, *[(3000 + k, " ".join(rng.sample(words, len(words)))) for k in range(3)]]


@pytest.mark.parametrize("tile", [4096, 5])
def test_chains_and_shared_passages(frame, monkeypatch, tile):
    monkeypatch.setattr(signature_join, "TILE", tile)
    monkeypatch.setattr(signature_join, "MEMBERS", 3)
    monkeypatch.setattr(signature_join, "HOOD", 1 + tile)
    rows = chains()
    got = signature_join.groups(frame(rows, "doc_id long, text string"), 4, 85, share=0.05)
    assert result(got) == brute(rows, 4, 85)


@pytest.mark.parametrize("tile", [4096, 5])
def test_links_equal_brute_force(frame, monkeypatch, tile):
    monkeypatch.setattr(signature_join, "TILE", tile)
    monkeypatch.setattr(signature_join, "MEMBERS", 3)
    monkeypatch.setattr(signature_join, "HOOD", 1 + tile)
    rows = chains() + [r for r in ROWS if r[0] is None or r[0] < 2000] + [(100, chains()[0][1])] * 2
    sets = [shingle_set(t, 4) for _, t in rows]
    want = []
    for a, (i, _) in enumerate(rows):
        linked = 0
        for b in range(len(rows)):
            both = len(sets[a] & sets[b])
            linked += a != b and bool(sets[a]) and bool(sets[b]) and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both)
        want.append((-1 if i is None else i, len(sets[a]), linked))
    got = signature_join.groups(frame(rows, "doc_id long, text string"), 4, 85, share=0.05).collect()
    assert sorted((-1 if r._id is None else r._id, r.n_shingles, r.n_links) for r in got) == sorted(want)
    assert max(w[2] for w in want) > 2


def test_tree_lets_every_link_through():
    rng = random.Random(1)
    texts = [t for _, t in chains()]
    sets = [np.unique(np.array([hash(s) & (2**63 - 1) for s in shingle_set(t, 4)], np.uint64)) for t in texts]
    order = sorted(range(len(sets)), key=lambda k: len(sets[k]))
    sets = [sets[k] for k in order]
    bits = np.frombuffer(b"".join(signature_join.bitmap(s) for s in sets), np.uint64).reshape(len(sets), -1)
    group = np.array([rng.randrange(4) for _ in sets])
    group = np.unique(group, return_inverse=True)[1]
    tree = signature_join.SignatureTree(np.array([len(s) for s in sets]), bits, group)
    found = {(int(a), int(b)) for i, j in tree.pairs(85) for a, b in zip(i, j, strict=True)}
    real = {(a, b) for b in range(len(sets)) for a in range(b) if group[a] != group[b]
            and 100 * len(np.intersect1d(sets[a], sets[b])) >= 85 * len(np.union1d(sets[a], sets[b]))}
    assert real <= found and len(found) < len(sets) ** 2 / 8


def test_empty_table(nothing):
    assert signature_join.groups(nothing).count() == 0


def test_components_of_paths_hubs_and_repeats(frame):
    rng = random.Random(4)
    links = [(k, k + 1) for k in range(0, 300)] + [(1000, 1000 + k) for k in range(1, 200)] + [(5, 5), (7, 8), (None, 3)]
    rng.shuffle(links)
    got = {r.id: r.component for r in components(frame(links, "a long, b long").repartition(5)).collect()}
    assert got == {**{k: 0 for k in range(301)}, **{1000 + k: 1000 for k in range(200)}}
    assert components(frame([], "a long, b long")).count() == 0
