import numpy as np

from tallyline.llm import flat_graph


def truth(rows, radius):
    ids = [i for i, v in rows]
    good = [v is not None and i is not None and len(v) > 0 and None not in v and np.isfinite(v).all() and np.any(v) for i, v in rows]
    links = [0] * len(rows)
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k
    for a in range(len(rows)):
        for b in range(a):
            if good[a] and good[b] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= radius:
                    links[a] += 1
                    links[b] += 1
                    parent[max(root(a), root(b))] = min(root(a), root(b))
    low = {}
    for k in range(len(rows)):
        low[root(k)] = min(low.get(root(k), 10**9), 10**9 if ids[k] is None else ids[k])
    return sorted((-1 if i is None else i, links[k], -1 if i is None else (low[root(k)] if good[k] else i)) for k, i in enumerate(ids))


def vectors():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(30, 16))
    rows = [(k, (centres[k % 30] + rng.normal(size=16) * rng.choice([0.02, 0.15, 0.8])).astype(np.float32).tolist()) for k in range(400)]
    hot = rows[0][1]
    rows += [(1000 + k, hot) for k in range(60)] + [(2000, None), (2001, [0.0] * 16), (2002, [float("nan")] + [1.0] * 15), (2003, []),
                                                   (2004, [None] + [1.0] * 15), (2005, [1.0, 2.0]), (2006, [2.0, 4.0]), (None, hot), (2007, hot), (2007, hot)]
    return rows


def test_links_and_components(frame):
    rows = vectors()
    got = flat_graph.near_duplicates(frame([(*r, 0, "x") for r in rows], "vec_id long, embedding array<float>, label int, cls string")).collect()
    assert len(got) == len(rows)
    assert min(r.audit_recall for r in got) >= 0.9
    want = truth(rows, flat_graph.COSINE)
    have = sorted((-1 if r.vec_id is None else r.vec_id, r.n_links, -1 if r.component_id is None else r.component_id) for r in got)
    assert sum(h[1] for h in have) >= 0.9 * sum(w[1] for w in want)
    assert all(h[1] <= w[1] for h, w in zip(have, want, strict=True))
    assert sum(h == w for h, w in zip(have, want, strict=True)) >= 0.95 * len(want)
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)


def test_graph_reaches_its_range():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(60, 12))[rng.integers(0, 60, 900)] + rng.normal(size=(900, 12)) * 0.1
    x = (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32)
    graph = flat_graph.Graph(x).build()
    q, node = graph.within(x, np.arange(len(x)), 0.95, flat_graph.BEAM)
    real = (x @ x.T >= 0.95).sum()
    assert len(q) <= real + 10 and len(q) >= 0.97 * real
    assert (graph.out >= -1).all() and graph.size.max() <= 2 * flat_graph.DEGREE


def test_large_shards_meet_in_parts(frame, monkeypatch):
    rows = [(k, v) for k, v in vectors() if k is not None and k < 400]
    monkeypatch.setattr(flat_graph, "MOST", 60)
    got = flat_graph.near_duplicates(frame(rows, "vec_id long, embedding array<float>")).collect()
    want = truth(rows, flat_graph.COSINE)
    assert sum(r.n_links for r in got) >= 0.9 * sum(w[1] for w in want)


def links_of(got):
    return sorted((-1 if r.vec_id is None else r.vec_id, r.n_links, -1 if r.component_id is None else r.component_id) for r in got)


def test_centres_grow_in_two_levels(frame, monkeypatch):
    rows = vectors()
    monkeypatch.setattr(flat_graph, "CENTRES", 4)
    monkeypatch.setattr(flat_graph, "SHARD", 20)
    monkeypatch.setattr(flat_graph, "PART", 150)
    got = flat_graph.near_duplicates(frame(rows, "vec_id long, embedding array<float>")).collect()
    want = truth(rows, flat_graph.COSINE)
    assert len(got) == len(want) and all(h[1] <= w[1] for h, w in zip(links_of(got), want, strict=True))
    assert sum(r.n_links for r in got) >= 0.9 * sum(w[1] for w in want)


def test_below_the_bar_all_classes_are_compared(frame, monkeypatch):
    rows = vectors()
    monkeypatch.setattr(flat_graph, "ROUNDS", 1)
    monkeypatch.setattr(flat_graph, "RECALL", 1.5)
    monkeypatch.setattr(flat_graph, "QUERIES_AT_ONCE", 64)
    got = flat_graph.near_duplicates(frame(rows, "vec_id long, embedding array<float>").repartition(3)).collect()
    assert links_of(got) == truth(rows, flat_graph.COSINE) and {r.audit_recall for r in got} == {1.0}


def test_missed_links_of_audited_vectors_are_added(frame, monkeypatch):
    """A search that finds nothing: the links of every fiftieth id are there all the same, and the recall tells."""
    rows = [(k, v) for k, v in vectors() if k is not None and k < 400]
    monkeypatch.setattr(flat_graph.Graph, "within", lambda self, queries, nodes, radius, beam: (np.arange(len(queries)), nodes))
    monkeypatch.setattr(flat_graph, "ROUNDS", 1)
    monkeypatch.setattr(flat_graph, "RECALL", 0.0)
    monkeypatch.setattr(flat_graph, "LEAST_LINKS", 1)
    got = {r.vec_id: r for r in flat_graph.near_duplicates(frame(rows, "vec_id long, embedding array<float>")).collect()}
    want = {w[0]: w for w in truth(rows, flat_graph.COSINE)}
    assert all(got[i].n_links == want[i][1] for i in range(0, 400, 50)) and sum(want[i][1] for i in range(0, 400, 50)) > 0
    assert all(got[i].n_links <= want[i][1] for i in want) and got[1].audit_recall == 0


def test_smallest_shared_place():
    a, b = np.array([[1, 4, 7], [2, 3, -1], [5, 6, 8]]), np.array([[4, 7, 9], [1, 4, -1], [5, 8, -1]])
    got = flat_graph._smallest_shared(a, b)
    assert got[0] == 4 and got[1] == np.iinfo(np.int64).max and got[2] == 5


def test_query_on_a_folder(spark, frame, tmp_path):
    from tallyline.llm.queries import QUERIES

    rows = vectors()
    frame([(*r, 0) for r in rows], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    df = QUERIES["op9_flat_graph"](spark, str(tmp_path))
    assert [f for f, _ in df.dtypes][:4] == ["vec_id", "n_links", "component_id", "kept"]
    assert dict(df.dtypes)["n_links"] == "bigint" and df.count() == len(rows)


def test_empty_table(frame):
    assert flat_graph.near_duplicates(frame([], "vec_id long, embedding array<float>")).count() == 0
