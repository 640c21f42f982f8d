"""Near-duplicate embeddings by robust-pruned flat graphs over overlapping cluster shards.

1. Equal vectors become one class, combined before the shuffle.
2. Centres are fitted on bounded samples, in two levels once a table needs more than ``CENTRES`` of them; every class goes to
   its nearest centres. A shard above ``MOST`` members is cut into parts, and every two parts meet in a shard of their own.
3. Each shard links its members in batches: a greedy search from the medoid gathers candidates, robust
   pruning keeps those that no kept one stands in for, reverse links are pruned likewise.
4. Adjacency lists of a class are united over its shards.
5. Each shard searches the united graph for every member: greedily from the medoid, then outwards
   through everything within the radius. Found pairs are verified with the raw vectors in double precision, and counted in
   the smallest shard that both classes share: links by class and a forest leave a task, no pairs.
6. Recall is audited against brute force over all classes for the classes of every ``ASKED``th id; below
   ``RECALL`` the search runs again with more overlap and wider beams, and in the end all classes are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.links import components, stars
from tallyline.llm.registry import query, table
from tallyline.llm.scratch import sampled, stored

COSINE = 0.95
SHARD = 500
MOST = 4_000
SAMPLE = 8_192
CENTRES = 1_024
OVERLAP = 3
DEGREE = 20
BEAM = 32
ALPHA = 1.2
ASKED = 50
LEAST_LINKS = 30
RECALL = 0.97
ROUNDS = 3
PART = 50_000
QUERIES_AT_ONCE = 2_048


def classes(vectors: DataFrame, vec_id: str, embedding: str) -> tuple[DataFrame, DataFrame]:
    """(vec, cls) of every row, and (cls, raw, n, top, asked) of every distinct usable vector: its doubles, number of rows, smallest
    id, and whether an id divisible by ``ASKED`` is among them."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = []
            for x in batch.column("_v"):
                v = None if x is None or not x.is_valid or x.values.null_count else x.values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
                raw.append(v.tobytes() if v is not None and len(v) and np.isfinite(v).all() and v.any() else None)
            yield pa.RecordBatch.from_arrays([batch.column("_vec"), pa.array(raw, pa.binary())], names=["vec", "raw"])

    rows = vectors.select(F.col(vec_id).cast("long").alias("_vec"), F.col(embedding).alias("_v"))
    found = stored(rows.mapInArrow(work, "vec long, raw binary").withColumn("cls", F.xxhash64("raw"))
                   .withColumn("cls", F.expr("if(raw is null or vec is null, null, cls)")))
    members = found.select("vec", "cls")
    # The vector of a class is the same in all its rows; only its hash and counts are combined, the vector is fetched once.
    sums = found.where("cls is not null").groupBy("cls").agg(F.count("*").alias("n"), F.min("vec").alias("top"), F.max("raw").alias("raw"),
                                                                 F.max(F.col("vec") % ASKED == 0).alias("asked"))
    return members, stored(sums)


def _unit(raw: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)
    return (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32)


def _centres(x: np.ndarray, k: int) -> np.ndarray:
    rng = np.random.default_rng(11)
    at = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(8):
        near = np.argmax(x @ at.T, axis=1)
        sums = np.zeros_like(at)
        np.add.at(sums, near, x)
        size = np.linalg.norm(sums, axis=1)
        at = np.where(size[:, None] > 0, sums / np.maximum(size, 1e-12)[:, None], at)
    return at.astype(np.float32)


class Graph:
    """A flat graph over unit vectors: at most ``2 * degree`` links out of a node, -1 where there is none."""

    def __init__(self, x: np.ndarray, degree: int = DEGREE) -> None:
        self.x, self.degree = x, degree
        self.out = np.full((len(x), 2 * degree), -1, np.int32)
        self.size = np.zeros(len(x), np.int64)
        centre = x.mean(axis=0)
        self.medoid = int(np.argmax(x @ centre)) if len(x) else 0

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Greedy beams from the medoid, all queries in step: node ids and similarities, best first, -1 where empty."""
        q, n = len(queries), len(self.x)
        ids = np.full((q, beam), -1, np.int32)
        sim = np.full((q, beam), -2.0, np.float32)
        ids[:, 0] = self.medoid
        sim[:, 0] = queries @ self.x[self.medoid]
        seen = np.zeros((q, n), bool)
        seen[:, self.medoid] = True
        done = np.zeros((q, beam), bool)
        live = np.arange(q)
        while len(live):
            todo = (ids[live] >= 0) & ~done[live]
            some = todo.any(axis=1)
            live, todo = live[some], todo[some]
            if not len(live):
                break
            at = todo.argmax(axis=1)
            done[live, at] = True
            near = self.out[ids[live, at]]
            ok = (near >= 0) & ~seen[live[:, None], np.maximum(near, 0)]
            r, c = np.nonzero(ok)
            seen[live[r], near[r, c]] = True
            score = np.full(near.shape, -2.0, np.float32)
            score[r, c] = np.einsum("ij,ij->i", queries[live[r]], self.x[near[r, c]])
            all_ids = np.concatenate((ids[live], np.where(ok, near, -1)), axis=1)
            all_sim = np.concatenate((sim[live], score), axis=1)
            all_done = np.concatenate((done[live], np.zeros(near.shape, bool)), axis=1)
            order = np.argsort(-all_sim, axis=1, kind="stable")[:, :beam]
            ids[live] = np.take_along_axis(all_ids, order, axis=1)
            sim[live] = np.take_along_axis(all_sim, order, axis=1)
            done[live] = np.take_along_axis(all_done, order, axis=1)
        return ids, sim

    def prune(self, nodes: np.ndarray, candidates: np.ndarray, alpha: float) -> None:
        """Set the links of ``nodes`` to what robust pruning keeps of their rows of ``candidates`` (-1: none)."""
        own = candidates == nodes[:, None]
        ids = np.where(own, -1, candidates)
        ordered = np.sort(ids, axis=1)
        ids = np.where(np.concatenate((np.zeros((len(ids), 1), bool), ordered[:, 1:] == ordered[:, :-1]), axis=1), -1, ordered)
        vectors = self.x[np.maximum(ids, 0)]
        far = 2 - 2 * np.einsum("bd,bmd->bm", self.x[nodes], vectors)
        far[ids < 0] = np.inf
        order = np.argsort(far, axis=1, kind="stable")
        ids, far = np.take_along_axis(ids, order, axis=1), np.take_along_axis(far, order, axis=1)
        vectors = np.take_along_axis(vectors, order[:, :, None], axis=1)
        between = 2 - 2 * np.matmul(vectors, vectors.transpose(0, 2, 1))
        alive = np.isfinite(far)
        rows = np.arange(len(nodes))
        out = np.full((len(nodes), self.out.shape[1]), -1, np.int32)
        count = np.zeros(len(nodes), np.int64)
        for _ in range(self.degree):
            has = alive.any(axis=1)
            if not has.any():
                break
            pick = alive.argmax(axis=1)
            r = rows[has]
            out[r, count[r]] = ids[r, pick[r]]
            count[r] += 1
            alive[r, pick[r]] = False
            alive[r] &= alpha * alpha * between[r, pick[r]] > far[r]
        self.out[nodes], self.size[nodes] = out, count

    def build(self, beam: int = BEAM, alpha: float = ALPHA, batch: int = 256) -> Graph:
        n = len(self.x)
        rng = np.random.default_rng(7)
        first = min(self.degree, max(n - 1, 0))
        if first:
            start = rng.integers(0, n, (n, first)).astype(np.int32)
            self.out[:, :first] = np.where(start == np.arange(n)[:, None], -1, start)
            self.size[:] = first
        for slack in (1.0, alpha):
            order = rng.permutation(n)
            for lo in range(0, n, batch):
                nodes = order[lo:lo + batch]
                found, _ = self.search(self.x[nodes], beam)
                self.prune(nodes, np.concatenate((found, self.out[nodes]), axis=1), slack)
                src = np.repeat(nodes, self.out.shape[1])
                dst = self.out[nodes].ravel()
                src, dst = src[dst >= 0], dst[dst >= 0]
                self._back(src, dst, slack)
        return self

    def _back(self, src: np.ndarray, dst: np.ndarray, alpha: float) -> None:
        """Add the links dst -> src; a node whose list overflows is pruned."""
        order = np.argsort(dst, kind="stable")
        src, dst = src[order], dst[order]
        new = (self.out[dst] != src[:, None]).all(axis=1)
        src, dst = src[new], dst[new]
        while len(dst):
            first = np.concatenate(([True], dst[1:] != dst[:-1]))
            node, other = dst[first], src[first]
            full = self.size[node] >= self.out.shape[1]
            if full.any():
                over = node[full]
                self.prune(over, np.concatenate((self.out[over], other[full][:, None].astype(np.int32)), axis=1), alpha)
            node, other = node[~full], other[~full]
            self.out[node, self.size[node]] = other
            self.size[node] += 1
            src, dst = src[~first], dst[~first]

    def within(self, queries: np.ndarray, nodes: np.ndarray, radius: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) pairs with a similarity of at least ``radius``: greedy beams, then expansion through the range."""
        ids, sim = self.search(queries, beam)
        q, c = np.nonzero(sim >= radius)
        node = ids[q, c].astype(np.int64)
        q, node = np.concatenate((q, np.arange(len(queries)))), np.concatenate((node, nodes))  # a query is a node itself
        n = len(self.x)
        found = np.unique(q * n + node)
        edge = found
        while len(edge):
            near = self.out[edge % n]
            key = np.unique(((edge // n)[:, None] * n + near)[near >= 0])
            key = key[~np.isin(key, found, assume_unique=True)]
            close = np.einsum("ij,ij->i", queries[key // n], self.x[key % n]) >= radius
            edge = key[close]
            found = np.union1d(found, edge)
        return found // n, found % n


def _nearest(raw: list[bytes], centres: np.ndarray, few: int) -> np.ndarray:
    return np.argsort(-(_unit(raw) @ centres.T), axis=1, kind="stable")[:, :few]


def _places(sets: DataFrame, n: int, overlap: int) -> DataFrame:
    """(cls, at): the shards of every class, ascending.

    Up to ``CENTRES`` shards their centres are fitted at once. Beyond that centres grow with the table in two levels: as many
    cells as each then has shards, and within a cell centres fitted on a sample of its own. A class goes to the nearest
    shards of its nearest cell, and to the nearest one of each other cell.
    """
    sample = sampled(sets, ["cls"], SAMPLE).select("cls", "raw").collect()
    first = _unit([bytes(r.raw) for r in sorted(sample)])
    shards = -(-n // SHARD)
    cells = max(1, shards) if shards <= CENTRES else int(np.ceil(np.sqrt(shards)))
    coarse = _centres(first, cells)
    few = min(overlap, len(coarse))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near = _nearest(batch.column("raw").to_pylist(), coarse, few)
                if shards <= CENTRES:
                    near = np.sort(near, axis=1)
                yield pa.RecordBatch.from_arrays([batch.column("cls"), pa.array(near.tolist(), pa.list_(pa.int64()))], names=["cls", "at"])

    placed = sets.select("cls", "raw").mapInArrow(assign, "cls long, at array<long>")
    if shards <= CENTRES:
        return stored(placed)
    inside = stored(placed.select("cls", F.posexplode("at").alias("rank", "cell")).join(sets.select("cls", "raw"), "cls"))
    sizes = inside.groupBy("cell").agg(F.count("*").alias("size"))
    steps = F.lit(1 << 30)
    mine = F.pmod(F.xxhash64("cls", F.lit(29)), steps) < F.lit((1 << 30) * SAMPLE) / F.col("size")

    def split(tab: pa.Table) -> pa.Table:
        order = np.argsort(tab.column("cls").to_numpy())
        fine = _centres(_unit([tab.column("raw")[int(i)].as_py() for i in order]), max(1, -(-tab.column("size")[0].as_py() // (SHARD * overlap))))
        return pa.table({"cell": tab.column("cell").slice(0, 1), "fine": pa.array([fine.tobytes()], pa.binary())})

    fine = inside.join(F.broadcast(sizes), "cell").where(mine).select("cell", "cls", "raw", "size")  # one row a cell
    fine = fine.groupBy("cell").applyInArrow(split, "cell long, fine binary")
    parts = sizes.select("cell", F.ceil(F.col("size") / PART).cast("int").alias("_parts"))
    met = inside.join(F.broadcast(parts), "cell").withColumn("part", F.pmod(F.xxhash64("cls"), F.col("_parts")).cast("int"))
    centres = fine.join(F.broadcast(parts), "cell").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))

    def deal(members: pa.Table, own: pa.Table) -> pa.Table:
        if not members.num_rows or not own.num_rows:
            return pa.table({"cls": pa.array([], pa.int64()), "shard": pa.array([], pa.int64())})
        raw = members.column("raw").to_pylist()
        at = np.frombuffer(own.column("fine")[0].as_py(), np.float32).reshape(-1, len(raw[0]) // 8)
        near = _nearest(raw, at, overlap).astype(np.int64)
        taken = np.where(members.column("rank").to_numpy() == 0, near.shape[1], 1)
        row = np.repeat(np.arange(len(raw)), taken)
        slot = np.arange(len(row)) - np.repeat(np.cumsum(taken) - taken, taken)
        cell = members.column("cell").to_numpy()[row]
        return pa.table({"cls": members.column("cls").to_numpy()[row], "shard": cell << 32 | near[row, slot]})

    dealt = (met.select("cell", "part", "cls", "rank", "raw").groupBy("cell", "part")
             .cogroup(centres.select("cell", "part", "fine").groupBy("cell", "part")).applyInArrow(deal, "cls long, shard long"))
    return stored(dealt.groupBy("cls").agg(F.sort_array(F.collect_set("shard")).alias("at")))


def _shards(sets: DataFrame, places: DataFrame) -> DataFrame:
    """(shard, x, y, part, cls, raw, n, asked, at): every class in its shards, large shards in pairs of parts."""
    placed = places.select("cls", "at", F.explode("at").alias("shard"))
    sizes = placed.groupBy("shard").agg(F.ceil(F.count("*") / MOST).cast("int").alias("_parts"))
    dealt = (placed.join(sizes, "shard")
             .withColumn("part", F.pmod(F.xxhash64("cls"), F.col("_parts")).cast("int"))
             .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))))
    return stored(dealt.select("shard", F.least("part", "_other").alias("x"), F.greatest("part", "_other").alias("y"), "part", "cls", "at")
                  .join(sets.select("cls", "raw", "n", "asked"), "cls"))


FOUND = "a long, b long, links long, audit boolean"


def _smallest_shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest value that each row of ``a`` shares with the same row of ``b``; rows ascend, padded with -1."""
    out = np.full(len(a), np.iinfo(np.int64).max)
    for k in range(a.shape[1]):
        both = ((a[:, k, None] == b) & (a[:, k, None] >= 0)).any(axis=1)
        out = np.where(both, np.minimum(out, a[:, k]), out)
    return out


def _tally(a: np.ndarray, b: np.ndarray, n: np.ndarray, asked: np.ndarray) -> pa.Table:
    """What pairs (a, b) of classes come down to: the number of rows that each class links with (b null), links that join up
    the classes of a component, and, marked, the pairs of classes that are asked for in the audit.

    ``n`` holds the rows of both classes, a column each, and ``asked`` whether either is.
    """
    ids, which = np.unique(np.concatenate((a, b)), return_inverse=True)
    links = np.zeros(len(ids), np.int64)
    np.add.at(links, which, np.concatenate((n[:, 1], n[:, 0])))
    low, root = stars(a, b)
    pairs = int(asked.sum())
    return pa.table({
        "a": pa.array(np.concatenate((ids, root, a[asked]))),
        "b": pa.concat_arrays([pa.nulls(len(ids), pa.int64()), pa.array(low), pa.array(b[asked])]),
        "links": pa.concat_arrays([pa.array(links), pa.nulls(len(low) + pairs, pa.int64())]),
        "audit": pa.array([False] * (len(ids) + len(low)) + [True] * pairs, pa.bool_()),
    })


def _found(shards: DataFrame, radius: float, beam: int) -> DataFrame:
    """Verified pairs of classes as ``_tally`` has them. A pair counts in the smallest shard that both classes are in, so it
    counts once, and no pairs leave a task but those of the audit."""
    keys = ["shard", "x", "y"]

    def build(tab: pa.Table) -> pa.Table:
        cls = tab.column("cls").to_numpy()
        order = np.argsort(cls)
        g = Graph(_unit([tab.column("raw")[int(i)].as_py() for i in order])).build(beam)
        cls = cls[order]
        src, c = np.nonzero(g.out >= 0)
        return pa.table({"cls": cls[src], "to": cls[g.out[src, c]]})

    def search(tab: pa.Table) -> pa.Table:
        tab = tab.take(pa.array(np.argsort(tab.column("cls").to_numpy()))).combine_chunks()
        cls, part, n = (tab.column(c).to_numpy() for c in ("cls", "part", "n"))
        asked = tab.column("asked").to_numpy(zero_copy_only=False).astype(bool)
        shard, one = tab.column("shard")[0].as_py(), tab.column("x")[0] == tab.column("y")[0]
        raw = tab.column("raw").to_pylist()
        links = [x or [] for x in tab.column("links").to_pylist()]
        places = tab.column("at").to_pylist()
        at_ = np.full((len(cls), max(map(len, places))), -1, np.int64)
        for k, p in enumerate(places):
            at_[k, :len(p)] = p
        g = Graph(_unit(raw))
        row = np.repeat(np.arange(len(cls)), [len(x) for x in links])
        to = np.fromiter((v for x in links for v in x), np.int64, len(row))
        at = np.minimum(np.searchsorted(cls, to), len(cls) - 1)
        here = cls[at] == to  # links to members of other shards end here
        row, at = row[here], at[here]
        slot = np.arange(len(row)) - np.searchsorted(row, row)
        g.out = np.full((len(cls), max(1, int(slot.max(initial=0)) + 1)), -1, np.int32)
        g.out[row, slot] = at
        full = np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)
        size = np.sqrt(np.einsum("ij,ij->i", full, full))
        kept = []
        for lo in range(0, len(cls), 512):
            nodes = np.arange(lo, min(lo + 512, len(cls)))
            q, node = g.within(g.x[nodes], nodes, radius - 1e-4, beam)
            a, b = np.minimum(nodes[q], node), np.maximum(nodes[q], node)
            a, b = a[a != b], b[a != b]
            fits = (part[a] != part[b]) | one
            a, b = a[fits], b[fits]
            mine = _smallest_shared(at_[a], at_[b]) == shard
            a, b = a[mine], b[mine]
            ok = np.einsum("ij,ij->i", full[a], full[b]) / (size[a] * size[b]) >= radius
            kept.append(a[ok] * len(cls) + b[ok])
        pairs = np.unique(np.concatenate(kept))
        a, b = pairs // len(cls), pairs % len(cls)
        return _tally(cls[a], cls[b], np.stack((n[a], n[b]), 1), asked[a] | asked[b])

    members = shards.select(*keys, "cls", "raw")
    edges = members.groupBy(*keys).applyInArrow(build, "cls long, to long")
    united = edges.groupBy("cls").agg(F.collect_set("to").alias("links"))  # at most 2 * DEGREE a shard
    return stored(shards.join(united, "cls", "left").groupBy(*keys).applyInArrow(search, FOUND))


def _true_links(sets: DataFrame, asked: DataFrame, radius: float) -> DataFrame:
    """(a, b), a < b: all links of the classes ``asked``, by comparing them with every class, block by block."""
    blocks = max(1, -(-asked.count() // QUERIES_AT_ONCE))

    def packed(tab: pa.Table) -> pa.Table:
        return pa.table({"q": tab.column("q").slice(0, 1), "q_names": pa.array([tab.column("cls").to_numpy().tobytes()], pa.binary()),
                         "q_block": pa.array([b"".join(tab.column("raw").to_pylist())], pa.binary())})

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, QUERIES_AT_ONCE):
                part = batch.slice(at, QUERIES_AT_ONCE)
                yield pa.RecordBatch.from_arrays([pa.array([part.column("cls").to_numpy().tobytes()], pa.binary()),
                                                  pa.array([b"".join(part.column("raw").to_pylist())], pa.binary())], names=["names", "block"])

    queries = (asked.select("cls", "raw", F.pmod(F.xxhash64("cls"), F.lit(blocks)).cast("int").alias("q"))
               .groupBy("q").applyInArrow(packed, "q int, q_names binary, q_block binary"))
    every = sets.select("cls", "raw").mapInArrow(pack, "names binary, block binary")
    met = every.withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).join(queries, "q")

    def brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def unit(block: bytes, names: np.ndarray) -> np.ndarray:
            x = np.frombuffer(block, np.float64).reshape(len(names), -1)
            return x / np.linalg.norm(x, axis=1)[:, None]

        for batch in batches:
            for mine, block, theirs, other in zip(*(batch.column(c).to_pylist() for c in ("names", "block", "q_names", "q_block")), strict=True):
                mine, theirs = np.frombuffer(mine, np.int64), np.frombuffer(theirs, np.int64)
                i, j = np.nonzero(unit(block, mine) @ unit(other, theirs).T >= radius)
                a, b = np.minimum(mine[i], theirs[j]), np.maximum(mine[i], theirs[j])
                yield pa.RecordBatch.from_arrays([pa.array(a[a != b]), pa.array(b[a != b])], names=["a", "b"])

    return stored(met.mapInArrow(brute, "a long, b long").distinct())


def _exactly(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs of classes as ``_tally`` has them, none left out."""
    n = sets.select("cls", "n")
    both = pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counts = both.join(n.withColumnRenamed("cls", "b"), "b").groupBy("a").agg(F.sum("n").alias("links"))
    none = F.lit(False).alias("audit")
    return counts.select("a", F.lit(None).cast("long").alias("b"), "links", none).union(
        pairs.select("a", "b", F.lit(None).cast("long").alias("links"), none))


def _searched(same: DataFrame, radius: float) -> tuple[DataFrame, float | None]:
    """The links of vectors of one length, and the share of the audited ones that the graphs found; None if too few are
    known to tell.

    True links that the graphs missed are added. Where the share stays below ``RECALL``, all classes are compared.
    """
    n = same.count()
    true = _true_links(same, same.where("asked"), radius)
    every = true.count()
    for attempt in range(ROUNDS):
        places = _places(same, n, OVERLAP * (attempt + 1))
        found = _found(_shards(same, places), radius, BEAM * (attempt + 1))
        missed = stored(true.join(found.where("audit").select("a", "b"), ["a", "b"], "left_anti"))
        got = 1 - missed.count() / every if every else 1.0
        if got >= RECALL:
            return found.union(_exactly(same, missed)), got if every >= LEAST_LINKS else None
    return _exactly(same, _true_links(same, same, radius)), 1.0


def near_duplicates(vectors: DataFrame, radius: float = COSINE, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept, audit_recall) of every row.

    Two vectors link when their cosine, in double precision, is at least ``radius``. A vector that is null,
    empty or zero, or holds null or non-finite components, and one with a null id, links with nothing.
    Rows that share an id are judged row by row. Vectors of different lengths never meet: each length is
    searched on its own. Equal vectors all link. The component is the smallest id reachable by links. ``audit_recall`` is the
    share of the links of every fiftieth id that the graphs found, the least of all lengths; null where fewer than
    ``LEAST_LINKS`` such links exist.
    """
    members, sets = classes(vectors, vec_id, embedding)
    found, recalls = vectors.sparkSession.createDataFrame([], FOUND), []
    for (size,) in sets.select(F.length("raw")).distinct().orderBy(F.length("raw")).collect():  # one row a vector length
        some, recall = _searched(sets.where(F.length("raw") == size), radius)
        found = found.union(some)
        recalls += [recall] if recall is not None else []
    around = found.where("b is null").groupBy("a").agg(F.sum("links").alias("_more"))
    joined = components(found.where("b is not null and not audit").select("a", "b"))
    parts = sets.select("cls", "n", "top").join(joined.withColumnRenamed("id", "cls"), "cls", "left")
    parts = parts.withColumn("component", F.coalesce("component", "cls"))
    named = parts.groupBy("component").agg(F.min("top").alias("_low"))
    by_class = stored(parts.join(named, "component").join(around.withColumnRenamed("a", "cls"), "cls", "left")
                      .select(F.col("cls").alias("_c"), (F.col("n") - 1 + F.coalesce("_more", F.lit(0))).alias("_links"), "_low"))
    out = members.join(by_class, members["cls"] == by_class["_c"], "left")
    component = F.coalesce("_low", "vec")
    return out.select(F.col("vec").alias("vec_id"), F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("vec") == component, F.lit(False)).alias("kept"),
                      F.lit(min(recalls, default=None)).cast("double").alias("audit_recall"))


@query("op9_flat_graph")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
