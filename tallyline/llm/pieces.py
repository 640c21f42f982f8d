"""SentencePiece N-best segmentation and decoding over whole texts.

A text becomes, as the model asks, a word mark, the text, and a word mark for every blank. Between two
characters that no piece of the vocabulary holds side by side every path of the lattice has a node, so the
lattice falls into segments there. A segment is solved once for all places where it stands:

* the model's own merges give its first path, in one call for all new segments of a chunk. A piece of that path has the score of the model; any other piece
  has the scores of the own pieces that start in its span, and a loss by its rank. So a path scores as the model's
  own one less the losses of its other pieces, and no other path is as good as the own one;
* the forward pass of Viterbi leaves at each node the best score from the start to it;
* the backward search extends partial paths from the end, ordered by their own score plus the forward
  score of the node they have reached. That bound is exact, so complete paths leave the queue best first.
  No more than N partial paths go on from a node, as only its N best ones can be part of the N best paths.

The N best paths of a text leave the best path of at most N - 1 segments, those with the smallest loss
(a path that left another one could be bettered N times). So the smallest loss of every segment is found first, exactly and
for thousands of segments at once, by a forward pass over positions that keeps the own path apart from all others; only
the segments picked by it are searched, and the same search runs over their alternatives.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyline.llm import kernels as K
from tallyline.llm.registry import query, table
from tallyline.llm.scratch import per_process

N_BEST = 4
CHUNK = 1 << 19
MOST_SEGMENTS = 250_000
MOST_SEARCHED = 20_000
WIDTHS = (4, 6, 8, 10, 12, 16, 24, 32)
BLOCK = 8_192
_BASE = np.uint64(K.BASE)
MARK = "▁"
UNKNOWN_PENALTY = 10.0
TABLE_BITS = 20

Edge = tuple[int, float, tuple[int, ...]]


def n_best(edges: Sequence[Sequence[Edge]], n: int) -> list[tuple[float, list[tuple[int, ...]]]]:
    """The ``n`` best paths of a lattice, best first, as (score, labels from start to end).

    ``edges[i]`` are the edges that end in node i as (node they start in, score, label); node 0 is the
    start and the last node the end. Paths of equal score leave in the fixed order of the search, which
    takes the node nearest to the start first.
    """
    last = len(edges) - 1
    best = [0.0] + [-np.inf] * last
    for node in range(1, last + 1):
        for start, score, _ in edges[node]:
            if best[start] + score > best[node]:
                best[node] = best[start] + score
    queue: list[tuple] = [(-best[last], last, 0, 0.0, None)]
    serial, found, taken = 0, [], [0] * (last + 1)
    while queue and len(found) < n:
        bound, node, _, after, tail = heapq.heappop(queue)
        if node == 0:
            path = []
            while tail is not None:
                label, tail = tail
                path.append(label)
            found.append((-bound, path))
            continue
        if taken[node] == n:
            continue
        taken[node] += 1
        for start, score, label in edges[node]:
            if best[start] > -np.inf and taken[start] < n:
                serial += 1
                heapq.heappush(queue, (-(best[start] + score + after), start, serial, score + after, (label, tail)))
    return found


class Vocabulary:
    """Pieces and scores of a model file."""

    def __init__(self, path: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = sentencepiece_model_pb2.ModelProto.FromString(model.serialized_model_proto())
        proto.normalizer_spec.add_dummy_prefix = False  # segments bring their marks
        self.model = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        size = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        plain = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i))]
        self.ids = {self.pieces[i]: (i, float(model.get_score(i))) for i in plain}
        self.byte = {int(self.pieces[i][3:-1], 16): i for i in range(size) if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.byte.items()}
        self.unknown = model.unk_id()
        scores = [s for _, s in self.ids.values() if s > -1e8]
        self.unknown_score = min(scores, default=0.0) - UNKNOWN_PENALTY
        self.top = max(scores, default=0.0) + 1.0  # every loss is 1 or more
        self.longest = max(map(len, self.ids), default=1)
        self.pairs = np.zeros(1 << TABLE_BITS, bool)  # a pair that no piece holds may share a slot; it is then not cut
        inside = {(a, b) for p in self.ids for a, b in zip(p, p[1:], strict=False)}
        if inside:
            a, b = np.array([(ord(a), ord(b)) for a, b in inside], np.uint32).T
            self.pairs[self.slot(a, b)] = True

        self.score = np.array([model.get_score(i) for i in range(size)])
        self.letters = np.array([len(p) for p in self.pieces])
        self.odd = np.array([i == self.unknown or i in self.byte_of for i in range(size)])
        keys = np.array([self._key(p) for p in self.ids], np.uint64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.losses = np.array([self.top - s for _, s in self.ids.values()], np.float32)[order]
        self.gate = np.zeros(1 << TABLE_BITS, bool)
        self.gate[(self.keys >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] = True

    @staticmethod
    def _key(piece: str) -> int:
        """A 64-bit hash of a piece, which a vector of texts can compute letter by letter."""
        h = 0
        for c in piece:
            h = (h * K.BASE + ord(c) + 1) % (1 << 64)
        return int(K.mix(np.array([h], np.uint64))[0])

    @staticmethod
    def slot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return ((a * np.uint32(0x9E3779B1)) ^ (b * np.uint32(0x85EBCA6B))) >> np.uint32(32 - TABLE_BITS)

    def own(self, segment: str) -> list[int]:
        """The nodes of the model's own segmentation, the start left out."""
        ids, nodes, node, k = self.model.encode(segment), [], 0, 0
        while k < len(ids):
            if ids[k] in self.byte_of:
                k += len(segment[node].encode())
                node += 1
            elif ids[k] == self.unknown:
                k += 1
                node += 1
                while node < len(segment) and segment[node] not in self.ids and (k == len(ids) or not segment.startswith(self.pieces[ids[k]], node)):
                    nodes.append(node)
                    node += 1
            else:
                node += len(self.pieces[ids[k]])
                k += 1
            nodes.append(node)
        return nodes

    def lattice(self, segment: str) -> list[list[Edge]]:
        """Edges into each node, scored so that the best path is the model's own one."""
        edges: list[list[Edge]] = [[] for _ in range(len(segment) + 1)]
        ids, longest = self.ids, self.longest
        stop_of, level, before, total = {}, [0.0] * (len(segment) + 1), 0, 0.0
        for node in self.own(segment):
            hit = ids.get(segment[before:node])
            stop_of[before] = node
            level[before:node] = [total] * (node - before)
            total += self.unknown_score if hit is None else hit[1]
            before = node
        level[before] = total
        for i in range(len(segment)):
            known, own = False, stop_of.get(i)
            for j in range(i + 1, min(i + longest, len(segment)) + 1):
                hit = ids.get(segment[i:j])
                if hit is not None:
                    score = level[j] - level[i]
                    edges[j].append((i, score if j == own else score + hit[1] - self.top, (hit[0],)))
                    known = known or j == i + 1
            if not known:
                raw = segment[i].encode()
                label = tuple(self.byte[b] for b in raw) if self.byte else (self.unknown,)
                score = level[i + 1] - level[i]
                edges[i + 1].append((i, score if i + 1 == own else score + self.unknown_score - self.top, label))
        return edges

    def segment(self, segment: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The ``n`` best paths of a segment as (score, ids)."""
        return [(score, tuple(x for label in path for x in label)) for score, path in n_best(self.lattice(segment), n)]

    def solve(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Best ids of all segments end to end, their number and score, and the loss of the second best path, by segment."""
        ids = self.model.encode(segments, num_threads=1)
        size = np.fromiter(map(len, segments), np.int64, len(segments))
        count = np.fromiter(map(len, ids), np.int64, len(ids))
        values = np.fromiter(chain.from_iterable(ids), np.int32, int(count.sum()))
        owner = np.repeat(np.arange(len(ids)), count)
        letters = self.letters[values]
        top = np.bincount(owner, self.score[values], minlength=len(ids))
        plain = np.bincount(owner, letters, minlength=len(ids)) == size
        plain &= np.bincount(owner, self.odd[values], minlength=len(ids)) == 0
        plain &= size <= WIDTHS[-1]
        loss = np.full(len(ids), np.inf)
        ahead = np.cumsum(letters) - letters
        start = ahead - ahead[np.minimum(np.cumsum(count) - count, max(len(values) - 1, 0))][owner] if len(values) else ahead
        for low, wide in zip((0, *WIDTHS), WIDTHS, strict=False):
            every = np.flatnonzero(plain & (size > low) & (size <= wide))
            for at in range(0, len(every), BLOCK):
                some = every[at:at + BLOCK]
                place = np.full(len(ids), -1)
                place[some] = np.arange(len(some))
                mine = place[owner] >= 0
                loss[some] = self._second([segments[k] for k in some.tolist()], wide, place[owner[mine]], start[mine], letters[mine])
        if not plain.all():
            parts = np.split(values, np.cumsum(count)[:-1])
            for k in np.flatnonzero(~plain).tolist():  # bytes, unknown characters and long segments
                found = self.segment(segments[k], 2)
                parts[k] = np.array(found[0][1], np.int32)
                count[k], top[k] = len(parts[k]), found[0][0]
                loss[k] = found[0][0] - found[1][0] if len(found) > 1 else np.inf
            values = np.concatenate(parts)
        return values, count, top, loss

    def _second(self, segments: list[str], wide: int, owner: np.ndarray, start: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """The smallest loss of a path other than the own one, for segments of at most ``wide`` letters.

        ``owner``, ``start`` and ``letters`` are the pieces of the own paths. One table a piece length holds the loss of the
        piece that starts at each letter; two passes run side by side, along the own path and off it.
        """
        n = len(segments)
        size = np.fromiter(map(len, segments), np.int64, n)
        point = np.zeros((n, wide), np.uint64)
        inside = np.arange(wide) < size[:, None]
        point[inside] = np.frombuffer("".join(segments).encode("utf-32-le"), np.uint32)
        own = np.zeros((n, wide + 1), np.int64)  # letters of the own piece that starts here
        own[owner, start] = letters
        on = np.full((n, wide + 1), np.inf, np.float32)
        on[owner, start] = 0
        on[np.arange(n), size] = 0
        longest = min(self.longest, wide)
        hashed, edges = np.zeros((n, wide), np.uint64), []
        for length in range(1, longest + 1):
            fits = wide - length + 1
            hashed = hashed[:, :fits] * _BASE + point[:, length - 1:] + np.uint64(1)
            real = inside[:, length - 1:]
            key = K.mix(hashed)
            edge = np.full((n, fits), np.inf, np.float32)
            row, at = np.nonzero(self.gate[(key >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] & real)
            some = key[row, at]
            hit = np.minimum(np.searchsorted(self.keys, some), len(self.keys) - 1)
            known = self.keys[hit] == some
            edge[row[known], at[known]] = self.losses[hit[known]]
            if length == 1:
                edge[real & np.isinf(edge)] = self.top - self.unknown_score
            edge[own[:, :fits] == length] = np.inf
            edges.append(edge)
        off = np.full((n, wide + 1), np.inf, np.float32)
        for node in range(1, wide + 1):
            best = off[:, node]
            for length in range(1, min(longest, node) + 1):
                before = node - length
                np.minimum(best, edges[length - 1][:, before] + np.minimum(on[:, before], off[:, before]), out=best)
                np.minimum(best, np.where(own[:, before] == length, off[:, before], np.inf), out=best)
        return off[np.arange(n), size].astype(float)

    def decode(self, ids: Sequence[int]) -> str:
        """The text of a path: pieces joined, byte runs decoded, marks turned to blanks, the first one dropped."""
        if self.byte_of and not self.byte_of.keys().isdisjoint(ids):
            raw = b"".join(bytes((self.byte_of[i],)) if i in self.byte_of else self.pieces[i].encode() for i in ids)
            joined = raw.decode("utf-8", "replace")
        else:
            joined = "".join(map(self.pieces.__getitem__, ids))
        return joined.replace(MARK, " ")[1:]


class Known:
    """Solved segments by hash: best ids, score, and the loss of the second best path. Holds ``MOST_SEGMENTS`` and a chunk's."""

    def __init__(self) -> None:
        self.names = np.zeros(0, np.uint64)
        self.origin, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.top, self.loss, self.values = np.zeros(0), np.zeros(0), np.zeros(0, np.int32)

    def find(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each name, and which of them are not there."""
        place = np.minimum(np.searchsorted(self.names, names), max(len(self.names) - 1, 0))
        return place, np.flatnonzero(self.names[place] != names) if len(self.names) else np.arange(len(names))

    def add(self, names: np.ndarray, solved: tuple[np.ndarray, ...]) -> None:
        values, count, top, loss = solved
        order = np.argsort(both := np.concatenate((self.names, names)))
        self.names = both[order]
        self.origin = np.concatenate((self.origin, np.cumsum(count) - count + len(self.values)))[order]
        self.count, self.top, self.loss = (
            np.concatenate(c)[order] for c in ((self.count, count), (self.top, top), (self.loss, loss)))
        self.values = np.concatenate((self.values, values))


def _loaded(path: str) -> Vocabulary:
    shared = per_process("pieces")
    if shared.get("path") != path:
        shared.update(path=path, vocabulary=Vocabulary(path), known=Known(), searched={})
    return shared["vocabulary"]


def combine(first: list[float], options: list[list[tuple[float, Sequence[int]]]], n: int) -> list[tuple[float, list[int]]]:
    """The ``n`` best choices of one option for each of a few segments, as (loss, chosen option of each)."""
    edges: list[list[Edge]] = [[]]
    for node, (top, some) in enumerate(zip(first, options, strict=True)):
        edges.append([(node, score - top, (k,)) for k, (score, _) in enumerate(some)])
    return [(loss, [label[0] for label in path]) for loss, path in n_best(edges, n)]


def _encode(texts: list[str], vocabulary: Vocabulary, n: int) -> Iterator[tuple[np.ndarray, list[dict]]]:
    """For each text its best ids and its ``n`` best paths, as edits of the best one."""
    shared = per_process("pieces")
    searched = shared["searched"]
    marked = [MARK + t.replace(" ", MARK) for t in texts]
    whole = "".join(marked)
    points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
    ends = np.concatenate(([0], np.cumsum([len(t) for t in marked])))
    cut = np.ones(len(points) + 1, bool)
    cut[1:-1] = ~vocabulary.pairs[vocabulary.slot(points[:-1], points[1:])]
    cut[ends] = True
    start = np.flatnonzero(cut[:-1])
    stop = np.append(start[1:], len(points))
    names, at, which = np.unique(K.span_hashes(points, start, stop), return_index=True, return_inverse=True)
    known = shared["known"]
    place, new = known.find(names)
    if len(known.names) + len(new) > MOST_SEGMENTS:
        known = shared["known"] = Known()
        place, new = known.find(names)
    if len(new):
        known.add(names[new], vocabulary.solve([whole[start[k]:stop[k]] for k in at[new].tolist()]))
        place, _ = known.find(names)
    top, loss, sizes, origin, values = known.top[place], known.loss[place], known.count[place], known.origin[place], known.values

    def options(k: int) -> list[tuple[float, tuple[int, ...]]]:
        """The ``n`` best paths of a segment of this chunk."""
        key = (int(names[k]), n)
        if key not in searched:
            if len(searched) >= MOST_SEARCHED:
                searched.clear()
            searched[key] = vocabulary.segment(whole[start[at[k]]:stop[at[k]]], n)
        return searched[key]

    size = sizes[which]
    total = np.concatenate(([0], np.cumsum(size)))
    flat = values[np.repeat(origin[which] - total[:-1], size) + np.arange(total[-1])]
    bounds = np.searchsorted(start, ends)
    for i in range(len(texts)):
        a, b = int(bounds[i]), int(bounds[i + 1])
        ids = flat[total[a]:total[b]]
        mine = which[a:b]
        best = float(top[mine].sum())
        losses = loss[mine]
        few = n - 1
        near = np.argpartition(losses, few)[:few] if len(losses) > few else np.arange(len(losses))
        near = np.sort(near[np.isfinite(losses[near])])
        some = [options(mine[k]) for k in near.tolist()]
        paths = []
        for lost, chosen in combine([o[0][0] for o in some], some, n):
            edits, count = [], len(ids)
            for k, pick, opts in zip(near.tolist(), chosen, some, strict=True):
                if pick:
                    other, drop = opts[pick][1], len(opts[0][1])
                    edits.append({"at": int(total[a + k] - total[a]), "drop": drop, "ids": list(other)})
                    count += len(other) - drop
            paths.append({"score": best + lost, "n_tokens": count, "edits": edits})
        yield ids, paths


def apply_edits(ids: Sequence[int], edits: Sequence) -> list[int]:
    """Ids of an alternative path, from the best path and the edits that lead to it."""
    out, at = [], 0
    for e in edits:
        out += [*ids[at:e["at"]], *e["ids"]]
        at = e["at"] + e["drop"]
    return out + list(ids[at:])


SCHEMA = ("ids array<int>, n_tokens int, score double, "
          "nbest array<struct<score:double,n_tokens:int,edits:array<struct<at:int,drop:int,ids:array<int>>>>>, decoded_equal boolean")


def encode(docs: DataFrame, model: str, n: int = N_BEST, keep: Sequence[Column | str] = ("doc_id",), text: str = "text") -> DataFrame:
    """The columns ``keep`` in a struct ``row``, with the best ids of the text, its ``n`` best paths and a decoding check.

    ``nbest[0]`` is the best path without edits; ``decoded_equal`` tells whether decoding the best ids
    gives the text back. A null text is empty; an empty text is a lone word mark. Texts that hold the
    word mark itself come back with blanks there and are compared so. Rows are independent of each other,
    so repeated rows and other columns need no care.
    """
    picked = docs.select(F.struct(*keep).alias("row"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    schema = picked.select("row").schema
    for field in StructType.fromDDL(SCHEMA):
        schema = schema.add(field)
    nested = pa.list_(pa.struct([("score", pa.float64()), ("n_tokens", pa.int32()), ("edits", pa.list_(pa.struct(
        [("at", pa.int32()), ("drop", pa.int32()), ("ids", pa.list_(pa.int32()))])))]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _loaded(model)
        for batch in batches:
            column = batch.column("_text")
            data, stops = K.bytes_of(column)
            for i, j, _, _ in K.chunks(data, stops, CHUNK):
                texts = column.slice(i, j - i).to_pylist()
                best, paths, same = [], [], []
                for t, (ids, some) in zip(texts, _encode(texts, vocabulary, n), strict=True):
                    best.append(ids)
                    paths.append(some)
                    same.append(vocabulary.decode(ids.tolist()) == t.replace(MARK, " "))
                counts = np.array([len(x) for x in best], np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(i, j - i), K.list_array(np.concatenate(best), counts, pa.int32()), pa.array(counts),
                     pa.array([p[0]["score"] for p in paths]), pa.array(paths, nested), pa.array(same)],
                    names=["row", "ids", "n_tokens", "score", "nbest", "decoded_equal"])

    return picked.mapInArrow(work, schema)


def decode(tokens: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """(row: all columns of ``tokens``, text): the texts of id lists; a null list gives a null text."""
    schema = tokens.select(F.struct("*").alias("row")).schema.add("text", "string")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _loaded(model)
        for batch in batches:
            texts = [None if x is None else vocabulary.decode(x) for x in batch.column("_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], names=["row", "text"])

    return tokens.select(F.struct("*").alias("row"), F.col(ids).alias("_ids")).mapInArrow(work, schema)


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query("op2_sentencepiece")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), vocabulary_path()).select("row.doc_id", "ids", "n_tokens", "score", "nbest", "decoded_equal")
