"""Removal of long byte strings that start earlier in the corpus, through run-length indexes.

Matches are found in four steps, each a Spark stage over whole texts:

1. Every string of ``least`` bytes holds at least one anchor, an ``ANCHOR``-byte string whose hash is
   the smallest of its window. Equal strings have equal anchors at equal offsets.
2. Anchors are shuffled by hash; those that occur once cannot lie in a repeat and end here.
3. The surroundings of repeated anchors meet by anchor. Copies within a task are marked at once and
   only the first goes on, so a passage held by a third of all texts is at most one row a task.
4. Each meeting point builds :class:`~tallyline.llm.run_index.RunIndex` over neighbouring groups,
   streams their matching statistics and marks what also starts earlier.

Very frequent anchors (more than ``share`` of the texts, at most anchors-per-text / share of them) are
found first and known to repeat. Their surroundings meet by longer cores, a few offsets each, so that
one frequent phrase with many different surroundings is spread over many groups. A group of more than ``LARGEST`` bytes
all the same (a long line with many different surroundings) is not indexed: its strings of ``least`` bytes are dealt by
a hash of 128 bits, each with its first place in a part of the group, and meet there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.llm import kernels as K
from tallyline.llm.registry import query, table
from tallyline.llm.run_index import RunIndex
from tallyline.llm.scratch import width

ANCHOR = 40
BLOCK = 31
BUNDLE = 1 << 19
LARGEST = 1 << 23
SALTS = 32
SALT_AT = 25
_U = np.uint64


def _window_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes from each position; the last positions are wrong and must be masked."""
    n = len(data)
    up, down = K.Powers.get(n)
    sums = np.zeros(n + 1, _U)
    np.cumsum((data.astype(_U) + _U(1)) * up, out=sums[1:])
    h = np.zeros(n, _U)
    np.subtract(sums[size:], sums[:n + 1 - size], out=h[:n + 1 - size])
    h *= down
    return K.mix(h)


def _slide(values: np.ndarray, size: int, pick: np.ufunc, back: bool) -> np.ndarray:
    """``pick`` over the ``size`` values from (``back``: up to) each position, in a logarithm of passes."""
    out, length = values, 1
    while length < size:
        step = min(length, size - length)
        fresh = out.copy()
        if step < len(out):
            if back:
                pick(out[step:], out[:-step], out=fresh[step:])
            else:
                pick(out[:-step], out[step:], out=fresh[:-step])
        out = fresh
        length += step
    return out


def anchors(data: np.ndarray, ends: np.ndarray, least: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors of texts laid end to end."""
    n = len(data)
    if n < least:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    left = (np.repeat(ends[1:], np.diff(ends)) - np.arange(n)).astype(np.int32)
    h = _window_hashes(data, anchor)
    brief = (h >> _U(32)).astype(np.uint32)  # the order of anchors needs no more bits
    brief[left < anchor] = 0xFFFFFFFF
    span = least - anchor + 1
    lowest = _slide(brief, span, np.minimum, back=False)
    lowest[left < least] = 0
    x = np.flatnonzero((_slide(lowest, span, np.maximum, back=True) == brief) & (left >= anchor))
    return x, h[x]


def _anchor_rows(batch: pa.RecordBatch, least: int, anchor: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(row of the batch, position in the text, hash) of all anchors, chunk by chunk."""
    data, ends = K.bytes_of(batch.column("_bytes"))
    for i, _, part, stops in K.chunks(data, ends):
        x, h = anchors(part, stops, least, anchor)
        row = np.searchsorted(stops, x, "right") - 1
        yield row + i, x - stops[row], h


class _Numbering:
    """Number of each row among the rows of its document id, over batches in order; the salt of a row stands in its high bits."""

    def __init__(self) -> None:
        self.last, self.seen = None, 0

    def of(self, batch: pa.RecordBatch) -> np.ndarray:
        ids, salts = batch.column("_id").to_numpy(), batch.column("_salt").to_numpy()
        n = len(ids)
        if not n:
            return np.zeros(0, np.int64)
        new = np.ones(n, bool)
        new[1:] = (ids[1:] != ids[:-1]) | (salts[1:] != salts[:-1])
        first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        number = np.arange(n) - first
        if self.last == (ids[0], salts[0]):
            number[:int(np.argmax(new[1:])) + 1 if new[1:].any() else n] += self.seen
        self.last, self.seen = (ids[-1], salts[-1]), int(number[-1]) + 1
        return (salts.astype(np.int64) << SALT_AT) + number


def _frequent(docs: DataFrame, least: int, anchor: int, share: float) -> np.ndarray:
    """Hashes of anchors that stand in more than ``share`` of the texts by the batches' own counts, ascending."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row, _, h in _anchor_rows(batch, least, anchor):
                if len(h):
                    order = np.lexsort((row, h))
                    h, row = h[order], row[order]
                    keep = np.ones(len(h), bool)
                    keep[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
                    found.append(h[keep])
            u, c = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, _U), np.zeros(0, int))
            often = c > max(2, share * len(batch))
            yield pa.RecordBatch.from_arrays([pa.array(u[often].view(np.int64)), pa.array(c[often].astype(np.int64))], names=["h", "c"])

    total = docs.count()
    rows = (docs.select("_bytes").mapInArrow(count, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))
            .where(F.col("c") > share * total).select("h").collect())
    return np.sort(np.array([r.h for r in rows], np.int64))


def _in_order(rows: DataFrame) -> DataFrame:
    """Rows of each task by id, those of one id by a hash of their text; a join keeps no order, so it is asked for after each."""
    return rows.sortWithinPartitions("_id", "_salt", F.xxhash64("_bytes"))


def mark_repeats(base: DataFrame, frequent: np.ndarray, least: int, anchor: int) -> DataFrame:
    """(_id, no, s, e): byte ranges that repeat what starts earlier, from ``base`` sorted by _id."""
    spark = base.sparkSession
    n = width(spark)
    reach = least - anchor

    buckets = 2 * n

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbering = _Numbering()
        for batch in batches:
            ids = batch.column("_id").to_numpy()
            number = numbering.of(batch)
            found = list(_anchor_rows(batch, least, anchor))
            if not found:
                continue
            row, x, h = (np.concatenate(c) for c in zip(*found, strict=True))
            hot = np.isin(h.view(np.int64), frequent)
            # A frequent anchor is known to repeat: it does not meet others by hash and travels by place.
            meet = np.where(hot, K.mix(x.astype(_U) + K.mix(ids[row].view(_U))), h)
            bucket = (meet % _U(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
            some = np.flatnonzero(np.diff(ends))
            blobs = []
            for k in some.tolist():
                of = order[ends[k]:ends[k + 1]]
                place = ids[row[of]]
                blobs.append(K.packed(h[of], np.diff(place, prepend=0), number[row[of]].astype(np.int32), x[of].astype(np.int32), hot[of]))
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(blobs, pa.binary())], names=["bucket", "blob"])

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for blobs in K.buckets(batches):
            parts = [K.unpacked(blob, _KINDS) for blob in blobs]
            for part in parts:
                part[1] = np.cumsum(part[1])
            h, place, no, x, hot = (np.concatenate(c) for c in zip(*parts, strict=True))
            _, which, count = np.unique(h, return_inverse=True, return_counts=True)
            keep = hot | (count[which] > 1)
            yield pa.RecordBatch.from_arrays([pa.array(hot[keep]), pa.array(place[keep]), pa.array(no[keep]), pa.array(x[keep])],
                                             names=["hot", "_id", "no", "x"])

    again = (base.mapInArrow(find, "bucket int, blob binary").repartition(n, "bucket").sortWithinPartitions("bucket")
             .mapInArrow(repeated, "hot boolean, _id long, no int, x int"))
    places = again.groupBy("_id", F.shiftright("no", SALT_AT).alias("_salt")).agg(F.collect_list(F.struct("no", "x", "hot")).alias("_at"))

    def surround(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbering, known = _Numbering(), set()
        for batch in batches:
            ids = batch.column("_id").to_numpy()
            number = numbering.of(batch)
            data, ends = K.bytes_of(batch.column("_bytes"))
            lists = batch.column("_at")
            counts = np.diff(lists.offsets.to_numpy())
            counts[np.asarray(lists.is_null())] = 0
            flat = lists.flatten()
            if not len(flat):
                continue
            row = np.repeat(np.arange(len(ids)), counts)
            no, x, hot = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(3))
            mine = number[row] == no
            row, x, hot = row[mine], x[mine].astype(np.int64), hot[mine]
            order = np.lexsort((x, row))
            row, x, hot = row[order], x[order], hot[order]
            for i, j, part, stops in K.chunks(data, ends):
                lo, hi = np.searchsorted(row, (i, j))
                if lo < hi:
                    yield _surroundings(part, stops, row[lo:hi] - i, x[lo:hi], hot[lo:hi], ids[i:j], number[i:j], least, anchor, known)

    around = _in_order(base.join(places, ["_id", "_salt"], "left")).mapInArrow(surround, "m long, _id long, no int, s int, e int, context binary")

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole, bundle in _bundles(batches):
            for rows in _indexed(bundle, least) if whole else _windows(bundle, least):
                if rows.num_columns == 4:  # marks stand alone
                    spread = K.mix(rows.column("_id").to_numpy().view(_U) + rows.column("s").to_numpy().astype(_U) * _U(K.BASE))
                    rows = pa.RecordBatch.from_arrays([*rows.columns, pa.array([x.tobytes() for x in spread], pa.binary())], names=["_id", "no", "s", "e", "w"])
                yield rows

    found = around.repartition(n, "m").sortWithinPartitions("m").mapInArrow(index, "_id long, no int, s int, e int, w binary")
    # strings of large groups (e is 0) meet by name, one row a part of a group
    place, string = F.struct("_id", "no", "s"), F.col("e") == 0
    met = found.withColumn("_first", F.min(F.when(string, place)).over(Window.partitionBy("w")))
    return met.where(~string | (place != F.col("_first"))).select(
        "_id", "no", "s", F.when(string, F.col("s") + least).otherwise(F.col("e")).cast("int").alias("e"))


def _indexed(bundle: pa.Table, least: int) -> Iterator[pa.RecordBatch]:
    """(_id, no, s, e) marks of whole groups, from one run-length index over them."""
    done = bundle.filter(pc.is_null(bundle.column("context")))
    yield from done.select(["_id", "no", "s", "e"]).to_batches()
    fresh = bundle.filter(pc.is_valid(bundle.column("context"))).combine_chunks()
    if fresh.num_rows < 2:
        return
    ids, no = fresh.column("_id").to_numpy(), fresh.column("no").to_numpy()
    s, e = (fresh.column(c).to_numpy().astype(np.int64) for c in ("s", "e"))
    order = np.lexsort((no, ids))
    new = np.ones(len(ids), bool)
    new[1:] = (ids[order][1:] != ids[order][:-1]) | (no[order][1:] != no[order][:-1])
    ordinal = np.empty(len(ids), np.int64)
    ordinal[order] = np.cumsum(new)
    # Equal surroundings of one group come from other tasks: the first stays, the others repeat it.
    group = fresh.column("m").to_numpy()
    text = pc.dictionary_encode(fresh.column("context")).combine_chunks().indices.to_numpy()
    at = (ordinal << 32) | s
    order = np.lexsort((at, text, group))
    new = np.ones(len(ids), bool)
    new[1:] = (group[order][1:] != group[order][:-1]) | (text[order][1:] != text[order][:-1])
    first = np.flatnonzero(new)
    later = order[at[order] > np.repeat(at[order[first]], np.diff(np.append(first, len(order))))]
    if len(later):
        yield pa.RecordBatch.from_arrays([pa.array(ids[later]), pa.array(no[later]), pa.array(s[later].astype(np.int32)),
                                          pa.array(e[later].astype(np.int32))], names=["_id", "no", "s", "e"])
    stay = order[first]
    alone = np.ones(len(stay) + 1, bool)
    alone[1:-1] = group[stay][1:] != group[stay][:-1]
    stay = stay[~(alone[:-1] & alone[1:])]  # a group of one has nothing to match
    if not len(stay):
        return
    fresh = fresh.take(pa.array(stay))
    ids, no, s, ordinal = ids[stay], no[stay], s[stay], ordinal[stay]
    data, ends = K.bytes_of(fresh.column("context"))
    runs = RunIndex(data, ends)
    inside = np.arange(len(runs.text)) - runs.starts[runs.string]
    place = (ordinal[runs.string] << 32) | (s[runs.string] + inside)
    p = runs.repeated(least, place)
    if not len(p):
        return
    string, at = runs.string[p], s[runs.string[p]] + inside[p]
    cut = np.ones(len(p), bool)
    cut[1:] = (string[1:] != string[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(cut)
    final = np.append(first[1:], len(p)) - 1
    of = string[first]
    yield pa.RecordBatch.from_arrays(
        [pa.array(ids[of]), pa.array(no[of]), pa.array(at[first].astype(np.int32)),
         pa.array((at[final] + least).astype(np.int32))], names=["_id", "no", "s", "e"])


def _windows(part: pa.Table, least: int) -> Iterator[pa.RecordBatch]:
    """Marks and strings of a part of a large group: what repeats an earlier place of the part is marked; the first place of
    each string of ``least`` bytes goes on, named by a hash of 128 bits (``w``), with 0 for its end."""
    yield from part.filter(pc.is_null(part.column("context"))).select(["_id", "no", "s", "e"]).to_batches()
    fresh = part.filter(pc.is_valid(part.column("context"))).combine_chunks()
    if not fresh.num_rows:
        return
    ids, no, s = (fresh.column(c).to_numpy() for c in ("_id", "no", "s"))
    data, ends = K.bytes_of(fresh.column("context"))
    row = K.owners(ends)
    at = np.flatnonzero(np.arange(len(data)) + least <= ends[1:][row])
    row, start = row[at], s[row[at]] + at - ends[row[at]]
    names = [_window_hashes(data, least)[at], K.span_hashes(data, at, at + least // 2) ^ K.mix(K.span_hashes(data, at + least // 2, at + least))]
    order = np.lexsort((start, no[row], ids[row], names[1], names[0]))
    new = np.ones(len(order), bool)
    new[1:] = (names[0][order][1:] != names[0][order][:-1]) | (names[1][order][1:] != names[1][order][:-1])
    first, later = order[new], order[~new]
    # the same place may come in two surroundings; it is not a repeat of itself
    head = first[np.cumsum(new) - 1][~new]
    later = later[(ids[row[later]] != ids[row[head]]) | (no[row[later]] != no[row[head]]) | (start[later] != start[head])]
    place = [pa.array(c) for c in (ids[row[later]], no[row[later]], start[later].astype(np.int32), (start[later] + least).astype(np.int32))]
    yield pa.RecordBatch.from_arrays(place, names=["_id", "no", "s", "e"])
    name = np.stack(names, 1)[first]
    yield pa.RecordBatch.from_arrays(
        [pa.array(ids[row[first]]), pa.array(no[row[first]]), pa.array(start[first].astype(np.int32)), pa.array(np.zeros(len(first), np.int32)),
         pa.array([x.tobytes() for x in name], pa.binary())], names=["_id", "no", "s", "e", "w"])


def _surroundings(data: np.ndarray, ends: np.ndarray, row: np.ndarray, x: np.ndarray, hot: np.ndarray, ids: np.ndarray,
                  number: np.ndarray, least: int, anchor: int, known: set) -> pa.RecordBatch:
    """What surrounds the repeated anchors x (ascending within ``row``) of a chunk, as far as their windows reach.

    A window belongs to the leftmost of its smallest anchors, so the windows of an anchor end where a
    smaller anchor comes in, and no window goes out twice. What an earlier row of the task also holds
    is marked (null ``context``), the first one goes on to meet others by ``m``.
    """
    reach = least - anchor
    brief = (_window_hashes(data, anchor) >> _U(32)).astype(np.uint32)
    begin, size = ends[row], np.diff(ends)[row]
    at = begin + x
    step = np.arange(1, reach + 1)
    before, after = at[:, None] - step, at[:, None] + step
    ahead = (before >= begin[:, None]) & (brief[np.maximum(before, 0)] <= brief[at][:, None])
    behind = (after + anchor <= (begin + size)[:, None]) & (brief[np.minimum(after, len(data) - 1)] < brief[at][:, None])
    low = np.maximum(x - np.where(ahead.any(1), ahead.argmax(1), reach), 0)
    high = np.minimum(x - reach + np.where(behind.any(1), behind.argmax(1), reach), size - least)
    whole = ~hot & (low <= high)
    pieces = [(-1, row[whole], low[whole], high[whole], x[whole], x[whole] + anchor)]
    for first in range(0, reach + 1, BLOCK):
        last = min(first + BLOCK - 1, reach)  # windows that start last .. first bytes before the anchor share a core
        a, z = np.maximum(x - last, low), np.minimum(x - first, high)
        some = hot & (a <= z)
        pieces.append((first, row[some], a[some], z[some], x[some] - first, x[some] - last + least))
    blob = data.tobytes()
    out: list[list] = [[], [], [], [], []]
    again: list[tuple[int, int, int]] = []
    for kind, rows, a, z, c0, c1 in pieces:
        for r, o, s, e, p, q in zip(rows.tolist(), ends[rows].tolist(), a.tolist(), (z + least).tolist(), c0.tolist(), c1.tolist(),
                                    strict=True):
            context = blob[o + s:o + e]
            name = hashlib.blake2b(context, digest_size=12, salt=b"%d,%d" % (kind, p - s)).digest()
            if name in known:
                again.append((r, s, e))
                continue
            known.add(name)
            core = hashlib.blake2b(blob[o + p:o + q], digest_size=8).digest()
            for column, value in zip(out, (core, r, s, e, context), strict=True):
                column.append(value)
    r, s, e = _merged(np.array(again, np.int64).reshape(-1, 3))
    rows = np.concatenate((r, np.array(out[1], np.int64)))
    spread = K.mix(ids[r].view(_U) + s.astype(_U)).view(np.int64)
    meet = np.concatenate((spread, np.frombuffer(b"".join(out[0]), np.int64)))
    return pa.RecordBatch.from_arrays(
        [pa.array(meet), pa.array(ids[rows]), pa.array(number[rows].astype(np.int32)), pa.array(s.tolist() + out[2], pa.int32()),
         pa.array(e.tolist() + out[3], pa.int32()), pa.array([None] * len(r) + out[4], pa.binary())],
        names=["m", "_id", "no", "s", "e", "context"])


def _merged(spans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) spans of rows, those of a row that touch or overlap joined."""
    row, s, e = spans[np.lexsort((spans[:, 1], spans[:, 0]))].T
    if not len(row):
        return row, s, e
    far = row << 32  # keeps the rows apart
    reach = np.maximum.accumulate(far + e)
    new = np.ones(len(row), bool)
    new[1:] = far[1:] + s[1:] > reach[:-1]
    first = np.flatnonzero(new)
    return row[first], s[first], reach[np.append(first[1:], len(row)) - 1] - far[first]


_KINDS = (np.uint64, np.int64, np.int32, np.int32, np.bool_)


def _bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, pa.Table]]:
    """Neighbouring whole groups of about ``BUNDLE`` bytes, from rows sorted by group; a group above ``LARGEST`` bytes comes in
    parts instead, as (False, part)."""
    held: list[pa.RecordBatch] = []
    rows = size = own = start = 0  # held rows, bytes of all, bytes of the last group, the row it starts at
    parts, last = False, None
    for batch in batches:
        n, begin = batch.num_rows, 0
        if not n:
            continue
        group = batch.column("m").to_numpy()
        lengths = pc.binary_length(batch.column("context")).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        total = np.concatenate(([0], np.cumsum(lengths)))
        edge = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1).tolist(), n]
        for a, b in zip(edge, edge[1:], strict=False):
            if group[a] != last:
                if rows + a - begin and (parts or size >= BUNDLE):
                    yield not parts, pa.Table.from_batches([*held, batch.slice(begin, a - begin)])
                    held, rows, size, begin = [], 0, 0, a
                last, own, parts, start = group[a], 0, False, rows + a - begin
            while own + int(total[b] - total[a]) > LARGEST:  # the group is cut here
                cut = max(a + 1, int(np.searchsorted(total, total[a] + LARGEST - own, "right")) - 1)
                some = pa.Table.from_batches([*held, batch.slice(begin, cut - begin)])
                if start:
                    yield True, some.slice(0, start)
                yield False, some.slice(start)
                held, rows, size, own, start, parts, begin, a = [], 0, 0, 0, 0, True, cut, cut
            size += int(total[b] - total[a])
            own += int(total[b] - total[a])
        if begin < n:
            held.append(batch.slice(begin))
            rows += n - begin
    if held:
        yield not parts, pa.Table.from_batches(held)


def remove_repeats(docs: DataFrame, keep: list[str], least: int = 100, anchor: int = ANCHOR, share: float = 0.01,
                   text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Drop each byte that a ``least``-byte string covers which also starts earlier.

    Earlier is a smaller document id, or an earlier start in the same document. Returns the columns
    ``keep`` in a struct ``row``, with ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` (binary, the
    bytes left).

    A null text is empty. A null id sorts before all others. Rows that share an id stand in the order
    of a hash of their text; a repeated row is a later copy. Texts under ``least`` bytes stay whole.
    Matches never cross documents. Other columns ride along untouched, whatever their names.
    """
    bare = docs.select(F.col(text).cast("binary").alias("_bytes"))
    frequent = _frequent(bare, least, anchor, share)
    n = width(docs.sparkSession)
    base = (docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63))).alias("_id"),
                        F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("_bytes"),
                        F.struct(*[F.col(c) for c in keep]).alias("_row"))
            .withColumn("_salt", F.pmod(F.xxhash64("_bytes"), F.lit(SALTS)).cast("int")).repartition(n, "_id", "_salt"))
    base = _in_order(base)  # rows that share an id are dealt by their text
    marks = (mark_repeats(base, frequent, least, anchor).groupBy("_id", F.shiftright("no", SALT_AT).alias("_salt"))
             .agg(F.collect_list(F.struct("no", "s", "e")).alias("_marks")))
    kind = docs.select(F.struct(*[F.col(c) for c in keep]).alias("_row")).schema
    schema = kind.add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept", "binary")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbering = _Numbering()
        for batch in batches:
            number = numbering.of(batch)
            column = batch.column("_bytes")
            lists = batch.column("_marks")
            counts = np.diff(lists.offsets.to_numpy())
            counts[np.asarray(lists.is_null())] = 0
            flat = lists.flatten()
            no, s, e = (flat.field(k).to_numpy(zero_copy_only=False) if len(flat) else np.zeros(0, np.int32) for k in range(3))
            stops = np.cumsum(counts)
            sizes, removed, spans, kept = [], [], [], []
            for i in range(batch.num_rows):
                raw = column[i].as_buffer().to_pybytes()
                lo, hi = stops[i] - counts[i], stops[i]
                mine = no[lo:hi] == number[i]
                a, z = s[lo:hi][mine], e[lo:hi][mine]
                sizes.append(len(raw))
                if not len(a):
                    removed.append(0)
                    spans.append(0)
                    kept.append(raw)
                    continue
                order = np.argsort(a)
                a, z = a[order], np.maximum.accumulate(z[order])
                new = np.ones(len(a), bool)
                new[1:] = a[1:] > z[:-1]
                first = np.flatnonzero(new)
                a, z = a[first].tolist(), z[np.append(first[1:], len(new)) - 1].tolist()
                left = b"".join(raw[p:q] for p, q in zip([0, *z], [*a, len(raw)], strict=True))
                removed.append(len(raw) - len(left))
                spans.append(len(a))
                kept.append(left)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                 pa.array(kept, pa.binary())], names=["_row", "n_bytes", "n_removed", "n_spans", "kept"])

    out = _in_order(base.join(marks, ["_id", "_salt"], "left")).mapInArrow(cut, schema)
    return out.withColumnRenamed("_row", "row")


@query("op1_suffix_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"), ["doc_id"])
    return out.select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))

