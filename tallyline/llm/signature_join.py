"""Exact Jaccard join of word shingles with signature trees, and the groups that its links form.

Documents with equal shingle sets are one class. Two classes that link share a token of their prefixes,
the first tokens of each set in one global order: the rarest first, by the exact number of sets that hold them.

1. One pass over the texts writes a narrow row a document: class, set size, and a bitmap of its tokens.
2. Tokens are counted over all sets; prefix tokens held by two or more classes are kept. In each token's group every class is paired with
   one representative; pairs whose bitmaps seem to share half of their tokens tie classes into neighbourhoods, and
   neighbourhoods that share many tokens grow together.
3. Each neighbourhood is searched by a signature tree: nodes hold the OR of the bitmaps and the size range
   below them; a dual traversal drops a pair of nodes as soon as the largest possible overlap falls
   short. A bitmap has a few bits for each token of its set, so long sets are told apart like short ones; trees over sets of two
   widths fold the wider ones. Within a neighbourhood the bitmaps have a bit for every token that two of its sets share, so
   the overlaps at the leaves are exact. A task counts the links of each class and returns no more of them
   than it has classes, enough to tell which classes hang together.
4. Token groups with classes of several neighbourhoods are searched by trees over the hashed bitmaps, which
   also drop pairs within one neighbourhood. Each pair's shared prefix tokens are counted over all groups;
   all tokens of a set that stand before the end of both prefixes are known, so the count bounds the
   overlap once more. What is left is compared token by token.

Two classes that link share a prefix token, so they are compared in step 3 or in step 4, and only in one of
them. No link is lost from the counts, and from the pairs only those that a path within one task implies.
Tokens and classes are known by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import kernels as K
from tallyline.llm.links import components
from tallyline.llm.registry import query, table
from tallyline.llm.scratch import stored, width

LEAST_BITS = 512
MOST_BITS = 1 << 15
ALIKE = 0.5
FANOUT = 8
SHARE = 0.001
TILE = 4_096
MEMBERS = 256
SALTS = 64
LOT = 1 << 20
HOOD = 512
HOOD_TOKENS = 1 << 19
BROADCAST_ROWS = 1_000_000
PAIRS_AT_ONCE = 1 << 15
WORDS_AT_ONCE = 1 << 21
PAIRS_HELD = 1 << 20
_U = np.uint64


def token_sets(column: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, ascending distinct tokens) of every text of a column that has words."""
    data, ends = K.bytes_of(column)
    for i, _, part, stops in K.chunks(data, ends):
        low = K.lower_ascii(part)
        starts, finish = K.words(low, stops)
        row = np.searchsorted(stops, starts, "right") - 1
        tokens, row = K.shingles(K.span_hashes(low, starts, finish), row, size)
        first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1]))) if len(row) else np.zeros(0, np.int64)
        for a, b in zip(first.tolist(), [*first[1:].tolist(), len(row)], strict=True):
            yield int(row[a]) + i, np.unique(tokens[a:b])


def class_of(tokens: np.ndarray) -> int:
    """A 64-bit name of a set."""
    return int(K.mix(np.array([K.mix(tokens).sum(dtype=_U) + _U(len(tokens))], _U)).view(np.int64)[0])


def bitmap(tokens: np.ndarray) -> bytes:
    """Bits of a set: two to four times as many as it has tokens, a power of two between ``LEAST_BITS`` and ``MOST_BITS``."""
    width = min(max(LEAST_BITS, 2 << (len(tokens) - 1).bit_length()), MOST_BITS)
    bits = np.zeros(width, bool)
    bits[(tokens % _U(width)).astype(np.int64)] = True
    return np.packbits(bits).tobytes()


def folded(maps: list[bytes], size: int) -> np.ndarray:
    """Bitmaps of ``size`` bytes or more, cut down to that size: a row of 64-bit words each."""
    out = np.zeros((len(maps), size // 8), _U)
    for k, m in enumerate(maps):
        out[k] = np.frombuffer(m, _U) if len(m) == size else np.bitwise_or.reduce(np.frombuffer(m, _U).reshape(-1, size // 8), axis=0)
    return out


def alike(a: bytes, b: bytes, na: int, nb: int) -> float:
    """About the similarity of two sets, from how many bits their union sets."""
    size = min(len(a), len(b))
    bits = 8 * size
    on = int(np.bitwise_count(np.bitwise_or(*folded([a, b], size))).sum())
    if on == bits:
        return 0.0
    union = max(-bits * np.log1p(-on / bits), na, nb)
    return (na + nb - union) / union


def prefix_size(n: int, percent: int) -> int:
    """Tokens of which a set must share one with any set it links with."""
    return n - -(-percent * n // 100) + 1


def _describe(docs: DataFrame, size: int, text: str, doc_id: str, share: float) -> tuple[DataFrame, np.ndarray]:
    """The narrow rows (_id, text_hash, cls, n, sig) and the frequent tokens, the rarest of them first."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            cls, n, sig = [None] * rows, [0] * rows, [None] * rows
            every = []
            for row, tokens in token_sets(batch.column("_text"), size):
                cls[row], n[row], sig[row] = class_of(tokens), len(tokens), bitmap(tokens)
                every.append(tokens)
            name, count = np.unique(np.concatenate(every), return_counts=True) if every else (np.zeros(0, _U), np.zeros(0, int))
            often = count > max(2, share * rows)
            name, count = name[often].view(np.int64), count[often]
            more = len(name)
            yield pa.RecordBatch.from_arrays(
                [pa.array([True] * rows + [False] * more), pa.concat_arrays([batch.column("_id"), pa.array(name, pa.int64())]),
                 pa.concat_arrays([batch.column("text_hash"), pa.nulls(more, pa.int64())]),
                 pa.array(cls + [None] * more, pa.int64()), pa.array(n + count.tolist(), pa.int64()),
                 pa.array(sig + [None] * more, pa.binary())], names=["doc", "_id", "text_hash", "cls", "n", "sig"])

    words = F.col(text).cast("string")
    some = docs.select(F.col(doc_id).cast("long").alias("_id"), F.xxhash64(words).alias("text_hash"), words.alias("_text"))
    rows = stored(some.mapInArrow(work, "doc boolean, _id long, text_hash long, cls long, n long, sig binary"))
    narrow = rows.where("doc").drop("doc")
    total = narrow.count()
    often = (rows.where("not doc").groupBy("_id").agg(F.sum("n").alias("n")).where(F.col("n") > share * total)
             .collect())  # at most mean set size / share
    frequent = np.array(sorted([(r.n, r._id) for r in often]), np.int64).reshape(-1, 2)[:, 1].view(_U)
    return narrow, frequent


_KINDS = (np.uint64, np.int64, np.int32)


def _short(tokens: np.ndarray) -> bytes:
    """The low 48 bits of tokens as planes of bytes."""
    return np.ascontiguousarray(tokens.view(np.uint8).reshape(-1, 8)[:, :6].T).tobytes()


def _long(blob: bytes) -> np.ndarray:
    out = np.zeros((len(blob) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(blob, np.uint8).reshape(6, -1).T
    return out.view(_U).ravel()


def _gathered(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[list[dict]]:
    """All rows of each key, of rows that come sorted by it."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and held[-1][key] != row[key]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _lot(sets: list[tuple], lot: int, buckets: int) -> pa.RecordBatch:
    """The tokens of the sets of a lot by bucket, each with the place of its set, and one row about the sets themselves."""
    owner = np.repeat(np.arange(len(sets)), [len(s[2]) for s in sets]).astype(np.uint16)
    tokens = np.concatenate([s[2] for s in sets])
    bucket = (tokens >> _U(48)).astype(np.int64) % buckets
    order = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
    some = np.flatnonzero(np.diff(ends))
    blobs = [_short(tokens[o]) + K.packed(owner[o]) for o in (order[ends[k]:ends[k + 1]] for k in some.tolist())]
    about = [[s[0] for s in sets], [s[1] for s in sets], [len(s[2]) for s in sets], [len(s[3]) for s in sets]]
    blobs.append(K.packed(*(np.array(c, np.int64) for c in about)) + np.concatenate([s[3] for s in sets]).tobytes())
    return pa.RecordBatch.from_arrays(
        [pa.array([*some.tolist(), lot % buckets], pa.int32()), pa.array([lot] * len(blobs), pa.int64()),
         pa.array([0] * len(some) + [len(sets)], pa.int32()), pa.array(blobs, pa.binary())], names=["bucket", "lot", "sets", "blob"])


def _shared(rows: list[dict]) -> Iterator[dict]:
    """The blocks of a bucket, cut down to tokens that two or more sets hold, with the number of these sets."""
    blocks = [r for r in rows if not r["sets"]]
    sizes = [len(r["blob"]) // 8 for r in blocks]
    token = np.concatenate([_long(r["blob"][:6 * k]) for r, k in zip(blocks, sizes, strict=True)])
    order = np.argsort(token)
    first = np.flatnonzero(np.concatenate(([True], token[order[1:]] != token[order[:-1]])))
    count = np.diff(np.append(first, len(token)))
    held = np.empty(len(token), np.uint32)
    held[order] = np.repeat(np.minimum(count, (1 << 32) - 1), count)
    at = 0
    for r, k in zip(blocks, sizes, strict=True):
        part = slice(at, at + k)
        some = held[part] > 1
        if some.any():
            owner = K.unpacked(r["blob"][6 * k:], (np.uint16,))[0]
            yield r | {"blob": _short(token[part][some]) + K.packed(owner[some], held[part][some])}
        at += k


def _prefixes(rows: list[dict], percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token, class and size of what the prefixes of a lot's sets share with other sets; frequent tokens have the highest bit."""
    about = next(r for r in rows if r["sets"])
    sets = about["sets"]
    names, n, rare, hot = K.unpacked(about["blob"][:32 * sets], (np.int64,) * 4)
    last = np.frombuffer(about["blob"], _U, offset=32 * sets) | _U(1 << 63)
    token, owner, held = [np.zeros(0, _U)], [np.zeros(0, np.uint16)], [np.zeros(0, np.uint32)]
    for r in rows:
        if not r["sets"]:
            k = len(r["blob"]) // 12
            token.append(K.mix(_long(r["blob"][:6 * k]) | _U(r["bucket"]) << _U(48)) >> _U(1))
            o, h = K.unpacked(r["blob"][6 * k:], (np.uint16, np.uint32))
            owner.append(o)
            held.append(h)
    token, owner, held = np.concatenate(token), np.concatenate(owner), np.concatenate(held)
    order = np.lexsort((token, held, owner))
    token, owner = token[order], owner[order]
    shared = np.bincount(owner, minlength=sets)
    prefix = np.minimum(n - -(-percent * n // 100) + 1, rare)
    wanted = prefix - (rare - shared)  # what only this set holds comes first
    keep = np.arange(len(token)) - (np.cumsum(shared) - shared)[owner] < wanted[owner]
    at = np.concatenate((owner[keep].astype(np.int64), np.repeat(np.arange(sets), hot)))
    return np.concatenate((token[keep], last)), names[at], n[at].astype(np.int32)


def _meetings(docs: DataFrame, size: int, percent: int, text: str, frequent: np.ndarray) -> DataFrame:
    """(token, cls, n, lead, lead_n): the prefix tokens that two or more classes hold, with a representative of each group.

    The order of prefixes is rarest first, by the exact number of sets that hold a token, the frequent ones last:

    * a task gathers its sets into lots and deals their tokens by hash, each with the place of its set in the lot;
    * by token, sets are counted, and tokens of two or more go back to their lots with that number. What doesn't come back is in one
      set only and stands first in its prefix, where it can't meet anything;
    * by lot, the rest of each prefix is filled with the rarest shared tokens. A set with enough tokens of its own is done.

    Prefix tokens then travel as packed blocks, by token; a block holds each class once. A frequent token is dealt
    over several buckets, each with a representative of its own. Equal sets of several tasks count apart in the
    order, which is the same for all sets, and are one class where prefixes meet.
    """
    n = width(docs.sparkSession)
    buckets = 2 * n
    rank = np.argsort(frequent)
    known = frequent[rank]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lot = TaskContext.get().partitionId() << 32
        done: set[int] = set()
        sets: list[tuple] = []
        rows = 0
        for batch in batches:
            for _, tokens in token_sets(batch.column(0), size):
                name = class_of(tokens)
                if name in done:
                    continue
                done.add(name)
                at = np.minimum(np.searchsorted(known, tokens), max(len(known) - 1, 0))
                hot = known[at] == tokens if len(known) else np.zeros(len(tokens), bool)
                rare = tokens[~hot]
                last = np.sort(rank[at[hot]])[:max(0, prefix_size(len(tokens), percent) - len(rare))]
                sets.append((name, len(tokens), rare, last.astype(_U)))
                rows += len(tokens)
                if rows >= LOT or len(sets) == 1 << 16:
                    yield _lot(sets, lot, buckets)
                    sets, rows, lot = [], 0, lot + 1
        if sets:
            yield _lot(sets, lot, buckets)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _gathered(batches, "bucket"):
            yield pa.RecordBatch.from_pylist([r for r in rows if r["sets"]], packed)
            for r in _shared(rows) if not all(r["sets"] for r in rows) else ():
                yield pa.RecordBatch.from_pylist([r], packed)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _gathered(batches, "lot"):
            token, cls, many = _prefixes(rows, percent)
            salted = np.where(token >> _U(63) > 0, K.mix(token + K.mix(cls.view(_U) % _U(SALTS))), token)
            bucket = (K.mix(salted) % _U(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
            some = np.flatnonzero(np.diff(ends))
            blobs = [K.packed(token[o], cls[o], many[o]) for o in (order[ends[k]:ends[k + 1]] for k in some.tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(blobs, pa.binary())], names=["bucket", "blob"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for blobs in K.buckets(batches):
            token, cls, many = (np.concatenate(c) for c in zip(*(K.unpacked(b, _KINDS) for b in blobs), strict=True))
            order = np.lexsort((cls, token))
            token, cls, many = token[order], cls[order], many[order]
            keep = np.ones(len(token), bool)
            keep[1:] = (token[1:] != token[:-1]) | (cls[1:] != cls[:-1])
            token, cls, many = token[keep], cls[keep], many[keep]
            first = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
            count = np.diff(np.append(first, len(token)))
            lead = np.repeat(first, count)
            met = (np.repeat(count, count) > 1) | (token >> _U(63) > 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[met]) for c in (token.view(np.int64), cls, many, cls[lead], many[lead])],
                names=["token", "cls", "n", "lead", "lead_n"])

    ddl = "bucket int, lot long, sets int, blob binary"
    packed = pa.schema([("bucket", pa.int32()), ("lot", pa.int64()), ("sets", pa.int32()), ("blob", pa.binary())])
    dealt = docs.select(F.col(text).cast("string")).mapInArrow(deal, ddl)
    weighed = dealt.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(weigh, ddl)
    chosen = weighed.repartition(n, "lot").sortWithinPartitions("lot").mapInArrow(choose, "bucket int, blob binary")
    return (chosen.repartition(n, "bucket").sortWithinPartitions("bucket")
            .mapInArrow(meet, "token long, cls long, n int, lead long, lead_n int"))


def _stars(met: DataFrame, maps: DataFrame) -> DataFrame:
    """(a, b): pairs of a class and the representative of a group it is in that seem to share half of their tokens.

    Representatives of one frequent token are paired with the smallest of them in turn. ``maps`` has cls and sig. Where near copies
    of one text differ so much that only some of them link, all still seem alike, and meet in one neighbourhood.
    """
    leads = met.groupBy("token", "lead", "lead_n").agg(F.count("*").alias("_n")).drop("_n")
    top = leads.groupBy("token").agg(F.min(F.struct("lead", "lead_n")).alias("t"), F.count("*").alias("_n")).where("_n > 1")
    between = leads.join(top, "token").where("lead <> t.lead").select(
        F.col("t.lead").alias("a"), F.col("t.lead_n").cast("int").alias("na"), F.col("lead").alias("b"), F.col("lead_n").alias("nb"))
    within = met.where("cls <> lead").select(F.col("lead").alias("a"), F.col("lead_n").alias("na"), F.col("cls").alias("b"), F.col("n").alias("nb"))
    near = within.union(between).where(F.least("na", "nb") >= ALIKE * F.greatest("na", "nb")).distinct()
    both = near.join(maps.select(F.col("cls").alias("a"), F.col("sig").alias("sig_a")), "a").join(
        maps.select(F.col("cls").alias("b"), F.col("sig").alias("sig_b")), "b").select("a", "b", "na", "nb", "sig_a", "sig_b")

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = [batch.column(k).to_pylist() for k in ("sig_a", "sig_b", "na", "nb")]
            keep = pa.array([alike(*row) >= ALIKE for row in zip(*c, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(keep) for k in ("a", "b")], names=["a", "b"])

    return both.mapInArrow(weigh, "a long, b long")


def _ties(met: DataFrame, stars: DataFrame, percent: int) -> DataFrame:
    """(a, b): neighbourhoods (named by a class) that share half as many tokens as the prefix of the largest
    set of the smaller one holds.

    They are compared as one, in place, rather than pair by pair. In each token's group the neighbourhoods are
    only paired with the smallest of them.
    """
    held = stored(met.select("token", "cls", "n").join(stars.withColumnRenamed("id", "cls"), "cls", "left")
                  .groupBy("token", F.coalesce("component", "cls").alias("b")).agg(F.max("n").alias("n")))
    low = held.groupBy("token").agg(F.min("b").alias("a"), F.max("b").alias("_high")).where("a <> _high").drop("_high")
    both = held.join(low, "token").where("a <> b").groupBy("a", "b").agg(F.count("*").alias("shared"))
    sizes = held.groupBy("b").agg(F.max("n").alias("m"))
    near = both.join(sizes, "b").join(sizes.select(F.col("b").alias("a"), F.col("m").alias("_m")), "a")
    return near.where(2 * F.col("shared") >= _prefix_size(F.least("m", "_m"), percent)).select("a", "b")


def _bound(bits_a: np.ndarray, bits_b: np.ndarray, slack_a: np.ndarray, slack_b: np.ndarray) -> np.ndarray:
    """The largest possible overlap: shared bits, and the tokens of a set beyond one a bit."""
    return np.bitwise_count(bits_a & bits_b).sum(axis=1, dtype=np.int64) + np.minimum(slack_a, slack_b)


def _need(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """The smallest overlap with which sets of these sizes link."""
    return -(-percent * (a + b) // (100 + percent))


class SignatureTree:
    """Sets in order of size, with nodes of ``FANOUT`` children up to a single root."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray, group: np.ndarray) -> None:
        slack = sizes - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        self.levels = [(bits, sizes, sizes, slack, group)]
        while len(self.levels[-1][0]) > 1:
            b, low, high, s, g = self.levels[-1]
            at = np.arange(0, len(b), FANOUT)
            same = np.minimum.reduceat(g, at) == np.maximum.reduceat(g, at)
            self.levels.append((np.bitwise_or.reduceat(b, at, axis=0), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at),
                                np.maximum.reduceat(s, at), np.where(same, g[at], -1)))

    def pairs(self, percent: int, exact: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of sets, i < j, of different groups whose bound lets them link.

        With ``exact``, bitmaps whose bits are single tokens: the pairs that do link.
        """
        stack = [(len(self.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while stack:
            level, i, j = stack.pop()
            words = self.levels[0][0].shape[1]
            if len(i) > max(256, min(WORDS_AT_ONCE // words, PAIRS_AT_ONCE if level else WORDS_AT_ONCE)):
                half = len(i) // 2
                stack += [(level, i[:half], j[:half]), (level, i[half:], j[half:])]
                continue
            bits, low, high, slack, group = self.levels[level]
            keep = ~((group[i] == group[j]) & (group[i] >= 0)) if level else (i < j) & (group[i] != group[j])
            keep &= 100 * high[i] >= percent * low[j]  # sizes ascend, so i holds the smaller sets
            i, j = i[keep], j[keep]
            if exact:  # tokens beyond the bits are in no other set
                most = np.bitwise_count(bits[i] & bits[j]).sum(axis=1, dtype=np.int64)
            else:
                most = np.minimum(_bound(bits[i], bits[j], slack[i], slack[j]), np.minimum(high[i], high[j]))
            fits = most >= _need(low[i], low[j], percent)
            i, j = i[fits], j[fits]
            if not len(i):
                continue
            if level == 0:
                yield i, j
                continue
            top = len(self.levels[level - 1][0])
            step = np.arange(FANOUT)
            a = np.repeat(i[:, None] * FANOUT + step, FANOUT, axis=1).ravel()
            b = np.tile(j[:, None] * FANOUT + step, (1, FANOUT)).ravel()
            real = (a < top) & (b < top) & (a <= b)
            stack.append((level - 1, a[real], b[real]))


def _bundles(batches: Iterator[pa.RecordBatch], keys: list[str], least: int) -> Iterator[pa.Table]:
    """Whole neighbouring groups, at least ``least`` rows at a time, of rows that come sorted by ``keys``."""
    held: list[pa.Table] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        tab = pa.Table.from_batches([batch])
        new = np.zeros(len(tab), bool)
        for k in keys:
            c = tab.column(k).to_numpy()
            new[1:] |= c[1:] != c[:-1]
            new[0] |= bool(held) and held[-1].column(k)[-1].as_py() != c[0]
        begin = 0
        for cut in np.flatnonzero(new).tolist():
            if rows + cut - begin >= least:
                if cut > begin:
                    held.append(tab.slice(begin, cut - begin))
                yield pa.concat_tables(held)
                held, rows, begin = [], 0, cut
        held.append(tab.slice(begin))
        rows += len(tab) - begin
    if held:
        yield pa.concat_tables(held)


def _tree_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of classes of different components that a signature tree over each group lets through.

    ``rows``: token, cls, n, sig, comp, _n (rows of the token). A group of more than ``TILE`` rows is cut into bands of size, each
    searched with the band below it, and bands into tiles, each searched with every tile, so that no
    task holds more than two tiles at once.
    """
    n = width(rows.sparkSession)
    small = F.col("_n") <= TILE
    band = F.when(small, 0).otherwise(F.floor(F.log(F.col("n").cast("double")) / np.log(100 / percent) + 1e-9)).cast("int")
    tiles = F.when(small, 1).otherwise(F.ceil(F.col("_n") / TILE)).cast("int")
    own = F.pmod(F.xxhash64("cls"), F.col("_tiles")).cast("int")
    placed = rows.withColumn("_band", band).withColumn("_tiles", tiles).withColumn("_tile", own)
    bands = F.when(small, F.array(F.col("_band"))).otherwise(F.array(F.col("_band"), F.col("_band") + 1))
    placed = placed.withColumn("_in", F.explode(bands)).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_tiles") - 1)))
    placed = (placed.withColumn("_x", F.least("_tile", "_other")).withColumn("_y", F.greatest("_tile", "_other"))
              .select("token", "_in", "_x", "_y", "_band", "_tile", "cls", "n", "sig", "comp"))

    def counted(pairs: list[np.ndarray]) -> pa.RecordBatch:
        rows = np.concatenate(pairs)
        once, which = np.unique(rows[:, :4], axis=0, return_inverse=True)
        shared = np.bincount(which.ravel(), rows[:, 4], minlength=len(once)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (*once.T, shared)], names=["a", "b", "large", "small", "shared"])

    steps = max(1, (99 // percent).bit_length())  # of width, by which sets that link may differ

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = np.zeros((0, 5), np.int64)
        pairs, held = [nothing], 0
        for tab in _bundles(batches, ["token", "_in", "_x", "_y"], TILE):
            maps = tab.column("sig").to_pylist()
            length = np.fromiter(map(len, maps), np.int64, len(maps))
            for size in np.unique(length).tolist():
                some = np.flatnonzero((length >= size) & (length <= size << steps))
                part = tab.take(pa.array(some))
                for rows in _group_pairs(part, folded([maps[k] for k in some.tolist()], size), length[some] == size, percent):
                    pairs.append(rows)
                    held += len(rows)
            if held > PAIRS_HELD:  # a pair met under several tokens is one row
                pairs = [np.column_stack([c.to_numpy() for c in counted(pairs).columns])]
                held = len(pairs[0])
                if held > PAIRS_HELD // 2:
                    yield counted(pairs)
                    pairs, held = [nothing], 0
        yield counted(pairs)

    keys = ["token", "_in", "_x", "_y"]
    met = (placed.repartition(n, *keys).sortWithinPartitions(*keys)
           .mapInArrow(search, "a long, b long, large long, small long, shared long")
           .groupBy("a", "b", "large", "small").agg(F.sum("shared").alias("shared")))
    return met.where(_likely(F.col("shared"), F.col("large"), F.col("small"), percent)).select("a", "b")


def _group_pairs(tab: pa.Table, bits: np.ndarray, narrow: np.ndarray, percent: int) -> Iterator[np.ndarray]:
    """Rows (class, class, larger size, smaller size, 1) for pairs within groups that a tree lets through and that hold a row
    of ``narrow``."""
    size, cls, comp, lower, tile, inside, x, y = (
        tab.column(c).to_numpy().astype(np.int64) for c in ("n", "cls", "comp", "_band", "_tile", "_in", "_x", "_y"))
    key = np.stack((tab.column("token").to_numpy(), inside, x, y))
    group = np.concatenate(([0], np.cumsum((key[:, 1:] != key[:, :-1]).any(axis=0))))
    order = np.lexsort((cls, comp, size, group))
    size, cls, comp, lower, tile, bits, narrow = (c[order] for c in (size, cls, comp, lower, tile, bits, narrow))
    first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    count = np.diff(np.append(first, len(group)))

    def found() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        yield from _leaves(size, bits, comp, group, np.repeat(count <= FANOUT, count), percent)
        for at, many in zip(first[count > FANOUT].tolist(), count[count > FANOUT].tolist(), strict=True):
            part = slice(at, at + many)
            names = np.unique(comp[part], return_inverse=True)[1]
            if names.any():
                for i, j in SignatureTree(size[part], bits[part], names).pairs(percent):
                    yield i + at, j + at

    for i, j in found():
        ok = ((lower[i] == inside[i]) | (lower[j] == inside[j])) & ((x[i] == y[i]) | (tile[i] != tile[j])) & (narrow[i] | narrow[j])
        i, j = i[ok], j[ok]
        yield np.stack((np.minimum(cls[i], cls[j]), np.maximum(cls[i], cls[j]), np.maximum(size[i], size[j]),
                        np.minimum(size[i], size[j]), np.ones(len(i), np.int64)), 1)


def _prefix_size(n: Column, percent: int) -> Column:
    return n - F.ceil(n * percent / F.lit(100)) + 1


def _likely(shared: Column, large: Column, small: Column, percent: int) -> Column:
    """Whether sets of these sizes can link when their prefixes share so many tokens.

    The set whose prefix ends first has no further token in common up to there, so the overlap is at
    most the shared ones and what it holds beyond its prefix.
    """
    beyond = F.greatest(large - _prefix_size(large, percent), small - _prefix_size(small, percent))
    return (100 * small >= percent * large) & ((shared + beyond) * (100 + percent) >= percent * (large + small))


def _leaves(size: np.ndarray, bits: np.ndarray, comp: np.ndarray, group: np.ndarray, few: np.ndarray,
            percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs within groups of at most ``FANOUT`` rows, all groups at once; rows ascend by size in a group."""
    slack = size - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
    for step in range(1, FANOUT):
        i = np.flatnonzero((group[:-step] == group[step:]) & few[:-step] & (comp[:-step] != comp[step:]))
        j = i + step
        keep = 100 * size[i] >= percent * size[j]
        i, j = i[keep], j[keep]
        fits = np.minimum(_bound(bits[i], bits[j], slack[i], slack[j]), size[i]) >= _need(size[i], size[j], percent)
        yield i[fits], j[fits]


def _texts(docs: DataFrame, narrow: DataFrame, needed: DataFrame, text: str, doc_id: str) -> DataFrame:
    """``needed`` (cls and more) with the text of one document of the class.

    The ids asked for are broadcast while they are few; beyond that the join shuffles. An id may stand for
    texts of several classes; whoever reads the texts compares their class.
    """
    asked = stored(needed.join(narrow.where("cls is not null").groupBy("cls").agg(F.min("_id").alias("_doc")), "cls"))
    held = docs.select(F.col(doc_id).cast("long").alias("_of"), F.col(text).cast("string").alias("_text"))
    few = F.broadcast(asked) if asked.count() <= BROADCAST_ROWS else asked
    return held.join(few, held["_of"].eqNullSafe(asked["_doc"])).drop("_of", "_doc")


def _within(docs: DataFrame, narrow: DataFrame, hoods: DataFrame, size: int, percent: int, text: str, doc_id: str) -> DataFrame:
    """(a, b, n_links) of each neighbourhood (cls, hood, rows, n), from exact overlaps.

    Rows with b are links that join up the linked classes; rows without b count the documents of other classes
    that a document of class a links with. A neighbourhood of more than ``HOOD`` classes or ``HOOD_TOKENS`` tokens is cut into parts;
    every two parts meet in a task, and a pair counts where its own two parts meet.
    """
    parts = hoods.groupBy("hood").agg(
        F.greatest(F.ceil(F.count("*") / HOOD), F.ceil(F.sum("n") / HOOD_TOKENS)).cast("int").alias("_parts"))
    hoods = hoods.drop("n")
    dealt = (_texts(docs, narrow, hoods.join(parts, "hood"), text, doc_id)
             .withColumn("_part", F.pmod(F.xxhash64("cls"), F.col("_parts")).cast("int"))
             .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
             .withColumn("_x", F.least("_part", "_other")).withColumn("_y", F.greatest("_part", "_other"))
             .select("hood", "_x", "_y", "cls", "_part", "rows", "_text"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tab in _bundles(batches, ["hood", "_x", "_y"], 1):
            names, sets, done = tab.column("cls").to_pylist(), [], set()
            parts, rows = tab.column("_part").to_pylist(), tab.column("rows").to_pylist()
            for row, tokens in token_sets(tab.column("_text").combine_chunks(), size):
                if class_of(tokens) == names[row] and names[row] not in done:
                    done.add(names[row])
                    sets.append((len(tokens), names[row], tokens, parts[row], rows[row]))
            sets.sort(key=lambda s: s[:2])
            if len(sets) < 2:
                continue
            sizes = np.array([s[0] for s in sets])
            cls = np.array([s[1] for s in sets], np.int64)
            part, many = np.array([s[3] for s in sets]), np.array([s[4] for s in sets], np.int64)
            one = tab.column("_x")[0] == tab.column("_y")[0]
            linked = np.zeros(len(sets), np.int64)
            root = np.arange(len(sets))
            for i, j in SignatureTree(sizes, _exact_bitmaps([s[2] for s in sets]), root).pairs(percent, exact=True):
                root = _joined(root, i, j)
                here = np.full(len(i), True) if one else part[i] != part[j]
                np.add.at(linked, i[here], many[j[here]])
                np.add.at(linked, j[here], many[i[here]])
            own, some = root != np.arange(len(sets)), linked > 0
            yield pa.RecordBatch.from_arrays(
                [pa.array([*cls[root[own]].tolist(), *cls[some].tolist()], pa.int64()), pa.array([*cls[own].tolist(), *[None] * some.sum()], pa.int64()),
                 pa.array([*[0] * own.sum(), *linked[some].tolist()], pa.int64())], names=["a", "b", "n_links"])

    keys = ["hood", "_x", "_y"]
    return (dealt.repartition(width(docs.sparkSession), *keys).sortWithinPartitions(*keys)
            .mapInArrow(search, "a long, b long, n_links long"))


def _exact_bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    """A bit for each token that at least two of the sets hold."""
    tokens, which, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    place = np.cumsum(shared) - 1
    words = max(1, -(-int(shared.sum()) // 64))
    bits = np.zeros((len(sets), words), _U)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    keep = shared[which]
    row, at = row[keep], place[which[keep]]
    np.bitwise_or.at(bits, (row, at >> 6), _U(1) << (at & 63).astype(_U))
    return bits


def _joined(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Roots of all sets after the links (i, j): the smallest index of each component."""
    while True:
        a, b = root[i], root[j]
        apart = a != b
        if not apart.any():
            return root
        np.minimum.at(root, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while (root != root[root]).any():
            root = root[root]


def _verified(docs: DataFrame, narrow: DataFrame, pairs: DataFrame, size: int, percent: int, text: str, doc_id: str) -> DataFrame:
    """The pairs (a, b) of classes whose sets link, compared token by token."""
    pairs = stored(pairs)
    needed = pairs.select("a").union(pairs.select("b")).distinct().withColumnRenamed("a", "cls")
    texts = stored(_texts(docs, narrow, needed, text, doc_id))
    salts = pairs.groupBy("a").agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("_salts"))
    dealt = pairs.join(salts, "a").withColumn("_salt", F.pmod(F.xxhash64("b"), F.col("_salts")).cast("int")).drop("_salts")
    member = dealt.join(texts.withColumnRenamed("cls", "b"), "b").select("a", "_salt", "b", "_text", F.lit(True).alias("_member"))
    leader = (dealt.select("a", "_salt").distinct().join(texts.withColumnRenamed("cls", "a"), "a")
              .select("a", "_salt", F.col("a").alias("b"), "_text", F.lit(False).alias("_member")))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, tokens = None, None
        for batch in batches:
            a, b, member_ = batch.column("a").to_pylist(), batch.column("b").to_pylist(), batch.column("_member").to_pylist()
            out_a, out_b = [], []
            for row, mine in token_sets(batch.column("_text"), size):
                if class_of(mine) != b[row]:
                    continue
                if not member_[row]:
                    at, tokens = a[row], mine
                elif at == a[row]:
                    both = len(np.intersect1d(tokens, mine, assume_unique=True))
                    if 100 * both >= percent * (len(tokens) + len(mine) - both):
                        out_a.append(a[row])
                        out_b.append(b[row])
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])

    n = width(docs.sparkSession)
    return stored(leader.union(member).repartition(n, "a", "_salt").sortWithinPartitions("a", "_salt", "_member")
                  .mapInArrow(compare, "a long, b long"))


def groups(docs: DataFrame, size: int = 5, percent: int = 80, share: float = SHARE, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(_id, text_hash, n_shingles, component_id, n_links, group) of every row of ``docs``.

    A set holds the distinct ``size``-word shingles of the whole text, its A-Z in lower case; a text of
    fewer words is one shingle. Two documents link when 100 * overlap >= ``percent`` * union. The component
    is the smallest document id reachable by links; ``n_links`` counts the other rows that a row links with. Null and empty texts and those without words have
    empty sets and link with nothing. Rows that share an id are judged row by row, each by its own text:
    ``text_hash`` (xxhash64) tells them apart, and ``group`` names components that share their smallest id. A
    null id links like any other but names no component: one of such rows alone has a null id.
    """
    narrow, frequent = _describe(docs, size, text, doc_id, share)
    classes = stored(narrow.where("cls is not null").groupBy("cls").agg(F.count("*").alias("rows"), F.max("n").alias("n"), F.max("sig").alias("sig")))
    met = stored(_meetings(docs, size, percent, text, frequent))
    stars = stored(_stars(met, classes))
    ties = _ties(met, components(stars), percent)
    hoods = stored(components(stars.union(ties)).select(F.col("id").alias("cls"), F.col("component").alias("hood")))
    links = stored(_within(docs, narrow, hoods.join(classes.drop("sig"), "cls"), size, percent, text, doc_id))
    known = stored(met.select("token", "cls", "n").join(hoods, "cls", "left")
                   .withColumn("comp", F.coalesce("hood", "cls")).drop("hood"))
    mixed = known.groupBy("token").agg(F.min("comp").alias("_a"), F.max("comp").alias("_b"), F.count("*").alias("_n"))
    open_ = known.join(mixed.where("_a <> _b").select("token", "_n"), "token")
    more = _verified(docs, narrow, _tree_pairs(open_.join(classes.select("cls", "sig"), "cls"), percent), size, percent, text, doc_id)
    more = more.distinct()  # rows that share id and text are compared more than once
    final = components(links.where("b is not null").select("a", "b").union(more))
    sides = more.select("a", F.col("b").alias("cls")).union(more.select("b", F.col("a").alias("cls")))
    counts = (links.where("b is null").select("a", "n_links").union(sides.join(classes.select("cls", "rows"), "cls").select("a", "rows"))
              .groupBy("a").agg(F.sum("n_links").alias("n_links")))
    classes = classes.select("cls", "rows")
    counts = classes.join(counts, classes["cls"] == counts["a"], "left").select(
        F.col("cls").alias("_l"), (F.col("rows") - 1 + F.coalesce("n_links", F.lit(0))).alias("n_links"))
    first = narrow.where("cls is not null").groupBy("cls").agg(F.min("_id").alias("_first"))
    held = first.join(final.withColumnRenamed("id", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    top = held.groupBy("component").agg(F.min("_first").alias("_top"))
    named = held.join(top, "component").join(counts, F.col("cls") == F.col("_l")).select(F.col("cls").alias("_c"), "_top", "n_links", F.col("component").alias("group"))
    return narrow.join(named, narrow["cls"] == named["_c"], "left").select(
        "_id", "text_hash", F.col("n").alias("n_shingles"), F.when(F.col("cls").isNull(), F.col("_id")).otherwise(F.col("_top")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "group")


@query("op10_signature_join")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = groups(table(spark, sf_dir, "documents"), size=4, percent=85)
    return out.select(F.col("_id").alias("doc_id"), "n_shingles", "component_id", "n_links")
