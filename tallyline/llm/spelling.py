"""Spelling variants: words one edit apart, found through pivotal bigrams.

1. Texts are cut into runs of letters and counted; a task counts its words before they are shuffled.
2. Bigrams are ordered by the number of their places in all words, rarest first. The prefix of a word holds its three
   rarest bigrams with their positions, and every other place of the last of them. Of the prefix a dynamic programme
   picks two bigrams that do not overlap and stand in the fewest places: the pivots.
3. One edit can't touch both pivots of a word. Say two words are one edit apart and the prefix of the first ends no later in
   the order than that of the second. A pivot of the first that the edit leaves alone stands in the prefix of the second,
   moved by one place at most: in the same place, with equal letters before it, if the edit comes after it; in the
   same place from the end, with equal letters behind it, if the edit comes before. So pivots are entered under their
   bigram, position and the letters on one side, once for each side, and meet the prefixes of other words there. Of the
   four entries of a word the one before the edit or the one behind it suffices: the left pivot serves edits
   to its right and the right pivot edits to its left.
4. Words that meet, are of fitting lengths and end their prefixes in the right order are compared letter by letter.
5. A word's form is its commonest near word, if that is twice as common; roots follow forms by doubling.

All letters are of Latin-1, so a word is a string of bytes. Entries that many words share are cut into parts that meet pair by
pair, so no task holds them all and no pair is lost.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import kernels as K
from tallyline.llm.registry import query, table
from tallyline.llm.scratch import stored, width

LEAST_LENGTH = 5
LEAST_COUNT = 3
SLIPS = 97
PREFIX = 3
PART = 4_096
CELLS = 1 << 22
_U = np.uint64

# ---- counting words --------------------------------------------------------------------------

_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = True
_LETTER[0x61:0x7B] = True
_LEAD = 0xC3  # in UTF-8 the letters from U+00C0 to U+00FF are this byte and one more


class _Shift:
    """Tables that carry a crc32 over n more zero bytes, so that the crc of two joined strings comes from their own."""

    tables: list[np.ndarray] = []

    @classmethod
    def over(cls, crc: np.ndarray, n: np.ndarray) -> np.ndarray:
        step = np.array([zlib.crc32(bytes([k])) ^ zlib.crc32(b"\0") for k in range(256)], np.uint32)
        while len(cls.tables) <= int(n.max(initial=0)):
            if not cls.tables:
                cls.tables.append(np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None])
            else:
                last = cls.tables[-1]
                cls.tables.append(step[last & 0xFF] ^ (last >> np.uint32(8)))
        out = np.zeros(len(crc), np.uint32)
        for size in np.unique(n).tolist():
            mine = n == size
            rest = crc[mine]
            t = cls.tables[size]
            out[mine] = t[0][rest & 0xFF] ^ t[1][rest >> 8 & 0xFF] ^ t[2][rest >> 16 & 0xFF] ^ t[3][rest >> 24]
        return out


MOST_SHIFT = 256


def joined_crc(first: np.ndarray, second: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """crc32 of strings joined of two, from the crc32 of both and the bytes of the second."""
    return _Shift.over(first, sizes) ^ second


def runs(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end in bytes of every maximal run of letters; no run crosses texts."""
    inside = _LETTER[data]
    lead = data == _LEAD
    inside |= lead
    inside[1:] |= lead[:-1]
    if not inside.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.zeros(len(data) + 1, bool)
    cut[ends] = True
    starts = np.flatnonzero(inside & (~np.concatenate(([False], inside[:-1])) | cut[:-1]))
    stops = np.flatnonzero(inside & (~np.concatenate((inside[1:], [False])) | cut[1:])) + 1
    return starts, stops


def _spans(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> list[bytes]:
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]


def _counted(data: np.ndarray, ends: np.ndarray, ids: Sequence[str], slips: int) -> dict[bytes, int]:
    """Words (UTF-8) of a few texts with the number of their places, slips applied."""
    data = K.lower_ascii(data)
    starts, stops = runs(data, ends)
    if not len(starts):
        return {}
    row = np.searchsorted(ends, starts, "right") - 1
    hashes = K.span_hashes(data, starts, stops)
    _, at, which = np.unique(hashes, return_index=True, return_inverse=True)
    words = _spans(data, starts[at], stops[at])
    total = np.bincount(which, minlength=len(words))
    pairs, times = np.unique(row.astype(np.int64) * len(words) + which, return_counts=True)
    row, which = pairs // len(words), pairs % len(words)
    heads = [f"{i}:".encode() for i in ids]
    head_crc = np.array([zlib.crc32(h) for h in heads], np.uint32)
    word_crc = np.array([zlib.crc32(w) for w in words], np.uint32)
    sizes = np.array([len(w) for w in words])
    crc = np.zeros(len(pairs), np.uint32)
    short = sizes[which] <= MOST_SHIFT
    crc[short] = joined_crc(head_crc[row[short]], word_crc[which[short]], sizes[which[short]])
    for k in np.flatnonzero(~short).tolist():
        crc[k] = zlib.crc32(words[which[k]], int(head_crc[row[k]]))
    out = dict(zip(words, total.tolist(), strict=True))
    for k in np.flatnonzero(crc % np.uint32(slips) == 0).tolist():
        word, n = words[which[k]], int(times[k])
        letters = word.decode()
        drop = int(crc[k]) % len(letters)
        changed = (letters[:drop] + letters[drop + 1:]).encode()
        out[word] -= n
        out[changed] = out.get(changed, 0) + n
    return out


def vocabulary(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least_length: int = LEAST_LENGTH,
               least_count: int = LEAST_COUNT, slips: int = SLIPS) -> DataFrame:
    """(word, n): words of at least ``least_length`` letters that stand in at least ``least_count`` places.

    A null text has no words; a null id counts as an empty one; repeated rows count as often as they stand there.
    """
    rows = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("_id"), F.col(text).cast("string").alias("_text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("_id").to_pylist()
            data, ends = K.bytes_of(batch.column("_text"))
            for i, j, part, stops in K.chunks(data, ends, 4 * K.CHUNK):
                found = _counted(part, stops, ids[i:j], slips)
                kept = [(w.decode(), n) for w, n in found.items() if n and len(w) >= least_length]
                yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], names=["word", "n"])

    words = rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return words.where((F.length("word") >= least_length) & (F.col("n") >= least_count))


# ---- pivots ----------------------------------------------------------------------------------


def _matrix(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of words end to end and n + 1 offsets."""
    ends = np.zeros(len(words) + 1, np.int64)
    np.cumsum([len(w) for w in words], out=ends[1:])
    return np.frombuffer(b"".join(words), np.uint8), ends


def bigram_order(words: DataFrame) -> np.ndarray:
    """Rank of each of the 65,536 pairs of bytes: rarest first by places in all words, ties by the pair.

    At most 8,100 pairs of letters exist, so what is collected is bounded.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            letters, ends = _matrix(batch.column("w").to_pylist())
            pair = letters[:-1].astype(np.int64) << 8 | letters[1:]
            total += np.bincount(np.delete(pair, ends[1:-1] - 1), minlength=1 << 16)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], names=["g", "n"])

    places = np.zeros(1 << 16, np.int64)
    for r in words.select("w").mapInArrow(count, "g int, n long").groupBy("g").agg(F.sum("n").alias("n")).collect():
        places[r["g"]] = r["n"]
    return places


def pivots(positions: Sequence[int], weights: Sequence[int]) -> tuple[int, int]:
    """Two of the bigrams at ``positions`` (rising) that do not overlap and have the least weight together.

    A dynamic programme over the positions: the cheapest single bigram that ends before each position, extended by
    the bigram there. Ties go to the first choice found from the left.
    """
    best, one, k = None, None, 0
    for at, weight in zip(positions, weights, strict=True):
        while k < len(positions) and positions[k] + 2 <= at:
            if one is None or weights[k] < one[0]:
                one = (weights[k], positions[k])
            k += 1
        if one is not None and (best is None or one[0] + weight < best[0]):
            best = (one[0] + weight, one[1], at)
    return best[1], best[2]


def grams(word: bytes, places: Sequence[int], rank: Sequence[int]) -> tuple[int, list[tuple[int, int]], tuple[int, int]]:
    """(rank of the last bigram of the prefix, (position, bigram) of the prefix, positions of both pivots)."""
    pairs = [word[i] << 8 | word[i + 1] for i in range(len(word) - 1)]
    order = sorted(rank[g] for g in pairs)
    last = order[PREFIX - 1]
    prefix = [(i, g) for i, g in enumerate(pairs) if rank[g] <= last]
    return last, prefix, pivots([i for i, _ in prefix], [places[g] for _, g in prefix])


# ---- meeting and comparing -------------------------------------------------------------------

ENTRY = "key long, w binary, last int, pivot boolean"


def _entries(words: DataFrame, places: np.ndarray) -> DataFrame:
    """Two entries for each bigram of a prefix: with the letters before it, and with those behind it.

    ``pivot`` marks the entry of a left pivot with what stands before it, and of a right pivot with what stands behind it.
    """
    rank = np.empty(1 << 16, np.int64)
    rank[np.lexsort((np.arange(1 << 16), places))] = np.arange(1 << 16)
    places_, rank_ = places.tolist(), rank.tolist()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, owner, lasts, firsts = [], [], [], []
            words_ = batch.column("w").to_pylist()
            for k, w in enumerate(words_):
                last, prefix, (left, right) = grams(w, places_, rank_)
                for at, _ in prefix:
                    keys += [b"L" + w[:at + 2], b"R" + w[at:]]
                    owner += [k, k]
                    lasts += [last, last]
                    firsts += [at == left, at == right]
            letters, ends = _matrix(keys)
            hashes = K.span_hashes(letters, ends[:-1], ends[1:]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes), pa.array(words_, pa.binary()).take(pa.array(owner, pa.int64())), pa.array(lasts, pa.int32()), pa.array(firsts)],
                names=["key", "w", "last", "pivot"])

    return words.select("w").mapInArrow(work, ENTRY)


def near_blocks(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Which rows of ``short`` and ``long``, matrices of letters, are one edit apart; their widths differ by one at most."""
    n = short.shape[1]
    if n == long.shape[1]:
        return (short[:, None, :] != long[None, :, :]).sum(2, dtype=np.uint16 if n > 255 else np.uint8) == 1
    head = short[:, None, :] == long[None, :, :n]
    tail = short[:, None, :] == long[None, :, 1:]
    # letters up to the first difference, and behind the last one, cover the shorter word
    before = np.where(head.all(2), n, head.argmin(2))
    behind = np.where(tail.all(2), n, tail[:, :, ::-1].argmin(2))
    return before + behind >= n


def _group_pairs(words: list[bytes], last: np.ndarray, pivot: np.ndarray, half: np.ndarray | None) -> Iterator[tuple[int, int]]:
    """Indices of near words of one entry; of each pair one word has a pivot there and the other's prefix ends no earlier.

    With ``half`` only pairs of different halves are taken.
    """
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    by_size = {}
    for size in np.unique(sizes).tolist():
        of = np.flatnonzero(sizes == size)
        by_size[size] = (of, np.frombuffer(b"".join(words[i] for i in of.tolist()), np.uint8).reshape(len(of), size))
    for size, (of, letters) in by_size.items():
        for other in (size, size + 1):
            if other not in by_size:
                continue
            of_b, letters_b = by_size[other]
            step = max(1, CELLS // max(1, len(of_b) * size))
            wide = max(1, CELLS // size)
            for a in range(0, len(of), step):
                for b in range(0, len(of_b), wide):
                    i, j = of[a:a + step], of_b[b:b + wide]
                    if not (pivot[i].any() or pivot[j].any()):
                        continue
                    hit = near_blocks(letters[a:a + step], letters_b[b:b + wide])
                    x, y = np.nonzero(hit)
                    x, y = i[x], j[y]
                    fits = (pivot[x] & (last[x] <= last[y])) | (pivot[y] & (last[y] <= last[x]))
                    if other == size:
                        fits &= x < y
                    if half is not None:
                        fits &= half[x] != half[y]
                    yield from zip(x[fits].tolist(), y[fits].tolist(), strict=True)


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b): every pair of different words (``w`` binary, one byte a letter) that are one edit apart, once."""
    entries = stored(_entries(words, bigram_order(words)))
    # of one entry all pairs are weighed, so large entries are cut into parts that meet pair by pair
    size = entries.groupBy("key").agg(F.count("*").alias("size"), F.max("pivot").alias("any"))
    size = size.where("size > 1 and any").select("key", F.ceil(F.col("size") / PART).cast("int").alias("parts"))
    met = entries.join(size, "key")
    part = F.pmod(F.xxhash64("w"), F.col("parts")).cast("int")
    met = met.withColumn("part", F.when(F.col("parts") > 1, part).otherwise(0))
    meets = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda k: F.struct(
        F.least(k, F.col("part")).alias("x"), F.greatest(k, F.col("part")).alias("y")))
    met = met.withColumn("tile", F.explode(meets)).select("key", "tile.x", "tile.y", "part", "w", "last", "pivot")
    dealt = met.repartition(width(words.sparkSession), "key", "x", "y").sortWithinPartitions("key", "x", "y")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups in _groups(batches):
            found = set()
            for words_, last, pivot, part_, apart in groups:
                half = part_ if apart else None
                found.update((words_[i], words_[j]) if words_[i] < words_[j] else (words_[j], words_[i])
                             for i, j in _group_pairs(words_, last, pivot, half))
            if found:
                a, b = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    return dealt.mapInArrow(work, "a binary, b binary").distinct()


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The whole groups that end in each batch: (words, last, pivot, part, whether two parts meet)."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        both = pa.Table.from_batches(held).combine_chunks()
        key, x, y = (both.column(c).to_numpy() for c in ("key", "x", "y"))
        edge = np.flatnonzero((key[1:] != key[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])) + 1
        if len(edge):
            yield _cut(both.slice(0, int(edge[-1])), edge)
            both = both.slice(int(edge[-1]))
        held = both.to_batches()
    if held and sum(b.num_rows for b in held):
        both = pa.Table.from_batches(held).combine_chunks()
        yield _cut(both, np.array([both.num_rows]))


def _cut(some: pa.Table, edge: np.ndarray) -> list[tuple]:
    words, last, pivot = some.column("w").to_pylist(), some.column("last").to_numpy(), some.column("pivot").to_numpy(zero_copy_only=False)
    part, x, y = (some.column(c).to_numpy() for c in ("part", "x", "y"))
    starts = [0, *edge[:-1].tolist()]
    return [(words[a:b], last[a:b], pivot[a:b], part[a:b], x[a] != y[a]) for a, b in zip(starts, edge.tolist(), strict=True) if b - a > 1]


# ---- forms -----------------------------------------------------------------------------------


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word of ``forms`` (word, form): the end of its chain of forms, by doubling.

    Counts at least double along a chain, so it has no cycle and few links.
    """
    known = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = known.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        new = known.join(ahead, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved"))
        new = stored(new)
        moved = new.where("_moved").limit(1).count()
        known = new.select("word", "root")
        if not moved:
            return known


def variants(words: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every row of ``words`` (word string of Latin-1 letters, n long).

    Words are distinct and have at least five letters. The form is the commonest near word, of equally common ones the
    first in code-point order, where it is at least twice as common as the word. No words give no rows.
    """
    words = stored(words.select("word", "n"))
    pairs = stored(near_pairs(words.select(F.encode("word", "ISO-8859-1").alias("w"))))
    a, b = (F.decode(c, "ISO-8859-1") for c in "ab")
    both = pairs.select(F.explode(F.array(F.struct(a.alias("word"), b.alias("other")), F.struct(b.alias("word"), a.alias("other")))).alias("e")).select("e.*")
    counted = both.join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
    best = counted.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other"))).alias("best"))
    strong = -F.col("best.less") >= 2 * F.col("n")
    judged = stored(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(strong, F.col("best.other")).alias("form"), F.when(strong, -F.col("best.less")).alias("form_n")))
    ends = roots(judged.where("form is not null"))
    return judged.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


@query("op11_spelling")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(vocabulary(table(spark, sf_dir, "documents")))
