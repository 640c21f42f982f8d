"""Byte-level BPE ids of whole columns of texts, with the ``tokenizers`` library.

A text is cut into the pieces that the vocabulary's own pattern cuts (words with the space before
them, numbers, other marks, contractions, white space); no merge crosses a cut. The cuts of a whole
chunk are found at once on its code points. Each distinct piece is encoded by the library once and its
ids are copied to wherever it stands, so the result is that of encoding the texts one by one. Texts
that hold a special token are handed to the library as they are.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable
from itertools import repeat

import numpy as np
import pyarrow as pa

from tallyline.llm import kernels as K
from tallyline.llm.scratch import per_process

CHUNK = 1 << 20
MOST_PIECES = 400_000
LETTER, NUMBER, OTHER, SPACE = 1, 2, 3, 4
#: Code points of white space, and the endings cut off after an apostrophe.
WHITE = (0x20, 0x85, 0xA0, 0x1680, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, *range(0x09, 0x0E), *range(0x2000, 0x200B))
ONE_LETTER = "stmd"
TWO_LETTERS = ("re", "ve", "ll")


def classes() -> np.ndarray:
    """Class of every code point."""
    kinds = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    for i in range(sys.maxunicode + 1):
        first = unicodedata.category(chr(i))[0]
        if first == "L":
            kinds[i] = LETTER
        elif first == "N":
            kinds[i] = NUMBER
    kinds[list(WHITE)] = SPACE
    return kinds


def cuts(points: np.ndarray, ends: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Start of every piece of texts laid end to end as code points; ``ends``: n + 1 offsets."""
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = kinds[points]
    edge = np.zeros(n + 1, bool)
    edge[ends] = True
    start = edge[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    space = kind == SPACE
    blank = points == 0x20
    joins = np.zeros(n, bool)  # a mark right after a blank of its text belongs to the blank
    joins[1:] = ~space[1:] & blank[:-1] & ~edge[1:n]
    last = np.zeros(n, bool)  # white space right before a mark of its text
    last[:-1] = space[:-1] & ~space[1:] & ~edge[1:n]
    start = (start & ~joins) | last
    quote = np.flatnonzero((points[:-1] == 0x27) & start[:-1] & ~edge[1:n]) if n > 1 else np.zeros(0, np.int64)
    quote = quote[kind[quote + 1] == LETTER]
    if len(quote):
        after = points[quote + 1]
        one = np.isin(after, [ord(c) for c in ONE_LETTER])
        second = np.where((quote + 2 < n) & ~edge[np.minimum(quote + 2, n)], points[np.minimum(quote + 2, n - 1)], 0)
        two = np.zeros(len(quote), bool)
        for pair in TWO_LETTERS:
            two |= (after == ord(pair[0])) & (second == ord(pair[1]))
        start[quote[one | two] + 1] = False
        rest = np.concatenate((quote[one] + 2, quote[two] + 3))
        rest = rest[rest < n]
        start[rest[kind[rest] == LETTER]] = True
    return np.flatnonzero(start)


def nothing() -> dict[str, np.ndarray]:
    """Ids of all pieces end to end, where each piece's begin and how many it has, before any is known."""
    return {"ids": np.zeros(0, np.uint32), "origins": np.zeros(0, np.int64), "sizes": np.zeros(0, np.int64)}


def encoder(path: str, kinds: np.ndarray) -> Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]:
    """A function from a column of texts to all ids end to end and the number of ids of each text; null is empty."""
    shared = per_process("byte_bpe")
    if shared.get("path") != path:
        from tokenizers import Tokenizer

        shared.update(path=path, tokenizer=Tokenizer.from_file(path), known={}, **nothing())
    tokenizer = shared["tokenizer"]
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]

    def learn(names: list[int], words: list[str]) -> None:
        """Encode distinct pieces in one call; their ids go behind those known so far."""
        known = shared["known"]
        got = tokenizer.encode(words, is_pretokenized=True, add_special_tokens=False)
        sizes = np.bincount(np.asarray(got.word_ids, np.int64), minlength=len(words))
        shared["origins"] = np.concatenate((shared["origins"], len(shared["ids"]) + np.cumsum(sizes) - sizes))
        shared["sizes"] = np.concatenate((shared["sizes"], sizes))
        shared["ids"] = np.concatenate((shared["ids"], np.asarray(got.ids, np.uint32)))
        known.update(zip(names, range(len(known), len(known) + len(names)), strict=True))

    def encode(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, ends = K.bytes_of(column)
        flat, counts = [], np.zeros(len(ends) - 1, np.int64)
        for i, j, part, stops in K.chunks(data, ends, CHUNK):
            blob = part.tobytes()
            if any(s.encode() in blob for s in special):
                for k in range(i, j):
                    ids = tokenizer.encode(blob[stops[k - i]:stops[k - i + 1]].decode(), add_special_tokens=False).ids
                    flat.append(np.asarray(ids, np.uint32))
                    counts[k] = len(ids)
                continue
            text = blob.decode()
            if not text:
                continue
            points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
            lead = np.concatenate(([0], np.cumsum((part & 0xC0) != 0x80)))
            at = lead[stops]
            start = cuts(points, at, kinds)
            stop = np.append(start[1:], len(points))
            names, first, which = np.unique(K.span_hashes(points, start, stop), return_index=True, return_inverse=True)
            keys = names.tolist()
            place = np.fromiter(map(shared["known"].get, keys, repeat(-1)), np.int64, len(keys))
            fresh = np.flatnonzero(place < 0).tolist()
            if len(shared["known"]) + len(fresh) > MOST_PIECES:
                shared["known"].clear()
                shared.update(nothing())
                fresh = list(range(len(keys)))
            if fresh:
                place[fresh] = np.arange(len(fresh)) + len(shared["known"])
                learn([keys[k] for k in fresh], [text[start[first[k]]:stop[first[k]]] for k in fresh])
            values = shared["ids"]
            origin = shared["origins"][place][which]
            size = shared["sizes"][place][which]
            total = np.concatenate(([0], np.cumsum(size)))
            flat.append(values[np.repeat(origin - total[:-1], size) + np.arange(total[-1])])
            counts[i:j] = np.diff(total[np.searchsorted(start, at)])
        return (np.concatenate(flat) if flat else np.zeros(0, np.uint32)), counts

    return encode
