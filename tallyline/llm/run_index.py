"""Run-length index of a small collection of repetitive byte strings.

The collection is sorted by suffix (prefix doubling, every string with a terminator of its own, the
terminators ordered as the strings). Its Burrows-Wheeler transform is kept as runs, with the text
position at each run head and the position one row above it. These samples are all that
:meth:`RunIndex.statistics` needs: the match of a suffix with its neighbour above is compared byte by
byte only at run heads; between two samples in text order the match moves along with the text and
loses one byte a step, so the statistics of the whole collection are streamed in text order.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
SYMBOLS = 7


class RunIndex:
    def __init__(self, data: np.ndarray, ends: np.ndarray) -> None:
        """``data``: the strings end to end; ``ends``: n + 1 offsets into it."""
        sizes = np.diff(ends)
        self.strings = len(sizes)
        self.starts = ends[:-1] + np.arange(self.strings)
        n = len(data) + self.strings
        self.text = np.zeros(n, np.int16)  # 0 is a terminator
        body = np.ones(n, bool)
        body[self.starts + sizes] = False
        self.text[body] = data.astype(np.int16) + 1
        self.string = np.repeat(np.arange(self.strings), sizes + 1)
        self.left = (self.starts + sizes)[self.string] - np.arange(n)  # bytes before the terminator
        self._sort(int(sizes.max()) + 1 if self.strings else 0)
        self._compress()

    def _sort(self, longest: int) -> None:
        n = len(self.text)
        key = np.zeros(n, _U)
        for k in range(SYMBOLS):
            step = np.zeros(n, _U)
            step[:n - k] = self.text[k:]
            step[self.left < k] = 0
            key = (key << _U(9)) | step
        self.words = key
        order = np.argsort(key)
        fresh = np.ones(n + 1, bool)
        sorted_key = key[order]
        fresh[1:n] = sorted_key[1:] != sorted_key[:-1]
        rank = np.empty(n, np.int64)  # row of the first suffix that is equal so far
        rank[order] = np.maximum.accumulate(np.where(fresh[:n], np.arange(n), 0))
        depth = SYMBOLS
        while True:
            rows = np.flatnonzero(~(fresh[:n] & fresh[1:]))  # rows not told apart yet
            if not len(rows):
                break
            at = order[rows]
            if depth >= longest:  # equal up to their terminators, which stand in the order of the strings
                follow = at
            else:
                follow = rank[np.minimum(at + depth, n - 1)] + 1
                follow[self.left[at] < depth] = 0
            pair = (rank[at].astype(_U) << _U(32)) | follow.astype(_U)
            by = np.argsort(pair)
            at, pair = at[by], pair[by]
            order[rows] = at
            if depth >= longest:
                break
            new = np.ones(len(rows), bool)
            new[1:] = pair[1:] != pair[:-1]
            fresh[rows] = new
            rank[at] = np.maximum.accumulate(np.where(new, rows, 0))
            depth *= 2
        self.suffixes = order

    def _compress(self) -> None:
        sa = self.suffixes
        before = np.where(sa > 0, self.text[np.maximum(sa, 1) - 1], 0)
        head = np.ones(len(sa), bool)
        head[1:] = (before[1:] != before[:-1]) | (before[1:] == 0)  # terminators all differ
        self.run_rows = np.flatnonzero(head)
        self.run_bytes = before[self.run_rows]
        self.run_heads = sa[self.run_rows]
        self.run_above = np.where(self.run_rows > 0, sa[np.maximum(self.run_rows, 1) - 1], -1)

    def _common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of the common prefix of suffixes x and y, up to their terminators."""
        most = np.minimum(self.left[x], self.left[y])
        length = np.zeros(len(x), np.int64)
        live = np.flatnonzero(most > 0)
        top = len(self.text) - 1
        while len(live):
            at = length[live]
            differ = self.words[np.minimum(x[live] + at, top)] ^ self.words[np.minimum(y[live] + at, top)]
            got = np.zeros(len(live), np.int64)
            for k in range(SYMBOLS):
                got += differ < _U(1 << (9 * k))  # symbols from the front that agree
            length[live] = np.minimum(at + got, most[live])
            live = live[(got == SYMBOLS) & (length[live] < most[live])]
        return length

    def statistics(self) -> tuple[np.ndarray, np.ndarray]:
        """For every text position: its match length with the suffix one row above, and where that one starts."""
        n = len(self.text)
        match = np.zeros(len(self.run_heads), np.int64)
        has = self.run_above >= 0
        match[has] = self._common(self.run_heads[has], self.run_above[has])
        sample = np.zeros(n, bool)
        sample[self.run_heads] = True
        matches, places = np.zeros(n, np.int64), np.zeros(n, np.int64)
        matches[self.run_heads], places[self.run_heads] = match, self.run_above
        last = np.maximum.accumulate(np.where(sample, np.arange(n), 0))  # position 0 heads a run
        moved = np.arange(n) - last
        above = places[last]
        return np.maximum(matches[last] - moved, 0), np.where(above >= 0, above + moved, -1)

    def repeated(self, least: int, place: np.ndarray) -> np.ndarray:
        """Text positions whose next ``least`` bytes also start at a smaller ``place``.

        Rows between two matches shorter than ``least`` share their first ``least`` bytes; the
        smallest place among them is the first occurrence, the others repeat it.
        """
        if not len(self.text):
            return np.zeros(0, np.int64)
        match, _ = self.statistics()
        joined = match[self.suffixes] >= least
        tops = np.flatnonzero(~joined)
        where = place[self.suffixes]
        first = np.repeat(np.minimum.reduceat(where, tops), np.diff(np.append(tops, len(where))))
        return np.sort(self.suffixes[(where > first) & (self.left[self.suffixes] >= least)])
