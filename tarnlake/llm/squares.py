"""Periodic runs of words, found online by catchers over completed power-of-two blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tarnlake.llm.scratch import importable
from tarnlake.llm.words import encoded_words, mix, text_runs, word_spans

#: Words that are appended at once; longer streams are appended in parts.
PART = 1 << 18
_ROLL = np.uint64(0xD6E8FEB86659FD93)
RUN = StructType([StructField(x, LongType()) for x in ("start", "length", "period")])


class SquareCatcher:
    """Runs of exponent ``power`` or more in a stream of numbers, told as words are appended.

    When a block ``[u, u + L)`` of a power of two L, u a multiple of L, is complete, it becomes a catcher for the
    periods d from 2 L - 1 to 4 L - 2: the first d words of a run of such a period hold at least one whole block
    of that size, so each run meets a catcher. A later window of L words equal to the block at distance d arms the
    catcher; it waits until as many words are there as ``power`` periods need, then compares its copies and the
    square of 2 d words at u. Squares of one period that overlap by a period belong to one run; its ends are found
    by comparing words d apart, to the right again as more words come. Squares within a run of a smaller period
    tell nothing new. A window meets at most three catchers of a size, so n words cost n log n. Hashes of
    windows only choose what is compared; ends are exact.
    """

    def __init__(self, power: int = 3) -> None:
        self.power, self.n = power, 0
        self.words = np.zeros(0, dtype=np.int64)
        self.hashes: list[np.ndarray] = []  # by size: of all complete windows of 1, 2, 4, ... words
        self.armed: list[np.ndarray] = []  # by size: (u, d) that wait for words
        self.start = self.end = self.period = np.zeros(0, dtype=np.int64)  # runs so far, by start

    def append(self, words: np.ndarray) -> None:
        """Take more words (int64; equal numbers are equal words)."""
        for i in range(0, len(words), PART):
            self._append(words[i : i + PART])

    def _append(self, words: np.ndarray) -> None:
        if not len(words):
            return
        old, self.n = self.n, self.n + len(words)
        self.words = np.concatenate([self.words, words])
        self._grow_runs(old)
        level = 0
        while (size := 1 << level) <= self.n:
            if level == len(self.hashes):
                self.hashes.append(np.zeros(0, dtype=np.uint64))
                self.armed.append(np.zeros((2, 0), dtype=np.int64))
            self._hash(level, size)
            level += 1
        for level in range(len(self.hashes)):
            self._test(level, 1 << level, np.concatenate([self.armed[level], self._arm(level, 1 << level, old)], axis=1))

    def _hash(self, level: int, size: int) -> None:
        """Hashes of the windows that the new words complete, from those of half the size."""
        done, total = len(self.hashes[level]), self.n - size + 1
        if level == 0:
            new = mix(self.words[done:total].astype(np.uint64) + _ROLL)
        else:
            half = self.hashes[level - 1]
            new = half[done:total] * _ROLL + half[done + size // 2 : total + size // 2]
            new ^= new >> np.uint64(32)
        self.hashes[level] = np.concatenate([self.hashes[level], new])

    def _arm(self, level: int, size: int, old: int) -> np.ndarray:
        """(u, d) of catchers and the windows completed just now that equal them at a distance of theirs."""
        h, first, total = self.hashes[level], max(0, old - size + 1), self.n - size + 1
        near, far = 2 * size - 1, 4 * size - 2
        u = np.arange(-(-max(0, first - far) // size) * size, total - near, size)
        if not len(u):
            return np.zeros((2, 0), dtype=np.int64)
        first = max(first, int(u[0]) + near)
        if size <= 2:  # dense: every distance is compared
            pairs = [(at := u[(u + d >= first) & (u + d < total)])[h[at] == h[at + d]] for d in range(near, far + 1)]
            return np.stack([np.concatenate(pairs), np.repeat(np.arange(near, far + 1), [len(p) for p in pairs])])
        bits = np.uint64(max(1024, 1 << (8 * len(u)).bit_length()) - 1)
        seen = np.zeros(int(bits) + 1, dtype=bool)
        seen[h[u] & bits] = True
        window = first + np.flatnonzero(seen[h[first:total] & bits])
        kinds, kind = np.unique(h[u], return_inverse=True)
        place = np.minimum(np.searchsorted(kinds, h[window]), len(kinds) - 1)
        same = kinds[place] == h[window]
        window, place = window[same], place[same]
        base = self.n + 4 * size
        key = kind * base + u
        order = np.argsort(key, kind="stable")
        key, u = key[order], u[order]
        low = np.searchsorted(key, place * base + np.maximum(window - far, 0))
        high = np.searchsorted(key, place * base + np.maximum(window - near + 1, 0))
        count = high - low
        of = np.repeat(np.arange(len(window)), count)
        at = u[low[of] + np.arange(len(of)) - (np.cumsum(count) - count)[of]]
        return np.stack([at, window[of] - at])

    def _within(self, u: np.ndarray, end: np.ndarray, runs: np.ndarray) -> np.ndarray:
        """Whether [u, end) lies inside one of these runs found before."""
        if not runs.any():
            return np.zeros(len(u), dtype=bool)
        before = np.searchsorted(self.start[runs], u, side="right") - 1
        return (before >= 0) & (np.maximum.accumulate(self.end[runs])[np.maximum(before, 0)] >= end)

    def _test(self, level: int, size: int, armed: np.ndarray) -> None:
        """Compare what has all of its words; the rest stays armed."""
        ripe = armed[0] + (self.power - 1) * armed[1] + size <= self.n
        self.armed[level] = armed[:, ~ripe]
        u, d = armed[:, ripe]
        h = self.hashes[level]
        for k in range(2, self.power):
            same = h[u + k * d] == h[u]
            u, d = u[same], d[same]
        if len(u):  # two windows of twice the size, or of the size where d is less than twice, cover d words
            wide = self.hashes[min(level + 1, len(self.hashes) - 1)]
            same = np.where(d < 2 * size, h[u + d - size] == h[u + 2 * d - size], False)
            a, p = u[d >= 2 * size], d[d >= 2 * size]
            same[d >= 2 * size] = (wide[a] == wide[a + p]) & (wide[a + p - 2 * size] == wide[a + 2 * p - 2 * size])
            u, d = u[same], d[same]
        again: list[tuple[int, int]] = []
        least, most = 2 * size - 1, 4 * size - 2
        for now in (d < most, d == most):  # of the periods of one size, only the last is a multiple of another
            a, p = u[now], d[now]
            new = ~self._within(a, a + 2 * p, (self.period < least) | (self.period == least) & (p[:1] == most).all())
            a, p = a[new], p[new]
            order = np.lexsort((a, p))
            a, p = a[order], p[order]
            apart = np.ones(len(a), dtype=bool)
            apart[1:] = (p[1:] != p[:-1]) | (a[1:] - a[:-1] > p[1:])
            own = (self.period >= least) & (self.period <= most)
            known = {(x, y) for x, y in zip(self.end[own].tolist(), self.period[own].tolist(), strict=True)}
            runs, last = [], (0, 0, 0)
            for x, y in zip(a[apart].tolist(), p[apart].tolist(), strict=True):
                if y == last[2] and last[0] <= x and x + 2 * y <= last[1]:
                    continue
                end = self._right(x + 2 * y, y)
                if (end, y) in known:
                    continue
                last = (self._left(x, y), end, y)
                if end - last[0] >= self.power * y and np.array_equal(self.words[x : x + y], self.words[x + y : x + 2 * y]):
                    runs.append(last)
                elif end == self.n:  # more words may make it long enough
                    again.append((x, y))
            self._add(runs)
        if again:
            self.armed[level] = np.concatenate([self.armed[level], np.array(again, dtype=np.int64).T], axis=1)

    def _left(self, start: int, d: int) -> int:
        return start - self._agree(start, start + d, -1)

    def _right(self, end: int, d: int) -> int:
        return end + self._agree(end - d, end, 1)

    def _agree(self, a: int, b: int, way: int) -> int:
        """Words that agree from a and b on (before them, if way is -1), compared in stretches that double."""
        w, done, step = self.words, 0, 64
        while True:
            most = min(step, self.n - b - done if way > 0 else a - done)
            if most <= 0:
                return done
            same = w[a + done : a + done + most] == w[b + done : b + done + most] if way > 0 else (w[a - done - most : a - done] == w[b - done - most : b - done])[::-1]
            if not same.all():
                return done + int(same.argmin())
            done, step = done + most, 2 * step

    def _grow_runs(self, old: int) -> None:
        """Runs that reach the former end go on as long as the new words agree."""
        for i in np.flatnonzero(self.end == old).tolist():
            self.end[i] = self._right(old, int(self.period[i]))

    def _add(self, runs: list[tuple[int, int, int]]) -> None:
        if runs:
            every = np.unique(np.concatenate([np.stack([self.start, self.end, self.period], axis=1), np.array(runs, dtype=np.int64)]), axis=0)
            self.start, self.end, self.period = every.T.copy()

    def runs(self, least: int) -> np.ndarray:
        """(start, length, period) rows of the runs of ``least`` words or more, by start and then period."""
        length = self.end - self.start
        keep = length >= np.maximum(least, self.power * self.period)
        out = np.stack([self.start, length, self.period], axis=1)[keep]
        return out[np.lexsort((out[:, 2], out[:, 0]))]


def runs_of_texts(data: np.ndarray, offsets: np.ndarray, power: int, least: int) -> tuple[list[np.ndarray], list[bytes]]:
    """For each text: its runs, and its words joined by one space without those that repeat a run's first period.

    All texts go through one catcher, one after the other, with a number between them that never comes again.
    """
    texts = len(offsets) - 1
    row, start, end = word_spans(data, offsets)
    first = np.searchsorted(row, np.arange(texts + 1))
    stream = np.empty(len(row) + texts, dtype=np.int64)
    place = np.arange(len(row)) + row
    space = (data == 32) | ((data >= 9) & (data <= 13))
    stream[place], _ = encoded_words(data, ~space, end - start)
    stream[first[1:] + np.arange(texts)] = -1 - np.arange(texts)
    catcher = SquareCatcher(power)
    catcher.append(stream)
    found = catcher.runs(least)
    edge = np.zeros(len(stream) + 1, dtype=np.int64)
    np.add.at(edge, found[:, 0] + found[:, 2], 1)
    np.add.at(edge, found[:, 0] + found[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(edge)[place] == 0)
    begins = first[:-1] + np.arange(texts)
    cut = np.searchsorted(begins, found[:, 0], side="right") - 1
    found[:, 0] -= begins[cut]
    # The kept words and a space after each, in a row.
    size = end[kept] - start[kept] + 1
    to = np.r_[0, np.cumsum(size)]
    out = data[np.minimum(np.repeat(start[kept] - to[:-1], size) + np.arange(to[-1]), max(len(data) - 1, 0))] if len(data) else np.zeros(0, np.uint8)
    out[to[1:] - 1] = 32
    ends = to[np.searchsorted(row[kept], np.arange(texts + 1))]
    text = out.tobytes()
    return np.split(found, np.searchsorted(cut, np.arange(1, texts))) if texts else [], [text[a : max(a, b - 1)] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def periodic_runs(docs: DataFrame, id: str = "doc_id", text: str = "text", power: int = 3, least: int = 24) -> DataFrame:
    """``doc_id, runs, collapsed`` of every whole text.

    A run is a stretch of words with smallest period q, as long as ``power`` q and ``least`` words, that no
    neighbouring word extends with that period; ``runs`` has its first word (from 0), length and period,
    by start and then period. ``collapsed`` is the text's words joined by one space, without those that a run
    contains after its first q words. Words lie between ASCII white space and are compared byte by byte.
    A null text counts as empty: no runs, an empty ``collapsed``. Ids aren't looked at: null and repeated ones have
    their rows. Other columns are ignored; an empty table gives no rows. One pass, no shuffle; memory follows the
    longest text, n words of it cost n log n steps.
    """
    importable(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in text_runs(batch["text"]):
                found, texts = runs_of_texts(data, offsets, power, least)
                rows = np.concatenate(found) if found else np.zeros((0, 3), dtype=np.int64)
                structs = pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in range(3)], RUN.names)
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum([len(f) for f in found])].astype(np.int32)), structs)
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(first, len(texts)), lists, pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "runs", "collapsed"])

    schema = StructType([StructField("doc_id", docs.schema[id].dataType), StructField("runs", ArrayType(RUN)), StructField("collapsed", StringType())])
    return docs.select(F.col(id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, schema)
