"""Word and shingle hashes of whole texts, vectorised over Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are taken in runs of about so many bytes (one text at least), which bounds memory.
RUN_BYTES = 500_000
_P = 0x9E3779B97F4A7C15 | 1
_INV = pow(_P, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """The first n powers of base modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        more = np.full(max(n, RUN_BYTES + 1), base, dtype=np.uint64)
        more[0] = 1
        have = np.multiply.accumulate(more)
        if n <= 8 * RUN_BYTES:
            _powers[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (splitmix64's finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_runs(column: pa.ChunkedArray | pa.Array, size: int = RUN_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of whole texts of about ``size`` bytes; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64, count=len(column) + column.offset + 1)[column.offset :]
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8) if column.buffers()[2] is not None and column.buffers()[2].size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1)
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def lower(data: np.ndarray) -> np.ndarray:
    """ASCII capitals in lower case."""
    return data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans: a polynomial from prefix sums, then mixed with the length."""
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power(_P, len(data)), out=sums[1:])
    h = (sums[ends] - sums[starts]) * _power(_INV, len(data) + 1)[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_spans(data: np.ndarray, offsets: np.ndarray, cuts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of words between ASCII white space, in order; none crosses a row's end or a byte in ``cuts``."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = ~((data == 32) | ((data >= 9) & (data <= 13)))
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    if cuts is not None:
        cut[cuts] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | cut))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | cut))
    per_row = np.diff(np.searchsorted(starts, offsets))
    return np.repeat(np.arange(len(per_row)), per_row), starts, ends


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every word, lower-cased in A-Z."""
    row, starts, ends = word_spans(data, offsets)
    return row, span_hashes(lower(data), starts, ends)


def encoded_words(data: np.ndarray, inside: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, pa.LargeBinaryArray]:
    """(number of each word, distinct words): words told apart byte by byte.

    ``data[inside]`` is all of their bytes in a row, ``sizes`` says how many each has.
    """
    offsets = np.r_[0, np.cumsum(sizes)].astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[inside]))])
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def array_bytes(words: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an array of binary values."""
    if not len(words):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(words.buffers()[1], dtype=np.int64, count=len(words) + words.offset + 1)[words.offset :]
    data = np.frombuffer(words.buffers()[2], dtype=np.uint8) if words.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def shingle_hashes(row: np.ndarray, word: np.ndarray, k: int, whole: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first word, hash) of runs of k words; with ``whole``, a row of fewer words has them all as one."""
    n = len(word)
    mult = [np.uint64(pow(0xC2B2AE3D27D4EB4F, j + 1, 1 << 64)) for j in range(k)]
    out_row, at, h = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if n >= k:
        total = np.zeros(n - k + 1, dtype=np.uint64)
        for j in range(k):
            total += word[j : n - k + 1 + j] * mult[j]
        at = np.flatnonzero(row[: n - k + 1] == row[k - 1 :])
        out_row, h = row[at], mix(total[at])
    if whole and n:
        first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        length = np.diff(np.r_[first, n])
        short = np.flatnonzero(length < k)
        if len(short):
            s, m = first[short], length[short]
            total = m.astype(np.uint64)
            for j in range(k - 1):
                has = m > j
                total[has] += mix(word[s[has] + j] + np.uint64(1)) * mult[j]
            out_row, at, h = np.r_[out_row, row[s]], np.r_[at, s], np.r_[h, mix(total)]
            order = np.argsort(at, kind="stable")
            out_row, at, h = out_row[order], at[order], h[order]
    return out_row, at, h


def distinct_sorted(row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, hash), by row and then hash."""
    order = np.argsort(h, kind="stable")
    order = order[np.argsort(row[order], kind="stable")]
    row, h = row[order], h[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    return row[new], h[new]
