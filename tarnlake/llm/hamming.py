"""Exact top-k search of binary codes by incremental multi-index hashing."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.blocks import Block, Search, search_blocks
from tarnlake.llm.collide import usable

BITS, SEGMENTS = 64, 4


def sign_code(vector: Column) -> Column:
    """A 64-bit code from the signs of up to 64 components, the first in the lowest bit."""
    first = F.slice(vector, 1, BITS)
    bits = F.transform(first, lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i.cast("int"))).otherwise(F.lit(0).cast("long")))
    return F.aggregate(bits, F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))


def _flips(width: int) -> list[np.ndarray]:
    """By radius, all masks with so many of ``width`` bits set."""
    return [np.array([sum(1 << b for b in c) for c in itertools.combinations(range(width), r)], dtype=np.int64) for r in range(width + 1)]


def multi_index_search(k: int) -> Search:
    """The k nearest codes in Hamming distance, for blocks of rows and the queries that pass them.

    Codes are cut into segments, each with a table from its value to the rows. A query probes
    segment after segment at radius 0, then at radius 1, and so on. After segment s at radius r
    every code within distance ``SEGMENTS * r + s`` was met: a code further from the query in all
    segments probed so far differs in at least r + 1 bits of each segment up to s and r of each other.
    The search ends when the kth verified distance is covered so.
    """
    width = BITS // SEGMENTS
    flips = _flips(width)

    def index(block: Block) -> Callable[[Block], Iterator[pa.RecordBatch]]:
        ids, codes = block.ids, block.vectors.view(np.uint64)
        part = [((codes >> np.uint64(s * width)) & np.uint64((1 << width) - 1)).astype(np.int64) for s in range(SEGMENTS)]
        order = [np.argsort(p, kind="stable") for p in part]
        start = [np.searchsorted(p[o], np.arange((1 << width) + 1)) for p, o in zip(part, order, strict=True)]

        def nearest(query_id: int, code: np.uint64) -> tuple[np.ndarray, np.ndarray]:
            own = [int((code >> np.uint64(s * width)) & np.uint64((1 << width) - 1)) for s in range(SEGMENTS)]
            checked = ids == query_id
            met = np.zeros(BITS + 1, dtype=np.int64)  # verified rows by distance
            found: list[np.ndarray] = [np.zeros(0, np.int64)]
            for step in range(SEGMENTS * (width + 1)):
                radius, s = divmod(step, SEGMENTS)
                values = own[s] ^ flips[radius]
                low, high = start[s][values], start[s][values + 1]
                some = high > low
                low, size = low[some], (high - low)[some]
                upto = np.cumsum(size)
                rows = order[s][np.repeat(low - (upto - size), size) + np.arange(int(upto[-1]) if len(upto) else 0)]
                rows = rows[~checked[rows]]
                if len(rows):
                    checked[rows] = True
                    found.append(rows)
                    met += np.bincount(np.bitwise_count(codes[rows] ^ code), minlength=BITS + 1)
                if met[: min(step, BITS) + 1].sum() >= k:
                    break
            rows = np.concatenate(found)
            distance = np.bitwise_count(codes[rows] ^ code).astype(np.int32)
            best = np.lexsort((ids[rows], distance))[:k]
            return ids[rows[best]], distance[best]

        def ask(queries: Block) -> Iterator[pa.RecordBatch]:
            out = [(np.full(len(d), q), i, d) for q, (i, d) in ((q, nearest(q, c)) for q, c in zip(queries.ids.tolist(), queries.vectors.view(np.uint64), strict=True))]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], ["query_id", "vec_id", "distance"])

        return ask

    return index


def nearest_codes(rows: DataFrame, is_query: Column, k: int = 10, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, distance``: for each query row the k nearest other rows, exactly.

    Codes are the signs of the vectors' components. Ties go to the smaller id; with fewer than k
    candidates all are returned. Rows that repeat an id count once, with the least of their codes as
    a signed number. Vectors that are null, zero or hold a null or non-finite component take no part, nor
    do rows without an id; other columns are ignored; an empty table gives no rows.
    """
    clean = rows.where(usable(vector) & F.col(id).isNotNull()).select(F.col(id).cast("long").alias("vec_id"), sign_code(F.col(vector)).alias("vector"), is_query.alias("query"))
    return search_blocks(clean, multi_index_search(k), k, "distance int", F.asc("distance"))
