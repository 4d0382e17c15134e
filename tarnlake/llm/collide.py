"""Approximate nearest neighbours by counting collisions of single projections."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.blocks import Block, Search, search_blocks

#: Projections; half a window's width for radius 1; the factor by which radii grow.
PROJECTIONS, WIDTH, GROWTH = 256, 2.0, 1.03
#: Standard deviations below the expected collisions of a vector just inside the radius.
SLACK = 0.7
#: A query's first radius holds so large a share of k in so many rows of the block, drawn out to all; the least square of a radius.
FIRST_SHARE, FIRST_ROWS, LEAST_SQUARE = 0.5, 4096, 1e-6
#: Bound on the error of a score in single precision, as a share of the product of both lengths.
ERROR = 1e-4
SEED = 20240


def threshold() -> int:
    """Windows that a row just inside the radius lies in, less SLACK standard deviations.

    The chance that a standard normal lies within a window of this width for its distance is the same
    for every radius, so one threshold serves them all.
    """
    share = erf(WIDTH / sqrt(2))
    return int(PROJECTIONS * share - SLACK * sqrt(PROJECTIONS * share * (1 - share)))


class Arrays:
    """The index of a block: every row in PROJECTIONS arrays, each sorted by one projection.

    Inner products become distances: rows are scaled by the block's largest norm and given one
    more component that makes them unit vectors; queries are made unit vectors.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.vectors, self.single = ids, vectors, vectors.astype(np.float32)
        self.room = np.zeros(0, dtype=np.int64)
        norms = np.sqrt((vectors**2).sum(axis=1))
        self.top = norms.max()
        unit = np.c_[vectors / self.top, np.sqrt(np.maximum(0.0, 1 - (norms / self.top) ** 2))]
        self.lines = np.random.default_rng(SEED).standard_normal((unit.shape[1], PROJECTIONS))
        at = (unit @ self.lines).T
        self.rows = np.argsort(at, axis=1, kind="stable").astype(np.int32)
        self.values = np.take_along_axis(at, self.rows, axis=1).astype(np.float32)

    def first_radii(self, queries: Block, k: int) -> np.ndarray:
        """For each query a radius within which about k rows of the block lie: where its windows begin to open.

        It follows from the query and rows spread evenly over the block, so answers don't depend on
        the queries that come together.
        """
        step = max(1, len(self.ids) // FIRST_ROWS)
        ids, rows = self.ids[::step], self.single[::step] / np.float32(self.top)
        unit = queries.vectors / np.sqrt((queries.vectors**2).sum(axis=1))[:, None]
        far = np.empty(len(unit))
        for i, (own, direction) in enumerate(zip(queries.ids, unit.astype(np.float32), strict=True)):
            near = (2 - 2 * rows @ direction)[ids != own]
            far[i] = np.quantile(near, min(1.0, FIRST_SHARE * k / len(self.ids))) if len(near) else 0
        return np.sqrt(np.maximum(far, LEAST_SQUARE))

    def _often(self, starts: np.ndarray, ends: np.ndarray, which: np.ndarray) -> np.ndarray:
        """How often each row stands in [start, end) of the arrays ``which``."""
        parts = [self.rows[j][a:b] for j, a, b in zip(which.tolist(), starts.tolist(), ends.tolist(), strict=True)]
        size = int((ends - starts).sum())
        if size > len(self.room):
            self.room = np.zeros(2 * size, dtype=np.int64)
        if not parts:
            return np.zeros(len(self.ids), dtype=np.int64)
        return np.bincount(np.concatenate(parts, out=self.room[:size]), minlength=len(self.ids))

    def collisions(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Windows [left, right) that each row lies in, counted from what lies outside where that is less."""
        n = len(self.ids)
        wide = 2 * (right - left) > n
        few, many = np.flatnonzero(~wide), np.flatnonzero(wide)
        zero, end = np.zeros(len(many), dtype=left.dtype), np.full(len(many), n, dtype=right.dtype)
        outside = self._often(np.r_[zero, right[many]], np.r_[left[many], end], np.r_[many, many])
        return self._often(left[few], right[few], few) - outside + len(many)

    def grown(self, left: np.ndarray, low: np.ndarray, high: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Windows that grew from [low, high) to [left, right) over each row."""
        every = np.arange(len(left))
        return self._often(np.r_[left, high], np.r_[low, right], np.r_[every, every])

    def windows(self, at: np.ndarray, half: float) -> tuple[np.ndarray, np.ndarray]:
        """Where the windows around ``at`` (queries x projections) begin and end in the arrays."""
        low, high = (at - half).astype(np.float32), (at + half).astype(np.float32)
        left = [v.searchsorted(a) for v, a in zip(self.values, low.T, strict=True)]
        right = [v.searchsorted(a, "right") for v, a in zip(self.values, high.T, strict=True)]
        return np.stack(left, axis=1), np.stack(right, axis=1)

    def _near(self, rows: np.ndarray, vector: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best of ``rows`` and all that tie with them, by their exact scores.

        Scores in single precision tell which rows could be among the k best; their error is far below ERROR of both lengths.
        """
        if len(rows) > 2 * k:
            rough = self.single[rows] @ vector.astype(np.float32)
            margin = ERROR * self.top * np.sqrt((vector**2).sum())
            rows = rows[rough >= np.partition(rough, -k)[-k] - margin]
        return rows, (self.vectors[rows] * vector).sum(axis=1)

    def nearest(self, query_id: int, vector: np.ndarray, at: np.ndarray, radius: float, left: np.ndarray, right: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(rows, scores, rows verified) of the k best rows found for a query, whose first windows are [left, right)."""
        length, least = np.sqrt((vector**2).sum()), threshold()
        count, checked = self.collisions(left, right), self.ids == query_id
        found, scores, verified = np.zeros(0, np.int64), np.zeros(0), 0
        while True:
            if radius > 2 * GROWTH:  # no two unit vectors are further apart: all rows are inside
                new = np.flatnonzero(~checked)
            else:
                new = np.flatnonzero((count >= least) & ~checked)
            checked[new] = True
            verified += len(new)
            new, more = self._near(new, vector, k)
            found, scores = np.r_[found, new], np.r_[scores, more]
            inside = 2 - 2 * scores / (length * self.top) <= radius**2
            if inside.sum() >= k or radius > 2 * GROWTH:
                break
            radius *= GROWTH
            low, high = left, right
            left, right = (x[0] for x in self.windows(at[None], WIDTH * radius))
            # Windows grow at their ends; what they hold already is counted.
            count += self.grown(left, low, high, right)
        best = np.lexsort((self.ids[found], -scores))[:k]
        return found[best], scores[best], verified


def collision_search(k: int) -> Search:
    """Nearest rows by inner product, for blocks of rows and the queries that pass them.

    For a radius a query opens a window around its own projection in every array; a row that lies in
    at least :func:`threshold` windows is a candidate and is verified exactly. Windows grow with the radius
    (virtual rehashing) until k rows were verified within the radius. No bound is set on candidates.
    """

    def index(block: Block) -> Callable[[Block], Iterator[pa.RecordBatch]]:
        arrays = Arrays(block.ids, block.vectors)

        def ask(queries: Block) -> Iterator[pa.RecordBatch]:
            unit = queries.vectors / np.sqrt((queries.vectors**2).sum(axis=1))[:, None]
            # One product a query, so its last bits don't depend on the other queries.
            own = np.stack([u @ arrays.lines for u in np.c_[unit, np.zeros(len(unit))]])
            first = arrays.first_radii(queries, k)
            left, right = arrays.windows(own, WIDTH * first[:, None])
            out = []
            for i, (query_id, vector) in enumerate(zip(queries.ids.tolist(), queries.vectors, strict=True)):
                rows, scores, verified = arrays.nearest(query_id, vector, own[i], first[i], left[i], right[i], k)
                out.append((np.full(len(rows), query_id), arrays.ids[rows], scores, np.r_[verified, np.zeros(len(rows), np.int64)][: len(rows)]))
            columns = [np.concatenate(x) for x in zip(*out, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "vec_id", "score", "verified"])

        return ask

    return index


def usable(vector: str) -> Column:
    """Neither null nor zero, and every component a finite number."""
    v = F.col(vector)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & fine & F.exists(v, lambda x: x != 0), F.lit(False))


def nearest_by_collisions(rows: DataFrame, is_query: Column, k: int = 20, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score, verified``: the k rows of largest inner product found for each query row.

    ``verified`` counts the rows of all blocks whose inner product the query needed. A row is no candidate
    of its own id; ties go to the smaller id; with fewer than k candidates all are returned. Rows
    that repeat an id count once, with the least of their vectors in the order of components. Vectors
    that are null, zero or hold a null or non-finite component take no part, nor do rows without an
    id; other columns are ignored; vectors are of one length; an empty table gives no rows.
    """
    clean = rows.where(usable(vector) & F.col(id).isNotNull()).select(F.col(id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"), is_query.alias("query"))
    return search_blocks(clean, collision_search(k), k, "score double, verified long", F.desc("score"), "verified")
