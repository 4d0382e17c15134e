"""A stated set of queries against all rows, in blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnlake.llm.scratch import importable, keep

#: Rows indexed together; queries that pass one copy of an index, and those that are asked at a time.
INDEX_ROWS, QUERY_ROWS, ASK_ROWS = 65_536, 65_536, 256


@dataclass(frozen=True)
class Block:
    """Ids, ascending and distinct, and what is compared: vectors (rows x components) or codes."""

    ids: np.ndarray
    vectors: np.ndarray


Search = Callable[[Block], Callable[[Block], Iterator[pa.RecordBatch]]]


def _block(parts: list[pa.RecordBatch]) -> Block:
    table = pa.Table.from_batches(parts).combine_chunks()
    ids, values = table["vec_id"].to_numpy(), table["vector"].combine_chunks()
    if pa.types.is_list(values.type):
        vectors = values.flatten().to_numpy().reshape(len(ids), -1)
    else:
        vectors = values.to_numpy()
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    first = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
    for s, e in zip(first, np.r_[first[1:], len(ids)], strict=True):
        if e > s + 1:  # an id that repeats: the least of its vectors
            vectors[s] = min(vectors[s:e].tolist())
    return Block(ids[first], vectors[first])


def _passing(search: Search, names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows come sorted by block, its rows before its queries; the block is indexed once and its queries pass it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: tuple[int, int] | None = None
        rows: list[pa.RecordBatch] = []
        asked: list[pa.RecordBatch] = []
        ask = None

        def answers() -> Iterator[pa.RecordBatch]:
            nonlocal ask, rows, asked
            if rows and asked:
                ask, rows = search(_block(rows)), []
            if ask and asked:
                for found in ask(_block(asked)):
                    yield found.select(names)
            asked = []

        for batch in batches:
            r, q, query = (batch[c].to_numpy(zero_copy_only=False) for c in ("r", "q", "query"))
            cuts = np.flatnonzero(np.r_[True, (r[1:] != r[:-1]) | (q[1:] != q[:-1]) | (query[1:] != query[:-1])]) if len(r) else []
            for s, e in zip(cuts, np.r_[cuts[1:], len(r)].astype(int), strict=True):
                if (int(r[s]), int(q[s])) != block:
                    yield from answers()
                    block, rows, ask = (int(r[s]), int(q[s])), [], None
                part = batch.slice(s, e - s).select(["vec_id", "vector"])
                if not query[s]:
                    rows.append(part)
                    continue
                for a in range(0, part.num_rows, ASK_ROWS):
                    asked.append(part.slice(a, ASK_ROWS))
                    if sum(x.num_rows for x in asked) >= ASK_ROWS:
                        yield from answers()
        yield from answers()

    return run


def search_blocks(rows: DataFrame, search: Search, k: int, value: str, best_first: Column, total: str | None = None) -> DataFrame:
    """The k best candidates of each query over all ``rows`` (``vec_id, vector, query``).

    Rows are hashed into blocks of about INDEX_ROWS; each block is sent once (once more for every
    further QUERY_ROWS queries), is indexed by ``search`` and then passed by the queries,
    which are few and are sent to every block. A query's at most k rows from each block meet in a
    window. ``value`` names the columns besides ``query_id, vec_id``, the first of which ranks;
    ``total`` is added up over all of a query's answers. Of rows that repeat an id, the one of least vector counts.
    """
    importable(rows.sparkSession)
    rows = keep(rows, "vectors")
    count, queries = rows.agg(F.count("*"), F.count_if("query")).first()
    row_blocks, query_blocks = -(-max(count, 1) // INDEX_ROWS), -(-max(queries, 1) // QUERY_ROWS)
    mixed = F.xxhash64("vec_id")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    data = rows.select(F.pmod(mixed, F.lit(row_blocks)).cast("int").alias("r"), every(query_blocks).alias("q"), F.lit(False).alias("query"), "vec_id", "vector")
    asked = rows.where("query").groupBy("vec_id").agg(F.min("vector").alias("vector"))
    asked = asked.select(every(row_blocks).alias("r"), F.pmod(F.shiftright(mixed, 20), F.lit(query_blocks)).cast("int").alias("q"), F.lit(True).alias("query"), "vec_id", "vector")
    parts = data.unionByName(asked).repartition(row_blocks * query_blocks, "r", "q").sortWithinPartitions("r", "q", "query", "vec_id")
    names = [c.split()[0] for c in value.split(", ")]
    found = parts.mapInArrow(_passing(search, ["query_id", "vec_id", *names]), f"query_id long, vec_id long, {value}")
    own = Window.partitionBy("query_id")
    rank = F.row_number().over(own.orderBy(best_first, "vec_id"))
    if total:
        found = found.withColumn(total, F.sum(total).over(own))
    return found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", *names)
