"""Sharding by Karmarkar-Karp differencing: indivisible groups, nearly equal bytes."""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.running import bucket_count, hash_bucket, total_before
from tarnlake.llm.scratch import keep

#: A group of at least 1 / HEAVY of all bytes is placed on its own; others go in bundles.
HEAVY, LEVELS, PER_LEVEL = 4000, 13, 2000


def differencing(sizes: Sequence[int], ways: int) -> np.ndarray:
    """Way of each size, by repeatedly combining the two partial partitions of largest spread, oppositely ordered."""
    where = np.zeros(len(sizes), dtype=np.int64)
    heap: list[tuple[int, int]] = []
    sums: dict[int, np.ndarray] = {}
    made: dict[int, tuple[int, int, np.ndarray, np.ndarray]] = {}
    for i, size in enumerate(sizes):
        sums[i] = np.zeros(ways, dtype=np.int64)
        sums[i][-1] = size
        heap.append((-int(size), i))
    heapq.heapify(heap)
    new = len(sizes)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        joined = sums.pop(a) + sums.pop(b)[::-1]
        order = np.argsort(joined, kind="stable")
        made[new] = (a, b, order, ways - 1 - order)
        joined = joined[order]
        sums[new] = joined - joined[0]
        heapq.heappush(heap, (-int(sums[new][-1]), new))
        new += 1
    todo = [(heap[0][1], np.arange(ways))] if heap else []
    while todo:
        node, shard = todo.pop()
        if node in made:
            a, b, left, right = made.pop(node)
            for child, slots in ((a, left), (b, right)):
                down = np.empty(ways, dtype=np.int64)
                down[slots] = shard
                todo.append((child, down))
        else:
            where[node] = shard[-1]
    return where


def shard_documents(docs: DataFrame, size: Column, group: Column, shards: int = 40, id: str = "doc_id", keep_columns: dict[str, Column] | None = None) -> DataFrame:
    """Put every row into one of ``shards`` shards of nearly equal bytes, rows of a group together.

    Adds ``shard`` and ``slot`` (gapless from 0 in its shard) to ``doc_id, size`` and
    ``keep_columns``. Groups (a binary or string key; null keys are one group) are summed
    with a map-side combine. A group of at least 1/4000 of all bytes is an item of its own,
    at most 4,000 of them; the others are hashed into at most 13 x 2,000 bundles whose
    expected sizes halve from level to level, so that differencing has fine material to
    end with. So the driver differences at most 30,000 sums whatever the input, and the
    tables it sends back have at most as many rows. A group larger than a shard's share
    makes that shard larger; nothing else could keep it whole.

    Repeated rows are kept; a null size counts as 0; an empty table gives no rows.
    """
    spark = docs.sparkSession
    more = keep_columns or {}
    rows = keep(
        docs.select(F.col(id).alias("doc_id"), F.coalesce(size.cast("long"), F.lit(0)).alias("size"), group.alias("_group"), *[c.alias(k) for k, c in more.items()])
        .withColumn("_hash", F.xxhash64("_group")).withColumn("_row", F.monotonically_increasing_id()), "shards")
    count, total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    level = F.least(F.lit(LEVELS - 1), F.bit_count(F.col("_hash").bitwiseAND(-F.col("_hash")) - 1)).cast("int")
    bundle = (level * PER_LEVEL + F.pmod(F.shiftright("_hash", 20), F.lit(PER_LEVEL))).cast("int")
    groups = rows.groupBy("_group", "_hash").agg(F.sum("size").alias("bytes"))
    heavy = F.col("bytes") * HEAVY >= F.lit(max(total, 1))
    items = groups.select(F.when(heavy, F.struct(F.col("_group").alias("key"))).alias("own"), F.when(~heavy, bundle).alias("bundle"), "bytes").groupBy("own", "bundle").agg(F.sum("bytes").alias("bytes")).collect()
    items.sort(key=lambda x: (x["bundle"] is None, x["bundle"] or 0, str(x["own"])))
    where = differencing([x["bytes"] for x in items], shards)
    kind = rows.schema["_group"].dataType.simpleString()
    of_bundle = spark.createDataFrame([(x["bundle"], int(s)) for x, s in zip(items, where, strict=True) if x["bundle"] is not None], "bundle int, by_bundle int")
    of_group = spark.createDataFrame([(x["own"]["key"], int(s)) for x, s in zip(items, where, strict=True) if x["own"] is not None], f"own {kind}, by_group int")
    placed = rows.withColumn("bundle", bundle).join(F.broadcast(of_bundle), "bundle", "left").join(F.broadcast(of_group), F.col("_group").eqNullSafe(F.col("own")), "left")
    placed = placed.withColumn("shard", F.coalesce("by_group", "by_bundle")).withColumn("_one", F.lit(1)).withColumn("_mixed", F.xxhash64("_row"))
    placed = placed.withColumn("_part", hash_bucket(F.col("_mixed"), bucket_count(count)))
    return total_before(placed, ["shard"], "_part", ["_mixed", "_row"], "_one", "slot").select("doc_id", "size", *more, "shard", "slot")
