"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnlake.llm.running import bucket_count, total_before
from tarnlake.llm.scratch import keep

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words between ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, epochs: int = 2) -> DataFrame:
    """Target size of each source (``source, size`` in; ``source, source_size, target, budget`` out).

    Sources in code point order, null last, get ``weights`` in turn and divide ``share``
    times all sizes by them; no target exceeds ``epochs`` times its source's size, and the
    excess goes to the others by weight. The level at which the others stop is found in one
    pass over the sources, sorted by cap / weight. This table has one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = sources.withColumn("weight", F.element_at(cycle, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))).withColumn("cap", F.col("source_size") * float(epochs))
    whole = Window.partitionBy()
    by_ratio = Window.orderBy((F.col("cap") / F.col("weight")), F.col("source").asc_nulls_last())
    sources = sources.withColumn("budget", F.sum("source_size").over(whole) * share)
    level = (F.col("budget") - F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))) / F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    sources = sources.withColumn("level", level)
    free = F.max(F.when(F.col("cap") / F.col("weight") > F.col("level"), F.col("level"))).over(whole)
    return sources.select("source", "source_size", F.coalesce(F.least("cap", free * F.col("weight")), F.col("cap")).alias("target"), "budget")


def mix_documents(docs: DataFrame, size: Column, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, epochs: int = 2, id: str = "doc_id", source: str = "source", seed: str = "mix", key: Column | None = None) -> DataFrame:
    """Whole documents, repeated up to ``epochs`` times, that fill ``share`` of the corpus in proportion to target weights.

    Each source is shuffled (by md5 of seed and id). A copy's virtual finish time is the
    words of its source up to and including it, over all earlier epochs too, divided by
    the source's target; copies of all sources in this order are taken until the next one
    would pass the budget. The order is cut into ranges of finish time; only range totals
    are summed along it, so neither a hot source nor the whole order meets in one task.

    Returns ``doc_id, size, source_size, target, taken`` for every row of ``docs``, and ``key`` if one is given.
    A null source is a source of its own; a null id is shuffled as an empty one; documents
    without words take part with size 0; repeated rows are separate documents, in the order of ``key`` where
    ids and sizes are the same. Other columns are ignored. Results depend only on the rows, not on their
    partitioning; without ``key``, rows of one id and size may swap what is taken of them.
    """
    shuffled = F.md5(F.concat(F.lit(seed), F.coalesce(F.col(id).cast("string"), F.lit(""))))
    rows = keep(docs.select(F.col(id).alias("doc_id"), F.col(source).alias("source"), size.cast("long").alias("size"), shuffled.alias("shuffle"), (F.lit(None).cast("long") if key is None else key).alias("key")).withColumn("row", F.monotonically_increasing_id()), "mix")
    targets = keep(source_targets(rows, weights, share, epochs), "mix-targets")
    buckets = bucket_count(rows.count())
    part = F.shiftright(F.conv(F.substring("shuffle", 1, 8), 16, 10).cast("long") * buckets, 32).cast("int")
    placed = total_before(rows.withColumn("part", part), ["source"], "part", ["shuffle", "doc_id", "size", "key", "row"], "size", "before")
    named = targets.withColumnRenamed("source", "of")
    copies = placed.join(named, placed["source"].eqNullSafe(named["of"])).withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    done = F.col("before") + F.col("size") + F.col("epoch") * F.col("source_size")
    copies = copies.withColumn("finish", F.coalesce(F.try_divide(done, F.col("target")), F.lit(0.0)))
    copies = copies.withColumn("range", F.floor(F.col("finish") / (1 + F.col("finish")) * buckets).cast("int"))
    order = ["finish", F.col("source").asc_nulls_last(), "epoch", "shuffle", "doc_id", "size", "key", "row"]
    ranked = total_before(copies, [], "range", order, "size", "ahead")
    taken = F.when(F.col("ahead") + F.col("size") <= F.col("budget"), F.col("size")).otherwise(0)
    return ranked.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("size").alias("size"), F.first("source_size").alias("source_size"), F.first("target").alias("target"), F.sum(taken).alias("taken"), F.first("key").alias("key")).drop("row", *(["key"] if key is None else []))
