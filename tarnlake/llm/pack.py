"""Mixture-controlled packing: deficit round-robin over source queues."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.running import bucket_count, hash_bucket, total_before
from tarnlake.llm.scratch import importable, keep
from tarnlake.llm.tokens import encoder
from tarnlake.llm.words import text_runs

#: Tokens of a unit that a queue sends as a whole; longer documents are several units.
UNIT = 512
#: Quanta are fixed-point numbers with so many binary places.
PLACES = 16
RUN_TOKENS = 500_000

_TOKENS = "row long, doc_id long, source string, tokens long, packed binary"
_PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def _tokenize(path: str, end_id: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, press = encoder(path), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for first, data, offsets in text_runs(batch["text"]):
                ids, at = enc.encode(data, offsets)
                n, end = len(at) - 1, np.array([end_id], dtype=enc.dtype).tobytes()
                part = batch.slice(first, n)
                packed = [press.compress(ids[at[i] : at[i + 1]].tobytes() + end) for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [part["row"], part["doc_id"].cast(pa.int64()), part["source"], pa.array(np.diff(at) + 1), pa.array(packed, pa.binary())], ["row", "doc_id", "source", "tokens", "packed"]
                )

    return run


def send_round(upto: Column, quantum: Column) -> Column:
    """The round of deficit round-robin in which a queue sends the unit that ends ``upto`` tokens from its start.

    In every round a queue's deficit grows by its quantum, and it sends whole units as long as the deficit
    covers the next one, keeping the rest. So after r rounds it has sent the units that end within r quanta,
    and no state has to be passed from round to round or from task to task.
    """
    return F.call_function("div", upto * (1 << PLACES) + quantum - 1, quantum)


def _cut(window: int, dtype: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pieces of documents with their ids: units that lie side by side in a window are one piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor()
        for batch in batches:
            tokens = batch["tokens"].to_numpy()
            run_of = np.cumsum(tokens) // RUN_TOKENS
            for r in np.unique(run_of):
                rows = np.flatnonzero(run_of == r)
                part = batch.slice(rows[0], len(rows))
                size, ids = tokens[rows], np.concatenate([np.frombuffer(expand.decompress(x.as_py()), dtype=dtype) for x in part["packed"]]).astype("<u4")
                units = part["units"].flatten()
                start, length, at = (units.field(i).to_numpy() for i in range(3))
                doc = np.repeat(np.arange(len(rows)), part["units"].value_lengths().to_numpy())
                new = np.r_[True, (doc[1:] != doc[:-1]) | (at[1:] != at[:-1] + length[:-1])]
                first = np.flatnonzero(new)
                doc, start, at = doc[first], start[first], at[first]
                length = np.add.reduceat(length, first)
                windows = (at + length - 1) // window - at // window + 1
                which, upto = np.repeat(np.arange(len(doc)), windows), np.cumsum(windows)
                number = at[which] // window + np.arange(int(upto[-1])) - np.repeat(upto - windows, windows)
                low, high = np.maximum(at[which], number * window), np.minimum(at[which] + length[which], (number + 1) * window)
                doc, start, length, at = doc[which], start[which] + low - at[which], high - low, low
                base = np.cumsum(size) - size
                begin = base[doc] + start
                assert begin[0] == 0 and (begin[1:] == begin[:-1] + length[:-1]).all()  # pieces lie in the ids' own order, so their bytes need no copy
                held = pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer((np.r_[begin, len(ids)] * 4).astype(np.int32)), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"].take(pa.array(doc)), pa.array(start), pa.array(length), held, pa.array(size[doc]), pa.array(at // window), pa.array(at % window)],
                    ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
                )

    return run


def place_units(narrow: DataFrame, quanta: DataFrame, window: int, tokens: int, rows: int, unit: int = UNIT) -> DataFrame:
    """``row, start, length, place`` of every unit of the documents ``row, doc_id, source, tokens``; ``quanta`` has ``of, quantum`` of each source.

    Units are sent round by round, in a round source by source (in the order of a hash), in a source one after
    the other. A place is the number of tokens sent before; it comes from totals of ranges of rounds.
    """
    mixed = narrow.withColumn("mixed", F.xxhash64("doc_id")).withColumn("part", hash_bucket(F.xxhash64("doc_id", "row"), bucket_count(rows)))
    placed = total_before(mixed, ["source"], "part", ["mixed", "row"], "tokens", "before")
    queued = placed.join(quanta, placed["source"].eqNullSafe(quanta["of"])).drop("of")
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tokens") - 1, F.lit(unit).cast("long")))
    units = queued.select("row", "source", "before", "quantum", "tokens", starts.alias("start")).withColumn("length", F.least(F.lit(unit).cast("long"), F.col("tokens") - F.col("start")))
    units = units.withColumn("upto", F.col("before") + F.col("start") + F.col("length")).withColumn("round", send_round(F.col("upto"), F.col("quantum")))
    # Rounds up to the last one if all queues ended together are cut evenly, later ones by their logarithm.
    buckets, even = bucket_count(tokens // unit + rows), tokens // window + 1
    late = F.lit(buckets) + F.floor(64 * F.log2(F.greatest(F.col("round") - even, F.lit(1)).cast("double")))
    cut = F.when(F.col("round") <= even, F.floor(F.col("round") / (even + 1) * buckets)).otherwise(late).cast("int")
    units = units.withColumn("range", cut).withColumn("queue", F.xxhash64("source"))
    out = total_before(units, [], "range", ["round", "queue", F.asc_nulls_first("source"), "upto"], "length", "place")
    return out.select("row", "start", "length", "place")


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, window: int = 4096, proportions: dict[str | None, float] | None = None, id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Cut all documents' ids into pieces that fill windows of ``window`` tokens to target proportions.

    Every source is a queue of its documents in shuffled order (hash of the id), served by deficit
    round-robin: a round adds a window's share to each deficit, in proportion to the target, and a queue
    sends its next unit, a document of up to UNIT tokens or a stretch of a longer one, when its deficit covers it. Deficits
    go on from round to round, over windows and partitions; so any stretch of the output holds a source's share
    but for less than two units. ``proportions`` default to the sources' shares of all tokens, so that all queues end
    together; sources not named get what they leave of 1, divided by size. Once a queue is empty, the others
    fill its place. Units are cut once more where a window ends; all windows but the last are full; only
    that one is padded. Any number of sources may take part.

    Returns pieces ``doc_id, start, length, ids`` (little-endian unsigned 32-bit), ``doc_tokens,
    sequence_id, offset``. A text is tokenised once; the ids wait, compressed, in the shared
    folder. A null text is empty (its end id alone), a null source is a source of its own (in ``proportions``: None),
    repeated rows are separate documents, other columns are ignored, and an empty table gives no pieces.
    """
    spark = docs.sparkSession
    importable(spark)
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"), F.col(text).cast("string").alias("text"))
    tokens = keep(texts.mapInArrow(_tokenize(tokenizer, end_id), _TOKENS), "pack")
    all_tokens, all_rows = tokens.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.count("*")).first()
    if not all_rows:
        return spark.createDataFrame([], _PIECES)
    share = tokens.groupBy(F.col("source").alias("of")).agg(F.sum("tokens").alias("n"))
    if proportions is None:
        share = share.withColumn("p", F.col("n") / F.lit(all_tokens))
    else:
        named = spark.createDataFrame([(k, float(v)) for k, v in proportions.items()], "name string, own double")
        share = share.join(named, F.col("of").eqNullSafe(F.col("name")), "left")
        others = share.where("own IS NULL").agg(F.sum("n").alias("others"))
        rest = max(0.0, 1.0 - sum(proportions.values()))
        share = share.crossJoin(others).withColumn("p", F.coalesce("own", rest * F.col("n") / F.col("others")))
    quanta = share.select("of", F.greatest(F.lit(1), F.floor(F.col("p") * float(window << PLACES))).cast("long").alias("quantum"))
    units = place_units(tokens.select("row", "doc_id", "source", "tokens"), quanta, window, int(all_tokens), int(all_rows))
    own = units.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "length", "place"))).alias("units"))
    ready = tokens.join(own, "row").select("doc_id", "tokens", "packed", "units")
    return ready.mapInArrow(_cut(window, encoder(tokenizer).dtype.str), _PIECES)
