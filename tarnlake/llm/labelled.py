"""Bounded samples of labelled documents to learn from."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnlake.llm.scratch import importable

#: Bytes of text of either label to learn from, at most.
LEARN_BYTES = 64_000_000


def fold(id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(id.cast("string"), F.lit(""))) % folds


def sample_ids(labels: DataFrame, label: str, value: int, learn: Column, most: int) -> DataFrame:
    """At most ``most`` distinct ids labelled ``value``, by a hash of the id: the same ones at every run."""
    ids = labels.where(learn & (F.col(label) == value) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    return ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).withColumn("label", F.lit(value))


def sample_documents(docs: DataFrame, labels: DataFrame, label: str, learn: Column, most: int, most_bytes: int = LEARN_BYTES) -> DataFrame:
    """``doc_id, text, label`` of at most ``most`` learning documents for each of the labels 0 and 1.

    Of these, in the order of a hash of the id, as many whole texts as have ``most_bytes`` bytes for
    a label; so what a driver collects is bounded in rows and in bytes. A single text above the bound is not
    learnt from and takes no other's place.
    """
    ids = sample_ids(labels, label, 0, learn, most).unionByName(sample_ids(labels, label, 1, learn, most))
    sizes = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("size")).join(F.broadcast(ids), "doc_id").where(F.col("size") <= most_bytes)
    upto = F.sum("size").over(Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0))
    fit = sizes.withColumn("upto", upto).groupBy("doc_id", "label").agg(F.max("upto").alias("upto")).where(F.col("upto") <= most_bytes).select("doc_id", "label")
    return docs.select("doc_id", "text").where(F.coalesce(F.octet_length("text"), F.lit(0)) <= most_bytes).join(F.broadcast(fit), "doc_id")


def fit_in_a_task(sample: DataFrame, fit: Callable[[list[str], list[int]], Any]) -> Any:
    """What ``fit`` makes of the texts and labels of a bounded ``sample``, in order of id and text.

    It runs in one task, so the driver never holds the texts, only the model.
    """
    importable(sample.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r["doc_id"], r["text"] or "", r["label"]) for b in batches for r in b.to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit([r[1] for r in rows], [r[2] for r in rows]))], pa.binary())], ["model"])

    found = sample.select("doc_id", "text", "label").repartition(1).mapInArrow(run, "model binary").first()
    return pickle.loads(found["model"]) if found else fit([], [])
