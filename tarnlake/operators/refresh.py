"""Derived tables that are refreshed from the rows of a new batch, in the order in which they depend on each other."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.sources import sinks

#: Parts that a view's rows fall into by their keys; a refresh rewrites those that its batch touches.
BUCKETS = 64
COMBINE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


@dataclass(frozen=True)
class Totals:
    """Measures by ``keys`` that add up: each is a kind of ``COMBINE`` and what it is taken of."""

    name: str
    keys: tuple[str, ...]
    measures: Mapping[str, tuple[str, Column]]

    def of(self, rows: DataFrame) -> DataFrame:
        """The measures of ``rows`` alone."""
        make = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}
        return rows.groupBy(*self.keys).agg(*[make[kind](x).alias(m) for m, (kind, x) in self.measures.items()])


@dataclass(frozen=True)
class Derived:
    """Columns worked out from each row of the view ``parent``."""

    name: str
    parent: str
    columns: Mapping[str, Column]


def refresh(spark: SparkSession, root: str, batch: DataFrame, views: Sequence[Totals | Derived]) -> dict[str, int]:
    """Bring all ``views`` up to date with the rows of ``batch``, which no refresh has seen; returns the rows written for each.

    The batch is aggregated alone; its totals are combined with those of the buckets they fall into, and only these are
    written again. Views that derive from another follow it, by the same buckets. Each view is staged before it
    replaces anything, so a refresh reads no table that it writes.
    """
    touched: dict[str, list[int]] = {}
    known: dict[str, DataFrame] = {}
    written = {}
    for view in views:
        path = f"{root}/{view.name}"
        if isinstance(view, Totals):
            new = view.of(batch).withColumn("_bucket", F.pmod(F.xxhash64(*view.keys), F.lit(BUCKETS)).cast("int"))
            sinks.create_if_absent(spark, path, new.schema)
            old = spark.read.schema(new.schema).parquet(path)
            touched[view.name] = sorted(r["_bucket"] for r in new.select("_bucket").distinct().collect())
            both = old.where(F.col("_bucket").isin(touched[view.name])).unionByName(new)
            rows = both.groupBy(*view.keys, "_bucket").agg(*[COMBINE[kind](m).cast(new.schema[m].dataType).alias(m) for m, (kind, _) in view.measures.items()])
        else:
            touched[view.name] = touched[view.parent]
            rows = known[view.parent].where(F.col("_bucket").isin(touched[view.name])).withColumns(dict(view.columns))
        staged = f"{root}/_staged/{view.name}-{uuid.uuid4().hex}"
        sinks.overwrite(rows, staged)
        ready = spark.read.schema(rows.schema).parquet(staged)
        written[view.name] = ready.count()
        if written[view.name]:
            sinks.replace_partitions(ready, path, "_bucket")
        known[view.name] = spark.read.schema(rows.schema).parquet(path)
    return written
