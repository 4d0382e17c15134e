"""Running totals over a whole table, without one task that sees a whole group."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 20_000
LEAST_BUCKETS = 1024


def bucket_count(rows: int) -> int:
    """A power of two; buckets hold about ``ROWS_PER_BUCKET`` rows once there are many."""
    return max(LEAST_BUCKETS, 1 << (max(rows, 1) // ROWS_PER_BUCKET).bit_length())


def hash_bucket(hashed: Column, buckets: int) -> Column:
    """Bucket of a 64-bit hash; rows are ordered by (bucket, hash)."""
    return F.pmod(F.shiftright(hashed, 20), F.lit(buckets)).cast("int")


def total_before(df: DataFrame, group: list[str], bucket: str, order: list[str], value: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all earlier rows of the row's group.

    Rows of a group are ordered by ``bucket`` and then ``order``. A task sorts single
    (group, bucket) pairs; only their totals, one row per pair, are summed along the
    group. So a group that holds most of the table is still spread over all its buckets.
    Null group keys form a group of their own. ``value`` must not be null.
    """
    inside = Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    along = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(*group, bucket).agg(F.sum(value).alias("_total"))
    bases = totals.select(*[F.col(g).alias(f"_g_{g}") for g in [*group, bucket]], F.coalesce(F.sum("_total").over(along), F.lit(0)).alias("_base"))
    rows = df.withColumn("_inner", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    on = reduce(lambda a, b: a & b, (rows[k].eqNullSafe(bases[f"_g_{k}"]) for k in [*group, bucket]))
    return rows.join(bases, on).withColumn(out, (F.col("_base") + F.col("_inner")).cast("long")).drop("_inner", "_base", *[f"_g_{k}" for k in [*group, bucket]])
