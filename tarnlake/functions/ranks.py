"""Cumulative sums, ranks and exact quantiles over a whole table, without one task that sees all of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges of values; each is summed up in a task of its own, and only the ranges' totals meet.
RANGES = 256


def cumulated(groups: DataFrame, value: str, sums: list[str], descending: bool = False, by: list[str] | None = None) -> DataFrame:
    """``groups`` with ``upto_<s>`` for each of ``sums``: its total over all values up to and including the row's own.

    ``value`` is a number, not null and distinct (for each value of ``by``): group by it first, which combines before
    the shuffle, so a value that most rows have is one row here. With ``by``, totals are each group's own; a group's
    rows are spread over the ranges too, so no task sorts a whole one.
    """
    by = by or []
    x = (-F.col(value) if descending else F.col(value)).cast("double")
    edges = groups.agg(F.percentile_approx(x, F.array(*[F.lit(i / RANGES) for i in range(1, RANGES)]), F.lit(10 * RANGES)).alias("_edges"))
    cut = groups.crossJoin(F.broadcast(edges)).withColumn("_range", F.size(F.filter("_edges", lambda e: e < x))).drop("_edges")
    before = Window.partitionBy(*(by or [F.lit(0)])).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # RANGES rows
    bases = cut.groupBy(*by, "_range").agg(*[F.sum(s).alias(f"_{s}") for s in sums]).select(*by, "_range", *[F.coalesce(F.sum(f"_{s}").over(before), F.lit(0)).alias(f"_{s}") for s in sums])
    inside = Window.partitionBy(*by, "_range").orderBy(x).rowsBetween(Window.unboundedPreceding, 0)
    rows = cut.withColumns({f"upto_{s}": F.sum(s).over(inside) for s in sums}).join(bases if by else F.broadcast(bases), [*by, "_range"])
    return rows.withColumns({f"upto_{s}": F.col(f"upto_{s}") + F.col(f"_{s}") for s in sums}).drop("_range", *[f"_{s}" for s in sums])


def quantiles(df: DataFrame, value: Column, shares: list[float]) -> DataFrame:
    """One row with the array ``quantiles`` of the non-null values at ``shares``, exact, between two values by their distance."""
    groups = df.select(value.cast("double").alias("x")).where("x IS NOT NULL").groupBy("x").agg(F.count("*").alias("n"))
    total = F.max("upto_n")
    upto = cumulated(groups, "x", ["n"])
    one = upto.agg(total.alias("total"))
    places = [(F.col("total") - 1) * F.lit(s) for s in shares]

    def at(place: Column) -> Column:
        return F.min(F.when(F.col("upto_n") > place, F.col("x")))

    ends = upto.crossJoin(F.broadcast(one)).groupBy("total").agg(*[at(F.floor(p)).alias(f"a{i}") for i, p in enumerate(places)], *[at(F.ceil(p)).alias(f"b{i}") for i, p in enumerate(places)])
    between = [F.col(f"a{i}") + (F.col(f"b{i}") - F.col(f"a{i}")) * (p - F.floor(p)) for i, p in enumerate(places)]
    return ends.select(F.array(*between).alias("quantiles"))


def group_quantiles(df: DataFrame, by: list[str], value: Column, shares: list[float]) -> DataFrame:
    """For every group of ``by`` the array ``quantiles`` of its non-null values at ``shares``, exact, between two values by their distance.

    ``by`` must not be null. A group is summed up by ranges of values, so the largest one needs no more memory than a range has.
    """
    groups = df.select(*by, value.cast("double").alias("x")).where("x IS NOT NULL").groupBy(*by, "x").agg(F.count("*").alias("n"))
    upto = cumulated(groups, "x", ["n"], by=by)
    whole = upto.groupBy(*by).agg(F.max("upto_n").alias("total"))
    both = upto.join(whole, by)
    at = lambda place: F.min(F.when(F.col("upto_n") > place, F.col("x")))
    places = [(F.col("total") - 1) * F.lit(s) for s in shares]
    ends = both.groupBy(*by, "total").agg(*[at(F.floor(p)).alias(f"a{i}") for i, p in enumerate(places)], *[at(F.ceil(p)).alias(f"b{i}") for i, p in enumerate(places)])
    between = [F.col(f"a{i}") + (F.col(f"b{i}") - F.col(f"a{i}")) * (p - F.floor(p)) for i, p in enumerate(places)]
    return ends.select(*by, F.array(*between).alias("quantiles"))


def numbered(df: DataFrame, order: list[Column], sort_key: Column, out: str) -> DataFrame:
    """Add ``out``, the place of each row in ``order`` from 1; ``sort_key`` is a number that never falls along it.

    Rows are cut into ranges of ``sort_key`` and numbered within them. Rows with one key lie in one range,
    so the key should tell most rows apart; null keys come last.
    """
    x = sort_key.cast("double")
    edges = df.agg(F.percentile_approx(x, F.array(*[F.lit(i / RANGES) for i in range(1, RANGES)]), F.lit(10 * RANGES)).alias("_edges"))
    cut = df.crossJoin(F.broadcast(edges)).withColumn("_range", F.when(x.isNull(), RANGES).otherwise(F.size(F.filter(F.coalesce("_edges", F.array().cast("array<double>")), lambda e: e < x)))).drop("_edges")
    before = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    bases = cut.groupBy("_range").agg(F.count("*").alias("_n")).select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return cut.withColumn("_inner", inside).join(F.broadcast(bases), "_range").withColumn(out, (F.col("_base") + F.col("_inner")).cast("long")).drop("_range", "_inner", "_base")
