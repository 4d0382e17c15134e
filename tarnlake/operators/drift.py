"""Model evaluation, drift and retraining decisions, computed in Spark."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tarnlake.functions.columns import ratio, wilson
from tarnlake.functions.ranks import cumulated, quantiles

FLOOR, BINS = 1e-4, 10


#: Upper bounds of the index, each with what it says up to there; beyond the last one a feature has shifted.
STEADY, BEYOND = ((0.1, False, "stable"), (0.25, True, "watch")), "shifted"
#: How far a flag's rate may lie from training before that matters, if it lies outside the interval.
MATERIAL = 0.05


def unpivoted(rows: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """``feature, number, label`` of every row and feature: numbers as doubles, the rest as text."""
    one = [F.struct(F.lit(f).alias("feature"), (F.col(f).cast("double") if k == "number" else F.lit(None).cast("double")).alias("number"), (F.lit(None).cast("string") if k == "number" else F.col(f).cast("string")).alias("label")) for f, k in kinds.items()]
    return rows.select("production", F.explode(F.array(*one)).alias("v")).select("production", "v.*")


def counted_bins(train: DataFrame, prod: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """``feature, bin, before, now``: rows of both sides in every bin of every feature, in one grouped pass.

    Numbers fall into right-closed bins at training's deciles; a missing number has a bin of its own.
    A missing label is a label; labels that training never had lie in one bin.
    """
    numeric = [f for f, k in kinds.items() if k == "number"]
    both = train.withColumn("production", F.lit(False)).unionByName(prod.withColumn("production", F.lit(True)), allowMissingColumns=True)
    values = unpivoted(both, kinds)
    for f in numeric:
        deciles = quantiles(train, F.col(f), [i / BINS for i in range(1, BINS)]).select(F.array_distinct("quantiles").alias(f"_{f}"))
        values = values.crossJoin(F.broadcast(deciles))
    number = F.lit(None).cast("string")
    for f in numeric:
        x = F.col("number")
        number = F.when(F.col("feature") == f, F.when(x.isNull() | F.isnan(x), "none").otherwise(F.size(F.filter(f"_{f}", lambda e: e < x)).cast("string"))).otherwise(number)
    bins = values.withColumn("bin", F.when(F.col("feature").isin(numeric), number).otherwise(F.coalesce("label", F.lit("<missing>"))))
    counts = bins.groupBy("feature", "bin").agg(F.count_if(~F.col("production")).alias("before"), F.count_if("production").alias("now"))
    known = F.col("feature").isin(numeric) | (F.col("before") > 0)
    return counts.groupBy("feature", F.when(known, F.col("bin")).otherwise("<unseen>").alias("bin")).agg(F.sum("before").alias("before"), F.sum("now").alias("now"))


def stability(counts: DataFrame) -> DataFrame:
    """``feature, psi``: how far the shares of the bins moved."""
    whole = Window.partitionBy("feature")
    share = lambda c: F.greatest(F.col(c).cast("double") / F.sum(c).over(whole), F.lit(FLOOR))
    moved = counts.select("feature", share("before").alias("p"), share("now").alias("q"))
    return moved.groupBy("feature").agg(F.sum((F.col("q") - F.col("p")) * F.ln(F.col("q") / F.col("p"))).alias("psi"))


def psi(train: DataFrame, prod: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """``feature, psi`` for numbers and categories."""
    return stability(counted_bins(train, prod, kinds))


def status(value: Column) -> Column:
    """What the bounds say of an index."""
    said = F.lit(BEYOND)
    for bound, closed, word in reversed(STEADY):
        said = F.when(value <= bound if closed else value < bound, word).otherwise(said)
    return said


def interval_status(reference: Column, k: Column, n: Column) -> Column:
    """Stable while the reference rate lies in the interval of k out of n."""
    return F.when(reference.between(*wilson(k, n)), STEADY[0][2]).otherwise(BEYOND)


def rate_status(reference: Column, k: Column, n: Column, material: float = MATERIAL) -> Column:
    """As :func:`interval_status`, but only to be watched while the rate is near the reference."""
    near = F.abs(ratio(k, n) - reference) < material
    return F.when(reference.between(*wilson(k, n)), STEADY[0][2]).when(near, STEADY[1][2]).otherwise(BEYOND)


def drift_report(train: DataFrame, prod: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """``feature, psi, status``, every feature from the same pass over both sides.

    The index of a yes/no feature is nearly blind to changes of a rate, so such a feature is judged
    by its production rate against training's.
    """
    counts = counted_bins(train, prod, kinds)
    yes = F.col("bin") == "true"
    rates = counts.groupBy("feature").agg(*[F.sum(F.when(c, F.col(v))).cast("double").alias(a) for a, c, v in (("hit", yes, "before"), ("all", F.lit(True), "before"), ("k", yes, "now"), ("n", F.lit(True), "now"))]).fillna(0.0, ["hit", "k"])
    flags = F.col("feature").isin([f for f, k in kinds.items() if k == "flag"])
    told = F.when(flags, rate_status(ratio(F.col("hit"), F.col("all")), F.col("k"), F.col("n"))).otherwise(status(F.col("psi")))
    return stability(counts).join(rates, "feature").select("feature", "psi", told.alias("status"))


def unseen_categories(train: DataFrame, prod: DataFrame, column: str) -> DataFrame:
    """``category, rows, share`` of production rows whose category training never had."""
    counts = counted_categories(train, prod, column)
    total = F.sum("now").over(Window.partitionBy(F.lit(0)))
    return counts.withColumn("share", F.col("now") / total).where("before = 0 AND now > 0").select("category", F.col("now").alias("rows"), "share")


def counted_categories(train: DataFrame, prod: DataFrame, column: str) -> DataFrame:
    both = train.select(F.col(column).alias("category"), F.lit(False).alias("production")).unionByName(prod.select(F.col(column).alias("category"), F.lit(True).alias("production")))
    return both.groupBy("category").agg(F.count_if(~F.col("production")).alias("before"), F.count_if("production").alias("now"))


def time_split(signals: DataFrame, start: str, boundary: str, cutoff: str) -> DataFrame:
    """``part``: train (admitted from ``start`` and before ``boundary``, discharged by ``cutoff``), production (admitted from ``boundary``), gap."""
    d = lambda x: F.lit(x).cast("date")
    train = (F.col("admit_day") >= d(start)) & (F.col("admit_day") < d(boundary)) & (F.col("discharge_day") <= d(cutoff))
    return signals.withColumn("part", F.when(train, "train").when(F.col("admit_day") >= d(boundary), "production").otherwise("gap"))


def average_precision(scored: DataFrame, score: str, hit: str) -> DataFrame:
    """Area under the steps of the precision-recall curve; rows of one score enter together."""
    g = scored.groupBy(F.col(score).cast("double").alias("s")).agg(F.count("*").alias("n"), F.count_if(hit).alias("k"))
    steps = cumulated(g, "s", ["n", "k"], descending=True)
    return steps.agg((F.sum(F.col("k") * F.col("upto_k") / F.col("upto_n")) / F.sum("k")).alias("average_precision"))


def threshold(scored: DataFrame, score: str, share: float) -> DataFrame:
    """The score above which ``share`` of the rows lies."""
    return quantiles(scored, F.col(score), [1.0 - share]).select(F.col("quantiles")[0].alias("cutoff"))


def recall_at(scored: DataFrame, score: str, hit: str, k: int, id: str) -> DataFrame:
    """Share of the hits among the k highest scores, ties to the smaller id."""
    top = scored.orderBy(F.desc(score), id).limit(k).agg(F.count_if(hit).alias("caught"))
    return top.crossJoin(scored.agg(F.count_if(hit).alias("hits"))).select("caught", "hits", ratio(F.col("caught"), F.col("hits")).alias("recall"))


def evaluate(scored: DataFrame, score: str, hit: str, probability: str, budget: float, groups: dict[str, Column]) -> DataFrame:
    """Per group of rows: flagged hits and misses under one cutoff for all, recall with its interval, average precision and Brier score."""
    rows = scored.crossJoin(F.broadcast(threshold(scored, score, budget))).withColumn("flag", F.col(score) > F.col("cutoff"))
    own = rows.withColumn("rows", F.explode(F.array_compact(F.array(*[F.when(test, name) for name, test in groups.items()]))))
    y = F.when(F.col(hit), 1.0).otherwise(0.0)
    counts = own.groupBy("rows").agg(F.count("*").alias("n"), F.count_if(hit).alias("hits"), F.count_if(F.col("flag") & F.col(hit)).alias("caught"), F.count_if(~F.col("flag") & F.col(hit)).alias("missed"), F.avg(F.pow(F.col(probability) - y, F.lit(2))).alias("brier"))
    precision = reduce(DataFrame.unionByName, [average_precision(scored.where(test), score, hit).withColumn("rows", F.lit(name)) for name, test in groups.items()])
    low, high = wilson(F.col("caught"), F.col("hits"))
    return counts.join(F.broadcast(precision), "rows").withColumns({"recall": ratio(F.col("caught"), F.col("hits")), "recall_low": low, "recall_high": high})


#: Cumulative chances of a Poisson(1) count of 0, 1, 2, ...; fixed values.
POISSON = [0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238462, 0.9963401531726563, 0.9994058151824183]
RESAMPLES = 1000


#: Draws that one digest gives: 32 bits each.
PER_DIGEST = 4


#: Tasks that draw, whatever the input's size: each sends on one row per group and resample, so that number bounds what is shuffled.
DRAWING = 32
#: Rows that are weighted at once, and groups whose totals a task holds before it sends them on.
WEIGHED, HELD = 1000, 1000


def weights(keys: Sequence[str | None], resamples: int, seed: int) -> np.ndarray:
    """A row of Poisson(1) counts per key, one for every resample, by a digest of seed, key and block of four resamples."""
    blocks = [str(k).encode() for k in range(-(-resamples // PER_DIGEST))]
    heads = [(f"{seed}:" if k is None else f"{seed}:{k}:").encode() for k in keys]
    u = np.frombuffer(b"".join(hashlib.md5(head + block).digest() for head in heads for block in blocks), ">u4").reshape(len(heads), -1)[:, :resamples]
    return np.searchsorted(np.array([s * 2.0**32 for s in POISSON]), u.ravel(), side="right").reshape(u.shape).astype("float64")


def drawn(per: DataFrame, key: str, resamples: int = RESAMPLES, seed: int = 7) -> DataFrame:
    """``per`` once for every resample ``b`` (from 0) with the Poisson(1) weight ``w`` of its cluster, weights of 0 left out.

    The draws of ``resampled`` row by row, for small tables: a row of ``per`` becomes about 632.
    """
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"), F.col("_block").cast("string")))
    blocks = per.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit((resamples - 1) // PER_DIGEST)))).withColumn("_digest", digest)

    def weight(i: int) -> Column:
        u = F.conv(F.substring("_digest", 8 * i + 1, 8), 16, 10).cast("double") / (1 << 32)
        return reduce(lambda x, y: x + y, [(u >= s).cast("int") for s in POISSON])

    each = F.array(*[F.struct((F.col("_block") * PER_DIGEST + i).alias("b"), weight(i).alias("w")) for i in range(PER_DIGEST)])
    return blocks.withColumn("_x", F.explode(each)).where(f"_x.w > 0 AND _x.b < {resamples}").select(*per.columns, "_x.b", "_x.w")


def drawn_sql(per: str, key: str, resamples: int = RESAMPLES, seed: int = 7) -> str:
    """The draws of ``resampled`` as SQL over ``per``: a row with weight ``w`` for every resample ``b``, weights of 0 left out."""
    u = f"(('0x' || substr(md5(concat_ws(':', '{seed}', {key}, b // {PER_DIGEST})), 8 * (b % {PER_DIGEST}) + 1, 8))::BIGINT / 4294967296.0::DOUBLE)"
    return f"SELECT * FROM (SELECT *, {' + '.join(f'(u >= {s}::DOUBLE)::INT' for s in POISSON)} AS w FROM (SELECT *, {u} AS u FROM {per}, range({resamples}) r(b))) WHERE w > 0"


def resampled(per: DataFrame, key: str, sums: list[str], by: list[str] | None = None, resamples: int = RESAMPLES, seed: int = 7) -> DataFrame:
    """``by``, ``b`` (from 0) and the weighted totals of ``sums`` as doubles, for every group and every resample of whole clusters that draws a row of it.

    Instead of drawing clusters with replacement, each cluster gets a Poisson(1) weight per resample (``weights``): a rerun, or
    another engine, draws the same. A task takes a share of the clusters through all resamples as products of matrices,
    so rows are never multiplied by resamples; it sends on one row per group and resample.
    """
    by = by or []
    fields = [per.schema[c] for c in by]
    out = T.StructType([*fields, T.StructField("b", T.IntegerType()), *[T.StructField(s, T.DoubleType()) for s in sums]])
    target = pa.schema([pa.field(f.name, to_arrow_type(f.dataType)) for f in out])
    width = 1 + 2 * len(sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for group, total in held.items():
                at = np.flatnonzero(total[0])
                names = [pa.array([v] * len(at), target.field(i).type) for i, v in enumerate(group)]
                values = [pa.array(total[1 + i][at], pa.float64(), mask=total[1 + len(sums) + i][at] == 0) for i in range(len(sums))]
                yield pa.RecordBatch.from_arrays([*names, pa.array(at, pa.int32()), *values], schema=target)
            held.clear()

        for whole in batches:
            for first in range(0, whole.num_rows, WEIGHED):
                batch = whole.slice(first, WEIGHED)
                known: dict[str | None, int] = {}
                place = np.array([known.setdefault(k, len(known)) for k in batch.column("_key").to_pylist()])
                w = weights(list(known), resamples, seed)
                columns = [batch.column(s) for s in sums]
                there = np.array([c.is_valid().to_numpy(zero_copy_only=False) for c in columns], dtype="float64")
                x = np.vstack([np.ones((1, batch.num_rows)), *[c.fill_null(0.0).to_numpy(zero_copy_only=False)[None] for c in columns], there])
                members: dict[tuple, list[int]] = {}
                groups = zip(*[batch.column(c).to_pylist() for c in by], strict=True) if by else [()] * batch.num_rows
                for i, group in enumerate(groups):
                    members.setdefault(group, []).append(i)
                for group, rows in members.items():
                    if group not in held:
                        if len(held) >= HELD:
                            yield from flush()
                        held[group] = np.zeros((width, resamples))
                    held[group] += x[:, rows] @ w[place[rows]]
        yield from flush()

    rows = per.select(*by, F.col(key).cast("string").alias("_key"), *[F.col(s).cast("double").alias(s) for s in sums])
    each = rows.repartition(DRAWING, "_key").sortWithinPartitions("_key").mapInArrow(run, out)
    return each.groupBy(*by, "b").agg(*[F.sum(s).alias(s) for s in sums])


def interval(draws: DataFrame, value: Column) -> DataFrame:
    """2.5, 50 and 97.5 percentiles over resamples, of which there are a fixed number."""
    q = draws.agg(F.percentile(value, F.array(*[F.lit(x) for x in (0.025, 0.5, 0.975)])).alias("q"))
    return q.select(F.col("q")[0].alias("low"), F.col("q")[1].alias("mid"), F.col("q")[2].alias("high"))


def cluster_bootstrap(scored: DataFrame, key: str, first: Column, second: Column, resamples: int = RESAMPLES, seed: int = 7) -> DataFrame:
    """The interval of the difference between two scorers' means, over resamples of whole clusters."""
    per = scored.groupBy(key).agg(F.sum(first).alias("a"), F.sum(second).alias("b_"), F.count(first).alias("n"))
    draws = resampled(per, key, ["a", "b_", "n"], resamples=resamples, seed=seed)
    return interval(draws, F.try_divide(F.col("a") - F.col("b_"), F.col("n")))


def cut_bootstrap(scored: DataFrame, key: str, score: str, rule: Column, hit: str, share: float, resamples: int = RESAMPLES, seed: int = 7) -> DataFrame:
    """The interval of the score's recall at its cutoff (``share`` of the rows) less the rule's, over resamples of whole clusters.

    The rule flags more rows than the cutoff; thinned at random to as many, it would catch the same share
    of its hits as it keeps of its flags, so that its recall needs no drawing.
    """
    rows = scored.crossJoin(F.broadcast(threshold(scored, score, share)))
    one = lambda test: F.sum(test.cast("double"))
    flag, good = F.col(score) > F.col("cutoff"), F.col(hit)
    per = rows.groupBy(key).agg(one(flag).alias("flags"), one(rule).alias("ruled"), one(flag & good).alias("caught"), one(rule & good).alias("by_rule"), one(good).alias("hits"))
    draws = resampled(per, key, ["flags", "ruled", "caught", "by_rule", "hits"], resamples=resamples, seed=seed)
    thinned = F.col("by_rule") * F.least(F.lit(1.0), F.try_divide(F.col("flags"), F.col("ruled")))
    return interval(draws, F.try_divide(F.col("caught") - F.coalesce(thinned, F.lit(0.0)), F.col("hits")))


def verdict(low: Column, hits: Column, least: int = 30) -> Column:
    """A scorer beats another if the lower bound of their difference is above zero, given enough hits to tell."""
    return F.when(hits < least, "too few").when(low > 0, "beats").otherwise("no better")


def verdicts(scored: DataFrame, group: str, key: str, first: Column, second: Column, hit: str, resamples: int = RESAMPLES, seed: int = 7) -> DataFrame:
    """``group, low, hits, verdict``: per group, whether ``second``'s mean error is surely below ``first``'s."""
    per = scored.groupBy(group, key).agg(F.sum(first - second).alias("gain"), F.count("*").alias("n"))
    draws = resampled(per, key, ["gain", "n"], [group], resamples, seed).select(group, F.try_divide("gain", "n").alias("d"))
    bounds = draws.groupBy(group).agg(F.percentile("d", F.lit(0.025)).alias("low"))
    hits = scored.groupBy(group).agg(F.count_if(hit).alias("hits"))
    return bounds.join(hits, group).select(group, "low", "hits", verdict(F.col("low"), F.col("hits")).alias("verdict"))


def windows(as_of: Column, months: int = 12, known_after: int = 30) -> dict[str, Column]:
    """Check window: the months before ``as_of`` whose outcomes are known; cutoff window: the months before that."""
    end = F.date_sub(as_of, known_after)
    return {"check_from": F.add_months(end, -months), "check_to": end, "cut_from": F.add_months(end, -2 * months), "cut_to": F.add_months(end, -months)}


def flag_rates(signals: DataFrame, flag: Column, by: Column) -> DataFrame:
    """Rate of a flag by group, with its interval and whether a budget lies inside."""
    g = signals.groupBy(by.alias("part")).agg(F.count("*").alias("n"), F.count_if(flag).alias("k"))
    low, high = wilson(F.col("k"), F.col("n"))
    return g.withColumn("rate", ratio(F.col("k"), F.col("n"))).withColumn("low", low).withColumn("high", high)
