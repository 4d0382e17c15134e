"""Decisions over yearly windows: champion's settings, scores, guards, a log of what was decided."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.functions.columns import ratio, wilson
from tarnlake.functions.ranks import group_quantiles
from tarnlake.operators import bayes
from tarnlake.operators.drift import RESAMPLES, interval, resampled, windows
from tarnlake.sources import sinks

#: What a model version's tags mean when one is missing; fixed values.
DEFAULTS = {"train_from": "1995-01-01", "train_to": "1998-12-01", "cutoff": "50"}


def champion_meta(history: DataFrame) -> DataFrame:
    """Typed settings of model versions from their text ``tags``; scoring starts no earlier than training ends."""
    tag = lambda k: F.coalesce(F.col("tags")[k], F.lit(DEFAULTS.get(k)))
    return history.select("version", tag("train_from").cast("date").alias("train_from"), tag("train_to").cast("date").alias("train_to"),
                          F.greatest(tag("train_to").cast("date"), F.col("tags")["scoring_start"].try_cast("date")).alias("scoring_start"), tag("cutoff").try_cast("double").alias("cutoff"))


def ranking_guard(scored: DataFrame, key: str, champion: str, challenger: str, hit: str, resamples: int = RESAMPLES, seed: int = 7) -> DataFrame:
    """``low, mid, high`` of the challenger's average precision less the champion's over resampled clusters, and whether it ranks clearly worse.

    Weighted precision needs rows by score only: clusters' weights are summed for every resample and
    score before anything is sorted. Without a hit nothing is judged.
    """
    from pyspark.sql import Window

    both = scored.select(key, F.col(hit).cast("int").alias("y"), F.explode(F.array(F.struct(F.lit(0).alias("who"), F.col(champion).alias("s")), F.struct(F.lit(1).alias("who"), F.col(challenger).alias("s")))).alias("x")).select(key, "y", "x.*")
    per = both.groupBy(key, "who", "s").agg(F.sum("y").alias("k"), F.count("*").alias("n"))
    steps = resampled(per, key, ["k", "n"], ["who", "s"], resamples, seed)
    upto = Window.partitionBy("b", "who").orderBy(F.desc("s")).rowsBetween(Window.unboundedPreceding, 0)
    steps = steps.withColumn("rank", F.sum("n").over(upto)).withColumn("tp", F.sum("k").over(upto))
    precision = steps.groupBy("b", "who").agg(F.try_divide(F.sum(F.col("k") * F.col("tp") / F.col("rank")), F.sum("k")).alias("ap"))
    draws = precision.groupBy("b").agg((F.max(F.when(F.col("who") == 1, F.col("ap"))) - F.max(F.when(F.col("who") == 0, F.col("ap")))).alias("d"))
    hits = scored.agg(F.count_if(hit).alias("hits"))
    out = interval(draws, F.col("d")).crossJoin(hits)
    return out.withColumn("verdict", F.when(F.col("hits") == 0, "not judged").when(F.col("high") < 0, "clearly worse").otherwise("not clearly worse"))


def cursors(rows: DataFrame, dates: list[str], train_months: int = 36) -> DataFrame:
    """``rows`` once for every date at which a decision is due, with what they are for it.

    ``window`` is ``check``, ``cut`` or null; ``trains`` says whether a challenger of that date learns from the row: admitted in
    the ``train_months`` before the check window, its outcome known on the date. A row without any use is left out.
    """
    each = rows.withColumn("as_of", F.explode(F.array(*[F.lit(x).cast("date") for x in dates])))
    w = windows(F.col("as_of"))
    inside = lambda a, b: (F.col("admit_day") > a) & (F.col("admit_day") <= b)
    window = F.when(inside(w["check_from"], w["check_to"]), "check").when(inside(w["cut_from"], w["cut_to"]), "cut")
    trains = inside(F.add_months(w["check_from"], -train_months), w["check_from"]) & (F.col("discharge_day") <= w["check_to"])
    return each.withColumn("window", window).withColumn("trains", trains).where("window IS NOT NULL OR trains")


def challenged(rows: DataFrame, dates: list[str], features: Mapping[str, Column], hit: str, fold: Column) -> DataFrame:
    """``cursors`` with ``challenger``: the score of the model trained for each date, without their own fold for the rows that it learnt from.

    All dates' models come from one aggregation by date and fold.
    """
    each = cursors(rows, dates)
    return bayes.scores(each.where("trains"), each.where("window IS NOT NULL"), ["as_of"], fold, F.col("trains"), F.col(hit), features, "challenger")


def decisions(scored: DataFrame, champion: str, challenger: str, cutoff: float, budget: float) -> DataFrame:
    """One row per date: what the champion flags in the check window, whether that calls for action, and the smallest change that helps.

    ``scored`` has ``as_of, window`` and both scores. The target share must lie inside the interval of the flag rate. Tried in
    order: the cutoff as it is; the champion with a cutoff from the window before; the challenger with its own cutoff from there.
    """
    cut = scored.where("window = 'cut'")
    new, own = (group_quantiles(cut, ["as_of"], F.col(c), [1 - budget]).select("as_of", F.col("quantiles")[0].alias(name)) for c, name in ((champion, "new_cutoff"), (challenger, "own_cutoff")))
    check = scored.where("window = 'check'").join(new, "as_of", "left").join(own, "as_of", "left")
    flags = {"keep": F.col(champion) > cutoff, "new cutoff": F.col(champion) > F.col("new_cutoff"), "retrain": F.col(challenger) > F.col("own_cutoff")}
    counts = check.groupBy("as_of").agg(F.count("*").alias("n"), *[F.count_if(v).alias(k) for k, v in flags.items()])
    fits = {k: F.lit(budget).between(*wilson(F.col(f"`{k}`"), F.col("n"))) for k in flags}
    action = F.when(fits["keep"], "keep").when(fits["new cutoff"], "new cutoff").when(fits["retrain"], "retrain").otherwise("no candidate")
    return counts.select("as_of", "n", ratio(F.col("keep"), F.col("n")).alias("rate"), (~fits["keep"]).alias("triggered"), action.alias("action"))


def replay(spark: SparkSession, decided: DataFrame, dates: list[str], path: str, live: str) -> DataFrame:
    """The decisions written to a history one date after the other, the live one after all replays; a date that is there is refused."""
    if sorted(dates) != dates or len(set(dates)) != len(dates) or live <= dates[-1]:
        raise ValueError("dates are replayed in order, each once, before the live one")
    schema = decided.withColumns({"mode": F.lit("replay"), "step": F.lit(0)}).schema
    sinks.create_if_absent(spark, path, schema)
    for step, date in enumerate([*dates, live]):
        if not spark.read.schema(schema).parquet(path).where(F.col("as_of") == F.lit(date).cast("date")).isEmpty():
            raise ValueError(f"{date} was decided before")
        row = decided.where(F.col("as_of") == F.lit(date).cast("date"))
        sinks.append(row.withColumns({"mode": F.lit("live" if date == live else "replay"), "step": F.lit(step)}), path, schema)
    return spark.read.schema(schema).parquet(path)
