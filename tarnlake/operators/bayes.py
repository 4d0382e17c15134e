"""A naive Bayes model of yes/no features, fitted for many groups at once, and with every row left out of its own fold's model."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Added to every count, so that nothing is impossible.
SMOOTHING = 1.0


def sums(rows: DataFrame, by: list[str], hit: Column, features: Mapping[str, Column]) -> DataFrame:
    """Per group the rows with and without a hit (``n_1, n_0``), and of these the rows with each feature (``k_1_<name>, k_0_<name>``).

    This is all that the model needs: one aggregation fits every group, combined before the shuffle.
    """
    y = F.coalesce(hit, F.lit(False))
    counts = [F.count_if(y).alias("n_1"), F.count_if(~y).alias("n_0")]
    for name, x in features.items():
        counts += [F.count_if(y & x).alias(f"k_1_{name}"), F.count_if(~y & x).alias(f"k_0_{name}")]
    return rows.groupBy(*by).agg(*counts)


def columns(features: Mapping[str, Column]) -> list[str]:
    return ["n_1", "n_0", *(f"k_{y}_{name}" for name in features for y in (1, 0))]


def probability(features: Mapping[str, Column], count: Mapping[str, Column]) -> Column:
    """Of a hit, from a row's ``features`` and the ``count``s of its model (by the names that ``sums`` gives)."""
    s = F.lit(SMOOTHING)
    n1, n0 = count["n_1"], count["n_0"]
    odds = F.ln(n1 + s) - F.ln(n0 + s)
    both = F.ln(n0 + 2 * s) - F.ln(n1 + 2 * s)
    for name, x in features.items():
        k1, k0 = count[f"k_1_{name}"], count[f"k_0_{name}"]
        odds = odds + F.when(x, F.ln(k1 + s) - F.ln(k0 + s)).otherwise(F.ln(n1 - k1 + s) - F.ln(n0 - k0 + s)) + both
    return 1 / (1 + F.exp(-odds))


def scores(train: DataFrame, rows: DataFrame, by: list[str], fold: Column, seen: Column, hit: Column, features: Mapping[str, Column], out: str) -> DataFrame:
    """``rows`` with ``out``: the score of their group's model, fitted on the rows of ``train``; rows that it has ``seen`` get the model without their ``fold``.

    Folds are whole entities, so no entity's rows stand on both sides. Counts by group and fold give all models: a fold's own
    counts are taken from its group's. A group without training rows has even odds.
    """
    names = columns(features)
    per = sums(train.withColumn("_fold", fold), [*by, "_fold"], hit, features)
    whole = (per.groupBy(*by) if by else per.groupBy()).agg(*[F.sum(c).alias(f"_all_{c}") for c in names])
    own = per.select(*by, "_fold", *[F.col(c).alias(f"_own_{c}") for c in names])
    each = rows.withColumn("_fold", fold)
    each = each.join(whole, by, "left") if by else each.crossJoin(whole)  # one row of sums
    each = each.join(own, [*by, "_fold"], "left")
    zero = F.lit(0)
    count = {c: F.coalesce(f"_all_{c}", zero) - F.when(seen, F.coalesce(f"_own_{c}", zero)).otherwise(zero) for c in names}
    return each.withColumn(out, probability(features, count)).drop("_fold", *[f"_{w}_{c}" for w in ("all", "own") for c in names])


def odds_sql(features: list[str], count: str) -> str:
    """The score as SQL; ``count`` is a template for the name of a count, features are columns of 0 and 1."""
    c = lambda name: count.format(name)
    both = f"(ln({c('n_0')} + 2) - ln({c('n_1')} + 2))"
    terms = [f"ln({c('n_1')} + 1) - ln({c('n_0')} + 1)"]
    for x in features:
        k1, k0 = c(f"k_1_{x}"), c(f"k_0_{x}")
        terms.append(f"CASE WHEN {x} = 1 THEN ln({k1} + 1) - ln({k0} + 1) ELSE ln({c('n_1')} - {k1} + 1) - ln({c('n_0')} - {k0} + 1) END + {both}")
    return f"1 / (1 + exp(-({reduce(lambda a, b: f'{a} + {b}', terms)})))"
