"""Rules, quarantine, gates and reconciliation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tarnlake.functions.columns import violations


def quarantine(typed: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that pass all rules, and whole failing rows with the names of the rules they fail."""
    marked = typed.withColumn("violations", violations(rules))
    return marked.where(F.size("violations") == 0).drop("violations"), marked.where(F.size("violations") > 0)


def row_gate(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """``rule, failures``: how many rows break each rule; a null counts as broken. One pass, one row per rule."""
    sums = df.agg(*[F.count_if(~F.coalesce(ok, F.lit(False))).alias(name) for name, ok in rules.items()])
    pairs = F.array(*[F.struct(F.lit(name).alias("rule"), F.col(name).alias("failures")) for name in rules])
    return sums.select(F.explode(pairs).alias("x")).select("x.rule", "x.failures")


def enforce(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """``df`` unchanged, or an error naming the broken rules; for use before a table is replaced."""
    broken = {r["rule"]: r["failures"] for r in row_gate(df, rules).where("failures > 0").collect()}
    if broken:
        raise ValueError(f"rows break rules: {broken}")
    return df


def gate(counts: dict[str, DataFrame]) -> DataFrame:
    """``name, violations`` from one-row frames, each with one count."""
    rows = [d.toDF("violations").select(F.lit(name).alias("name"), F.col("violations").cast("long").alias("violations")) for name, d in counts.items()]
    return reduce(DataFrame.unionByName, rows)


def key_copies(df: DataFrame, *key: str) -> DataFrame:
    """Rows beyond the first of their key, as one count."""
    return df.agg((F.count("*") - F.count_distinct(F.struct(*key))).alias("copies"))


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str) -> DataFrame:
    """Child rows whose key is set but unknown to the parent, as one count."""
    known = parent.select(F.col(parent_key).alias(key)).distinct()
    return child.where(F.col(key).isNotNull()).join(known, key, "left_anti").agg(F.count("*").alias("orphans"))


def fingerprint(df: DataFrame, *without: str) -> DataFrame:
    """Rows and an order-free sum of row digests (15 hex digits of the md5 of all values as text), for a before and after comparison."""
    values = [F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in df.columns if c not in without]
    digest = F.conv(F.substring(F.md5(F.concat_ws("\u0001", *values)), 1, 15), 16, 10).cast("decimal(38,0)")
    return df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(digest), F.lit(0)).cast("string").alias("digest_sum"))


def schema_difference(a: StructType, b: StructType) -> list[tuple[str, str]]:
    """(name, type) pairs in one schema only; nullability doesn't count."""
    one, two = ({(f.name, f.dataType.simpleString()) for f in s.fields} for s in (a, b))
    return sorted(one ^ two)


def reconcile(a: DataFrame, b: DataFrame, *without: str) -> DataFrame:
    """Rows of two builds of one table and rows that only one of them has, copies counted, as one row."""
    columns = [c for c in a.columns if c not in without]
    left, right = a.select(*columns), b.select(*columns)
    both = left.withColumn("_d", F.lit(1)).unionByName(right.withColumn("_d", F.lit(-1))).groupBy(*columns).agg(F.sum("_d").alias("_d"), F.count_if(F.col("_d") == 1).alias("_l"), F.count_if(F.col("_d") == -1).alias("_r"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return both.agg(total("_l").alias("left_rows"), total("_r").alias("right_rows"), total(F.greatest("_d", F.lit(0))).alias("only_left"), total(F.greatest(-F.col("_d"), F.lit(0))).alias("only_right"))


def contract(df: DataFrame, declared: StructType) -> list[tuple[str, str]]:
    """Declared columns that are missing or of another type."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return [(f.name, f.dataType.simpleString()) for f in declared.fields if have.get(f.name) != f.dataType.simpleString()]


NUMBERS = {"double", "float", "decimal", "integer", "long", "short", "byte"}


def _folded(df: DataFrame, letter: str) -> tuple[DataFrame, list[str], list[str]]:
    """Columns named by place, texts without case or outer blanks and numbers as doubles; the names of either."""
    names = [f"{letter}{i}" for i in range(len(df.columns))]
    number = [f.dataType.typeName() in NUMBERS for f in df.schema.fields]
    columns = [F.col(f"`{f.name}`").cast("double") if n else F.lower(F.trim(F.col(f"`{f.name}`").cast("string"))) for f, n in zip(df.schema.fields, number, strict=True)]
    out = df.select(*[c.alias(x) for c, x in zip(columns, names, strict=True)])
    return out, [x for x, n in zip(names, number, strict=True) if not n], [x for x, n in zip(names, number, strict=True) if n]


def _summary(df: DataFrame, texts: list[str], numbers: list[str]) -> dict[str, tuple]:
    """Per column, what doesn't depend on the order of rows: of a text its rows and hashes, of a number its rows, extremes and sum."""
    one = [F.struct(F.count(x), F.sum(F.xxhash64(x).cast("decimal(38,0)"))).alias(x) for x in texts] + [F.struct(F.count(x), F.min(x), F.max(x), F.sum(x)).alias(x) for x in numbers]
    row = df.agg(*one, F.count("*").alias("rows")).first()
    return {x: tuple(row[x]) for x in [*texts, *numbers]} | {"": (row["rows"],)}


def same_results(expected: DataFrame, actual: DataFrame, within: float = 0.005) -> DataFrame:
    """Whether two results hold the same rows, as one row ``same``.

    Rows and columns come in any order, and ``actual`` may have more columns. Texts are compared without
    case or outer blanks, numbers up to ``within``. A column is paired with the first free one of
    its kind whose values agree as a whole. Then rows of equal texts are sorted by their
    numbers on both sides and compared place by place, so no edge of a grid splits a pair.
    """
    spark = expected.sparkSession
    (left, left_texts, left_numbers), (right, right_texts, right_numbers) = _folded(expected, "x"), _folded(actual, "y")
    mine, other = _summary(left, left_texts, left_numbers), _summary(right, right_texts, right_numbers)

    def near(a: tuple, b: tuple) -> bool:
        rows = max(a[0], 1)
        return a[0] == b[0] and all(p == q or None not in (p, q) and abs(p - q) <= t for p, q, t in zip(a[1:], b[1:], (within, within, within * rows), strict=True))

    pairs: list[tuple[str, str]] = []
    for x in [*left_texts, *left_numbers]:
        text = x in left_texts
        free = [y for y in (right_texts if text else right_numbers) if y not in {q for _, q in pairs}]
        pairs += [(x, y) for y in free if (mine[x] == other[y] if text else near(mine[x], other[y]))][:1]
    if len(pairs) < len(left.columns) or mine[""] != other[""]:
        return spark.createDataFrame([(False,)], "same boolean")
    texts, numbers = ([(x, y) for x, y in pairs if (x in left_texts) == t] for t in (True, False))

    def placed(df: DataFrame, side: int) -> DataFrame:
        key = F.xxhash64(F.lit(0), *[p[side] for p in texts])
        place = F.row_number().over(Window.partitionBy("key").orderBy(*[F.asc_nulls_first(p[side]) for p in numbers] or [F.lit(0)]))
        return df.withColumn("key", key).withColumn("place", place).select("key", "place", *[p[side] for p in pairs])

    both = placed(left, 0).join(placed(right, 1), ["key", "place"], "full")
    fits = [F.col(x).eqNullSafe(F.col(y)) for x, y in texts] + [F.coalesce(F.abs(F.col(x) - F.col(y)) <= within, F.col(x).isNull() & F.col(y).isNull()) for x, y in numbers]
    return both.agg(F.coalesce(F.bool_and(reduce(Column.__and__, fits)), F.lit(True)).alias("same"))
