"""Column helpers: every one a plain expression that stays in the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ZONE = "America/Chicago"
#: Counts from 1 to this are small cells; zero may be shown.
SMALL = 10


def local_day(ts: Column | str, zone: str = ZONE) -> Column:
    """Calendar day of a UTC instant in the business's zone."""
    return F.to_date(F.from_utc_timestamp(ts, zone))


def date_key(day: Column | str) -> Column:
    return F.date_format(day, "yyyyMMdd").cast("int")


def whole_years(birth: Column, ref: Column) -> Column:
    """Completed years from ``birth`` to ``ref``."""
    return F.floor(F.months_between(ref, birth) / 12).cast("long")


def top_coded_age(birth: Column, ref: Column, cap: int = 90) -> Column:
    """Age where ``cap`` means that old or older."""
    return F.least(whole_years(birth, ref), F.lit(cap).cast("long"))


def blank_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def banded(value: Column, edges: list[int], labels: list[str]) -> Column:
    """Label of the first edge that the value lies below, else the last label."""
    chain = reduce(lambda w, el: w.when(value < el[0], el[1]), zip(edges[1:], labels[1:], strict=False), F.when(value < edges[0], labels[0]))
    return F.when(value.isNotNull(), chain.otherwise(labels[-1]))


def violations(rules: dict[str, Column]) -> Column:
    """Names of the failed rules; a rule that is null has failed."""
    return F.filter(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]), lambda x: x.isNotNull())


def ratio(part: Column, whole: Column) -> Column:
    """Share that is null on an empty group."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def wilson(part: Column, whole: Column, z: float = 1.96) -> tuple[Column, Column]:
    """Bounds of the Wilson interval of a share, clamped to [0, 1]; (0, 1) for an empty group."""
    n, p = whole.cast("double"), F.try_divide(part.cast("double"), whole.cast("double"))
    scale = 1 + z * z / n
    middle = (p + z * z / (2 * n)) / scale
    half = z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / scale
    empty = whole == 0
    return F.when(empty, 0.0).otherwise(F.greatest(F.lit(0.0), middle - half)), F.when(empty, 1.0).otherwise(F.least(F.lit(1.0), middle + half))


def is_small(n: Column) -> Column:
    return n.between(1, SMALL)


def shown(n: Column, value: Column) -> Column:
    """``value``, hidden where its count is unknown or a small cell."""
    return F.when(n.isNotNull() & ~is_small(n), value)


def mask_text(c: Column) -> Column:
    return F.when(c.isNotNull(), F.lit("***"))


def mask_date(c: Column) -> Column:
    return F.trunc(c, "YEAR")


def mask_zip(c: Column) -> Column:
    return F.substring(c, 1, 3)


def open_on(start: Column, end: Column, day: Column) -> Column:
    """A span without an end is still open."""
    return (start <= day) & (end.isNull() | (end >= day))


def whole_word(text: Column, word: Column) -> Column:
    return F.regexp_like(F.lower(text), F.concat(F.lit(r"\b"), word, F.lit(r"\b")))
