"""Grading answers to questions: one verdict for each, from the result that an answer gives and the one that is right."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnlake.operators.quality import same_results

#: How an answer declines, rows that a result may have, and all verdicts.
REFUSE, MOST_ROWS = "REFUSE", 10_000
VERDICTS = ("correct", "wrong_result", "sql_error", "blocked", "too_many_rows", "answered_unanswerable", "wrongly_refused", "error")


@dataclass(frozen=True)
class Question:
    """``gold`` makes the right result; a question without one can't be answered from the data."""

    tier: str
    gold: Callable[[], DataFrame] | None
    ordered: bool = False


def refusal(reply: str) -> bool:
    return reply.strip().strip(".").upper() == REFUSE


def gated(sql: str) -> str | None:
    """Why ``sql`` may not run, or None: only one statement that reads may."""
    text = re.sub(r"--[^\n]*|/\*.*?\*/", " ", sql, flags=re.DOTALL).strip().rstrip(";").strip()
    if ";" in re.sub(r"'[^']*'", "''", text):
        return "more than one statement"
    return None if re.match(r"(?is)(select|with)\b", text) else "not a query"


def placed(df: DataFrame) -> DataFrame:
    """A result's rows (few) with their place in it, so that their order is compared too."""
    at = df.limit(MOST_ROWS).withColumn("_at", F.monotonically_increasing_id())
    return at.withColumn("_place", F.row_number().over(Window.orderBy("_at")).cast("double")).drop("_at")


def verdict(spark: SparkSession, question: Question, reply: str | None, views: Mapping[str, DataFrame]) -> str:
    """Exactly one of ``VERDICTS``; what is checked first decides.

    A reply is SQL over ``views`` (written with their names in braces), ``REFUSE``, or None where none came.
    """
    if reply is None:
        return "error"
    if refusal(reply):
        return "wrongly_refused" if question.gold else "correct"
    if question.gold is None:
        return "answered_unanswerable"
    if gated(reply):
        return "blocked"
    try:
        rows = spark.sql(reply, **views).limit(MOST_ROWS + 1).toArrow()  # runs it once; what is compared is what it gave
    except PySparkException:
        return "sql_error"
    if rows.num_rows > MOST_ROWS:
        return "too_many_rows"
    gold, answer = question.gold(), spark.createDataFrame(rows.rename_columns([f"c{i}" for i in range(rows.num_columns)]))
    both = (placed(gold), placed(answer)) if question.ordered else (gold, answer)
    return "correct" if same_results(*both).first()["same"] else "wrong_result"


def graded(spark: SparkSession, questions: Mapping[str, Question], answers: Mapping[str, Mapping[str, str | None]], views: Mapping[str, DataFrame]) -> DataFrame:
    """``contestant, question, tier, verdict`` for every contestant and question; one that has no answer is an error."""
    found = [(who, name, q.tier, verdict(spark, q, replies.get(name), views)) for who, replies in answers.items() for name, q in questions.items()]
    return spark.createDataFrame(found, "contestant string, question string, tier string, verdict string")


def report(verdicts: DataFrame) -> DataFrame:
    """Verdicts counted by contestant and tier, a column for each kind."""
    return verdicts.groupBy("contestant", "tier").pivot("verdict", list(VERDICTS)).count().fillna(0)
