"""Answerable questions over the index stays: filters, groups, rates and top lists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.functions.columns import banded, ratio
from tarnlake.plans.registry import query
from tarnlake.plans.stays import signal


def _rate(df: DataFrame, *by: str) -> DataFrame:
    g = df.groupBy(*by).agg(F.count("*").alias("stays"), F.count_if("outcome_readmitted").alias("returned"))
    return g.withColumn("rate", ratio(F.col("returned"), F.col("stays")))


RATE = "count(*) AS stays, count_if(outcome_readmitted) AS returned, count_if(outcome_readmitted)::DOUBLE / count(*) AS rate"

QUESTIONS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "q_rate_by_gender": (f"SELECT gender, {RATE} FROM signal GROUP BY gender", lambda s: _rate(s, "gender")),
    "q_rate_by_year": (f"SELECT admit_year, {RATE} FROM signal GROUP BY admit_year", lambda s: _rate(s, "admit_year")),
    "q_rate_by_reason": (f"SELECT admit_reason, {RATE} FROM signal GROUP BY admit_reason", lambda s: _rate(s, "admit_reason")),
    "q_rate_planned": (f"SELECT is_planned, {RATE} FROM signal GROUP BY is_planned", lambda s: _rate(s, "is_planned")),
    "q_rate_via_emergency": (f"SELECT arrived_via_emergency, {RATE} FROM signal GROUP BY ALL", lambda s: _rate(s, "arrived_via_emergency")),
    "q_rate_followed_up": (f"SELECT post_followup_7d, {RATE} FROM signal GROUP BY ALL", lambda s: _rate(s, "post_followup_7d")),
    "q_rate_by_prior_stays": (f"SELECT least(prior_stays_12m, 3) AS prior, {RATE} FROM signal GROUP BY ALL", lambda s: _rate(s.withColumn("prior", F.least("prior_stays_12m", F.lit(3))), "prior")),
    "q_rate_by_age_band": (f"SELECT CASE WHEN age_at_admit < 18 THEN '0-17' WHEN age_at_admit < 45 THEN '18-44' WHEN age_at_admit < 65 THEN '45-64' ELSE '65+' END AS band, {RATE} FROM signal GROUP BY ALL",
                           lambda s: _rate(s.withColumn("band", banded(F.col("age_at_admit"), [18, 45, 65], ["0-17", "18-44", "45-64", "65+"])), "band")),
    "q_first_stays": ("SELECT count(*) AS stays FROM signal WHERE days_since_last_discharge IS NULL", lambda s: s.where("days_since_last_discharge IS NULL").agg(F.count("*").alias("stays"))),
    "q_long_stays": ("SELECT count(*) AS stays, count(DISTINCT patient_id) AS patients FROM signal WHERE length_of_stay > 8", lambda s: s.where("length_of_stay > 8").agg(F.count("*").alias("stays"), F.count_distinct("patient_id").alias("patients"))),
    "q_cost_by_gender": ("SELECT gender, CAST(sum(stay_cost) AS DECIMAL(34,2)) AS cost, max(stay_cost) AS dearest FROM signal GROUP BY gender", lambda s: s.groupBy("gender").agg(F.sum("stay_cost").alias("cost"), F.max("stay_cost").alias("dearest"))),
    "q_dearest_stays": ("SELECT patient_id, stay_no, stay_cost FROM signal ORDER BY stay_cost DESC, patient_id, stay_no LIMIT 10", lambda s: s.select("patient_id", "stay_no", "stay_cost").orderBy(F.desc("stay_cost"), "patient_id", "stay_no").limit(10)),
    "q_most_stays": ("SELECT patient_id, count(*) AS stays FROM signal GROUP BY patient_id ORDER BY stays DESC, patient_id LIMIT 10", lambda s: s.groupBy("patient_id").agg(F.count("*").alias("stays")).orderBy(F.desc("stays"), "patient_id").limit(10)),
    "q_median_stay_by_year": ("SELECT admit_year, median(length_of_stay)::DOUBLE AS days FROM signal GROUP BY admit_year", lambda s: s.groupBy("admit_year").agg(F.median("length_of_stay").alias("days"))),
    "q_reasons_over_average": (f"SELECT admit_reason, {RATE} FROM signal GROUP BY admit_reason HAVING count_if(outcome_readmitted)::DOUBLE / count(*) > (SELECT avg(outcome_readmitted::INT) FROM signal)",
                               lambda s: _rate(s, "admit_reason").crossJoin(F.broadcast(s.agg(F.avg(F.col("outcome_readmitted").cast("double")).alias("mean")))).where("rate > mean").drop("mean")),
    "q_returned_cost": ("SELECT count(*) AS returns, CAST(sum(outcome_return_cost) AS DECIMAL(34,2)) AS cost FROM signal WHERE outcome_readmitted", lambda s: s.where("outcome_readmitted").agg(F.count("*").alias("returns"), F.sum("outcome_return_cost").alias("cost"))),
}

for _name, (_sql, _answer) in QUESTIONS.items():
    query(_sql, _name)(lambda spark, d, answer=_answer: answer(signal(spark, d)))
