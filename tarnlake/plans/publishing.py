"""Facts under one contract, findings, more questions, and what may be published."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.functions.columns import date_key, is_small, ratio
from tarnlake.operators import grading, privacy, quality
from tarnlake.plans.models import REPORT, dr_report, ml_evaluate
from tarnlake.plans.questions import QUESTIONS, RATE, _rate
from tarnlake.plans.registry import ORACLE_SQL, query
from tarnlake.plans.sql_views import VIEWS
from tarnlake.plans.stays import events, signal
from tarnlake.sources import adapters as a
from tarnlake.sources import sinks
from tarnlake.sources.shared import shared_folder


def patient_rules() -> dict[str, Column]:
    """Rules of a patient's row; a null outcome breaks a rule."""
    return {
        "has_name": F.length(F.trim("full_name")) > 0,
        "born_before_death": F.coalesce(F.col("birth_date") <= F.col("death_date"), F.lit(True)),
        "known_gender": F.col("gender").isin("F", "M"),
        "income_not_negative": F.col("income") >= 0,
    }


@query("""SELECT md5('patient' || patient_id) AS patient_key, full_name, birth_date, death_date, death_date IS NOT NULL AS is_deceased, gender, state, zip, payer, income, array_to_string(list_filter([CASE WHEN NOT length(trim(full_name)) > 0 THEN 'has_name' END, CASE WHEN death_date < birth_date THEN 'born_before_death' END,
CASE WHEN gender NOT IN ('F', 'M') THEN 'known_gender' END, CASE WHEN income < 0 THEN 'income_not_negative' END], lambda x: x IS NOT NULL), ',') AS broken FROM patient""")
def dm_patient(spark: SparkSession, d: str) -> DataFrame:
    """Patients typed, keyed and held to their rules, written and read back; those that break one lie whole in quarantine, with the rules' names."""
    root = shared_folder(spark, "patients")
    keyed = a.patient(spark, d).select(patient_key(F.col("patient_id")).alias("patient_key"), "full_name", "birth_date", "death_date", F.col("death_date").isNotNull().alias("is_deceased"), "gender", "state", "zip", "payer", "income")
    good, bad = quality.quarantine(keyed, patient_rules())
    sinks.overwrite(good.withColumn("broken", F.lit("")), f"{root}/patient")
    sinks.overwrite(bad.withColumn("broken", F.array_join("violations", ",")).drop("violations"), f"{root}/quarantine")
    return spark.read.parquet(f"{root}/patient").unionByName(spark.read.parquet(f"{root}/quarantine"))


#: Fact tables: source, code, day, value, and the rule a row must meet.
FACTS = {
    "condition": ("code", "onset_date", "datediff(resolved_date, onset_date)", "resolved_date IS NULL OR resolved_date >= onset_date"),
    "observation": ("code", "to_date(observed_at)", "value", "value >= 0"),
    "medication": ("description", "started_on", "datediff(stopped_on, started_on)", "stopped_on IS NULL OR stopped_on >= started_on"),
    "procedure": ("code", "done_on", "CAST(NULL AS DOUBLE)", "code <> 'P0'"),
    "encounter": ("encounter_class", "to_date(started_at)", "total_cost", "stopped_at >= started_at"),
}
FACT_SQL = {
    "condition": ("code", "onset_date", "resolved_date - onset_date", FACTS["condition"][3]), "observation": ("code", "CAST(observed_at AS DATE)", "value", FACTS["observation"][3]),
    "medication": ("description", "started_on", "stopped_on - started_on", FACTS["medication"][3]), "procedure": ("code", "done_on", "NULL", FACTS["procedure"][3]), "encounter": ("encounter_class", "CAST(started_at AS DATE)", "total_cost", FACTS["encounter"][3]),
}


FACT_ROWS = " UNION ALL ".join(f"""SELECT '{n}' AS fact, 'patient' || patient_id AS who, {c} AS code, {t} AS day, CAST({v} AS DOUBLE) AS value, list_filter([CASE WHEN patient_id IS NULL THEN 'no_patient' END, CASE WHEN {c} IS NULL THEN 'no_code' END,
  CASE WHEN {t} IS NULL THEN 'no_day' END, CASE WHEN ({r}) IS NOT TRUE THEN 'against_rule' END], lambda x: x IS NOT NULL) AS broken FROM {n}""" for n, (c, t, v, r) in FACT_SQL.items())


def fact_tables(spark: SparkSession, d: str, root: str) -> None:
    """Write all facts with surrogate keys to ``facts``, one partition a fact, and whole rows that break a rule to ``quarantine``, one partition a rule.

    Keys are digests of the natural keys, so a rebuild gives the same ones without a lookup and facts join their dimensions by them.
    """
    for n, (code, day, value, rule) in FACTS.items():
        rows = getattr(a, n)(spark, d).select(F.lit(n).alias("fact"), "patient_id", F.expr(code).alias("code"), F.expr(day).alias("day"), F.expr(value).cast("double").alias("value"), F.coalesce(F.expr(rule), F.lit(False)).alias("fine"))
        rules = {"no_patient": F.col("patient_id").isNotNull(), "no_code": F.col("code").isNotNull(), "no_day": F.col("day").isNotNull(), "against_rule": F.col("fine")}
        good, bad = quality.quarantine(rows, rules)
        keyed = good.select("fact", patient_key(F.col("patient_id")).alias("patient_key"), F.md5(F.concat(F.col("fact"), F.lit("/"), "code")).alias("code_key"), date_key("day").alias("date_key"), "value")
        sinks.replace_partitions(keyed, f"{root}/facts", "fact")
        broken = bad.withColumn("rule", F.col("violations")[0]).drop("fine", "violations")
        sinks.replace_partitions(broken.withColumn("value", F.col("value").cast("double")), f"{root}/quarantine/{n}", "rule")


def patient_key(id: Column) -> Column:
    return F.md5(F.concat(F.lit("patient"), id.cast("string")))


@query(f"SELECT fact, md5(who) AS patient_key, md5(fact || '/' || code) AS code_key, CAST(year(day) * 10000 + month(day) * 100 + day(day) AS INT) AS date_key, value, NULL AS rule FROM ({FACT_ROWS}) WHERE len(broken) = 0 UNION ALL SELECT fact, md5(who), md5(fact || '/' || code), CAST(year(day) * 10000 + month(day) * 100 + day(day) AS INT), value, broken[1] FROM ({FACT_ROWS}) WHERE len(broken) > 0")
def dm_facts(spark: SparkSession, d: str) -> DataFrame:
    """All facts built from their specifications, written and read back: kept rows by their keys, and those in quarantine with the first rule that they break."""
    root = shared_folder(spark, "facts")
    fact_tables(spark, d, root)
    kept = spark.read.parquet(f"{root}/facts").select("fact", "patient_key", "code_key", "date_key", "value", F.lit(None).cast("string").alias("rule"))
    aside = [bad for n in FACTS if not (bad := read_if_any(spark, f"{root}/quarantine/{n}")).isEmpty()]
    keys = lambda df: df.select("fact", patient_key(F.col("patient_id")).alias("patient_key"), F.md5(F.concat("fact", F.lit("/"), "code")).alias("code_key"), date_key("day").alias("date_key"), "value", "rule")
    return reduce(DataFrame.unionByName, [kept, *map(keys, aside)])


def read_if_any(spark: SparkSession, path: str) -> DataFrame:
    """A quarantine folder's rows; one that nothing was written to has none."""
    schema = "fact string, patient_id long, code string, day date, value double, rule string"
    sinks.create_if_absent(spark, path, spark.createDataFrame([], schema).schema)
    return spark.read.schema(schema).parquet(path)


@query("SELECT fact, year(day) AS year, gender, count(*) AS rows, count(DISTINCT patient_id) AS patients FROM (SELECT fact, patient_id, day FROM (" + " UNION ALL ".join(f"SELECT '{n}' AS fact, patient_id, {t} AS day FROM {n} WHERE ({r}) IS TRUE AND patient_id IS NOT NULL AND {c} IS NOT NULL AND {t} IS NOT NULL" for n, (c, t, v, r) in FACT_SQL.items()) + ")) JOIN patient USING (patient_id) GROUP BY ALL")
def dm_fact_star(spark: SparkSession, d: str) -> DataFrame:
    """The facts read back and joined to patients and days by their surrogate keys."""
    root = shared_folder(spark, "facts")
    fact_tables(spark, d, root)
    people = a.patient(spark, d).select("patient_id", "gender", patient_key(F.col("patient_id")).alias("patient_key"))
    star = spark.read.parquet(f"{root}/facts").join(people, "patient_key")
    return star.groupBy("fact", F.floor(F.col("date_key") / 10000).cast("long").alias("year"), "gender").agg(F.count("*").alias("rows"), F.count_distinct("patient_id").alias("patients"))


VIEWS["member"] = "SELECT payer AS member, count(*) AS stays, count_if(readmitted) AS returned, avg(length_of_stay)::DOUBLE AS days, CAST(sum(stay_cost) AS DECIMAL(34,2)) AS cost FROM returns WHERE is_index_stay GROUP BY payer"


@query("""WITH m AS (SELECT *, stays::DOUBLE / sum(stays) OVER () AS share, row_number() OVER (ORDER BY stays DESC, member) AS by_stays, row_number() OVER (ORDER BY cost DESC, member) AS by_cost, sum(days * stays) OVER () / sum(stays) OVER () AS network FROM member),
q AS (SELECT year(admit_day) * 4 + quarter(admit_day) AS q, avg(length_of_stay)::DOUBLE AS days, count(*) AS n FROM returns WHERE is_index_stay GROUP BY q), l AS (SELECT * FROM q ORDER BY q DESC LIMIT 8)
SELECT 'largest member' AS finding, member AS subject, round(share, 3) AS value, by_cost::DOUBLE AS other FROM m WHERE by_stays = 1 AND stays > 10
UNION ALL SELECT 'longer stays', member, round(days - network, 3), NULL FROM m WHERE days - network >= 0.05 AND stays > 10
UNION ALL SELECT 'few stays', member, stays, NULL FROM m WHERE stays BETWEEN 11 AND 20
UNION ALL SELECT 'widest gap', 'rates', round(max(returned::DOUBLE / stays) - min(returned::DOUBLE / stays), 3), NULL FROM m HAVING min(CASE WHEN returned BETWEEN 1 AND 10 OR stays BETWEEN 1 AND 10 THEN 0 ELSE 1 END) = 1
UNION ALL SELECT 'range of quarters', 'days', round(max(days) - min(days), 3), count(*) FROM l HAVING min(n) > 10""")
def mt_findings(spark: SparkSession, d: str) -> DataFrame:
    """Findings by fixed rules over the members' numbers; one that rests on a hidden number is dropped."""
    from pyspark.sql import Window

    index = events(spark, d).where("is_index_stay")
    members = index.groupBy(F.col("payer").alias("member")).agg(F.count("*").alias("stays"), F.count_if("readmitted").alias("returned"), F.avg("length_of_stay").alias("days"), F.sum("stay_cost").alias("cost"))
    whole = Window.partitionBy(F.lit(0))  # as many rows as members
    order = lambda c: F.row_number().over(whole.orderBy(F.desc(c), "member"))
    m = members.select("*", (F.col("stays") / F.sum("stays").over(whole)).alias("share"), order("stays").alias("by_stays"), order("cost").alias("by_cost"), (F.sum(F.col("days") * F.col("stays")).over(whole) / F.sum("stays").over(whole)).alias("network"))
    shown = ~is_small(F.col("stays"))
    finding = lambda df, name, subject, value, other=None: df.select(F.lit(name).alias("finding"), subject.alias("subject"), value.cast("double").alias("value"), (F.lit(None) if other is None else other).cast("double").alias("other"))
    rate = F.col("returned") / F.col("stays")
    gap = m.agg((F.max(rate) - F.min(rate)).alias("gap"), F.bool_or(is_small(F.col("returned")) | is_small(F.col("stays"))).alias("hidden")).where("NOT hidden")
    quarter = (F.year("admit_day") * 4 + F.quarter("admit_day")).alias("q")
    last = index.groupBy(quarter).agg(F.avg("length_of_stay").alias("days"), F.count("*").alias("n")).orderBy(F.desc("q")).limit(8)
    spread = last.agg((F.max("days") - F.min("days")).alias("range"), F.count("*").alias("quarters"), F.min("n").alias("least")).where("least > 10")
    return reduce(DataFrame.unionByName, [
        finding(m.where(shown & (F.col("by_stays") == 1)), "largest member", F.col("member"), F.round("share", 3), F.col("by_cost")),
        finding(m.where(shown & (F.col("days") - F.col("network") >= 0.05)), "longer stays", F.col("member"), F.round(F.col("days") - F.col("network"), 3)),
        finding(m.where(shown & (F.col("stays") <= 20)), "few stays", F.col("member"), F.col("stays")),
        finding(gap, "widest gap", F.lit("rates"), F.round("gap", 3)),
        finding(spread, "range of quarters", F.lit("days"), F.round("range", 3), F.col("quarters")),
    ])


#: Questions about stays, visits and patients beside those over index stays.
MORE = {
    "q_visits_by_class": ("SELECT encounter_class, count(*) AS n, count(DISTINCT patient_id) AS patients FROM encounter GROUP BY ALL", lambda s, d: a.encounter(s, d).groupBy("encounter_class").agg(F.count("*").alias("n"), F.count_distinct("patient_id").alias("patients"))),
    "q_patients_without_visit": ("SELECT count(*) AS patients FROM patient WHERE patient_id NOT IN (SELECT patient_id FROM encounter)", lambda s, d: a.patient(s, d).join(a.encounter(s, d), "patient_id", "left_anti").agg(F.count("*").alias("patients"))),
    "q_deaths_by_gender": ("SELECT gender, count(death_date) AS deaths FROM patient GROUP BY gender", lambda s, d: a.patient(s, d).groupBy("gender").agg(F.count("death_date").alias("deaths"))),
    "q_patients_by_state": ("SELECT state, count(*) AS patients FROM patient GROUP BY state", lambda s, d: a.patient(s, d).groupBy("state").agg(F.count("*").alias("patients"))),
    "q_income_by_payer": ("SELECT payer, CAST(max(income) AS DECIMAL(14,2)) AS top, median(income::DOUBLE) AS mid FROM patient GROUP BY payer", lambda s, d: a.patient(s, d).groupBy("payer").agg(F.max("income").alias("top"), F.median(F.col("income").cast("double")).alias("mid"))),
    "q_open_conditions": ("SELECT code, count(*) AS n FROM condition WHERE resolved_date IS NULL GROUP BY code", lambda s, d: a.condition(s, d).where("resolved_date IS NULL").groupBy("code").agg(F.count("*").alias("n"))),
    "q_common_procedures": ("SELECT code, count(*) AS n FROM procedure GROUP BY code ORDER BY n DESC, code LIMIT 5", lambda s, d: a.procedure(s, d).groupBy("code").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "code").limit(5)),
    "q_unpaid_by_class": ("SELECT encounter_class, CAST(sum(total_cost - payer_paid) AS DECIMAL(34,2)) AS unpaid FROM encounter GROUP BY ALL", lambda s, d: a.encounter(s, d).groupBy("encounter_class").agg(F.sum(F.col("total_cost") - F.col("payer_paid")).cast("decimal(34,2)").alias("unpaid"))),
    "q_visits_without_reason": ("SELECT encounter_class, count_if(reason IS NULL)::DOUBLE / count(*) AS share FROM encounter GROUP BY ALL", lambda s, d: a.encounter(s, d).groupBy("encounter_class").agg(ratio(F.count_if(F.col("reason").isNull()), F.count("*")).alias("share"))),
    "q_stays_by_payer_year": ("SELECT payer, CAST(year(admit_day) AS INT) AS y, count(*) AS stays FROM returns GROUP BY ALL", lambda s, d: events(s, d).groupBy("payer", F.year("admit_day").alias("y")).agg(F.count("*").alias("stays"))),
    "q_index_share_by_payer": ("SELECT payer, count_if(is_index_stay)::DOUBLE / count(*) AS share FROM returns GROUP BY payer", lambda s, d: events(s, d).groupBy("payer").agg(ratio(F.count_if("is_index_stay"), F.count("*")).alias("share"))),
    "q_hospice_after_stay": ("SELECT count(*) AS stays FROM returns WHERE excl_hospice", lambda s, d: events(s, d).where("excl_hospice").agg(F.count("*").alias("stays"))),
    "q_returns_in_a_week": ("SELECT count(*) AS returns FROM returns WHERE is_index_stay AND days_to_unplanned_return <= 7", lambda s, d: events(s, d).where("is_index_stay AND days_to_unplanned_return <= 7").agg(F.count("*").alias("returns"))),
    "q_latest_vitals": ("SELECT code, max(observed_at) AS last_at, count(*) AS n FROM observation GROUP BY code", lambda s, d: a.observation(s, d).groupBy("code").agg(F.max("observed_at").alias("last_at"), F.count("*").alias("n"))),
    "q_drug_courses_by_year": ("SELECT CAST(year(started_on) AS INT) AS y, count(*) AS courses, count_if(stopped_on IS NULL) AS going_on FROM medication GROUP BY ALL", lambda s, d: a.medication(s, d).groupBy(F.year("started_on").alias("y")).agg(F.count("*").alias("courses"), F.count_if(F.col("stopped_on").isNull()).alias("going_on"))),
    "q_rate_many_conditions": (f"SELECT conditions_at_admit >= 5 AS many, {RATE} FROM signal GROUP BY ALL", lambda s, d: _rate(signal(s, d).withColumn("many", F.col("conditions_at_admit") >= 5), "many")),
}
for _name, (_sql, _answer) in MORE.items():
    query(_sql, _name)(_answer)


#: Questions of the contest by tier, those whose order counts, and one that the data can't answer.
TIERS = {"q_rate_by_gender": "easy", "q_first_stays": "easy", "q_long_stays": "medium", "q_rate_by_age_band": "medium", "q_dearest_stays": "hard", "q_reasons_over_average": "hard"}
ORDERED, OPEN = {"q_dearest_stays"}, "u_home_address"
_SAID = {q: QUESTIONS[q][0] for q in TIERS}
#: What three contestants say: all right in other words; planted mistakes; and answers that never come to a result.
ANSWERS: dict[str, dict[str, str | None]] = {
    "careful": {q: f"SELECT * FROM ({sql}) ORDER BY 1" if q not in ORDERED else sql for q, sql in _SAID.items()} | {"q_first_stays": "SELECT count_if(days_since_last_discharge IS NULL) AS n, 'first' AS what FROM signal", OPEN: "refuse."},
    "careless": {"q_rate_by_gender": _SAID["q_rate_by_gender"].replace("FROM signal", "FROM signal WHERE is_planned"), "q_first_stays": "SELECT count(*) FROM signal", "q_long_stays": "SELECT patient_id FROM no_such_table", "q_rate_by_age_band": "REFUSE",
                 "q_dearest_stays": "SELECT * FROM (" + _SAID["q_dearest_stays"] + ") ORDER BY stay_cost, patient_id, stay_no", "q_reasons_over_average": _SAID["q_reasons_over_average"], OPEN: "SELECT patient_id FROM signal"},
    "rash": {"q_rate_by_gender": "DROP TABLE signal", "q_first_stays": "SELECT 1; SELECT 2", "q_long_stays": "SELECT a.patient_id FROM signal a, (VALUES (1), (2), (3), (4), (5), (6), (7), (8), (9), (10), (11), (12), (13), (14), (15), (16), (17), (18), (19), (20), (21), (22), (23), (24), (25), (26), (27), (28), (29), (30)) AS t(n)", OPEN: None},
}
REPLIED = {"refuse.": ("correct", "wrongly_refused"), "REFUSE": ("correct", "wrongly_refused"), None: ("error", "error"), "DROP TABLE signal": ("", "blocked"), "SELECT 1; SELECT 2": ("", "blocked"), "SELECT patient_id FROM no_such_table": ("", "sql_error")}


def _verdict_sql(question: str, reply: str | None) -> str:
    """SQL of the verdict: what needs no result is plain, results are compared row by row on the columns that are asked for."""
    if question == OPEN:
        return f"'{REPLIED[reply][0]}'" if reply in REPLIED else "'answered_unanswerable'"
    if reply in REPLIED:
        return f"'{REPLIED[reply][1]}'"
    gold, place = _SAID[question], ", row_number() OVER ()" if question in ORDERED else ""
    width = {"q_first_stays": "#1", "q_long_stays": "#1"}.get(question, "*")
    a_, g_ = f"SELECT {width}{place} FROM ({reply})", f"SELECT {width}{place} FROM ({gold})"
    return f"CASE WHEN (SELECT count(*) FROM ({reply})) > 10000 THEN 'too_many_rows' WHEN EXISTS (({a_}) EXCEPT ALL ({g_})) OR EXISTS (({g_}) EXCEPT ALL ({a_})) THEN 'wrong_result' ELSE 'correct' END"


VIEWS["graded"] = " UNION ALL ".join(f"SELECT '{who}' AS contestant, '{({**TIERS, OPEN: 'unanswerable'})[q]}' AS tier, {_verdict_sql(q, replies.get(q))} AS verdict" for who, replies in ANSWERS.items() for q in [*TIERS, OPEN])


@query("SELECT contestant, tier, " + ", ".join(f"count_if(verdict = '{v}') AS {v}" for v in grading.VERDICTS) + " FROM graded GROUP BY contestant, tier")
def mt_eval_report(spark: SparkSession, d: str) -> DataFrame:
    """Three contestants' answers run and graded against the right results, counted by contestant and tier of difficulty."""
    stays = signal(spark, d)
    questions = {q: grading.Question(tier, lambda q=q: QUESTIONS[q][1](stays), q in ORDERED) for q, tier in TIERS.items()} | {OPEN: grading.Question("unanswerable", None)}
    named = {who: {q: re.sub(r"\bsignal\b", "{signal}", r) if r else r for q, r in replies.items()} for who, replies in ANSWERS.items()}
    return grading.report(grading.graded(spark, questions, named, {"signal": stays}))


@query(f"SELECT feature, round(psi, 3) AS psi, status FROM ({REPORT})")
def pv_publish_drift(spark: SparkSession, d: str) -> DataFrame:
    """The drift report as it may be published: rounded, without rates of training."""
    return privacy.published(dr_report(spark, d), {"psi": 3}, {"training_rate"})


@query()
def pv_publish_model(spark: SparkSession, d: str) -> DataFrame:
    """The rule's evaluation as it may be published."""
    return privacy.published_scores(ml_evaluate(spark, d), "all")


ORACLE_SQL["pv_publish_model"] = f"""SELECT rows, CASE WHEN fine THEN round(recall, 3) END AS recall, CASE WHEN fine THEN round(average_precision, 3) END AS average_precision, CASE WHEN fine THEN round(brier, 3) END AS brier,
CASE WHEN hits < 30 THEN 'too few' ELSE 'judged' END AS verdict FROM (SELECT *, rows = 'all' AND NOT (caught BETWEEN 1 AND 10 OR missed BETWEEN 1 AND 10) AS fine FROM ({ORACLE_SQL['ml_evaluate']}))"""


VIEWS["window_flag"] = "SELECT admit_year, admit_reason, count(*) AS stays, count_if(length_of_stay > 8) AS flagged FROM signal GROUP BY ALL"


@query("SELECT admit_year, admit_reason, CASE WHEN NOT (stays BETWEEN 1 AND 10 OR flagged BETWEEN 1 AND 10) THEN stays END AS stays, CASE WHEN NOT (stays BETWEEN 1 AND 10 OR flagged BETWEEN 1 AND 10) THEN round(flagged::DOUBLE / stays, 3) END AS flag_rate FROM window_flag")
def pv_publish_retrain(spark: SparkSession, d: str) -> DataFrame:
    """Windows of retraining: their size and flag rate are hidden where either would tell of 1 to 10 people."""
    w = signal(spark, d).groupBy("admit_year", "admit_reason").agg(F.count("*").alias("stays"), F.count_if(F.col("length_of_stay") > 8).alias("flagged"))
    return privacy.published_windows(w, ["admit_year", "admit_reason"], "stays", "flagged", {"admit_year", "admit_reason"})


@query("SELECT step, count(*) AS rows, count_if(seen) AS clear FROM (SELECT unnest(['1 cleared', '2 revoked', '3 restored']) AS step, patient_id FROM patient), LATERAL (SELECT step <> '2 revoked' AS seen) GROUP BY step")
def pv_mask_toggle_check(spark: SparkSession, d: str) -> DataFrame:
    """The same rows for a reader who is cleared, then not, then again: the mask comes and goes, nothing else changes."""
    p = a.patient(spark, d).select("patient_id", "full_name", "zip")
    tags = {"full_name": "name", "zip": "zip"}
    steps = [("1 cleared", True), ("2 revoked", False), ("3 restored", True)]
    views = [privacy.masked_view(p, tags, clear).select("patient_id", F.col("full_name").alias("shown"), F.lit(step).alias("step")) for step, clear in steps]
    rows = reduce(DataFrame.unionByName, views).join(p.select("patient_id", "full_name"), "patient_id")
    return rows.groupBy("step").agg(F.count("*").alias("rows"), F.count_if(F.col("shown") == F.col("full_name")).alias("clear"))


ALL_QUESTIONS = {**{k: (sql, lambda s, d, f=f: f(signal(s, d))) for k, (sql, f) in QUESTIONS.items()}, **MORE}


@query(" UNION ALL ".join(f"SELECT '{k}' AS question, count(*) AS rows FROM ({sql})" for k, (sql, _) in ALL_QUESTIONS.items()))
def mt_questions(spark: SparkSession, d: str) -> DataFrame:
    """All questions and how many rows their answers have."""
    counts = [answer(spark, d).agg(F.lit(k).alias("question"), F.count("*").alias("rows")) for k, (_, answer) in ALL_QUESTIONS.items()]
    return reduce(DataFrame.unionByName, counts)
