"""Queries over care measures, the star schema and the metric layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.functions.columns import local_day, ratio, wilson
from tarnlake.operators import measures as op
from tarnlake.plans.basics import WILSON_HIGH, WILSON_LOW
from tarnlake.plans.registry import query
from tarnlake.plans.sql_views import DAY, VIEWS
from tarnlake.plans.stays import events, signal
from tarnlake.sources import adapters as a

AGES = {"lab_done": (18, 75), "pressure_controlled": (18, 85), "drug_taken": (21, 75)}
VIEWS["period"] = "SELECT CAST(year(last_day) - 1 AS INT) AS measure_year, make_date(year(last_day) - 1, 1, 1) AS period_start, make_date(year(last_day) - 1, 12, 31) AS period_end FROM data_end"
VIEWS["denominator"] = """SELECT DISTINCT c.patient_id, m.measure FROM condition c JOIN measure_code m ON m.code = c.code JOIN patient p ON p.patient_id = c.patient_id CROSS JOIN period
  WHERE c.onset_date <= period_end AND (c.resolved_date IS NULL OR c.resolved_date >= period_start) AND (p.death_date IS NULL OR p.death_date >= period_start)"""
VIEWS["met"] = f"""SELECT DISTINCT patient_id, 'lab_done' AS measure FROM procedure CROSS JOIN period WHERE code IN ('P5','P6','P7') AND done_on BETWEEN period_start AND period_end
  UNION ALL SELECT patient_id, 'pressure_controlled' FROM (SELECT patient_id, arg_max(total_cost, ROW(started_at, encounter_id)) AS last FROM encounter CROSS JOIN period WHERE {DAY.format('started_at')} BETWEEN period_start AND period_end GROUP BY ALL) WHERE last < 250000
  UNION ALL SELECT DISTINCT patient_id, 'drug_taken' FROM medication CROSS JOIN period WHERE regexp_matches(description, '\\bring\\b') AND started_on <= period_end AND (stopped_on IS NULL OR stopped_on >= period_start)"""
VIEWS["in_hospice"] = f"SELECT DISTINCT patient_id FROM encounter CROSS JOIN period WHERE encounter_class = 'hospice' AND {DAY.format('started_at')} BETWEEN period_start AND period_end"
VIEWS["flagged"] = """SELECT d.patient_id, d.measure, measure_year, datesub('month', birth_date, period_end) // 12 AS age_at_year_end, coalesce(death_date <= period_end, false) AS excl_died, h.patient_id IS NOT NULL AS excl_hospice, m.patient_id IS NOT NULL AS numerator_met
  FROM denominator d JOIN patient p USING (patient_id) CROSS JOIN period LEFT JOIN met m ON m.patient_id = d.patient_id AND m.measure = d.measure LEFT JOIN in_hospice h ON h.patient_id = d.patient_id"""
VIEWS["care_gap"] = """SELECT *, NOT (excl_age OR excl_died OR excl_hospice) AND NOT numerator_met AS gap, count(*) OVER (PARTITION BY patient_id, measure) AS key_copies FROM (SELECT *,
  NOT CASE measure WHEN 'lab_done' THEN age_at_year_end BETWEEN 18 AND 75 WHEN 'pressure_controlled' THEN age_at_year_end BETWEEN 18 AND 85 ELSE age_at_year_end BETWEEN 21 AND 75 END AS excl_age FROM flagged)"""


def gaps(spark: SparkSession, d: str) -> DataFrame:
    e = a.encounter(spark, d)
    period = op.measure_period(e)
    met = {"lab_done": op.met_by_procedure(a.procedure(spark, d), ["P5", "P6", "P7"], period), "pressure_controlled": op.met_by_last_cost(e, period, 250000), "drug_taken": op.met_by_drug(a.medication(spark, d), ["ring"], period)}
    hospice = e.where("encounter_class = 'hospice'").withColumn("day", local_day("started_at")).crossJoin(F.broadcast(period)).where(F.col("day").between(F.col("period_start"), F.col("period_end")))
    return op.care_gaps(op.measure_denominator(a.condition(spark, d), a.patient(spark, d), a.measure_codes(spark), period), met, hospice, AGES)


@query("SELECT * FROM period")
def cg_period(spark: SparkSession, d: str) -> DataFrame:
    return op.measure_period(a.encounter(spark, d))


@query("SELECT * FROM denominator")
def cg_denominator(spark: SparkSession, d: str) -> DataFrame:
    return op.measure_denominator(a.condition(spark, d), a.patient(spark, d), a.measure_codes(spark), op.measure_period(a.encounter(spark, d))).select("patient_id", "measure")


@query("SELECT measure, count(*) AS patients FROM met GROUP BY measure")
def cg_numerators(spark: SparkSession, d: str) -> DataFrame:
    e = a.encounter(spark, d)
    period = op.measure_period(e)
    parts = {"lab_done": op.met_by_procedure(a.procedure(spark, d), ["P5", "P6", "P7"], period), "pressure_controlled": op.met_by_last_cost(e, period, 250000), "drug_taken": op.met_by_drug(a.medication(spark, d), ["ring"], period)}
    out = None
    for k, m in parts.items():
        one = m.agg(F.lit(k).alias("measure"), F.count("*").alias("patients"))
        out = one if out is None else out.unionByName(one)
    return out


@query("SELECT patient_id, measure, measure_year, age_at_year_end, excl_age, excl_died, excl_hospice, numerator_met, gap, key_copies FROM care_gap")
def cg_gap(spark: SparkSession, d: str) -> DataFrame:
    return gaps(spark, d)


@query("SELECT measure, count(*) AS rows, count_if(c) AS eligible, count_if(c AND numerator_met) AS met, count_if(gap) AS gaps, count_if(c AND numerator_met)::DOUBLE / nullif(count_if(c), 0) AS met_share FROM (SELECT *, NOT (excl_age OR excl_died OR excl_hospice) AS c FROM care_gap) GROUP BY measure")
def cg_summary(spark: SparkSession, d: str) -> DataFrame:
    return op.gap_summary(gaps(spark, d))


@query("SELECT m.code, count(DISTINCT c.patient_id) AS patients FROM measure_code m LEFT JOIN condition c USING (code) GROUP BY m.code")
def cg_code_coverage(spark: SparkSession, d: str) -> DataFrame:
    return F.broadcast(a.measure_codes(spark)).join(a.condition(spark, d), "code", "left").groupBy("code").agg(F.count_distinct("patient_id").alias("patients"))


@query("""SELECT system, code, min(seen_on) AS first_seen, max(seen_on) AS last_seen, arg_max(description, ROW(seen_on, description)) AS description FROM (SELECT 'CONDITION' AS system, code, 'condition ' || (encounter_id % 3) AS description, onset_date AS seen_on FROM condition
UNION ALL SELECT 'PROCEDURE', code, 'procedure ' || (encounter_id % 3), done_on FROM procedure) GROUP BY ALL""")
def dm_dim_code(spark: SparkSession, d: str) -> DataFrame:
    label = lambda w: F.concat(F.lit(w), F.col("encounter_id") % 3).alias("description")
    one = a.condition(spark, d).select(F.lit("CONDITION").alias("system"), "code", label("condition "), F.col("onset_date").alias("seen_on"))
    two = a.procedure(spark, d).select(F.lit("PROCEDURE").alias("system"), "code", label("procedure "), F.col("done_on").alias("seen_on"))
    return op.code_dimension([one, two]).drop("code_key")


@query("SELECT CAST(strftime(day, '%Y%m%d') AS INT) AS date_key, day, CAST(year(day) AS INT) AS year, CAST(quarter(day) AS INT) AS quarter, CAST(month(day) AS INT) AS month, dayofweek(day) IN (0, 6) AS is_weekend FROM (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day FROM (SELECT " + DAY.format("min(started_at)") + " AS a, " + DAY.format("max(stopped_at)") + " AS b FROM encounter))")
def dm_dim_date(spark: SparkSession, d: str) -> DataFrame:
    return op.date_dimension(a.encounter(spark, d))


@query("SELECT s_suppkey AS organization_id, s_name AS name, n_name AS state FROM supplier JOIN nation ON n_nationkey = s_nationkey")
def dm_dim_ref(spark: SparkSession, d: str) -> DataFrame:
    nation = a.table(spark, d, "nation")
    return a.table(spark, d, "supplier").join(F.broadcast(nation), F.col("n_nationkey") == F.col("s_nationkey")).select(F.col("s_suppkey").alias("organization_id"), F.col("s_name").alias("name"), F.col("n_name").alias("state"))


@query(f"SELECT encounter_id, patient_id, organization_id, encounter_class, CAST(strftime({DAY.format('started_at')}, '%Y%m%d') AS INT) AS start_key, CAST(strftime({DAY.format('stopped_at')}, '%Y%m%d') AS INT) AS stop_key, round((epoch(stopped_at) - epoch(started_at)) / 3600, 2)::DOUBLE AS duration_hours, total_cost, payer_paid, CAST(total_cost - payer_paid AS DECIMAL(14,2)) AS patient_paid FROM encounter")
def dm_fact_encounter(spark: SparkSession, d: str) -> DataFrame:
    return op.encounter_facts(a.encounter(spark, d))


@query("SELECT encounter_class, CASE encounter_class WHEN 'wellness' THEN 'preventive' ELSE encounter_class END AS canonical_class, CASE encounter_class WHEN 'inpatient' THEN 'index_eligible' ELSE 'other' END AS role, count(*) AS n FROM encounter GROUP BY ALL")
def dm_class_map(spark: SparkSession, d: str) -> DataFrame:
    rows = [("inpatient", "inpatient", "index_eligible"), ("emergency", "emergency", "other"), ("ambulatory", "ambulatory", "other"), ("hospice", "hospice", "other"), ("wellness", "preventive", "other")]
    mapping = spark.createDataFrame(rows, "encounter_class string, canonical_class string, role string")
    return a.encounter(spark, d).join(F.broadcast(mapping), "encounter_class", "left").groupBy("encounter_class", "canonical_class", "role").agg(F.count("*").alias("n"))


@query("""SELECT p.patient_id, gender, death_date IS NOT NULL AS is_deceased, least(datesub('month', birth_date, coalesce(death_date, last_day)) // 12, 90) AS age_years, coalesce(v.encounters, 0) AS encounters, coalesce(v.inpatient, 0) AS inpatient, coalesce(v.emergency, 0) AS emergency, coalesce(v.total_cost, 0) AS total_cost, v.last_visit_at,
coalesce(c.conditions, 0) AS conditions, coalesce(c.active, 0) AS active_conditions, round(l.s, 0) AS latest_systolic, round(l.d, 0) AS latest_diastolic, round(l.b, 1) AS latest_bmi, coalesce(r.index_stays, 0) AS index_stays, coalesce(r.back, 0) AS returns
FROM patient p CROSS JOIN data_end LEFT JOIN (SELECT patient_id, count(*) AS encounters, count_if(encounter_class = 'inpatient') AS inpatient, count_if(encounter_class = 'emergency') AS emergency, sum(total_cost) AS total_cost, max(started_at) AS last_visit_at FROM encounter GROUP BY ALL) v USING (patient_id)
LEFT JOIN (SELECT patient_id, count(*) AS conditions, count_if(resolved_date IS NULL) AS active FROM condition GROUP BY ALL) c USING (patient_id)
LEFT JOIN (SELECT patient_id, arg_max(value, ROW(observed_at, observation_id)) FILTER (WHERE code = 'systolic') AS s, arg_max(value, ROW(observed_at, observation_id)) FILTER (WHERE code = 'diastolic') AS d, arg_max(value, ROW(observed_at, observation_id)) FILTER (WHERE code = 'bmi') AS b FROM observation GROUP BY ALL) l USING (patient_id)
LEFT JOIN (SELECT patient_id, count_if(is_index_stay) AS index_stays, count_if(is_index_stay AND readmitted) AS back FROM returns GROUP BY ALL) r USING (patient_id)""")
def dm_patient_360(spark: SparkSession, d: str) -> DataFrame:
    return op.patient_summary(a.patient(spark, d), a.encounter(spark, d), a.condition(spark, d), a.observation(spark, d), events(spark, d))


@query("SELECT payer, CAST(year(admit_day) AS INT) AS year, count(*) AS stays, count(DISTINCT patient_id) AS patients, CAST(sum(length_of_stay) AS BIGINT) AS days, avg(length_of_stay)::DOUBLE AS avg_days, CAST(sum(stay_cost) AS DECIMAL(34,2)) AS cost, sum(stay_cost::DOUBLE) / count(*) AS cost_per_stay FROM returns GROUP BY ALL")
def mt_stays(spark: SparkSession, d: str) -> DataFrame:
    return op.stay_view(events(spark, d)).query(["payer", "year"])


@query("SELECT payer, is_planned AS planned, count(*) AS index_stays, count_if(readmitted) AS returns, count_if(readmitted)::DOUBLE / count(*) AS rate FROM returns WHERE is_index_stay GROUP BY ALL")
def mt_readmission(spark: SparkSession, d: str) -> DataFrame:
    return op.return_view(events(spark, d)).query(["payer", "planned"])


@query(f"SELECT encounter_class AS \"class\", CAST(date_trunc('month', {DAY.format('started_at')}) AS DATE) AS month, count(*) AS visits, CAST(sum(total_cost) AS DECIMAL(24,2)) AS cost FROM encounter GROUP BY ALL")
def mt_operations(spark: SparkSession, d: str) -> DataFrame:
    return op.visit_view(a.encounter(spark, d)).query(["class", "month"])


@query("SELECT measure, count(*) AS eligible, count_if(numerator_met) AS met, count_if(numerator_met)::DOUBLE / count(*) AS met_share FROM care_gap WHERE NOT (excl_age OR excl_died OR excl_hospice) GROUP BY measure")
def mt_care_gaps(spark: SparkSession, d: str) -> DataFrame:
    return op.gap_view(gaps(spark, d)).query(["measure"])


@query("SELECT CAST(year(admit_day) AS INT) AS year, count(*) AS stays FROM returns WHERE payer = 'BUILDING' GROUP BY ALL")
def mt_view(spark: SparkSession, d: str) -> DataFrame:
    return op.stay_view(events(spark, d)).query(["year"], ["stays"], F.col("_d_payer") == "BUILDING")


@query("SELECT (SELECT count(*) FROM returns) AS total, (SELECT CAST(sum(n) AS BIGINT) FROM (SELECT count(*) AS n FROM returns GROUP BY payer)) AS over_split, 0::BIGINT AS unnamed")
def mt_split_check(spark: SparkSession, d: str) -> DataFrame:
    view = op.stay_view(events(spark, d))
    split = view.query(["payer"], ["stays"]).agg(F.sum("stays").alias("over_split"), F.count_if(F.col("payer").isNull()).alias("unnamed"))
    return view.query([], ["stays"]).withColumnRenamed("stays", "total").crossJoin(split)


VIEWS["kpi"] = "SELECT to_day, CAST(to_day + 1 - INTERVAL 12 MONTH AS DATE) AS from_day, CAST(to_day + 1 - INTERVAL 24 MONTH AS DATE) AS prior_from FROM (SELECT CASE WHEN last_day = last_day(last_day) THEN last_day ELSE CAST(date_trunc('month', last_day) AS DATE) - 1 END AS to_day FROM data_end)"


@query("SELECT * FROM kpi")
def mt_kpi_window(spark: SparkSession, d: str) -> DataFrame:
    return op.kpi_window(a.encounter(spark, d))


@query("""WITH r AS (SELECT *, admit_day BETWEEN from_day AND to_day AS now, admit_day >= prior_from AND admit_day < from_day AS prior FROM returns CROSS JOIN kpi),
t AS (SELECT 'stays' AS tile, count_if(now)::DOUBLE AS value, count_if(prior)::DOUBLE AS prior FROM r UNION ALL SELECT 'avg_days', avg(length_of_stay) FILTER (WHERE now), avg(length_of_stay) FILTER (WHERE prior) FROM r UNION ALL SELECT 'cost_per_stay', avg(stay_cost::DOUBLE) FILTER (WHERE now), avg(stay_cost::DOUBLE) FILTER (WHERE prior) FROM r)
SELECT tile, value, prior, value - prior AS change, (value - prior) / nullif(prior, 0) AS change_share FROM t""")
def mt_kpi_tiles(spark: SparkSession, d: str) -> DataFrame:
    return op.kpi_tiles(events(spark, d), op.kpi_window(a.encounter(spark, d)))


@query("SELECT CAST(date_trunc('quarter', admit_day) AS DATE) AS quarter, count(*) AS stays, avg(length_of_stay)::DOUBLE AS avg_days FROM returns GROUP BY ALL")
def mt_trends(spark: SparkSession, d: str) -> DataFrame:
    return op.stay_view(events(spark, d)).query(["quarter"], ["stays", "avg_days"])


@query("SELECT organization_id AS member, count(*) AS stays, avg(length_of_stay)::DOUBLE AS avg_days, (SELECT avg(length_of_stay) FROM returns)::DOUBLE AS network, avg(length_of_stay) - (SELECT avg(length_of_stay) FROM returns) AS gap FROM returns GROUP BY ALL HAVING count(*) >= 11")
def mt_by_member(spark: SparkSession, d: str) -> DataFrame:
    return op.by_member(events(spark, d), "organization_id")


LEVELS = {"gender": F.col, "planned": F.col}
VIEWS["long_signal"] = "SELECT patient_id, outcome_readmitted AS hit, 'gender' AS signal, gender AS level FROM signal UNION ALL SELECT patient_id, outcome_readmitted, 'planned', CAST(is_planned AS VARCHAR) FROM signal UNION ALL SELECT patient_id, outcome_readmitted, 'reason', admit_reason FROM signal"
VIEWS["level"] = """SELECT signal, level, count(*) AS index_stays, count_if(hit) AS readmitted, count(DISTINCT CASE WHEN hit THEN patient_id END) AS readmitted_patients, (SELECT count(*) FROM signal) - count(*) AS rest_stays, (SELECT count_if(outcome_readmitted) FROM signal) - count_if(hit) AS rest_readmitted,
  (SELECT count(DISTINCT o.patient_id) FROM long_signal o WHERE o.signal = l.signal AND o.level IS DISTINCT FROM l.level AND o.hit) AS rest_patients FROM long_signal l GROUP BY signal, level"""


def levels(spark: SparkSession, d: str) -> DataFrame:
    return op.story_levels(signal(spark, d), {"gender": F.col("gender"), "planned": F.col("is_planned"), "reason": F.col("admit_reason")})


@query("SELECT * FROM level")
def mt_story_levels(spark: SparkSession, d: str) -> DataFrame:
    return levels(spark, d)


@query(f"""WITH a AS (SELECT *, index_stays::DOUBLE AS n, readmitted::DOUBLE AS k FROM level), b AS (SELECT *, {WILSON_LOW} AS low, {WILSON_HIGH} AS high FROM a), c AS (SELECT * REPLACE (rest_stays::DOUBLE AS n, rest_readmitted::DOUBLE AS k) FROM b), e AS (SELECT *, {WILSON_LOW} AS rest_low, {WILSON_HIGH} AS rest_high FROM c)
SELECT signal, level, least(index_stays, rest_stays) >= 30 AND CASE WHEN readmitted::DOUBLE / nullif(index_stays, 0) >= coalesce(rest_readmitted::DOUBLE / nullif(rest_stays, 0), 0) THEN readmitted_patients ELSE rest_patients END >= 10 AND (high < rest_low OR rest_high < low) AS separates FROM e""")
def mt_separates(spark: SparkSession, d: str) -> DataFrame:
    x = levels(spark, d)
    (low, high), (rest_low, rest_high) = wilson(F.col("readmitted"), F.col("index_stays")), wilson(F.col("rest_readmitted"), F.col("rest_stays"))
    higher = F.when(ratio(F.col("readmitted"), F.col("index_stays")) >= F.coalesce(ratio(F.col("rest_readmitted"), F.col("rest_stays")), F.lit(0.0)), F.col("readmitted_patients")).otherwise(F.col("rest_patients"))
    return x.select("signal", "level", ((F.least("index_stays", "rest_stays") >= 30) & (higher >= 10) & ((high < rest_low) | (rest_high < low))).alias("separates"))


@query("SELECT (SELECT count(*) FROM returns) AS stays, (SELECT count_if(is_index_stay) FROM returns) AS index_stays, (SELECT count(*) FROM encounter) AS visits")
def mt_story_totals(spark: SparkSession, d: str) -> DataFrame:
    e = events(spark, d)
    stays = op.stay_view(e).query([], ["stays"]).crossJoin(op.return_view(e).query([], ["index_stays"]))
    return stays.crossJoin(op.visit_view(a.encounter(spark, d)).query([], ["visits"]))


@query("SELECT patient_id, name, value FROM (SELECT patient_id, CAST(count(*) AS BIGINT) AS visits, CAST(count_if(encounter_class = 'inpatient') AS BIGINT) AS stays FROM encounter GROUP BY ALL) UNPIVOT (value FOR name IN (visits, stays))")
def mt_unpivot_scores(spark: SparkSession, d: str) -> DataFrame:
    g = a.encounter(spark, d).groupBy("patient_id").agg(F.count("*").alias("visits"), F.count_if(F.col("encounter_class") == "inpatient").alias("stays"))
    return g.unpivot(["patient_id"], ["visits", "stays"], "name", "value")
