"""Queries over rules, gates and reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnlake.operators import quality as op
from tarnlake.operators import stays as stay_op
from tarnlake.plans.registry import query
from tarnlake.plans.sql_views import VIEWS
from tarnlake.plans.stays import RULES, events, rd_merge_stays
from tarnlake.sources import adapters as a

#: Raw rows as they would arrive: strings, some of them broken.
VIEWS["raw_encounter"] = """SELECT CAST(encounter_id AS VARCHAR) AS id, CASE WHEN encounter_id % 97 = 0 THEN 'not a date' ELSE strftime(started_at, '%Y-%m-%d %H:%M:%S') END AS start, CASE WHEN encounter_id % 89 = 0 THEN '1990-01-01 00:00:00' ELSE strftime(stopped_at, '%Y-%m-%d %H:%M:%S') END AS stop,
  CAST(CASE WHEN encounter_id % 83 = 0 THEN -patient_id - 1 ELSE patient_id END AS VARCHAR) AS patient, CASE WHEN encounter_id % 79 = 0 THEN '' ELSE encounter_class END AS class FROM encounter"""
VIEWS["typed_encounter"] = """SELECT r.*, list_filter([CASE WHEN s IS NULL THEN 'start' END, CASE WHEN NOT coalesce(t >= s, false) THEN 'order' END, CASE WHEN known IS NULL THEN 'patient' END, CASE WHEN class = '' THEN 'class' END], lambda x: x IS NOT NULL) AS violations
  FROM (SELECT *, try_cast(start AS TIMESTAMP) AS s, try_cast(stop AS TIMESTAMP) AS t FROM raw_encounter) r LEFT JOIN (SELECT CAST(patient_id AS VARCHAR) AS known FROM patient) k ON k.known = r.patient"""


def raw(spark: SparkSession, d: str) -> DataFrame:
    e, i = a.encounter(spark, d), F.col("encounter_id")
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return e.select(i.cast("string").alias("id"), F.when(i % 97 == 0, "not a date").otherwise(text("started_at")).alias("start"), F.when(i % 89 == 0, "1990-01-01 00:00:00").otherwise(text("stopped_at")).alias("stop"),
                    F.when(i % 83 == 0, -F.col("patient_id") - 1).otherwise(F.col("patient_id")).cast("string").alias("patient"), F.when(i % 79 == 0, "").otherwise(F.col("encounter_class")).alias("class"))


def ruled(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    known = a.patient(spark, d).select(F.col("patient_id").cast("string").alias("patient"), F.lit(True).alias("known"))
    typed = raw(spark, d).withColumn("s", F.col("start").try_cast("timestamp")).withColumn("t", F.col("stop").try_cast("timestamp")).join(known, "patient", "left")
    rules = {"start": F.col("s").isNotNull(), "order": F.col("t") >= F.col("s"), "patient": F.col("known"), "class": F.col("class") != ""}
    return op.quarantine(typed, rules)


@query("SELECT id, violations FROM typed_encounter WHERE len(violations) > 0")
def dq_quarantine(spark: SparkSession, d: str) -> DataFrame:
    return ruled(spark, d)[1].select("id", "violations")


@query("SELECT id, s AS started_at FROM typed_encounter WHERE len(violations) = 0")
def dq_drop_row(spark: SparkSession, d: str) -> DataFrame:
    return ruled(spark, d)[0].select("id", F.col("s").alias("started_at"))


dm_encounter = query("SELECT id, patient, class, s AS started_at, t AS stopped_at FROM typed_encounter WHERE len(violations) = 0", "dm_encounter")(lambda spark, d: ruled(spark, d)[0].select("id", "patient", "class", F.col("s").alias("started_at"), F.col("t").alias("stopped_at")))


@query("SELECT unnest(violations) AS rule, count(*) AS rows FROM typed_encounter GROUP BY 1")
def dq_entity_rules(spark: SparkSession, d: str) -> DataFrame:
    return ruled(spark, d)[1].select(F.explode("violations").alias("rule")).groupBy("rule").agg(F.count("*").alias("rows"))


@query("SELECT count_if(len(violations) = 0) AS passed, count_if(len(violations) > 0) AS quarantined FROM typed_encounter")
def mt_dq_report(spark: SparkSession, d: str) -> DataFrame:
    good, bad = ruled(spark, d)
    return good.agg(F.count("*").alias("passed")).crossJoin(bad.agg(F.count("*").alias("quarantined")))


@query("SELECT 'cost_known' AS rule, count_if(NOT coalesce(total_cost > 0, false)) AS failures FROM encounter UNION ALL SELECT 'reason_known', count_if(reason IS NULL) FROM encounter UNION ALL SELECT 'ordered', count_if(NOT coalesce(stopped_at >= started_at, false)) FROM encounter")
def dq_row_gate(spark: SparkSession, d: str) -> DataFrame:
    return op.row_gate(a.encounter(spark, d), {"cost_known": F.col("total_cost") > 0, "reason_known": F.col("reason").isNotNull(), "ordered": F.col("stopped_at") >= F.col("started_at")})


@query("""SELECT 'encounters without patient' AS name, (SELECT count(*) FROM encounter WHERE patient_id NOT IN (SELECT patient_id FROM patient)) AS violations UNION ALL SELECT 'stay copies', (SELECT count(*) - count(DISTINCT (patient_id, stay_no)) FROM stay)
UNION ALL SELECT 'stays without order', (SELECT count(*) FROM stay WHERE discharge_day < admit_day) UNION ALL SELECT 'overlapping stays', (SELECT count(*) FROM (SELECT admit_day, lag(discharge_day) OVER (PARTITION BY patient_id ORDER BY stay_no) AS b FROM stay) WHERE admit_day <= b)
UNION ALL SELECT 'encounters lost', (SELECT (SELECT count(*) FROM eligible) - sum(encounters_in_stay) FROM stay)""")
def dq_gate_row(spark: SparkSession, d: str) -> DataFrame:
    e, s = a.encounter(spark, d), rd_merge_stays(spark, d)
    before = F.lag("discharge_day").over(Window.partitionBy("patient_id").orderBy("stay_no"))
    lost = stay_op.eligible_days(e).agg(F.count("*").alias("n")).crossJoin(s.agg(F.sum("encounters_in_stay").alias("m"))).select(F.col("n") - F.col("m"))
    return op.gate({
        "encounters without patient": op.orphans(e, a.patient(spark, d), "patient_id", "patient_id"), "stay copies": op.key_copies(s, "patient_id", "stay_no"), "stays without order": s.agg(F.count_if(F.col("discharge_day") < F.col("admit_day"))),
        "overlapping stays": s.withColumn("b", before).agg(F.count_if(F.col("admit_day") <= F.col("b"))), "encounters lost": lost})


@query("SELECT count_if(s_suppkey IS NULL) AS orphans FROM encounter LEFT JOIN (SELECT s_suppkey FROM supplier WHERE s_suppkey < 25) ON s_suppkey = organization_id")
def dq_referential(spark: SparkSession, d: str) -> DataFrame:
    return op.orphans(a.encounter(spark, d), a.table(spark, d, "supplier").where("s_suppkey < 25"), "organization_id", "s_suppkey")


@query("SELECT count(*) - count(DISTINCT (patient_id, code)) AS copies FROM procedure")
def dq_unique_key(spark: SparkSession, d: str) -> DataFrame:
    return op.key_copies(a.procedure(spark, d), "patient_id", "code")


@query("SELECT (SELECT CAST(sum(total_cost) AS DECIMAL(24,2)) FROM eligible) AS eligible_cost, (SELECT CAST(sum(stay_cost) AS DECIMAL(34,2)) FROM stay_cost) AS stay_cost, true AS balanced")
def dq_balance(spark: SparkSession, d: str) -> DataFrame:
    e = a.encounter(spark, d)
    one = stay_op.eligible_days(e).agg(F.sum("total_cost").alias("eligible_cost"))
    two = stay_op.stay_costs(rd_merge_stays(spark, d), e).agg(F.sum("stay_cost").alias("stay_cost"))
    return one.crossJoin(two).withColumn("balanced", F.abs(F.col("eligible_cost") - F.col("stay_cost")) <= 1)


@query("SELECT encounter_class AS value, count(*) AS rows FROM encounter WHERE encounter_class NOT IN ('inpatient', 'emergency', 'ambulatory') GROUP BY ALL")
def dq_unmapped_value(spark: SparkSession, d: str) -> DataFrame:
    known = spark.createDataFrame([("inpatient",), ("emergency",), ("ambulatory",)], "encounter_class string")
    return a.encounter(spark, d).join(F.broadcast(known), "encounter_class", "left_anti").groupBy(F.col("encounter_class").alias("value")).agg(F.count("*").alias("rows"))


@query(r"SELECT count_if(regexp_matches(p_name, '\bring\b') AND p_name NOT LIKE '%ring') AS false_hits, count_if(p_name LIKE '% ring' AND NOT regexp_matches(p_name, '\bring\b')) AS missed FROM part")
def dq_two_way_text(spark: SparkSession, d: str) -> DataFrame:
    hit, like = F.col("p_name").rlike(r"\bring\b"), F.col("p_name")
    return a.table(spark, d, "part").agg(F.count_if(hit & ~like.like("%ring")).alias("false_hits"), F.count_if(like.like("% ring") & ~hit).alias("missed"))


@query("""WITH halves AS (SELECT DISTINCT patient_id, unnest(generate_series(2 * datediff('day', DATE '1970-01-01', start_day), 2 * datediff('day', DATE '1970-01-01', stop_day))) AS half FROM eligible),
runs AS (SELECT patient_id, min(half) AS a, max(half) AS b FROM (SELECT *, half - row_number() OVER (PARTITION BY patient_id ORDER BY half) AS run FROM halves) GROUP BY patient_id, run),
days AS (SELECT patient_id, DATE '1970-01-01' + (a // 2)::INT AS admit_day, DATE '1970-01-01' + (b // 2)::INT AS discharge_day FROM runs), own AS (SELECT patient_id, admit_day, discharge_day FROM stay)
SELECT (SELECT count(*) FROM own) AS left_rows, (SELECT count(*) FROM days) AS right_rows, (SELECT count(*) FROM (FROM own EXCEPT ALL FROM days)) AS only_left, (SELECT count(*) FROM (FROM days EXCEPT ALL FROM own)) AS only_right""")
def dq_reconcile(spark: SparkSession, d: str) -> DataFrame:
    """The stays merged by windows against a second build from days in hospital, compared row by row."""
    return op.reconcile(events(spark, d).select("patient_id", "admit_day", "discharge_day"), stay_op.stays_by_days(a.encounter(spark, d)))


@query("SELECT count(*) AS chunks, count(DISTINCT note_id) AS notes, 0::BIGINT AS broken FROM (SELECT note_id, unnest(generate_series(0, greatest((length(note_text) - 1) // 1800, 0))) AS i FROM note)")
def dq_text_rebuild(spark: SparkSession, d: str) -> DataFrame:
    from tarnlake.operators.spans import chunk_notes, rebuild_notes

    chunks = chunk_notes(a.note(spark, d), "note_id", "note_text")
    back = rebuild_notes(chunks, "note_id").join(a.note(spark, d), "note_id")
    return chunks.agg(F.count("*").alias("chunks"), F.count_distinct("note_id").alias("notes")).crossJoin(back.agg(F.count_if(~F.col("rebuilt").eqNullSafe(F.col("note_text"))).alias("broken")))


@query("SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'Encounter' ELSE 'Condition' END AS kind, count(*) AS resources FROM orders GROUP BY ALL")
def dq_source_probe(spark: SparkSession, d: str) -> DataFrame:
    return bundles(spark, d).select(F.get_json_object("resource", "$.resourceType").alias("kind")).groupBy("kind").agg(F.count("*").alias("resources"))


def bundles(spark: SparkSession, d: str) -> DataFrame:
    """Nested documents made of orders: one resource as text per row, routed by its type."""
    o = a.table(spark, d, "orders")
    kind = F.when(F.col("o_orderkey") % 2 == 0, "Encounter").otherwise("Condition")
    subject = F.struct(F.concat(F.lit("urn:uuid:"), F.col("o_custkey")).alias("reference"))
    doc = F.struct(F.array(F.struct(F.to_json(F.struct(kind.alias("resourceType"), F.col("o_orderkey").cast("string").alias("id"), subject.alias("subject"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("onset"))).alias("resource"))).alias("entry"))
    return o.select(F.from_json(F.to_json(doc), "entry ARRAY<STRUCT<resource: STRING>>").alias("bundle")).select(F.explode("bundle.entry").alias("e")).select("e.resource")


@query("SELECT o_orderkey AS id, o_custkey AS patient_id, CAST(o_orderdate AS DATE) AS onset FROM orders WHERE o_orderkey % 2 <> 0")
def src_json_typed(spark: SparkSession, d: str) -> DataFrame:
    r = bundles(spark, d).where(F.get_json_object("resource", "$.resourceType") == "Condition").select(F.from_json("resource", "id STRING, subject STRUCT<reference: STRING>, onset DATE").alias("r"))
    return r.select(F.col("r.id").cast("long").alias("id"), F.regexp_replace("r.subject.reference", "^urn:uuid:", "").cast("long").alias("patient_id"), "r.onset")


dm_flatten_fhir = query("SELECT o_orderkey AS id, o_custkey AS patient_id FROM orders WHERE o_orderkey % 2 = 0", "dm_flatten_fhir")(
    lambda spark, d: bundles(spark, d).select(F.from_json("resource", "resourceType STRING, id STRING, subject STRUCT<reference: STRING>").alias("r")).where("r.resourceType = 'Encounter'").select(F.col("r.id").cast("long").alias("id"), F.regexp_replace("r.subject.reference", "^urn:uuid:", "").cast("long").alias("patient_id")))


@query("SELECT count(*) AS left_rows, count(*) AS right_rows, 0::BIGINT AS only_left, 0::BIGINT AS only_right FROM orders WHERE o_orderkey % 2 = 0")
def dq_fhir_reconcile(spark: SparkSession, d: str) -> DataFrame:
    tabular = a.table(spark, d, "orders").where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("patient_id"))
    return op.reconcile(dm_flatten_fhir(spark, d), tabular)


FINGERPRINT = "SELECT count(*) AS rows, CAST(sum(('0x' || left(md5(concat_ws(chr(1), {0})), 15))::HUGEINT) AS VARCHAR) AS digest_sum FROM {1}"


def _texts(*columns: str) -> str:
    return ", ".join(f"coalesce(CAST({x} AS VARCHAR), chr(0))" for x in columns)


@query(FINGERPRINT.format(_texts("encounter_id", "patient_id", "encounter_class", "reason", "total_cost"), "encounter"))
def ag_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    """One number for a table's rows, whatever their order."""
    return op.fingerprint(a.encounter(spark, d).select("encounter_id", "patient_id", "encounter_class", "reason", "total_cost"))


@query(" UNION ALL ".join(f"SELECT '{n}' AS name, rows, digest_sum FROM ({FINGERPRINT.format(_texts(*x), n)})" for n, x in (("patient", ("patient_id", "full_name", "birth_date", "state")), ("condition", ("patient_id", "encounter_id", "code", "onset_date", "resolved_date")))))
def dq_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    """Fingerprints of several tables, to be compared before and after a change."""
    one = lambda name, *x: op.fingerprint(getattr(a, name)(spark, d).select(*x)).withColumn("name", F.lit(name))
    return one("patient", "patient_id", "full_name", "birth_date", "state").unionByName(one("condition", "patient_id", "encounter_id", "code", "onset_date", "resolved_date"))


assert RULES.window_days == 30
