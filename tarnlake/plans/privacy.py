"""Queries over masks, de-identification and suppression."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnlake.operators import privacy as op
from tarnlake.plans.measures import levels
from tarnlake.plans.registry import query
from tarnlake.plans.sql_views import VIEWS
from tarnlake.sources import adapters as a

TAGS = {"full_name": "name", "birth_date": "date", "death_date": "date", "zip": "zip"}


@query("SELECT patient_id, '***' AS full_name, CAST(date_trunc('year', birth_date) AS DATE) AS birth_date, CAST(date_trunc('year', death_date) AS DATE) AS death_date, gender, state, left(zip, 3) AS zip, payer, income FROM patient")
def pv_masked_view(spark: SparkSession, d: str) -> DataFrame:
    return op.masked_view(a.patient(spark, d), TAGS, cleared=False)


@query("SELECT note_id, '***' AS source_file, length(note_text) AS chars FROM note")
def pv_note_path_mask(spark: SparkSession, d: str) -> DataFrame:
    notes = a.note(spark, d).select("note_id", F.concat(F.lit("notes/"), "note_id").alias("source_file"), F.char_length("note_text").cast("long").alias("chars"))
    return op.masked_view(notes, {"source_file": "path"}, cleared=False)


@query("SELECT DISTINCT encounter_class AS tag FROM encounter WHERE encounter_class NOT IN ('inpatient', 'emergency', 'ambulatory')")
def pv_tag_vocabulary(spark: SparkSession, d: str) -> DataFrame:
    declared = spark.createDataFrame([("inpatient",), ("emergency",), ("ambulatory",)], "tag string")
    return a.encounter(spark, d).select(F.col("encounter_class").alias("tag")).distinct().join(declared, "tag", "left_anti")


@query("SELECT patient_id, state FROM patient WHERE state IN ('NATION_3', 'NATION_7')")
def pv_row_scope(spark: SparkSession, d: str) -> DataFrame:
    scopes = spark.createDataFrame([("ana", "NATION_3"), ("ana", "NATION_7"), ("bo", "*")], "reader string, scope string")
    return op.row_scope(a.patient(spark, d), scopes, "ana").select("patient_id", "state")


udf_filter_state = query("SELECT patient_id, state FROM patient", "udf_filter_state")(lambda spark, d: op.row_scope(a.patient(spark, d), spark.createDataFrame([("bo", "*")], "reader string, scope string"), "bo").select("patient_id", "state"))


@query("SELECT patient_id, full_name FROM patient")
def udf_is_cleared(spark: SparkSession, d: str) -> DataFrame:
    clearance = spark.createDataFrame([("ana", "full")], "reader string, clearance string")
    return op.masked_view(a.patient(spark, d), TAGS, cleared=not clearance.where("reader = 'ana' AND clearance = 'full'").isEmpty()).select("patient_id", "full_name")


@query("SELECT patient_id, '***' AS text, CAST(date_trunc('year', birth_date) AS DATE) AS day, left(zip, 3) AS zip, CAST(NULL AS DOUBLE) AS point FROM patient")
def udf_masks(spark: SparkSession, d: str) -> DataFrame:
    m = op.MASKS
    return a.patient(spark, d).select("patient_id", m["name"](F.col("full_name")).alias("text"), m["date"](F.col("birth_date")).alias("day"), m["zip"](F.col("zip")).alias("zip"), m["point"](F.col("income")).alias("point"))


VIEWS["banded"] = """SELECT *, CASE WHEN age <= 89 THEN CAST(year(birth_date) // 5 * 5 AS INT) END AS b, CASE WHEN age <= 89 THEN CAST(year(death_date) // 5 * 5 AS INT) END AS dd FROM (SELECT *, datesub('month', birth_date, coalesce(death_date, DATE '2001-06-30')) // 12 AS age FROM patient)"""
VIEWS["deid"] = """SELECT patient_id, CASE WHEN NOT hidden THEN b END AS birth_year_from, CASE WHEN NOT hidden THEN dd END AS death_year_from, hidden AS years_suppressed, CASE WHEN NOT hidden THEN death_date IS NOT NULL END AS is_deceased, gender, state
  FROM (SELECT *, count(*) OVER (PARTITION BY b, gender, dd) < 5 OR age > 89 AS hidden FROM banded)"""


def deid(spark: SparkSession, d: str) -> DataFrame:
    return op.deid_patients(a.patient(spark, d), F.lit("2001-06-30").cast("date"))


@query("SELECT * FROM deid")
def pv_deid_patient(spark: SparkSession, d: str) -> DataFrame:
    return deid(spark, d)


@query("SELECT patient_id, encounter_id, started_at + to_days(CAST(patient_id % 364 + 1 AS INT)) AS started_at, stopped_at + to_days(CAST(patient_id % 364 + 1 AS INT)) AS stopped_at, encounter_class FROM encounter")
def pv_deid_encounter(spark: SparkSession, d: str) -> DataFrame:
    keys = a.patient(spark, d).select("patient_id", (F.col("patient_id") % 364 + 1).cast("int").alias("offset_days"))
    return op.shift_encounters(a.encounter(spark, d), keys)


@query("SELECT patient_id, left(h, 32) AS deid_id, CAST(('0x' || substr(h, 33, 8))::BIGINT % 364 + 1 AS INT) AS offset_days FROM (SELECT patient_id, sha256('round salt:' || patient_id) AS h FROM patient WHERE patient_id % 10 <> 0)")
def pv_deid_key(spark: SparkSession, d: str) -> DataFrame:
    p = a.patient(spark, d)
    return op.deid_keys(p, p.where("patient_id % 10 = 0").select("patient_id"), "round salt")


@query("SELECT 0::BIGINT AS repeated_ids, count(*) AS patients, 0::BIGINT AS changed_gaps FROM patient")
def pv_deid_checks(spark: SparkSession, d: str) -> DataFrame:
    p, e = a.patient(spark, d), a.encounter(spark, d)
    keys = op.deid_keys(p, p.limit(0).select("patient_id"), "round salt")
    moved = op.shift_encounters(e, keys)
    changed = e.alias("o").join(moved.alias("m"), "encounter_id").select(F.expr("(unix_timestamp(o.stopped_at) - unix_timestamp(o.started_at)) <> (unix_timestamp(m.stopped_at) - unix_timestamp(m.started_at))").alias("x"))
    return keys.agg((F.count("*") - F.count_distinct("deid_id")).alias("repeated_ids"), F.count("*").alias("patients")).crossJoin(changed.agg(F.count_if("x").alias("changed_gaps")))


@query("""WITH s AS (SELECT 'plan' AS version, count(*) AS n FROM patient GROUP BY birth_date, left(zip, 3), gender UNION ALL SELECT 'released', count(*) FROM deid GROUP BY birth_year_from, death_year_from, years_suppressed, is_deceased, gender)
SELECT version, CASE WHEN n >= 11 THEN '11+' WHEN n >= 5 THEN '5-10' ELSE CAST(n AS VARCHAR) END AS k, count(*) AS groups, CAST(sum(n) AS BIGINT) AS people FROM s GROUP BY 1, 2""")
def pv_kanon(spark: SparkSession, d: str) -> DataFrame:
    plan = [F.col("birth_date"), F.substring("zip", 1, 3), F.col("gender")]
    released = [F.col(c) for c in ("birth_year_from", "death_year_from", "years_suppressed", "is_deceased", "gender")]
    return op.k_anonymity({"plan": (a.patient(spark, d), plan), "released": (deid(spark, d), released)})


VIEWS["small"] = "SELECT *, index_stays < 11 OR readmitted BETWEEN 1 AND 10 OR rest_stays < 11 OR rest_readmitted BETWEEN 1 AND 10 AS suppressed FROM level"


@query("SELECT signal, level, suppressed, CASE WHEN NOT suppressed THEN readmitted END AS readmitted FROM small")
def pv_small_cell(spark: SparkSession, d: str) -> DataFrame:
    return op.small_cells(levels(spark, d)).select("signal", "level", "suppressed", F.when(~F.col("suppressed"), F.col("readmitted")).alias("readmitted"))


VIEWS["cell"] = "SELECT CAST(c_nationkey % 5 AS VARCHAR) AS signal, CAST(c_nationkey AS VARCHAR) || CASE WHEN c_custkey % 3 = 0 THEN 'a' ELSE 'b' END AS level, count(*) AS index_stays, count_if(c_custkey % 9 = 0) AS readmitted FROM customer GROUP BY ALL"
VIEWS["celled"] = "SELECT *, sum(index_stays) OVER (PARTITION BY signal) - index_stays AS rest_stays, sum(readmitted) OVER (PARTITION BY signal) - readmitted AS rest_readmitted FROM cell"


def cells(spark: SparkSession, d: str) -> DataFrame:
    own = Window.partitionBy("signal")
    level = F.concat(F.col("c_nationkey").cast("string"), F.when(F.col("c_custkey") % 3 == 0, "a").otherwise("b"))
    g = a.table(spark, d, "customer").groupBy((F.col("c_nationkey") % 5).cast("string").alias("signal"), level.alias("level")).agg(F.count("*").alias("index_stays"), F.count_if(F.col("c_custkey") % 9 == 0).alias("readmitted"))
    return g.withColumn("rest_stays", F.sum("index_stays").over(own) - F.col("index_stays")).withColumn("rest_readmitted", F.sum("readmitted").over(own) - F.col("readmitted"))


@query("""WITH RECURSIVE b AS (SELECT *, index_stays < 11 OR readmitted BETWEEN 1 AND 10 OR rest_stays < 11 OR rest_readmitted BETWEEN 1 AND 10 AS s0, count(*) OVER (PARTITION BY signal) AS n FROM celled),
o AS (SELECT *, row_number() OVER (PARTITION BY signal ORDER BY s0, level <> 'other', readmitted = 0, readmitted, index_stays, level) AS step FROM b),
t AS (SELECT signal, k, count(*) FILTER (WHERE s0 OR step <= k) AS h, coalesce(sum(index_stays) FILTER (WHERE s0 OR step <= k), 0) AS hs, coalesce(sum(readmitted) FILTER (WHERE s0 OR step <= k), 0) AS hr, any_value(n) AS n
  FROM o CROSS JOIN (SELECT unnest(generate_series(0, 20)) AS k) GROUP BY signal, k),
w AS (SELECT signal, min(k) AS k FROM t WHERE h >= n OR NOT (h = 1 OR (hs > 0 AND (hs < 11 OR hr BETWEEN 1 AND 10))) GROUP BY signal)
SELECT o.signal, o.level, s0 OR step <= k AS suppressed FROM o JOIN w USING (signal)""".replace("WITH RECURSIVE ", "WITH "))
def pv_complementary(spark: SparkSession, d: str) -> DataFrame:
    return op.complementary(op.small_cells(cells(spark, d))).select("signal", "level", "suppressed")


@query("""WITH r AS (SELECT signal, level, readmitted, readmitted BETWEEN 1 AND 10 AS small, row_number() OVER (PARTITION BY signal ORDER BY readmitted BETWEEN 1 AND 10 DESC, readmitted, level) AS p FROM celled),
q AS (SELECT *, count_if(NOT small) OVER w AS j, sum(CASE WHEN small THEN 0 ELSE readmitted END) OVER w AS s, lead(readmitted) OVER (PARTITION BY signal ORDER BY p) AS nxt, bool_or(small) OVER (PARTITION BY signal) AS has_small FROM r WINDOW w AS (PARTITION BY signal ORDER BY p ROWS UNBOUNDED PRECEDING)),
n AS (SELECT *, min(CASE WHEN NOT small AND (nxt IS NULL OR s - j * nxt <= 1) THEN j END) OVER (PARTITION BY signal) AS need FROM q)
SELECT signal, level, coalesce(has_small AND (small OR j <= need), false) AS hidden FROM n""")
def pv_secondary_interval(spark: SparkSession, d: str) -> DataFrame:
    return op.secondary(cells(spark, d), "signal", "readmitted", "level").select("signal", "level", "hidden")


VIEWS["guarded"] = "SELECT signal, count_if(readmitted BETWEEN 1 AND 10) AS alone, sum(CASE WHEN readmitted BETWEEN 1 AND 10 THEN readmitted ELSE 0 END) AS under, sum(CASE WHEN readmitted BETWEEN 1 AND 10 THEN 0 ELSE readmitted END) AS shown, sum(readmitted) AS total FROM cell GROUP BY signal"


@query("""SELECT * FROM (SELECT 'no role: rest_stays' AS problem, count(*) AS rows FROM celled UNION ALL SELECT 'no role: rest_readmitted', count(*) FROM celled UNION ALL SELECT 'small count: readmitted', count_if(readmitted BETWEEN 1 AND 10) FROM celled
UNION ALL SELECT 'unknown text: signal', count_if(signal NOT IN ('0', '1', '2', '3')) FROM celled UNION ALL SELECT 'lone hidden level', count_if(alone = 1) FROM guarded UNION ALL SELECT 'small hidden sum', count_if(under BETWEEN 1 AND 10) FROM guarded
UNION ALL SELECT 'small leftover', count_if(total - shown BETWEEN 1 AND 10) FROM guarded) WHERE rows > 0""")
def pv_publish_guard(spark: SparkSession, d: str) -> DataFrame:
    """All six refusals: texts, roles and counts by column, and what hidden levels give away by group."""
    rows = cells(spark, d)
    columns = op.publish_guard(rows, {"index_stays": "size", "readmitted": "count"}, {"signal": ["0", "1", "2", "3"]})
    tile = rows.groupBy("signal").agg(F.sum("readmitted").alias("total"))
    return columns.unionByName(op.hidden_refusals(rows, "signal", "readmitted", op.is_small(F.col("readmitted")), tile))


@query("SELECT payer, CASE WHEN payer = 'BUILDING' THEN payer ELSE 'Payer ' || row_number() OVER (PARTITION BY payer = 'BUILDING' ORDER BY count(*) DESC, payer) END AS pseudonym FROM patient GROUP BY payer")
def pv_pseudonymise(spark: SparkSession, d: str) -> DataFrame:
    g = a.patient(spark, d).groupBy("payer").agg(F.count("*").alias("n"))
    return op.pseudonyms(g, "payer", F.col("n"), "Payer", ["BUILDING"]).select("payer", "pseudonym")


@query("SELECT n_name AS table_name, CAST(count(*) AS BIGINT) AS runs FROM events JOIN nation ON contains(lower('select * from ' || 'nation_' || (user_id % 25)), lower(n_name)) GROUP BY n_name")
def pv_access_audit(spark: SparkSession, d: str) -> DataFrame:
    log = a.table(spark, d, "events").select(F.concat(F.lit("SELECT * FROM NATION_"), F.col("user_id") % 25).alias("statement"))
    return op.access_audit(log, a.table(spark, d, "nation").select(F.col("n_name").alias("table_name")))
