"""Clinical entities as deterministic views of order, part and event tables.

Integer arithmetic only, so that any engine can state the same views.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.functions.columns import local_day


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def patient(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("patient_id"), F.col("c_name").alias("full_name"),
        F.expr("date_add(DATE'1925-01-01', cast(c_custkey * 7919 % 24000 AS int))").alias("birth_date"),
        F.expr("CASE WHEN c_custkey % 9 = 0 THEN date_add(DATE'1996-01-01', cast(c_custkey * 31 % 2000 AS int)) END").alias("death_date"),
        F.expr("CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END").alias("gender"),
        F.col("n_name").alias("state"), F.expr("lpad(cast(c_custkey * 37 % 90000 + 10000 AS string), 5, '0')").alias("zip"),
        F.col("c_mktsegment").alias("payer"), F.col("c_acctbal").cast("decimal(14,2)").alias("income"))


def encounter(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    o = o.withColumn("started_at", F.expr("o_orderdate + make_dt_interval(0, 0, 0, o_orderkey * 7919 % 86400)"))
    kind = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "inpatient").when(F.col("o_orderpriority") == "3-MEDIUM", "emergency").when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "ambulatory")
    kind = kind.otherwise(F.when(F.col("o_orderkey") % 10 == 0, "hospice").otherwise("wellness"))
    return o.select(
        F.col("o_orderkey").alias("encounter_id"), F.col("o_custkey").alias("patient_id"), "started_at",
        F.expr("started_at + make_dt_interval(0, cast(o_orderkey * 31 % 240 AS int))").alias("stopped_at"), kind.alias("encounter_class"),
        F.expr("CASE WHEN o_orderkey % 11 <> 0 THEN concat('reason ', o_orderkey % 12) END").alias("reason"),
        (F.col("o_orderkey") % 30).alias("organization_id"), F.col("o_totalprice").cast("decimal(14,2)").alias("total_cost"),
        (F.col("o_totalprice") * 0.8).cast("decimal(14,2)").alias("payer_paid"))


def _line(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("patient_id"))
    return table(spark, sf_dir, "lineitem").withColumn("day", F.to_date("l_shipdate")).join(orders, "l_orderkey")


def condition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _line(spark, sf_dir).where("l_returnflag <> 'R'").select(
        "patient_id", F.col("l_orderkey").alias("encounter_id"), F.expr("concat('C', l_partkey % 40)").alias("code"), F.col("day").alias("onset_date"),
        F.expr("CASE WHEN l_returnflag = 'A' THEN date_add(day, cast(l_quantity * 10 AS int)) END").alias("resolved_date"))


def procedure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _line(spark, sf_dir).where("l_returnflag = 'R'").select("patient_id", F.col("l_orderkey").alias("encounter_id"), F.expr("concat('P', l_partkey % 40)").alias("code"), F.col("day").alias("done_on"))


def medication(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    return _line(spark, sf_dir).join(part, "l_partkey").select(
        "patient_id", F.expr("CASE WHEN l_partkey % 50 = 0 THEN concat('string of ', p_name, 's') ELSE p_name END").alias("description"), F.col("day").alias("started_on"),
        F.expr("CASE WHEN l_linestatus = 'F' THEN date_add(day, cast(l_quantity AS int)) END").alias("stopped_on"))


def observation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("observation_id"), F.col("user_id").alias("patient_id"), F.expr("CASE event_type WHEN 'view' THEN 'systolic' WHEN 'click' THEN 'diastolic' WHEN 'purchase' THEN 'hba1c' WHEN 'signup' THEN 'bmi' ELSE 'other' END").alias("code"),
        F.col("ts").cast("timestamp").alias("observed_at"), F.col("value"))


def note(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("note_id"), F.col("text").alias("note_text"))


def identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What names a patient, by kind: ``patient_id, given, family, place, born_in, zip, ssn, license, passport``."""
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("_n"), F.initcap(F.lower("n_name")).alias("born_in"))
    keys = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("patient_id"), (F.col("c_custkey") * 7 % 25).alias("_n"), F.initcap(F.lower("c_mktsegment")).alias("given"))
    pad = lambda x, n: f"lpad(cast({x} AS string), {n}, '0')"
    return patient(spark, sf_dir).select("patient_id", F.col("full_name").alias("family"), F.col("state").alias("place"), "zip").join(keys, "patient_id").join(nation, "_n").select(
        "patient_id", "given", "family", "place", "born_in", "zip", F.expr(f"concat({pad('patient_id % 900 + 100', 3)}, '-', {pad('patient_id * 31 % 90 + 10', 2)}, '-', {pad('patient_id * 7919 % 9000 + 1000', 4)})").alias("ssn"),
        F.expr(f"concat('S', {pad('patient_id * 97 % 100000000', 8)})").alias("license"), F.expr(f"concat('X', {pad('patient_id * 89 % 10000000', 7)}, 'X')").alias("passport"))


def chart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``note_id, patient_id, note_text``: each document as a note about a patient, whose details stand before, between and after its text."""
    own = identity(spark, sf_dir).join(patient(spark, sf_dir).select("patient_id", "birth_date", "death_date"), "patient_id")
    seen = encounter(spark, sf_dir).select("patient_id", local_day("started_at").alias("day")).groupBy("patient_id").agg(F.min("day").alias("first_visit"), F.max("day").alias("last_visit"))
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("note_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = docs.crossJoin(F.broadcast(own.agg(F.max("patient_id").alias("_most")))).withColumn("patient_id", F.col("note_id") % F.col("_most") + 1)
    rows = rows.join(own, "patient_id").join(seen, "patient_id", "left")
    day = lambda c, f: F.coalesce(F.date_format(c, f), F.lit("unknown"))
    half = F.floor(F.char_length("text") / 2).cast("int")
    head = F.concat("given", F.lit(" "), "family", F.lit(" of "), "place", F.lit(" ("), "zip", F.lit("), born "), day("birth_date", "MMMM d, yyyy"), F.lit(" in "), "born_in", F.lit(". The re"), "given", F.lit(" stays. "))
    middle = F.concat(F.lit("\n"), "family", F.lit(", ssn "), "ssn", F.lit(", seen "), day("first_visit", "yyyy-MM-dd"), F.lit(" and "), day("last_visit", "M/d/yyyy"), F.lit("; "), "given", F.lit(" is a "), (F.col("note_id") % 120).cast("string"), F.lit(" year-old.\n"))
    tail = F.concat(F.lit(" License "), "license", F.lit(", passport "), "passport", F.lit(", last on "), day("last_visit", "d MMMM yyyy"), F.lit(", died "), day("death_date", "MM/dd/yyyy"), F.lit(", not on 1/1/1900."))
    return rows.select("note_id", "patient_id", F.concat(head, F.substring(F.col("text"), F.lit(1), half), middle, F.col("text").substr(half + 1, F.char_length("text")), tail).alias("note_text"))


def private_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``patient_id, category, needle``: all values of a patient's tables that must not be left in a note, but dates."""
    kinds = {"given": "name", "family": "name", "place": "geography", "born_in": "geography", "zip": "zip", "ssn": "ssn", "license": "license", "passport": "other_id"}
    pairs = F.array(*[F.struct(F.lit(k).alias("category"), F.trim(c).alias("needle")) for c, k in kinds.items()])
    return identity(spark, sf_dir).select("patient_id", F.explode(pairs).alias("x")).select("patient_id", "x.*").where("needle <> ''").distinct()


def private_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``patient_id, day``: birth, death and every visit's local day."""
    people = patient(spark, sf_dir)
    return people.select("patient_id", F.col("birth_date").alias("day")).unionByName(people.select("patient_id", F.col("death_date").alias("day"))).unionByName(
        encounter(spark, sf_dir).select("patient_id", local_day("started_at").alias("day"))).where("day IS NOT NULL").distinct()


#: Code lists: fixed values of the care measures over the codes of these views.
MEASURES = [("lab_done", "C1"), ("lab_done", "C2"), ("pressure_controlled", "C3"), ("pressure_controlled", "C4"), ("drug_taken", "C5"), ("drug_taken", "C6")]
PLANNED_REASONS = ["reason 3", "reason 7"]
CANCER_PROCEDURES, SCHEDULED_SURGERY, EMERGENCY_SURGERY = ["P1"], ["P2", "P3"], ["P4"]


def measure_codes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(MEASURES, "measure string, code string")
