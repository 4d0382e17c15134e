"""Queries that write to storage, ingest from it or stream, and read back what is there then."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyarrow import fs as pa_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tarnlake.functions import columns as c
from tarnlake.operators import quality, refresh
from tarnlake.plans.registry import query
from tarnlake.sources import adapters as a
from tarnlake.sources import sinks
from tarnlake.sources.shared import shared_folder
from tarnlake.streaming import ingest

VISIT = ["encounter_id", "patient_id", "encounter_class"]
EARLY = "encounter_id % 2 = 0"


def visits(spark: SparkSession, d: str) -> DataFrame:
    return a.encounter(spark, d).select(*VISIT)


def land(df: DataFrame, folder: str) -> None:
    """Rows as one more batch of CSV files with a header in a landing folder."""
    df.write.mode("append").option("header", True).csv(folder)


@query("SELECT CAST(encounter_id AS VARCHAR) AS encounter_id, CAST(patient_id AS VARCHAR) AS patient_id, encounter_class FROM encounter")
def src_csv_stream(spark: SparkSession, d: str) -> DataFrame:
    """A directory of CSV files with headers, streamed into a table of strings."""
    root = shared_folder(spark, "csv-stream")
    land(visits(spark, d), f"{root}/in")
    ingest.ingest_csv(spark, f"{root}/in", VISIT, f"{root}/out", f"{root}/state", "b1")
    return spark.read.parquet(f"{root}/out").select(*VISIT)


@query(f"SELECT CASE WHEN {EARLY} THEN 'b1' ELSE 'b2' END AS batch, count(*) AS rows FROM encounter GROUP BY ALL")
def sm_incremental_files(spark: SparkSession, d: str) -> DataFrame:
    """A second batch beside the first adds only its own rows; a third run adds none."""
    root = shared_folder(spark, "incremental")

    def run(batch: str) -> None:
        ingest.ingest_csv(spark, f"{root}/in", VISIT, f"{root}/out", f"{root}/state", batch)

    land(visits(spark, d).where(EARLY), f"{root}/in")
    run("b1")
    land(visits(spark, d).where(f"NOT {EARLY}"), f"{root}/in")
    run("b2")
    run("b3")
    return spark.read.parquet(f"{root}/out").groupBy(F.col("_batch_id").alias("batch")).agg(F.count("*").alias("rows"))


@query(f"SELECT CAST(encounter_id AS VARCHAR) AS encounter_id, CASE WHEN NOT {EARLY} THEN reason END AS reason, CASE WHEN NOT {EARLY} AND encounter_id % 5 = 0 THEN encounter_class || ', ' || patient_id END AS remark, CASE WHEN {EARLY} THEN 'b1' ELSE 'b2' END AS batch FROM encounter")
def src_schema_evolve(spark: SparkSession, d: str) -> DataFrame:
    """Later files bring new columns, one with commas in its name and values; the running stream widens its table, and earlier rows have none."""
    root = shared_folder(spark, "evolve")
    rows = a.encounter(spark, d).select("encounter_id", "reason", F.concat("encounter_class", F.lit(", "), "patient_id").alias("remark, free"))
    late = rows.where(f"NOT {EARLY}")
    batches = {"b1": [rows.where(EARLY).select("encounter_id")], "b2": [late.where("encounter_id % 5 <> 0").select("reason", "encounter_id"), late.where("encounter_id % 5 = 0")], "b3": []}
    for batch, parts in batches.items():
        for part in parts:
            land(part, f"{root}/in")
        ingest.ingest_evolving(spark, f"{root}/in", f"{root}/out", f"{root}/state", batch)
    return ingest.evolved(spark, f"{root}/out").select("encounter_id", "reason", F.col("`remark, free`").alias("remark"), F.col("_batch_id").alias("batch"))


@query("SELECT CAST(encounter_id AS VARCHAR) AS encounter_id, true AS from_csv, true AS has_time, 'b1' AS batch FROM encounter")
def src_lineage(spark: SparkSession, d: str) -> DataFrame:
    """Every landed row knows its file, time and batch."""
    root = shared_folder(spark, "lineage")
    land(visits(spark, d), f"{root}/in")
    ingest.ingest_csv(spark, f"{root}/in", VISIT, f"{root}/out", f"{root}/state", "b1")
    return spark.read.parquet(f"{root}/out").select("encounter_id", F.col("_source_file").endswith(".csv").alias("from_csv"), F.col("_ingested_at").isNotNull().alias("has_time"), F.col("_batch_id").alias("batch"))


@query("SELECT 'condition' AS entity, count(*) AS rows, count(DISTINCT code) AS codes FROM condition UNION ALL SELECT 'procedure', count(*), count(DISTINCT code) FROM procedure")
def sm_multi_stream(spark: SparkSession, d: str) -> DataFrame:
    """One stream per entity, each with its own state."""
    root = shared_folder(spark, "streams")
    entities = {"condition": a.condition(spark, d).select("patient_id", "code"), "procedure": a.procedure(spark, d).select("patient_id", "code")}
    for name, rows in entities.items():
        land(rows, f"{root}/in/{name}")
    ingest.ingest_all(spark, {name: ["patient_id", "code"] for name in entities}, f"{root}/in", f"{root}/out", f"{root}/state", "b1")
    counts = [spark.read.parquet(f"{root}/out/{name}").agg(F.lit(name).alias("entity"), F.count("*").alias("rows"), F.count_distinct("code").alias("codes")) for name in entities]
    return reduce(DataFrame.unionByName, counts)


#: Bundles that one JSON file holds, about; a file is read by one task.
BUNDLES_PER_FILE = 100


#: Notes that one task writes, about, and folders that they lie in. A file of its own for each costs far more than its bytes, by which Spark would join tasks.
NOTES_PER_TASK, NOTE_FOLDERS = 250, 256


def _note_files(spark: SparkSession, d: str, root: str) -> None:
    """Every note as a text file named by its id, written by tasks: a table's writer makes a folder for each, which is slower to make and list than the note."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = pa_fs.FileSystem.from_uri(root)
        n = 0
        for batch in batches:
            for i, folder, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                files.create_dir(f"{base}/in/{folder}")
                with files.open_output_stream(f"{base}/in/{folder}/{i}.txt") as out:
                    out.write(f"{text}\u0001".encode())
                n += 1
        yield pa.RecordBatch.from_pydict({"n": [n]})

    folder = F.pmod(F.xxhash64("note_id"), F.lit(NOTE_FOLDERS))
    notes = a.note(spark, d).where("note_text IS NOT NULL").select("note_id", folder.alias("folder"), "note_text")
    tasks = max(-(-notes.count() // NOTES_PER_TASK), 1)
    notes.repartition(tasks, "note_id").mapInArrow(write, "n long").agg(F.sum("n")).collect()


def _notes_back(spark: SparkSession, root: str) -> DataFrame:
    # Every file ends with one separator, so none is empty.
    text = F.col("note_text").substr(F.lit(1), F.char_length("note_text") - 1)
    return spark.read.parquet(f"{root}/out").select(F.col("note_id").cast("long").alias("note_id"), F.char_length(text).cast("long").alias("chars"), F.md5(text.cast("binary")).alias("digest"))


NOTES_SQL = "SELECT note_id, length(note_text) AS chars, md5(note_text) AS digest FROM note WHERE note_text IS NOT NULL"


@query(NOTES_SQL)
def src_text_stream(spark: SparkSession, d: str) -> DataFrame:
    """Whole text files, one row each, the id taken from the path."""
    root = shared_folder(spark, "texts")
    _note_files(spark, d, root)
    ingest.ingest_notes(spark, f"{root}/in/*", f"{root}/out", f"{root}/state", "b1")
    return _notes_back(spark, root)


@query("SELECT note_id, length(note_text) > 0 AS whole FROM note WHERE note_text IS NOT NULL")
def sm_wholetext(spark: SparkSession, d: str) -> DataFrame:
    """A file with many lines stays one row of the stream, and a second run adds none."""
    root = shared_folder(spark, "wholetext")
    _note_files(spark, d, root)
    for batch in ("b1", "b2"):
        ingest.ingest_notes(spark, f"{root}/in/*", f"{root}/out", f"{root}/state", batch)
    return _notes_back(spark, root).select("note_id", (F.col("chars") > 0).alias("whole"))


@query("SELECT encounter_class, count(*) AS n, CAST(sum(total_cost) AS DECIMAL(24,2)) AS cost, min(CAST(started_at AT TIME ZONE 'UTC' AS DATE)) AS first_day FROM (SELECT encounter_class, total_cost, started_at::TIMESTAMPTZ AS started_at FROM encounter) GROUP BY ALL")
def src_csv_typed(spark: SparkSession, d: str) -> DataFrame:
    """CSV read with a declared schema; types are never guessed."""
    root = shared_folder(spark, "typed")
    land(a.encounter(spark, d).select("encounter_id", "encounter_class", "started_at", "total_cost"), root)
    rows = spark.read.schema("encounter_id long, encounter_class string, started_at timestamp, total_cost decimal(14,2)").option("header", True).csv(root)
    return rows.groupBy("encounter_class").agg(F.count("*").alias("n"), F.sum("total_cost").alias("cost"), F.min(F.col("started_at").cast("date")).alias("first_day"))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS id, CASE WHEN o_orderkey % 2 = 0 THEN 'Encounter' ELSE 'Condition' END AS kind FROM orders")
def src_json_bundle(spark: SparkSession, d: str) -> DataFrame:
    """Bundles in JSON files of many lines: entries exploded, routed by their resource type."""
    root = shared_folder(spark, "bundles")
    o = a.table(spark, d, "orders")
    resource = F.struct(F.when(F.col("o_orderkey") % 2 == 0, "Encounter").otherwise("Condition").alias("resourceType"), F.col("o_orderkey").cast("string").alias("id"))
    entries = o.groupBy("o_custkey").agg(F.collect_list(F.struct(resource.alias("resource"))).alias("entry"))
    files = -(-a.table(spark, d, "customer").count() // BUNDLES_PER_FILE)
    bundle = F.struct(F.lit("Bundle").alias("resourceType"), "entry")
    text = F.to_json(F.collect_list(bundle), {"pretty": "true"})
    entries.groupBy(F.pmod(F.xxhash64("o_custkey"), F.lit(files)).alias("file")).agg(text.alias("value")).repartition("file").write.partitionBy("file").text(root)
    read = spark.read.schema("resourceType string, entry array<struct<resource: struct<resourceType: string, id: string>>>").option("multiLine", True).json(root)
    return read.select(F.explode("entry.resource").alias("r")).select("r.id", F.col("r.resourceType").alias("kind"))


@query("SELECT encounter_id, encounter_class FROM encounter")
def snk_overwrite(spark: SparkSession, d: str) -> DataFrame:
    """A rebuild replaces rows and schema."""
    path = shared_folder(spark, "overwrite")
    sinks.overwrite(visits(spark, d), path)
    sinks.overwrite(visits(spark, d).drop("patient_id"), path)
    return spark.read.parquet(path)


@query(f"SELECT run, count(*) AS rows FROM (SELECT 'one' AS run FROM encounter WHERE {EARLY} UNION ALL SELECT 'two' FROM encounter) GROUP BY run")
def snk_append(spark: SparkSession, d: str) -> DataFrame:
    """Each run adds its rows to what earlier runs left."""
    path = shared_folder(spark, "append")
    for run, rows in (("one", visits(spark, d).where(EARLY)), ("two", visits(spark, d))):
        rows = rows.withColumn("run", F.lit(run))
        sinks.append(rows, path, rows.schema)
    return spark.read.parquet(path).groupBy("run").agg(F.count("*").alias("rows"))


@query("SELECT CAST(organization_id % 3 AS INT) AS version, encounter_id, CASE WHEN organization_id % 3 = 1 THEN 'again' ELSE 'first' END AS run FROM encounter")
def snk_replace_where(spark: SparkSession, d: str) -> DataFrame:
    """Only one version's rows are written anew."""
    path = shared_folder(spark, "versions")
    rows = a.encounter(spark, d).select((F.col("organization_id") % 3).cast("int").alias("version"), "encounter_id")
    sinks.replace_partitions(rows.withColumn("run", F.lit("first")), path, "version")
    sinks.replace_partitions(rows.where("version = 1").withColumn("run", F.lit("again")), path, "version")
    return spark.read.parquet(path).select("version", "encounter_id", "run")


@query("SELECT event_id, event_type AS stage, CASE WHEN event_type IN ('click', 'view') THEN 'new' ELSE 'old' END AS version FROM events")
def snk_replace_stage(spark: SparkSession, d: str) -> DataFrame:
    """Stages that the input has are replaced, the others stay."""
    path = shared_folder(spark, "stages")
    rows = a.table(spark, d, "events").select("event_id", F.col("event_type").alias("stage"))
    sinks.replace_partitions(rows.withColumn("version", F.lit("old")), path, "stage")
    sinks.replace_partitions(rows.where(F.col("stage").isin("click", "view")).withColumn("version", F.lit("new")), path, "stage")
    return spark.read.parquet(path).select("event_id", "stage", "version")


@query("SELECT patient_id, CAST(patient_id % 364 + 1 AS INT) AS offset_days, CASE WHEN patient_id % 3 = 0 THEN 1 ELSE 2 END::INT AS run FROM patient")
def snk_insert_missing(spark: SparkSession, d: str) -> DataFrame:
    """Ids that have a key keep it; a later run adds keys for the others only."""
    path = shared_folder(spark, "keys")
    ids = a.patient(spark, d).select("patient_id")
    make = lambda df, run: df.select("patient_id", (F.col("patient_id") % 364 + 1).cast("int").alias("offset_days"), F.lit(run).alias("run"))
    first = make(ids.where("patient_id % 3 = 0"), 1)
    sinks.append(first, path, first.schema)
    rest = make(ids.join(spark.read.parquet(path), "patient_id", "left_anti"), 2)
    sinks.append(rest, path, rest.schema)
    return spark.read.parquet(path)


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 AND event_type <> 'error' THEN 1 ELSE 2 END::INT AS run FROM events")
def snk_resume(spark: SparkSession, d: str) -> DataFrame:
    """A run goes on where one stopped: what is done is skipped, what failed is tried again."""
    path = shared_folder(spark, "resume")
    e = a.table(spark, d, "events").select("event_id", "event_type")
    done = e.where("event_id % 3 = 0").select("event_id", F.lit(1).alias("run"), (F.col("event_type") == "error").alias("failed"))
    sinks.append(done, path, done.schema)
    good = spark.read.parquet(path).where("NOT failed")
    rest = e.join(good, "event_id", "left_anti").select("event_id", F.lit(2).alias("run"), F.lit(False).alias("failed"))
    sinks.append(rest, path, rest.schema)
    return spark.read.parquet(path).where("NOT failed").select("event_id", "run")


@query("SELECT encounter_id, patient_id, encounter_class FROM encounter")
def snk_create_if_absent(spark: SparkSession, d: str) -> DataFrame:
    """Declared empty at first; later declarations leave the rows alone."""
    path = shared_folder(spark, "declared")
    rows = visits(spark, d)
    sinks.create_if_absent(spark, path, rows.schema)
    sinks.append(rows, path, rows.schema)
    sinks.create_if_absent(spark, path, rows.schema)
    return spark.read.schema(rows.schema).parquet(path)


@query("SELECT encounter_class, count(*) AS n, count(*) < 11 AS hidden FROM encounter GROUP BY ALL")
def snk_parquet_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """Counts only, guarded, as one small file."""
    path = shared_folder(spark, "snapshot")
    sinks.snapshot(a.encounter(spark, d).groupBy("encounter_class").agg(F.count("*").alias("n")).withColumn("hidden", F.col("n") < 11), path)
    return spark.read.parquet(path)


@query("SELECT patient_id, count(*) AS visits, CAST(sum(total_cost) AS DECIMAL(24,2)) AS cost, min(started_at) AS first_at, max(started_at) AS last_at, sum(total_cost) > 100000 AS dear FROM encounter GROUP BY patient_id")
def snk_materialized_view(spark: SparkSession, d: str) -> DataFrame:
    """Two views, one derived from the other, brought up to date with three batches in turn: they equal a full rebuild."""
    root = shared_folder(spark, "views")
    visits = a.encounter(spark, d)
    for batch in range(3):
        refresh.refresh(spark, root, visits.where(F.col("encounter_id") % 3 == batch), visit_views())
    return spark.read.parquet(f"{root}/dear").drop("_bucket")


def visit_views() -> list[refresh.Totals | refresh.Derived]:
    measures = {"visits": ("count", F.lit(1)), "cost": ("sum", F.col("total_cost")), "first_at": ("min", F.col("started_at")), "last_at": ("max", F.col("started_at"))}
    return [refresh.Totals("by_patient", ("patient_id",), measures), refresh.Derived("dear", "by_patient", {"dear": F.col("cost") > 100000})]


@query("SELECT patient_id, 'masked' AS full_name, state FROM patient")
def snk_temp_view(spark: SparkSession, d: str) -> DataFrame:
    """A view that is never stored: no copy of the names exists beside the source."""
    a.patient(spark, d).withColumn("full_name", F.lit("masked")).createOrReplaceTempView("v_masked_patient")
    return spark.table("v_masked_patient").select("patient_id", "full_name", "state")


@query("SELECT count(*) AS left_rows, count(*) AS right_rows, count_if(encounter_class = 'wellness') AS only_left, count_if(encounter_class = 'wellness') AS only_right FROM encounter")
def src_before_copy(spark: SparkSession, d: str) -> DataFrame:
    """A copy taken before a change proves what the change touched."""
    root = shared_folder(spark, "before")
    sinks.overwrite(visits(spark, d), f"{root}/table")
    sinks.overwrite(spark.read.parquet(f"{root}/table"), f"{root}/before")
    changed = spark.read.parquet(f"{root}/before").withColumn("encounter_class", F.when(F.col("encounter_class") == "wellness", "ambulatory").otherwise(F.col("encounter_class")))
    sinks.overwrite(changed, f"{root}/table")
    return quality.reconcile(spark.read.parquet(f"{root}/before"), spark.read.parquet(f"{root}/table"))


#: Tags of columns that say who someone is: fixed values.
TAGS = {"full_name": "name", "birth_date": "date", "death_date": "date", "zip": "zip"}


def column_census(df: DataFrame) -> DataFrame:
    """``name, filled, different`` of every column, in one pass."""
    one = df.agg(*[F.struct(F.count(x).alias("filled"), F.count_distinct(x).alias("different")).alias(x) for x in df.columns])
    return one.select(F.explode(F.array(*[F.struct(F.lit(x).alias("name"), F.col(f"`{x}`.filled").alias("filled"), F.col(f"`{x}`.different").alias("different")) for x in df.columns])).alias("x")).select("x.*")


PATIENT_COLUMNS = ["patient_id", "full_name", "birth_date", "death_date", "gender", "state", "zip", "payer", "income"]
CENSUS = " UNION ALL ".join(f"SELECT '{x}' AS name, count({x}) AS filled, count(DISTINCT {x}) AS different FROM patient" for x in PATIENT_COLUMNS)
TAG_SQL = "CASE name " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TAGS.items()) + " END"


@query(f"SELECT name, {TAG_SQL} AS tag, filled FROM ({CENSUS})")
def src_catalog_meta(spark: SparkSession, d: str) -> DataFrame:
    """Columns of the catalog with their tags and how many rows fill them."""
    a.patient(spark, d).createOrReplaceTempView("v_catalog_patient")
    names = [x.name for x in spark.catalog.listColumns("v_catalog_patient")]
    tags = spark.createDataFrame([(x, TAGS.get(x)) for x in names], "name string, tag string")
    return column_census(spark.table("v_catalog_patient")).join(tags, "name").select("name", "tag", "filled")


@query(f"SELECT name, different = (SELECT count(*) FROM patient) AS tells_apart FROM ({CENSUS}) WHERE {TAG_SQL} IS NULL AND different * 2 > (SELECT count(*) FROM patient)")
def pv_tag_drift(spark: SparkSession, d: str) -> DataFrame:
    """Columns without a tag whose values tell most patients apart: candidates for one."""
    p = a.patient(spark, d)
    rows = p.agg(F.count("*").alias("rows"))
    census = column_census(p).where(~F.col("name").isin(list(TAGS))).crossJoin(F.broadcast(rows))
    return census.where(F.col("different") * 2 > F.col("rows")).select("name", (F.col("different") == F.col("rows")).alias("tells_apart"))


ENTITIES = {"patient": "patient_id", "encounter": "encounter_class", "condition": "code", "procedure": "code", "medication": "description", "observation": "code"}


@query(" UNION ALL ".join(f"SELECT '{n}' AS entity, count(*) AS rows, count(DISTINCT {k}) AS codes, count(*)::DOUBLE / count(DISTINCT patient_id) AS per_patient, true AS has_csv, true AS parquet_smaller FROM {n}" for n, k in ENTITIES.items()))
def src_profile(spark: SparkSession, d: str) -> DataFrame:
    """Rows, codes, rows a patient, and bytes as CSV and as Parquet of every entity."""
    def one(name: str, code: str) -> DataFrame:
        rows, root = getattr(a, name)(spark, d), shared_folder(spark, f"profile-{name}")
        rows.write.option("header", True).csv(f"{root}/csv")
        sinks.overwrite(rows, f"{root}/parquet")
        size = lambda kind: spark.read.format("binaryFile").option("pathGlobFilter", f"*.{kind}").load(f"{root}/{kind}").agg(F.sum("length").alias(kind))
        counts = spark.read.parquet(f"{root}/parquet").agg(F.lit(name).alias("entity"), F.count("*").alias("rows"), F.count_distinct(code).alias("codes"), c.ratio(F.count("*"), F.count_distinct("patient_id")).alias("per_patient"))
        return counts.crossJoin(size("csv")).crossJoin(size("parquet")).select("entity", "rows", "codes", "per_patient", (F.col("csv") > 0).alias("has_csv"), (F.col("parquet") < F.col("csv")).alias("parquet_smaller"))

    return reduce(DataFrame.unionByName, [one(n, k) for n, k in ENTITIES.items()])


@query("SELECT 'started_at' AS name, 'timestamp' AS kind, (SELECT count(*) FROM encounter) AS rows UNION ALL SELECT 'started_at', 'string', (SELECT count(*) FROM encounter)")
def st_schema_diff(spark: SparkSession, d: str) -> DataFrame:
    """(name, type) pairs that only one of two builds of a table has, beside its rows."""
    e = a.encounter(spark, d)
    found = quality.schema_difference(e.schema, e.withColumn("started_at", F.col("started_at").cast("string")).schema)
    return spark.createDataFrame(found, "name string, kind string").crossJoin(e.agg(F.count("*").alias("rows")))


@query("SELECT 'total_cost' AS name, count(total_cost) AS filled, true AS broken FROM encounter UNION ALL SELECT 'reason', count(reason), false FROM encounter")
def dq_contract(spark: SparkSession, d: str) -> DataFrame:
    """Declared columns a table must have, those that break the contract, and how many rows each concerns."""
    e = a.encounter(spark, d).withColumn("total_cost", F.col("total_cost").cast("string"))
    declared = StructType.fromDDL("total_cost decimal(14,2), reason string")
    broken = [n for n, _ in quality.contract(e, declared)]
    return column_census(e.select(*declared.names)).select("name", "filled", F.col("name").isin(broken).alias("broken"))


@query("SELECT true AS same, false AS other, count(*) AS rows FROM (SELECT organization_id FROM encounter GROUP BY organization_id)")
def dq_result_match(spark: SparkSession, d: str) -> DataFrame:
    """Two answers to one question agree within a tolerance, whatever the order of their rows and columns, extra columns and the case of texts."""
    want = a.encounter(spark, d).groupBy("organization_id").agg(F.avg("total_cost").cast("double").alias("mean"), F.max("encounter_class").alias("kind"))
    near = want.select(F.upper("kind").alias("k"), (F.col("mean") + 0.004).alias("m"), "organization_id", F.lit(1).alias("extra"))
    far = want.select("organization_id", (F.col("mean") + 0.02).alias("mean"), "kind")
    same, other = quality.same_results(want, near), quality.same_results(want, far).withColumnRenamed("same", "other")
    return same.crossJoin(other).crossJoin(want.agg(F.count("*").alias("rows")))
