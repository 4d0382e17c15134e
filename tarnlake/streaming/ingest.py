"""Bronze ingestion: incremental file streams of string-typed rows with lineage."""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType, TimestampType

from tarnlake.sources import sinks

LINEAGE = StructType([StructField("_source_file", StringType()), StructField("_ingested_at", TimestampType()), StructField("_batch_id", StringType())])


def text_schema(columns: list[str]) -> StructType:
    """Every column a string: types are never guessed on arrival."""
    return StructType([StructField(c, StringType()) for c in columns])


def first_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``file, line``: the first line of every file, wherever the file is split.

    It lies in the split that begins at byte 0; the rows of a split come in order within its task.
    """
    rows = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("begin"), F.monotonically_increasing_id().alias("at"))
    return rows.where("begin = 0").groupBy("file").agg(F.min_by("value", "at").alias("line"))


def column_names(line: str) -> list[str]:
    """The names in a header; those in quotes may hold commas."""
    return next(csv.reader([line]))


def header(spark: SparkSession, folder: str) -> list[str]:
    """All column names in the folder's files, those of earlier files first; read before a run, so new columns widen the schema.

    Only distinct header lines reach the driver, however many files have them.
    """
    names: list[str] = []
    for row in first_lines(spark, folder).groupBy("line").agg(F.min("file").alias("file")).orderBy("file").collect():
        names += [n for n in column_names(row["line"]) if n not in names]
    return names


def with_lineage(df: DataFrame, batch_id: str) -> DataFrame:
    return df.select("*", F.col("_metadata.file_path").alias("_source_file"), F.current_timestamp().alias("_ingested_at"), F.lit(batch_id).alias("_batch_id"))


def ingest_csv(spark: SparkSession, folder: str, columns: list[str], out: str, checkpoint: str, batch_id: str) -> None:
    """Land files not seen before as rows of ``out``; a rerun adds nothing."""
    stream = spark.readStream.schema(text_schema(columns)).option("header", True).csv(folder)
    with_lineage(stream, batch_id).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


DECLARED = StructType([StructField("place", IntegerType()), StructField("name", StringType())])


def declared(spark: SparkSession, out: str) -> list[str]:
    """Columns of the table at ``out`` so far, in the order in which they came."""
    sinks.create_if_absent(spark, f"{out}/columns", DECLARED)
    return [r["name"] for r in spark.read.schema(DECLARED).parquet(f"{out}/columns").orderBy("place").collect()]


def ingest_evolving(spark: SparkSession, folder: str, out: str, checkpoint: str, batch_id: str, files: int = 1000) -> None:
    """Land CSV files not seen before, whatever columns they have: a batch that brings new ones widens the table.

    A micro-batch (``files`` files at most) reads its files' headers, adds unknown columns to the declared ones, and
    appends the rows by their own header; older rows have null in the new columns. A micro-batch that runs
    again after a failure replaces what it had written.
    """

    def land(lines: DataFrame, epoch: int) -> None:
        session = lines.sparkSession
        paths = [r["f"] for r in lines.select(F.input_file_name().alias("f")).distinct().collect()]
        if not paths:
            return
        by_line: dict[str, list[str]] = {}
        for r in first_lines(session, paths).collect():  # as many as a micro-batch has files
            by_line.setdefault(r["line"], []).append(r["file"])
        known = declared(session, out)
        fresh = list(dict.fromkeys(n for line in sorted(by_line, key=lambda x: min(by_line[x])) for n in column_names(line) if n not in known))
        if fresh:
            sinks.append(session.createDataFrame([(len(known) + i, n) for i, n in enumerate(fresh)], DECLARED), f"{out}/columns", DECLARED)
        parts = []
        for line, own in by_line.items():
            rows = session.read.schema(text_schema(column_names(line))).option("header", True).csv(own)
            have = with_lineage(rows, batch_id)
            parts.append(have.select(*[F.col(f"`{n}`") if n in rows.columns else F.lit(None).cast("string").alias(n) for n in [*known, *fresh]], *LINEAGE.names))
        sinks.replace_partitions(reduce(DataFrame.unionByName, parts).withColumn("_epoch", F.lit(f"{batch_id}-{epoch}")), f"{out}/rows", "_epoch")

    stream = spark.readStream.format("text").option("maxFilesPerTrigger", files).load(folder)
    stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def evolved(spark: SparkSession, out: str) -> DataFrame:
    """The table that ``ingest_evolving`` has landed, with all columns declared so far."""
    return spark.read.schema(StructType([*text_schema(declared(spark, out)).fields, *LINEAGE.fields])).parquet(f"{out}/rows")


def ingest_all(spark: SparkSession, entities: dict[str, list[str]], landing: str, out: str, checkpoints: str, batch_id: str) -> None:
    """One independent stream per entity."""
    for entity, columns in entities.items():
        ingest_csv(spark, f"{landing}/{entity}", columns, f"{out}/{entity}", f"{checkpoints}/{entity}", batch_id)


#: Files that a micro-batch of notes reads, at most: what the driver holds of a batch doesn't grow with the folder.
NOTES_PER_BATCH = 8000
#: Bytes that opening a note counts as; by Spark's own 4 MB a task reads 32 small files.
OPEN_BYTES = 64 << 10
#: The driver's cache of listed files: no batch lists those of another, but up to 250 MB of them would stay.
LISTED = "spark.sql.hive.filesourcePartitionFileCacheSize"
NOTE_FILE = StructType([StructField("path", StringType()), StructField("modificationTime", TimestampType()), StructField("length", LongType()), StructField("content", BinaryType())])


def ingest_notes(spark: SparkSession, folder: str, out: str, checkpoint: str, batch_id: str, id_pattern: str = r"([^/_]+)\.txt$") -> None:
    """One row per file, its id taken from the file's name.

    A micro-batch lists its files again, by a task for each unless the session says otherwise while it runs. Files are
    read as bytes: the reader of whole texts sets up a Hadoop job for each.
    """
    tasks = str(2 * spark.sparkContext.defaultParallelism)
    own = {"spark.sql.sources.parallelPartitionDiscovery.parallelism": tasks, "spark.sql.files.openCostInBytes": str(OPEN_BYTES), LISTED: "0"}
    before = {k: spark.conf.get(k) for k in own}
    try:
        for k, v in own.items():
            spark.conf.set(k, v)
        stream = spark.readStream.format("binaryFile").schema(NOTE_FILE).option("maxFilesPerTrigger", NOTES_PER_BATCH).load(folder)
        named = stream.select(F.col("content").cast("string").alias("note_text"), F.regexp_extract(F.col("_metadata.file_path"), id_pattern, 1).alias("note_id"), "_metadata")
        rows = with_lineage(named, batch_id).drop("_metadata")
        query = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
