"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Bytes that an Arrow batch holds on its way to Python while a table is written: both sides hold a few.
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "8m"
#: A table that is written needs no shuffle of its making again; else shuffle files stay until the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Estimated bytes of a table that the driver sends to every task, at most: hashed for a join it takes several times that, and some fifty of them wait for the driver's collector.
SMALL, MOST_SMALL = "spark.sql.autoBroadcastJoinThreshold", 1 << 20
#: The driver's cache of listed files; tables that are kept are listed once.
LISTED = "spark.sql.hive.filesourcePartitionFileCacheSize"


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temporary folder only where that is unset in local mode (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", "")
    if not found and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return found.rstrip("/") if found else f"file://{tempfile.gettempdir()}/tarnlake-scratch"


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    This cuts the lineage: what follows reads files that outlive any executor, and a
    table used twice is computed once. The files go when the session ends, or when :func:`release` is called.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    small = min(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold(), MOST_SMALL)
    own = {BATCH: BATCH_BYTES, CLEANUP: "true", SMALL: str(small), LISTED: "0"}
    before = {k: spark.conf.get(k) for k in own}
    try:
        for k, v in own.items():
            spark.conf.set(k, v)
        df.write.option("compression", "zstd").parquet(path)
        kept = spark.read.schema(df.schema).parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    where, files = _files(spark, path)
    files.deleteOnExit(where)
    kept.kept_at = path
    return kept


def _files(spark: SparkSession, path: str) -> tuple:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def release(*tables: DataFrame) -> None:
    """Delete the files of tables from :func:`keep` that nothing will read again.

    What was made of them must be written itself by then: after the loss of an executor only its own files are read.
    """
    for table in tables:
        where, files = _files(table.sparkSession, table.kept_at)
        files.delete(where, True)


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    Enough where both see that folder (local mode, a shared home); elsewhere the package is
    installed on the executors or sent with ``--py-files`` as usual.
    """
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)
