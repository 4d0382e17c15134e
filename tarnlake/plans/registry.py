"""Where queries over the library's own operators register, with their SQL; ``plans.all`` imports them all."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tarnlake.plans.sql_views import with_views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with the SQL that gives its rows over the driver's tables if SQL can."""

    def put(f: Query) -> Query:
        key = name or f.__name__
        QUERIES[key] = f
        if sql:
            ORACLE_SQL[key] = with_views(sql)
        return f

    return put


#: Bytes of the input folder for which a shared table's shuffles get one partition more, and shuffled bytes to which small partitions are put together.
INPUT_BYTES, SHUFFLED = 4 << 20, "16m"
#: Shared tables that are remembered, at most; the oldest goes first.
MOST_SHARED = 8
_shared: dict[tuple, DataFrame] = {}


def stamp(spark: SparkSession, folder: str) -> tuple:
    """Names, sizes and times of a folder's files, two levels deep: rewritten tables have another stamp."""
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for one in fs.listStatus(root):
        inner = fs.listStatus(one.getPath()) if one.isDirectory() else [one]
        found += [(x.getPath().toString(), x.getLen(), x.getModificationTime()) for x in inner]
    return tuple(sorted(found))


@contextmanager
def parted_by_size(spark: SparkSession, input_bytes: int) -> Iterator[None]:
    """Shuffles of what is run inside get as many partitions as their input needs, never fewer than the session's: a task's share stays the same when tables grow."""
    number = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-input_bytes // INPUT_BYTES))
    wanted = {"spark.sql.shuffle.partitions": str(number), "spark.sql.adaptive.advisoryPartitionSizeInBytes": SHUFFLED}
    before = {k: spark.conf.get(k) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def shared(build: Query) -> Query:
    """An intermediate table that many queries start from: checkpointed at its first use over unchanged input files.

    That also cuts its long lineage, which each further step of a query would analyse again. It is
    built when a query that needs it is, so that takes a job. The folder is the cluster's
    ``spark.checkpoint.dir``; a temporary one only where that is unset in local mode (tests).
    """

    def get(spark: SparkSession, sf_dir: str) -> DataFrame:
        files = stamp(spark, sf_dir)
        key = (spark.sparkContext.applicationId, build.__name__, sf_dir, files)
        if key not in _shared:
            if not spark.conf.get("spark.checkpoint.dir", ""):
                if not spark.sparkContext.master.startswith("local"):
                    raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
                spark.sparkContext.setCheckpointDir(f"file://{tempfile.gettempdir()}/tarnlake-checkpoints")
            while len(_shared) >= MOST_SHARED:
                _shared.pop(next(iter(_shared)))
            table = build(spark, sf_dir)
            with parted_by_size(spark, sum(size for _, size, _ in files)):
                _shared[key] = table.checkpoint()
        return _shared[key]

    return get
