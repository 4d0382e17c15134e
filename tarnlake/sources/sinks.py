"""Table sinks on Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def overwrite(df: DataFrame, path: str) -> None:
    """A full rebuild; the schema is replaced with the rows."""
    df.write.mode("overwrite").parquet(path)


def append(df: DataFrame, path: str, declared: StructType) -> None:
    """Append a run's rows, after checking them against the declared schema."""
    have = {f.name: f.dataType for f in df.schema.fields}
    wrong = [f.name for f in declared.fields if have.get(f.name) != f.dataType]
    if wrong or len(have) != len(declared.fields):
        raise ValueError(f"columns differ from the declared schema: {wrong or sorted(set(have) ^ set(declared.names))}")
    df.select(*declared.names).write.mode("append").parquet(path)


def replace_partitions(df: DataFrame, path: str, *by: str) -> None:
    """Replace only the partitions that ``df`` has rows for."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def create_if_absent(spark: SparkSession, path: str, declared: StructType) -> None:
    spark.createDataFrame([], declared).write.mode("ignore").parquet(path)


def snapshot(df: DataFrame, path: str) -> None:
    """A small published table as one file; callers guard it first."""
    df.coalesce(1).write.mode("overwrite").parquet(path)
