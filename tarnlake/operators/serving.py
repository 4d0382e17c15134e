"""Fitted pipelines in a folder: versions that are never written again, a champion among them, and scores by version."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, MapType, StringType, StructField, StructType

from tarnlake.sources import sinks

VERSIONS = StructType([StructField("version", StringType()), StructField("step", IntegerType()), StructField("tags", MapType(StringType(), StringType()))])
ALIASES = StructType([StructField("alias", StringType()), StructField("step", IntegerType()), StructField("version", StringType())])


@dataclass(frozen=True)
class Served:
    version: str
    tags: dict[str, str]
    model: PipelineModel


def listed(spark: SparkSession, root: str) -> DataFrame:
    """All published versions with their tags, in the order of ``step``."""
    sinks.create_if_absent(spark, f"{root}/versions", VERSIONS)
    return spark.read.schema(VERSIONS).parquet(f"{root}/versions")


def publish(spark: SparkSession, root: str, version: str, model: PipelineModel, tags: dict[str, str]) -> None:
    """Save a fitted pipeline as a new version; a version that is there is refused, so scores can name what made them."""
    known = listed(spark, root)
    if not known.where(F.col("version") == version).isEmpty():
        raise ValueError(f"{version} is published already")
    model.write().save(f"{root}/models/{version}")
    step = known.count()
    sinks.append(spark.createDataFrame([(version, step, tags)], VERSIONS), f"{root}/versions", VERSIONS)


def promote(spark: SparkSession, root: str, version: str, alias: str = "champion") -> None:
    """Let ``alias`` name a published version from now on."""
    if listed(spark, root).where(F.col("version") == version).isEmpty():
        raise ValueError(f"{version} is not published")
    sinks.create_if_absent(spark, f"{root}/aliases", ALIASES)
    step = spark.read.schema(ALIASES).parquet(f"{root}/aliases").count()
    sinks.append(spark.createDataFrame([(alias, step, version)], ALIASES), f"{root}/aliases", ALIASES)


def served(spark: SparkSession, root: str, alias: str = "champion") -> Served:
    """The version that ``alias`` names now, loaded from its files; an error if it names none."""
    sinks.create_if_absent(spark, f"{root}/aliases", ALIASES)
    found = spark.read.schema(ALIASES).parquet(f"{root}/aliases").where(F.col("alias") == alias).agg(F.max_by("version", "step").alias("version")).first()["version"]
    if found is None:
        raise ValueError(f"no version is the {alias}")
    tags = listed(spark, root).where(F.col("version") == found).first()["tags"]
    return Served(found, tags, PipelineModel.load(f"{root}/models/{found}"))


def batch_score(rows: DataFrame, by: Served, path: str, keys: list[str]) -> DataFrame:
    """Score ``rows`` with a stored model and replace that version's rows at ``path``; other versions stay.

    As many rows as the version's tag ``expected`` says must come, each key once; else nothing is written.
    ``flagged`` is a score at or above the tag ``cutoff``.
    """
    spark = rows.sparkSession
    have = rows.agg(F.count("*").alias("rows"), F.count_distinct(*keys).alias("keys")).first()
    expected = int(by.tags["expected"])
    if have["rows"] != expected or have["keys"] != expected:
        raise ValueError(f"{have['rows']} rows of {have['keys']} keys to score, {expected} expected")
    score = vector_to_array("probability")[1]
    out = by.model.transform(rows).select(F.lit(by.version).alias("version"), *keys, score.alias("score"), (score >= float(by.tags["cutoff"])).alias("flagged"))
    sinks.replace_partitions(out, path, "version")
    return spark.read.schema(out.schema).parquet(path)
