"""A corpus pipeline of five stages over ``documents``; part of the llm subpackage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.llm.jaccard import jaccard_components
from tarnlake.llm.mix import mix_documents, word_count
from tarnlake.llm.pack import pack_documents
from tarnlake.llm.passages import repeated_passages, row_key, without_passages
from tarnlake.llm.scratch import free_name, keep, release
from tarnlake.llm.toxicity import learn_toxicity, with_toxicity

#: Score from which a document counts as toxic and goes.
TOXIC = 0.7
TOKENIZER, END_ID, WINDOW = "word_bpe_49k.json", 2, 4096


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn from the labelled documents, score all, drop those that score TOXIC or more; nothing else goes."""
    model = learn_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), F.lit(True))
    score = free_name(docs, "toxicity")
    return with_toxicity(docs, model, score).where(F.col(score) < TOXIC).drop(score)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of rows that links reach (runs of five words, Jaccard 0.8), the one of smallest id and then smallest row key stays.

    Rows are told apart by id and text together, so other texts under an id that repeats are not
    touched. Null ids come last; rows without words stay; of rows that repeat id and text, one stays.
    """
    groups = keep(jaccard_components(docs, k=5, num=4, den=5, row=row_key()), "groups")
    first = groups.where("n_shingles > 0").groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first"))
    gone = groups.where("n_shingles > 0").join(first, "root").where("row <> first.row").select("row").distinct()
    again = groups.groupBy("row").count().where("count > 1").select("row")
    key = free_name(docs, "row")
    rows = docs.withColumn(key, row_key())
    gone, again = gone.withColumnRenamed("row", key), keep(again.withColumnRenamed("row", key), "again")
    left = rows.join(gone, key, "left_anti")
    if not again.isEmpty():
        left = left.join(again, key, "left_anti").unionByName(left.join(again, key, "left_semi").dropDuplicates([key]))
    return left.select(*docs.columns)


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages of 40 words or more that repeat one of another document; all documents stay."""
    return without_passages(docs, repeated_passages(docs)).withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in code point order weigh 5, 2, 1, repeating; a document stands as often as the mix takes it.

    Documents that the mix doesn't take go. Those without words add nothing to any target; they stay once.
    Rows that repeat id and text are documents of their own, each with its own count.
    """
    mixed = mix_documents(docs, word_count(F.col("text")), key=row_key())
    taken = F.when(F.col("size") > 0, (F.col("taken") / F.greatest("size", F.lit(1))).cast("int")).otherwise(1)
    key, times = free_name(docs, "row"), free_name(docs, "times")
    total = mixed.groupBy("key").agg(F.sum(taken).alias(times), F.count("*").alias("rows"), F.max(taken).alias("most"))
    total = total.where(F.col(times) > 0).withColumnRenamed("key", key)
    # All but the first of rows that repeat id and text are dropped; the first stands for all.
    rows = docs.withColumn(key, row_key())
    many = keep(total.where("rows > 1").select(key), "again")
    if not many.isEmpty():
        rows = rows.join(many, key, "left_anti").unionByName(rows.join(many, key, "left_semi").dropDuplicates([key]))
    rows = rows.join(total.select(key, times), key)
    return rows.withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids that fill windows to the sources' proportions."""
    return pack_documents(docs, public_tokenizers.path(TOKENIZER), END_ID, WINDOW)


STAGES = [("toxicity", drop_toxic), ("jaccard", drop_near_copies), ("passages", cut_passages), ("mix", mix), ("pack", pack)]

#: No SQL can express compression lengths, chaining or tokenizers.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each result is written as Parquet, read by the next and deleted when that is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        before, docs = docs, keep(stage(spark, docs, sf_dir), f"stage-{name}")
        if i:
            release(before)
    return docs
