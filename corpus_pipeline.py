"""A corpus pipeline: each stage reads all rows that the one before it kept."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doorledger.llm import exact_dedup, near_dedup, packing, suffix_dedup, toxicity
from doorledger.llm.catalog import tokenizer_file
from doorledger.llm.common import decided, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose calibrated score stays below one half."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return (docs.withColumn("__score", toxicity.score(F.col("text"), model))
            .where("__score < 0.5").drop("__score"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the smallest id."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dedup.drop_near_copies(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of 200-byte strings that start elsewhere too."""
    return suffix_dedup.remove_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 4096 tokens."""
    return packing.packed(docs, tokenizer_file()).withColumnRenamed("id", "doc_id")


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies),
          ("suffix_dedup", cut_repeats), ("packing", pack)]

#: a boosted model and a tokenizer take part, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each stored in the shared folder before the next reads it; what a stage stored for itself is then deleted."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = decided(partial(stage, spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
