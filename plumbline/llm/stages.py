"""Stages of the corpus pipeline: (spark, docs, sf_dir) to a DataFrame.

All but the last return the columns of ``docs``. Extra columns stay as they are; rows with null
ids, null texts and repeated rows are handled as each operator's docstring says; an empty table
gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import jaccard, packing, quality, suffix_dedup, toxicity
from plumbline.llm.queries import vocabulary
from plumbline.llm.tables import quoted, small_batches
from plumbline.session import table


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity tagger does not reject."""
    small_batches(spark)
    scored = toxicity.classify(docs, table(spark, sf_dir, "labels"), carry=True)
    return scored.where("predicted = 0").select("row.*")


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    small_batches(spark)
    scored = quality.classify(docs, table(spark, sf_dir, "labels"), carry=True)
    return scored.where("predicted = 1").select("row.*")


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of least doc_id, of each class of near duplicates."""
    small_batches(spark)
    return jaccard.representatives(docs, jaccard.join(docs))


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without strings of 50 bytes that an earlier one has.

    A character that lost some of its bytes goes; n_chars counts what is left.
    """
    small_batches(spark)
    left = suffix_dedup.dedup(docs, carry=True, characters=True)
    columns = []
    for name in docs.columns:
        if name == "text":
            columns.append(F.col("left_text").alias("text"))
        elif name == "n_chars":
            columns.append(F.length("left_text").cast(docs.schema[name].dataType).alias(name))
        else:
            columns.append(F.col("row." + quoted(name)).alias(name))
    # Whole characters are removed, so what a text has of U+FFFD by itself stays.
    return left.withColumn("left_text", F.col("kept").cast("string")).select(*columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all remaining tokens in sequences of 1024."""
    small_batches(spark)
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"))
