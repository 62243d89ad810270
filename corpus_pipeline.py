"""Cleaning and packing of a document corpus, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plumbline.llm import stages
from plumbline.llm.tables import kept
from plumbline.session import table

#: (name, function): each takes (spark, docs, sf_dir) and gets what the one before it kept. All but
#: the last return the columns of documents.
STAGES = [
    ("toxicity", stages.clean),
    ("quality classifier", stages.good),
    ("n-gram Jaccard join", stages.distinct),
    ("suffix-array dedup", stages.unrepeated),
    ("packing", stages.packed),
]

#: Classifiers, similarity joins, byte-level dedup and tokenizers have no SQL form; the stages
#: are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
