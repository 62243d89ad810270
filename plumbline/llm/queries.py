"""The registered queries of this package and their SQL twins.

Vocabulary files are looked up when a query runs: ``PLUMBLINE_TOKENIZERS`` names their folder, else
the installed ``public_tokenizers`` package gives it.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.tables import small_batches
from plumbline.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            small_batches(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def vocabulary(name: str) -> str:
    folder = os.environ.get("PLUMBLINE_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_packing")
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plumbline.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


@query("op2_bpe")
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plumbline.llm.bpe import encode_texts

    return encode_texts(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"),
                        digests_only=True)


@query("op9_language_model")
def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plumbline.llm.language_model import score_held_out

    return score_held_out(table(spark, sf_dir, "documents")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op10_licenses")
def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plumbline.llm.licenses import labelled, scan

    return labelled(scan(table(spark, sf_dir, "documents")))


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plumbline.llm.toxicity import classify

    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "held_out", "score", "predicted", F.size("spans").alias("n_spans"))


@query("op6_quality")
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plumbline.llm.quality import classify

    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "held_out", "score", "predicted", F.size("lines").alias("n_lines"))


@query("op4_fingerprints")
def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plumbline.llm.fingerprints import compare_edited

    return compare_edited(table(spark, sf_dir, "documents"))


@query("op3_jaccard", r"""
    WITH RECURSIVE split AS (
      SELECT doc_id, list_filter(regexp_split_to_array(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                         'abcdefghijklmnopqrstuvwxyz'), '[\t\n\v\f\r ]+'),
               lambda x: x <> '') AS words
      FROM documents),
    grams AS (
      SELECT DISTINCT doc_id, unnest(
               CASE WHEN len(words) >= 5 THEN list_transform(
                      range(1, len(words) - 3), lambda i: list_slice(words, i, i + 4))
                    WHEN len(words) > 0 THEN [words] ELSE [] END) AS gram
      FROM split),
    sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
    shared AS (
      SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
      FROM grams a JOIN grams b USING (gram) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
    near AS (
      SELECT x, y FROM shared JOIN sizes sx ON x = sx.doc_id JOIN sizes sy ON y = sy.doc_id
      WHERE 5 * c >= 4 * (sx.n + sy.n - c)),
    reach(a, b) AS (
      SELECT doc_id, doc_id FROM documents
      UNION SELECT reach.a, near.y FROM reach JOIN near ON reach.b = near.x)
    SELECT doc_id, class_id, links
    FROM (SELECT a AS doc_id, min(b) AS class_id FROM reach GROUP BY a)
    JOIN (SELECT doc_id, count(y) AS links FROM documents LEFT JOIN near ON doc_id = x
          GROUP BY doc_id) USING (doc_id)""")
def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plumbline.llm.jaccard import join

    return join(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "links")


@query("op7_suffix_dedup")
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plumbline.llm.suffix_dedup import dedup

    return dedup(table(spark, sf_dir, "documents"), texts=False)


@query("op5_neighbours")
def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plumbline.llm.neighbours import search

    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.where(F.col("vec_id") % 20 == 0))


@query("op11_spelling")
def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plumbline.llm.spelling import group_variants

    return group_variants(table(spark, sf_dir, "documents"))


@query("op12_language")
def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plumbline.llm.language_id import identify

    return identify(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model")).select(
        "doc_id", "held_out", "lang_pred", "score")


@query("op13_alignment")
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plumbline.llm.alignment import align

    return align(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"),
                 vocabulary("piece_bpe_32k.model"), digests_only=True)
