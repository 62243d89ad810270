import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from plumbline.llm.queries import vocabulary  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, " \
         "score double, node long, label int, spans string"


@pytest.fixture(scope="session")
def make(spark):
    """documents with extra columns that carry the operators' own names."""
    def build(texts, ids=None):
        ids = range(len(texts)) if ids is None else ids
        return spark.createDataFrame(
            [(i, t, None if k % 2 else "en", None, None if t is None else len(t), "r", 0.5, k, 1,
              None) for k, (i, t) in enumerate(zip(ids, texts, strict=True))], SCHEMA)

    return build


@pytest.fixture(scope="session")
def bpe_path():
    return vocabulary("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def word_path():
    return vocabulary("word_bpe_49k.json")


@pytest.fixture(scope="session")
def corpus(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def rows(df, *names):
    return [tuple(r[n] for n in names) for r in df.collect()]
