"""Language identification: lattices against enumeration, held-out accuracy, odd rows."""

import math

import numpy as np
import pytest
from conftest import rows

from plumbline.llm import language_id as L
from plumbline.llm.queries import vocabulary

PIECES = [*[bytes([b]) for b in range(256)], b" a", b"ab", b"bc", b" abc", b"cab", "é".encode()]


@pytest.fixture(scope="module")
def piece_path():
    return vocabulary("piece_bpe_32k.model")


def spellings(word, chance):
    """(probability, pieces used) of each segmentation."""
    if not word:
        return [(1.0, [])]
    out = []
    for i, piece in enumerate(PIECES):
        if word.startswith(piece):
            out += [(chance[i] * p, [i, *used]) for p, used in spellings(word[len(piece):], chance)]
    return out


def packed(words):
    data = np.frombuffer(b"".join(words), np.uint8)
    return data, np.r_[0, np.cumsum([len(w) for w in words])]


def test_forward_and_expected_equal_enumeration():
    chance = np.random.default_rng(3).dirichlet(np.ones(len(PIECES)), 2).T
    words = [b" abcab", b" a", b" cabbc", b"x", " éa".encode()]
    data, bounds = packed(words)
    lattice = L.Lattice(PIECES)
    value = L.forward(lattice, data, bounds, chance)
    for w, word in enumerate(words):
        for k in range(2):
            assert value[w, k] == pytest.approx(math.log(sum(
                p for p, _ in spellings(word, chance[:, k]))))
    count = np.array([3, 1, 2, 5, 1])
    want = np.zeros(len(PIECES))
    for word, n in zip(words, count.tolist(), strict=True):
        ways = spellings(word, chance[:, 0])
        total = sum(p for p, _ in ways)
        for p, used in ways:
            for i in used:
                want[i] += n * p / total
    assert L.expected(lattice, data, bounds, count, chance[:, 0]) == pytest.approx(want)


def test_long_words_are_spelled_in_stretches():
    word = "é".encode() * 100
    data, bounds = packed([b"ab", word])
    flat, cuts, owner = L.spelled(data, bounds[:-1], bounds[1:])
    parts = [flat[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    assert parts[0] == b" ab" and b"".join(parts[1:]) == b" " + word
    assert all(len(p) <= L.STRETCH + 1 and p.decode() for p in parts)
    assert owner.tolist() == [0] + [1] * (len(parts) - 1)
    least = L.SMOOTHING / 33_000
    value = L.forward(L.Lattice(PIECES), flat, cuts, np.full((len(PIECES), 1), least))
    assert np.isfinite(value).all()


def test_held_out_accuracy(spark, piece_path):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = L.identify(documents, piece_path).join(documents.select("doc_id", "lang"), "doc_id")
    held = [r for r in found.collect() if r.held_out]
    assert len(held) > 200
    right = sum(r.lang == r.lang_pred for r in held)
    assert right / len(held) >= 0.97
    assert all(0 <= r.score <= 1 for r in held)
    assert all(set(r.languages) == {"de", "en", "es", "fr"} for r in held if r.lang_pred != "und")


def test_odd_rows(spark, make, piece_path):
    texts = [None, "", " 12 !! — …", "the of and is", "THE OF AND IS", "é", "日本語", "a" * 5000,
             "the of and is", "x " * 800_000, "«—»"]
    ids = [None, 1, 2, 3, 4, 5, 6, 7, 3, 9, 10]
    model_rows = [(100 + i, "the of and is to in that it was for", "en") for i in range(8)] + [
        (200 + i, "der die und das ist nicht ein ich auf den", "de") for i in range(8)]
    frame = make(texts, ids).drop("lang").selectExpr("*", "string(null) lang")
    frame = frame.unionByName(spark.createDataFrame(
        model_rows, "doc_id long, text string, lang string"), allowMissingColumns=True)
    found = [r for r in L.identify(frame, piece_path).collect()
             if r.doc_id is None or r.doc_id < 100]
    by = {}
    for r in found:
        by.setdefault(r.doc_id, []).append(r)
    assert len(found) == len(texts) and len(by[3]) == 2 and by[3][0].score == by[3][1].score
    for i in (None, 1, 2, 10):
        assert by[i][0].lang_pred == "und" and by[i][0].score == 0 and not by[i][0].languages
    assert by[3][0].lang_pred == by[4][0].lang_pred == "en"
    assert by[3][0].score == pytest.approx(by[4][0].score)
    assert all(by[i][0].lang_pred in ("en", "de") for i in (5, 6, 7, 9))
    one = by[9][0].languages["en"] / 800_000
    assert -60 < one < 0  # all 800,000 words of a text that is read in parts
    assert rows(L.identify(make([]), piece_path), "doc_id") == []
    lone = L.identify(make(["some text"], [1]).drop("lang").selectExpr(
        "*", "string(null) lang"), piece_path)
    assert rows(lone, "lang_pred", "score") == [("und", 0.0)]


def test_sample_is_bounded_and_repeatable(spark, piece_path):
    """A share of the rows by their own hash; the fit is the same each time."""
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    vocabulary_ = L.vocabulary_pieces(piece_path)
    one, two = (L.fit(documents.repartition(n), vocabulary_, sample=20_000, rounds=2)
                for n in (1, 5))
    assert one.languages == two.languages == sorted(one.languages)
    assert np.abs(one.table - two.table).max() < 1e-3
    assert one.table.sum(axis=0) == pytest.approx(1)
    assert one.table.min() >= L.SMOOTHING / len(vocabulary_) * 0.99
