"""Alignment of two tokenizers against their libraries and a plain count of all links."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from plumbline.llm import alignment as A
from plumbline.llm.queries import vocabulary
from plumbline.llm.tokens import byte_letters

PARTS = [" ", "  ", "   ", "\n", "\n\n", "\t", "\r", ";\r\n", "a", "b1", "'s", "É", "\xa0", "　",
         "<|endoftext|>", "<s>", "<0x0A>", "\x00", "é", "ΑΣ", "ß", "日本", "%%%", "x" * 60, "\x1c",
         "\x85", "  ", "🙂", "́", "hello", " world", "﻿", "the", "."]


@pytest.fixture(scope="module")
def paths():
    return vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")


class Plain:
    """The libraries on whole texts."""

    def __init__(self, paths):
        self.a = Tokenizer.from_file(paths[0])
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=paths[1])
        self.letters = byte_letters()

    def tokens(self, text):
        if not text:
            return [], []
        want = (" " + text).encode()
        a = [(i, bytes(self.letters[c] for c in self.a.id_to_token(i))) for i in self.a.encode(
            " " + text, add_special_tokens=False).ids]
        b = []
        for i in self.b.encode(text):
            piece = self.b.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if self.b.is_byte(i)
                      else piece.replace("▁", " ").encode()))
        if any(b"".join(t for _, t in side) != want for side in (a, b)):
            return [], []
        return a, b

    def align(self, texts):
        """(n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of each text."""
        count, lines = Counter(), []
        for text in texts:
            a, b = self.tokens(text)
            links, groups, i, j, end_a, end_b = [], [], 0, 0, 0, 0
            ends_a = np.cumsum([len(t) for _, t in a]).tolist()
            ends_b = np.cumsum([len(t) for _, t in b]).tolist()
            for x, (ia, ta) in enumerate(a):
                for y, (ib, tb) in enumerate(b):
                    if max(ends_a[x] - len(ta), ends_b[y] - len(tb)) < min(ends_a[x], ends_b[y]):
                        links.append((ia, ib))
            for end in sorted(set(ends_a) & set(ends_b)):
                own = ([], [])
                while i < len(a) and ends_a[i] <= end:
                    own[0].append(str(a[i][0]))
                    i += 1
                while j < len(b) and ends_b[j] <= end:
                    own[1].append(str(b[j][0]))
                    j += 1
                groups.append(",".join(own[0]) + "|" + ",".join(own[1]))
            count.update(links)
            lines.append((len(a), len(b), groups, links))
        best = {}
        for (_, ib), n in count.items():
            best[ib] = max(best.get(ib, 0), n)
        return [(na, nb, len(groups), len(links), sum(count[p] == best[p[1]] for p in links),
                 sum(count[p] for p in links), ";".join(groups))
                for na, nb, groups, links in lines]


NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")


def found(df):
    return sorted(((r.doc_id, *(r[n] for n in NAMES)) for r in df.collect()), key=str)


def odd_texts(n=250):
    draw = random.Random(11)
    return [None, "", " ", "  ", "\n", " a", "a ", "a \n b  ", "x▁y", "▁", " \xa0", "\xa0 b",
            *("".join(draw.choice(PARTS) for _ in range(draw.randint(1, 12))) for _ in range(n))]


def test_odd_texts_equal_the_libraries(make, paths):
    texts = odd_texts()
    texts += texts[30:40]  # repeated rows
    ids = [None, None, *range(len(texts) - 2)]
    want = sorted(((i, *line) for i, line in zip(ids, Plain(paths).align(texts), strict=True)),
                  key=str)
    assert found(A.align(make(texts, ids), *paths)) == want
    assert A.align(make([]), *paths).count() == 0
    assert found(A.align(make([None, ""]), *paths)) == [(0, *[0] * 6, ""), (1, *[0] * 6, "")]


def test_corpus_with_many_radixes_salts_and_small_blocks(spark, corpus, paths, monkeypatch):
    texts = corpus.where("length(text) < 2000").limit(60)
    rows = texts.select("doc_id", "text").collect()
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = sorted(((r.doc_id, *line) for r, line in zip(
        rows, Plain(paths).align([r.text for r in rows]), strict=True)), key=str)
    assert found(A.align(frame, *paths)) == want
    monkeypatch.setattr(A, "FAN", 3)  # several levels of merges
    assert found(A.align(frame, *paths, radix_text=1000, merged=50)) == want
    digest = {r.doc_id: r.groups_sha256 for r in A.align(frame, *paths, digests_only=True).collect()}
    assert digest == {w[0]: hashlib.sha256(w[-1].encode()).hexdigest() if w[-1] else ""
                      for w in want}


def test_merge_equals_a_plain_count(monkeypatch):
    monkeypatch.setattr(A, "BLOCK", 7)
    draw = np.random.default_rng(5)
    runs, total = [], Counter()
    for size in (0, 1, 7, 8, 100, 300):
        code = np.sort(draw.integers(0, 60, size)).astype(np.uint32) << 13
        n = draw.integers(1, 5, size).astype(np.uint32)
        for c, k in zip(code.tolist(), n.tolist(), strict=True):
            total[c] += k
        runs.append(A.blocks_of([code, n, n]))
    runs.append(A.blocks_of([np.full(40, 3 << 13, np.uint32), np.ones(40, np.uint32),
                             np.ones(40, np.uint32)]))
    total[3 << 13] += 40
    opened = [((c, n) for c, n, _ in A.read_blocks(r, A.RUN_KINDS)) for r in runs]
    lines = [x for c, n, t in A.with_best(A.merged_counts(opened))
             for x in zip(c.tolist(), n.tolist(), t.tolist(), strict=True)]
    top = {}
    for c, n in total.items():
        top[c >> 16] = max(top.get(c >> 16, 0), n)
    assert lines == [(c, n, int(n == top[c >> 16])) for c, n in sorted(total.items())]


def test_long_texts_come_in_parts(make, paths, monkeypatch):
    """Parts give what the whole gives; a text that ends badly leaves no record."""
    texts = ["lorem ipsum dolor " * 120_000, "word " * 300_000 + "▁", "lorem ipsum dolor",
             "a" * 1_500_000]
    lines = {r.doc_id: r for r in A.align(make(texts), *paths).collect()}
    plain = Plain(paths)
    a = plain.a.encode(" " + texts[0], add_special_tokens=False).ids
    b = plain.b.encode(texts[0])
    assert (lines[0].n_a, lines[0].n_b) == (len(a), len(b))
    assert lines[0].groups.count(";") + 1 == lines[0].n_groups
    assert [int(x) for g in lines[0].groups.split(";") for x in g.split("|")[1].split(",")] == b
    assert lines[1].n_a == lines[1].count_sum == 0 and lines[1].groups == ""
    assert lines[2].count_sum > 0 and lines[3].n_b == len(plain.b.encode(texts[3]))


@pytest.mark.parametrize("blank", [" ", "\n", "\t", "　"])
def test_long_white_space(make, paths, blank):
    """Runs on which the pattern's own engine runs out of stack."""
    texts = [blank * 2_000_000 + "x", "x" + blank * 2_000_000, "y" + blank * 5000 + " z"]
    lines = {r.doc_id: r for r in A.align(make(texts), *paths).collect()}
    coder = A.Encoders.load(*paths)
    for i, text in enumerate(texts):
        assert lines[i].n_links >= lines[i].n_groups > 0
        if i == 2:
            assert [x for g in lines[i].groups.split(";") for x in g.split("|")[0].split(",")] == [
                str(x) for x in coder.core.encode_ordinary(" " + text)]


def test_any_character_comes_back(paths):
    """Every character but U+2581 is given back by both tokenizers, alone and in a row."""
    coder = A.Encoders.load(*paths)
    chars = [chr(c) for c in (*range(0xD800), *range(0xE000, 0x30000), *range(0xE0000, 0xE0200))
             if c != 0x2581]
    for low in range(0, len(chars), 5000):
        text = " " + "".join(f"{c}." for c in chars[low:low + 5000])
        assert coder.joined_b(coder.second_ids(text)) == text.encode()
