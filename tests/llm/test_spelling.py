"""Spelling variants against a brute-force search over full neighbourhoods."""

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from plumbline.llm import spelling

LETTERS = [chr(c) for c in (*range(97, 123), *range(0xC0, 0x100))]
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, length=6, times=5, drop=199, ratio=5):
    seen = Counter()
    for doc_id, text in rows:
        for match in re.finditer("[A-Za-zÀ-ÿ]+", text or ""):
            word = match.group().translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % drop == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            if len(word) >= length:
                seen[word] += 1
    n = {w: c for w, c in seen.items() if c >= times}
    near, form = {}, {}
    for w in n:
        around = {w[:i] + w[i + 1:] for i in range(len(w))}
        around |= {w[:i] + a + w[i + 1:] for i in range(len(w)) for a in LETTERS}
        around |= {w[:i] + a + w[i:] for i in range(len(w) + 1) for a in LETTERS}
        near[w] = sorted((x for x in around - {w} if x in n), key=lambda x: (-n[x], x))
        if near[w] and n[near[w][0]] >= ratio * n[w]:
            form[w] = near[w][0]

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n[w], len(near[w]), n.get(form.get(w))) for w in n}


def found(df):
    out = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()]
    assert len(out) == len(set(out))
    return set(out)


def test_corpus_equals_brute_force(corpus):
    rows = [(r.doc_id, r.text) for r in corpus.select("doc_id", "text").collect()]
    for drop in (199, 3):  # with 3 most words have variants
        assert found(spelling.group_variants(corpus, drop=drop)) == brute(rows, drop=drop)


def test_odd_rows(make):
    chain = ["colour" * 2] * 130 + ["colourcolou"] * 26 + ["colourcolo"] * 5
    ties = ["abcdef"] * 25 + ["abcdez"] * 25 + ["abcdeq"] * 5  # the form is the first in order
    accents = ["cafésÿà"] * 5 + ["CAFÉSÿà"] * 6 + ["a×b÷cde"] * 5
    texts = [None, "", " ", " ".join(chain), ",".join(ties), "\n".join(accents), "x" * 9, "1", "日本"]
    texts += ["same text twice"] * 3
    ids = [None, None, *range(len(texts) - 5), 3, 3, 3]
    rows = list(zip(ids, texts, strict=True))
    assert found(spelling.group_variants(make(texts, ids))) == brute(rows)
    assert any(f == "abcdef" for _, f, *_ in brute(rows))
    assert spelling.group_variants(make([])).count() == 0
    assert spelling.group_variants(make([None, "", "..."])).count() == 0


def test_long_words_and_texts(make):
    """A word of 20,000 letters and its variant; a text that is read in many parts."""
    giant = "qwertyuiop" * 2000
    texts = [" ".join([giant] * 30), " ".join([giant[:-1]] * 5), "letters " * 700_000]
    lines = {r.word: r for r in spelling.group_variants(make(texts), drop=10**9).collect()}
    assert lines[giant[:-1]].root == giant and lines[giant].n_near == 1
    assert lines["letters"].n == 700_000 and len(lines) == 3


def test_neighbourhood_is_whole_and_distinct():
    """Generated keys are those of all strings at one edit in the reduced alphabet."""
    symbol = np.zeros(256, np.uint8)
    symbol[spelling.LETTERS] = np.arange(len(spelling.LETTERS)) % 3
    letter = {0: "a", 1: "b", 2: "c"}
    for word in ("aabbca", "abcabcc", "cccccc"):
        near = np.concatenate([k for k, _ in spelling.neighbourhoods(pa.array([word]), symbol)])
        strings = {word}
        strings |= {word[:i] + word[i + 1:] for i in range(len(word))}
        strings |= {word[:i] + a + word[i + 1:] for i in range(len(word)) for a in letter.values()}
        strings |= {word[:i] + a + word[i:] for i in range(len(word) + 1) for a in letter.values()}
        keys = spelling.reduced_keys(pa.array(sorted(strings)), symbol)
        assert sorted(near.tolist()) == sorted(keys.tolist())


def test_crc_of_spans_equals_zlib():
    data = np.frombuffer("12:café x ".encode(), np.uint8)
    start, end = np.array([0, 3, 9]), np.array([3, 8, 10])
    state = np.array([zlib.crc32(b""), zlib.crc32(b"77:"), zlib.crc32(b"-1:")], np.uint32)
    want = [zlib.crc32(data[a:b].tobytes(), int(s)) for a, b, s in zip(start, end, state, strict=True)]
    assert spelling.crcs(data, start, end, state).tolist() == want
