"""Packing and byte-pair encoding against the tokenizers library and by exact round trips."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from plumbline.llm import bpe, packing
from plumbline.llm import text as T
from plumbline.llm import tokens
from plumbline.llm.tokens import ByteEncoder

PARTS = [" ", "  ", "\n", "\t", "a", "b1", "'s", "É", " ", "<|endoftext|>", "́", "\r",
         "ΑΣ", "İ", "hello", "<|startoftext|>", "ß", "日本", "%%%", "x" * 300, "\x1c", " "]


def odd_texts(n=600):
    draw = random.Random(7)
    return ["", None, " ", "a  ", "a \n \nb", "ΟΔΥΣΣΕΥΣ", "é é", *(
        "".join(draw.choice(PARTS) for _ in range(draw.randint(1, 12))) for _ in range(n))]


def check_packing(found, expected, length=1024):
    """Every id in one place; sequences gapless from 0 and at most ``length``."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in found:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for doc, ids in expected.items():
        pieces = sorted(by_doc[doc], key=lambda r: r.start)
        at = 0
        for r in pieces:
            assert r.start == at and r.doc_tokens == len(ids) and 0 < r.length <= length
            part = np.array(ids[at:at + r.length], "<u4").tobytes()
            assert r.ids_crc32 == zlib.crc32(part)
            at += r.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= length
    return len(by_sequence)


def test_packing_places_every_id_once(make, bpe_path):
    texts = [*odd_texts(), "word " * 5000]
    tok = Tokenizer.from_file(bpe_path)
    expected = {i: tok.encode(t or "", add_special_tokens=False).ids + [0]
                for i, t in enumerate(texts)}
    found = packing.pack(make(texts), bpe_path).collect()
    check_packing(found, expected)
    assert packing.pack(make([]), bpe_path).count() == 0


def test_packing_has_little_padding(corpus, bpe_path):
    found = packing.pack(corpus, bpe_path, group=50).collect()
    tok = Tokenizer.from_file(bpe_path)
    expected = {r.doc_id: tok.encode(r.text, add_special_tokens=False).ids + [0]
                for r in corpus.collect()}
    sequences = check_packing(found, expected)
    assert sum(map(len, expected.values())) > 0.9 * 1024 * sequences


def test_packing_keeps_repeated_rows_and_null_ids(make, bpe_path):
    found = packing.pack(make(["a b", "a b", "c"], [3, 3, None]), bpe_path).collect()
    assert sorted((r.doc_id or -1, r.doc_tokens) for r in found) == [(-1, 2), (3, 3), (3, 3)]
    assert len({(r.sequence_id, r.offset) for r in found}) == 3


def test_first_fit_takes_the_first_bin_with_room():
    draw = random.Random(1)
    sizes = sorted((draw.randint(1, 1024) for _ in range(500)), reverse=True)
    bins, offsets = packing.first_fit_decreasing(sizes, 1024)
    free = [1024] * len(sizes)
    for size, bin_, offset in zip(sizes, bins, offsets, strict=True):
        first = next(i for i, room in enumerate(free) if room >= size)
        assert (bin_, offset) == (first, 1024 - free[first])
        free[first] -= size


def test_byte_ids_equal_the_library(bpe_path):
    texts = odd_texts(3000)
    encoder, tok = ByteEncoder.load(bpe_path), Tokenizer.from_file(bpe_path)
    ids, counts = encoder.slice(*T.utf8(pa.array(texts)))
    for got, text in zip(np.split(ids, np.cumsum(counts)[:-1]), texts, strict=True):
        assert got.tolist() == tok.encode(text or "", add_special_tokens=False).ids


def test_encoding_and_decoding_equal_the_library(make, word_path):
    texts = [*odd_texts(), "ab" * 5000, "word Word, " * 3000]
    tok = Tokenizer.from_file(word_path)
    found = {r.doc_id: r for r in bpe.encode_texts(make(texts), word_path).collect()}
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        ids = tok.encode(text or "", add_special_tokens=False).ids
        raw, decoded = np.array(ids, "<u4").tobytes(), tok.decode(ids, skip_special_tokens=False)
        r = found[i]
        assert (r.n_tokens, bytes(r.ids), bytes(r.decoded).decode()) == (len(ids), raw, decoded)
        assert r.ids_sha256 == hashlib.sha256(raw).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
    assert bpe.encode_texts(make([]), word_path).count() == 0


def test_decoder_gives_the_text_back_piece_by_piece(word_path):
    encoder = bpe.WordEncoder.load(word_path)
    ids = encoder.encode("naïve 日本 café <|endoftext|>")
    machine = bpe.Decoder(encoder.raw)
    assert "".join([*(machine.feed([i]) for i in ids), machine.feed([], last=True)]) == \
        "naïve 日本 café <|endoftext|>"


@pytest.mark.parametrize("seed", range(30))
def test_stream_with_bounded_lookahead_equals_whole_merge(seed):
    draw = random.Random(seed)
    text = {i: chr(97 + i) for i in range(draw.choice([2, 3]))}
    letters, merges = list(text), []
    for _ in range(40):
        a, b = draw.choice(list(text)), draw.choice(list(text))
        if text[a] + text[b] not in text.values() and len(text[a] + text[b]) <= 8:
            text[len(text)] = text[a] + text[b]
            merges.append((a, b, len(text) - 1))
    machine = bpe.Transducer(merges)
    machine.step = 8
    for _ in range(20):
        symbols = [draw.choice(letters) for _ in range(draw.randint(1, 400))]
        assert list(machine.stream(symbols)) == machine.merge(symbols)


@pytest.mark.parametrize("blank", [" ", "\n", "\t", "\u3000", "\r\n"])
def test_packing_survives_long_white_space(make, bpe_path, blank):
    """Runs of millions, on which the split pattern's engine runs out of stack; the shorter ones equal
    the library."""
    tok = Tokenizer.from_file(bpe_path)
    encoder = ByteEncoder.load(bpe_path)
    for text in (f"a{blank * 5000} b", f"a{blank * 5000}b", f"a{blank * 5000}",
                 f"{blank * 5000}<|endoftext|>x{blank * 4096}\x1cy"):
        assert encoder.whole(text).tolist() == tok.encode(text, add_special_tokens=False).ids
    texts = [f"x{blank * 3_000_000} y", blank * 2_000_000]
    found = packing.pack(make(texts), bpe_path).collect()
    for i, text in enumerate(texts):
        pieces = sorted((r for r in found if r.doc_id == i), key=lambda r: r.start)
        assert sum(r.length for r in pieces) == pieces[0].doc_tokens == len(encoder.whole(text)) + 1


def test_packing_groups_are_bounded_by_pieces(spark, make, bpe_path):
    """Many equal rows and a few long documents: groups follow the number of pieces."""
    texts = [""] * 3000 + ["word " * 100_000] * 2
    frame = make(texts, [None] * 3000 + [1, 1])
    found = packing.pack(frame, bpe_path, group=256).collect()
    groups = Counter(r.sequence_id >> 32 for r in found)
    assert len(found) > 3150 and len(groups) >= 11 and max(groups.values()) < 400
    assert len({(r.sequence_id, r.offset) for r in found}) == len(found)


def test_word_cache_is_bounded_in_bytes(word_path, bpe_path, monkeypatch):
    """Long words without spaces: few of them are kept, and ids stay those of the library."""
    draw = random.Random(4)
    lines = ["".join(chr(draw.randrange(0x4E00, 0x4F00)) for _ in range(200)) for _ in range(60)]
    monkeypatch.setattr(tokens, "CACHE_BYTES", 2000)
    for encoder, path in ((bpe.WordEncoder(word_path), word_path),
                          (ByteEncoder(bpe_path), bpe_path)):
        library = Tokenizer.from_file(path)
        for line in lines:
            data, bounds = T.utf8(pa.array([f"{line} {line[:20]}"]))
            start, end, _ = tokens.space_words(data, bounds)
            found = encoder.ids(encoder.slots(data, start, end)).tolist()
            assert found == library.encode(f"{line} {line[:20]}", add_special_tokens=False).ids
            assert encoder.held <= 2000 + len(data) and len(encoder.slot) <= 12
