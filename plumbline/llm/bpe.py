"""Byte-pair encoding as a streaming transducer with bounded lookahead, and decoding.

From the merge list follows how many symbols after a token can still change it: a merge is undone
only if its right part is taken by an earlier rule to its right, whose own right part may be taken
by a still earlier one, and so on along falling ranks. The longest such chain is the sufficient
lookahead. The transducer keeps that many symbols and the longest token; it emits a token once
all the lookahead behind it has been read, so memory is constant for words of any length.
Decoding feeds the bytes of each token to an incremental UTF-8 machine that holds back at most
the bytes of one unfinished character.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm import text as T
from plumbline.llm.tables import pieces
from plumbline.llm.tokens import WordTable, byte_letters, space_words

#: Fixed value: how the vocabulary file's pre-tokenizer splits a normalised text.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_LOADED: dict[str, "WordEncoder"] = {}


class Transducer:
    """Tokens of a symbol stream under a merge list.

    ``merges`` are (left, right, merged) symbol numbers in rank order.
    """

    def __init__(self, merges: list[tuple[int, int, int]]) -> None:
        self.rank = {a << 32 | b: r for r, (a, b, _) in enumerate(merges)}
        self.merged = [m for _, _, m in merges]
        self.length: dict[int, int] = {}
        self.lookahead = self.sufficient_lookahead(merges)
        self.step = max(64, max(self.length.values(), default=1))

    def sufficient_lookahead(self, merges: list[tuple[int, int, int]]) -> int:
        """Symbols after a token's end that decide whether it stays; one pass in rank order.

        ``taken[x]``: how far the rules so far that take x as left part reach to the right, chains
        included. ``inner[t]``: the same for the symbols along the right edge of t, each under the
        rules that came before the one that consumed it.
        """
        taken: dict[int, int] = {}
        inner: dict[int, int] = {}
        length = self.length
        for left, right, merged in merges:
            reach = max(taken.get(right, 0), inner.get(right, 0))
            size = length.setdefault(right, 1)
            length[merged] = length.setdefault(left, 1) + size
            inner[merged] = max(inner.get(merged, 0), reach)
            taken[left] = max(taken.get(left, 0), size + reach)
        return max([0, *taken.values(), *inner.values()])

    def merge(self, symbols: list[int]) -> list[int]:
        """Tokens of a whole buffer: the lowest rank first, from the left."""
        get, none, merged = self.rank.get, len(self.merged), self.merged
        found = symbols[:]
        ranks = [get(a << 32 | b, none) for a, b in zip(found, found[1:], strict=False)]
        while ranks:
            least = min(ranks)
            if least == none:
                break
            i = ranks.index(least)
            found[i:i + 2] = [merged[least]]
            del ranks[i]
            if i:
                ranks[i - 1] = get(found[i - 1] << 32 | found[i], none)
            if i < len(ranks):
                ranks[i] = get(found[i] << 32 | found[i + 1], none)
        return found

    def tokens(self, symbols: list[int]) -> list[int]:
        """Tokens of a word; one that fits the buffer is read to its end before any is emitted."""
        if len(symbols) < self.lookahead + 2 * self.step:
            return self.merge(symbols)
        return list(self.stream(symbols))

    def stream(self, symbols: Iterable[int]) -> Iterator[int]:
        """Tokens as soon as they are stable; holds lookahead + two steps of symbols at most."""
        buffer: list[int] = []
        limit = self.lookahead + 2 * self.step
        for symbol in symbols:
            buffer.append(symbol)
            if len(buffer) >= limit:
                used, safe = 0, len(buffer) - self.lookahead
                for token in self.merge(buffer):
                    if used + self.length.get(token, 1) > safe:
                        break
                    used += self.length.get(token, 1)
                    yield token
                del buffer[:used]
        yield from self.merge(buffer)


class Decoder:
    """Text of a token stream, piece by piece; holds back the bytes of an unfinished character."""

    def __init__(self, token_bytes: dict[int, bytes], between: bytes = b"") -> None:
        self.token_bytes, self.between = token_bytes, between
        self.started = False
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int], last: bool = False) -> str:
        run = self.between.join([self.token_bytes[i] for i in ids])
        if self.started and run:
            run = self.between + run
        self.started |= bool(run)
        return self.machine.decode(run, last)


class WordEncoder(WordTable):
    """The word-end BPE of ``path``: equal to the tokenizers library's encode and decode."""

    def __init__(self, path: str) -> None:
        import regex

        super().__init__()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = regex.compile(
            "(" + "|".join(regex.escape(t) for t in self.special) + ")")
        self.find = regex.compile(SPLIT).findall
        letters = byte_letters()
        of_byte = {b: c for c, b in letters.items()}
        self.middle = [vocab[of_byte[b]] for b in range(256)]
        self.final = [vocab[of_byte[b] + suffix] for b in range(256)]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.transducer = Transducer([(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs])
        #: What the library's decode writes for each id: the vocabulary has no decoder.
        self.piece = {i: t.encode() for t, i in vocab.items()}
        self.piece |= {i: t.encode() for t, i in self.special.items()}
        #: The bytes each id stands for, with a space at word ends.
        self.raw = {i: bytes(letters[c] for c in t.removesuffix(suffix))
                    + (b" " if t.endswith(suffix) else b"") for t, i in vocab.items()
                    if t not in self.special}
        self.raw |= {i: t.encode() for t, i in self.special.items()}
        self.texts: list[bytes] = []

    @classmethod
    def load(cls, path: str) -> WordEncoder:
        if path not in _LOADED:
            _LOADED[path] = cls(path)
        return _LOADED[path]

    def forget(self) -> None:
        super().forget()
        self.texts = []

    def symbols(self, word: str) -> list[int]:
        raw, middle = word.encode(), self.middle
        return [*[middle[b] for b in raw[:-1]], self.final[raw[-1]]]

    def encode(self, text: str) -> list[int]:
        """ids of a text, through the transducer word by word."""
        out: list[int] = []
        parts = self.special_split.split(text) if "<|" in text else [text]
        for part in parts:
            if part in self.special:
                out.append(self.special[part])
                continue
            # The library lower-cases character by character, without final sigma.
            if not part.isascii():
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ")
            for word in self.find(part.lower()):
                out.extend(self.transducer.tokens(self.symbols(word)))
        return out

    def decode(self, ids: Iterable[int], raw: bool = False) -> str:
        """As the library writes ids (pieces joined by spaces), or the text they stand for."""
        if raw:
            return Decoder(self.raw).feed(ids, last=True)
        return Decoder(self.piece, b" ").feed(ids, last=True)

    def encode_new(self, words: list[bytes]) -> tuple[list[int], np.ndarray, np.ndarray]:
        found = [self.encode(w.decode()) for w in words]
        self.texts += [self.decode(ids).encode() for ids in found]
        flat = np.array([i for ids in found for i in ids], np.uint32)
        return list(range(len(words))), flat, np.array([len(ids) for ids in found], np.int64)


SCHEMA = "doc_id long, n_tokens long, ids binary, decoded binary, ids_sha256 string, " \
         "decoded_sha256 string"


def encode_texts(documents: DataFrame, path: str, digests_only: bool = False) -> DataFrame:
    """ids and decoded text of every whole text, with their SHA-256 digests.

    ``documents`` has doc_id and text; other columns are not read. Rows: doc_id, n_tokens, ids
    (little-endian unsigned 32-bit), decoded (UTF-8), ids_sha256, decoded_sha256; the two binary
    columns are left out with ``digests_only``. A null text counts as empty and has no tokens; a
    null doc_id stays null; repeated rows give repeated results; an empty table gives no rows.
    """
    fields = SCHEMA.replace(" ids binary, decoded binary,", "") if digests_only else SCHEMA

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder.load(path)
        for batch in pieces(batches):
            for first, end, data, bounds in T.slices(batch.column(1)):
                rows = end - first
                start, stop, owner = space_words(data, bounds)
                slots = encoder.slots(data, start, stop)
                some = encoder.size[slots] > 0
                slots, owner = slots[some], owner[some]
                size = encoder.size[slots]
                counts = np.bincount(owner, weights=size, minlength=rows).astype(np.int64)
                raw = memoryview(encoder.ids(slots).astype("<u4").tobytes())
                edge = (np.r_[0, np.cumsum(counts)] * 4).tolist()
                ids = [raw[a:b] for a, b in zip(edge, edge[1:], strict=False)]
                texts, listed = encoder.texts, slots.tolist()
                cut = np.searchsorted(owner, np.arange(rows + 1)).tolist()
                decoded = [b" ".join([texts[s] for s in listed[a:b]])
                           for a, b in zip(cut, cut[1:], strict=False)]
                columns = {
                    "doc_id": batch.column(0).slice(first, rows), "n_tokens": pa.array(counts),
                    "ids_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                    "decoded_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in decoded]),
                }
                if not digests_only:
                    columns |= {"ids": pa.array([bytes(x) for x in ids], pa.binary()),
                                "decoded": pa.array(decoded, pa.binary())}
                names = [f.strip().split(" ")[0] for f in fields.split(",")]
                yield pa.RecordBatch.from_arrays([columns[n] for n in names], names)

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")
                            ).mapInArrow(run, fields)
