"""Token ids of whole texts from a byte-level BPE file, each distinct word encoded once.

The file's split pattern never joins a character to a space that follows it, so a text may be
cut before each space and the parts encoded alone. The one exception is a space inside a run of
white space, which ``JOINED`` finds; such texts are encoded in one piece.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pandas as pd

from plumbline.llm import text as T

#: A space after white space and before white space or the end: cutting there changes ids.
JOINED = re.compile(r"\s (?:\s|\Z)")
#: What the split pattern takes as white space, here in long runs, on which its engine
#: would run out of stack.
BLANK = re.compile("[\\t-\\r %s]{4096,}" % "".join(map(chr, (
    0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))))
#: Words start at a space; the space belongs to the word.
NOT_SPACE = T.byte_class((0x20, 0x20))
#: Distinct words kept per process, and bytes of them: text without spaces makes words of whole lines.
CACHE, CACHE_BYTES = 600_000, 32 << 20
#: Fixed value: how the vocabulary file's pre-tokenizer splits a text.
SPLIT = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

_LOADED: dict[str, ByteEncoder] = {}


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file, and the byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class WordTable:
    """ids of distinct words, each worked out once per process while the table has room."""

    def __init__(self) -> None:
        self.forget()

    def forget(self) -> None:
        self.slot: dict[int, int] = {}
        self.held = 0
        self.begin = self.size = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def encode_new(self, words: list[bytes]) -> tuple[list[int], np.ndarray, np.ndarray]:
        """Order in which the words were encoded, their ids in a row, and how many each has."""
        raise NotImplementedError

    def slots(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Place of each word in ``begin`` and ``size``."""
        back, keys = pd.factorize(T.span_hash(T.prefix(data, T.EXACT), start, end))
        first = np.zeros(len(keys), np.int64)
        first[back[::-1]] = np.arange(len(back))[::-1]
        if len(self.slot) > CACHE or self.held > CACHE_BYTES:
            self.forget()
        listed = keys.tolist()
        slots = np.array([self.slot.get(key, -1) for key in listed], np.int64)
        missing = np.flatnonzero(slots < 0)
        if len(missing):
            raw = data.tobytes()
            at = first[missing]
            self.held += int((end[at] - start[at]).sum())
            order, ids, sizes = self.encode_new(
                [raw[a:b] for a, b in zip(start[at].tolist(), end[at].tolist(), strict=True)])
            self.size = np.concatenate([self.size, sizes]).astype(np.int64)
            self.begin = np.cumsum(self.size) - self.size
            self.flat = np.concatenate([self.flat, ids])
            for i in order:
                self.slot[listed[missing[i]]] = len(self.slot)
            slots[missing] = [self.slot[listed[i]] for i in missing]
        return slots[back]

    def ids(self, slots: np.ndarray) -> np.ndarray:
        """ids of the words at ``slots``, one word after the other."""
        return self.flat[T.spread(self.begin[slots], self.size[slots])]


def space_words(data: np.ndarray, bounds: np.ndarray
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text of the parts between cuts before each space; together they are all."""
    n = len(data)
    cut = ~NOT_SPACE[data]
    cut[bounds[bounds < n]] = True
    start = np.flatnonzero(cut)
    end = np.append(start[1:], n)[:len(start)]
    return start, end, np.searchsorted(bounds, start, "right") - 1


class ByteEncoder(WordTable):
    """ids of texts, equal to ``Tokenizer.from_file(path).encode(text, add_special_tokens=False)``."""

    def __init__(self, path: str) -> None:
        import tiktoken

        super().__init__()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        order = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in merges]
        if order != sorted(order) or spec["normalizer"] is not None:
            raise ValueError(f"{path}: ids do not follow the merge order")
        letters = byte_letters()
        ranks = {bytes(letters[c] for c in token): i for token, i in vocab.items()
                 if token not in special}
        self.core = tiktoken.Encoding(path, pat_str=SPLIT, mergeable_ranks=ranks,
                                      special_tokens=special)
        self.special = tuple(special)
        self.bytes_of = np.zeros(len({**vocab, **special}), np.int64)
        for token, i in [*ranks.items(), *((t.encode(), i) for t, i in special.items())]:
            self.bytes_of[i] = len(token)

    @classmethod
    def load(cls, path: str) -> ByteEncoder:
        if path not in _LOADED:
            _LOADED[path] = cls(path)
        return _LOADED[path]

    def whole(self, text: str) -> np.ndarray:
        """ids of a text. A long run of white space is split as the pattern does it: all but its
        last character are one word, and the whole run before the end or a special token is."""
        out, at = [], 0
        for run in BLANK.finditer(text):
            stop = run.end()
            if stop < len(text) and not text.startswith(self.special, stop):
                stop -= 1
            out += [self.core.encode_to_numpy(text[at:run.start()], allowed_special="all"),
                    np.array(self.core._encode_single_piece(text[run.start():stop]))]
            at = stop
        out.append(self.core.encode_to_numpy(text[at:], allowed_special="all"))
        return np.concatenate(out).astype(np.uint32)

    def encode_new(self, words: list[bytes]) -> tuple[list[int], np.ndarray, np.ndarray]:
        """Nearly all words go through the encoder in one call, as cutting there is safe."""
        run, alone, texts = [], [], [w.decode() for w in words]
        for i, word in enumerate(texts):
            joins = (len(word) > 1 and word[0] == " "
                     and not word[1].isspace() and not word[-1].isspace())
            (run if joins else alone).append(i)
        ids = self.core.encode_to_numpy("".join([texts[i] for i in run]), allowed_special="all")
        ends = np.cumsum([len(words[i]) for i in run]).astype(np.int64)
        last = np.searchsorted(np.cumsum(self.bytes_of[ids]), ends, "left") + 1
        own = [self.whole(texts[i]) for i in alone]
        sizes = np.r_[np.diff(last, prepend=0), np.array([len(x) for x in own], np.int64)]
        return run + alone, np.concatenate([ids, *own]).astype(np.uint32), sizes

    def slice(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ids of all texts of a slice in a row, and how many each text has."""
        rows = len(bounds) - 1
        raw = data.tobytes()
        apart = {}
        if JOINED.search(raw.decode()):
            for row in range(rows):
                text = raw[bounds[row]:bounds[row + 1]].decode()
                if JOINED.search(text):
                    apart[row] = self.whole(text)
        start, end, owner = space_words(data, bounds)
        if apart:
            keep = ~np.isin(owner, list(apart))
            start, end, owner = start[keep], end[keep], owner[keep]
        slots = self.slots(data, start, end)
        ids = self.ids(slots)
        counts = np.bincount(owner, weights=self.size[slots], minlength=rows).astype(np.int64)
        if apart:
            parts = np.split(ids, np.cumsum(counts)[:-1])
            for row, own in apart.items():
                parts[row], counts[row] = own, len(own)
            ids = np.concatenate(parts)
        return ids, counts
