"""Words, spans and hashes of Arrow text columns as NumPy arrays.

Texts are handled as UTF-8 bytes. A word is a run of bytes of one class; its 64-bit hash is a
polynomial over a random byte table, so that the hash of any span of a text follows from two
prefix sums. Work goes by slices of some MB, so memory follows the longest text at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; a longer text makes a slice of its own.
SLICE = 1 << 20
#: Bytes for which powers stay in a task's memory.
KEPT = 8 << 20

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of each.

    Those for up to ``KEPT`` bytes stay in memory; longer ones are made anew and go with their use.
    """
    if _POWERS and len(_POWERS[0]) >= n:
        return _POWERS[0], _POWERS[1]
    made = []
    for base in (_BASE, _INVERSE):
        run = np.full(max(n, SLICE + 4096), base & _MASK, np.uint64)
        run[0] = 1
        made.append(np.multiply.accumulate(run, out=run))
    if n <= KEPT:
        _POWERS[:] = made
    return made[0], made[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_table(fold_case: bool) -> np.ndarray:
    """A random 64-bit value per byte; A-Z share those of a-z if ``fold_case``."""
    table = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
    if fold_case:
        table[65:91] = table[97:123]
    return table


def byte_class(*outside: tuple[int, int]) -> np.ndarray:
    """True for each byte that belongs to a word: all but the given inclusive ranges."""
    inside = np.ones(256, bool)
    for low, high in outside:
        inside[low:high + 1] = False
    return inside


FOLDED = byte_table(True)
EXACT = byte_table(False)
#: Words between white space (space and the controls 9 to 13).
SPACED = byte_class((0x20, 0x20), (0x09, 0x0D))
#: Words of letters, digits and everything beyond ASCII.
ALNUM = byte_class((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))


def utf8(array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row, and the len + 1 bounds between them. Null counts as empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = pc.fill_null(array, "")
    array = array.cast(pa.large_binary())
    if not len(array):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(array.buffers()[1], np.int64)[array.offset:array.offset + len(array) + 1]
    raw = array.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[bounds[0]:bounds[-1]], bounds - bounds[0]


def slices(array, size: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, bounds) of consecutive rows that hold ``size`` bytes or one."""
    data, bounds = utf8(array)
    first, rows = 0, len(bounds) - 1
    while first < rows:
        end = int(np.searchsorted(bounds, bounds[first] + size, "right")) - 1
        end = min(rows, max(end, first + 1))
        yield first, end, data[bounds[first]:bounds[end]], bounds[first:end + 1] - bounds[first]
        first = end


def words(data: np.ndarray, bounds: np.ndarray, inside: np.ndarray
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each run of ``inside`` bytes; runs stop at text bounds."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none
    in_word = inside[data]
    cut = np.zeros(n + 1, bool)
    cut[bounds] = True
    opens = in_word.copy()
    opens[1:] &= ~in_word[:-1] | cut[1:n]
    closes = in_word.copy()
    closes[:-1] &= ~in_word[1:] | cut[1:n]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return start, end, np.searchsorted(bounds, start, "right") - 1


def prefix(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Prefix sums from which ``span_hash`` takes the hash of any span."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * powers(len(data) + 1)[0][:len(data)], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    length = (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return mix((sums[end] - sums[start]) * powers(len(sums))[1][start] + length)


def word_hashes(data: np.ndarray, bounds: np.ndarray, inside: np.ndarray, table: np.ndarray
                ) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of each word.

    A hash depends on the bytes of its word alone, so sums run over ``SLICE`` bytes, or one longer word,
    at a time, however long a text is.
    """
    start, end, text = words(data, bounds, inside)
    found, i = np.empty(len(start), np.uint64), 0
    while i < len(start):
        at = start[i]
        j = max(i + 1, int(np.searchsorted(end, at + SLICE, "right")))
        found[i:j] = span_hash(prefix(data[at:end[j - 1]], table), start[i:j] - at, end[i:j] - at)
        i = j
    return found, text


def shingles(hashes: np.ndarray, text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of each run of ``size`` words. Of a text with fewer: all its words."""
    n = len(hashes)
    if not n:
        return hashes, text
    first = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
    count = np.diff(np.r_[first, n])
    left = np.repeat(first + count, count) - np.arange(n)  # words from here to the text's end
    whole = left >= size
    run = np.zeros(n, np.uint64)
    for step in range(min(size, n)):
        run[:n - step] = mix(run[:n - step] * np.uint64(_BASE) + hashes[step:])
    out, owner = run[whole], text[whole]
    for at in np.flatnonzero(count < size):  # short texts
        value = np.zeros(1, np.uint64)
        for x in hashes[first[at]:first[at] + count[at]]:
            value = mix(value * np.uint64(_BASE) + x)
        out, owner = np.r_[out, value], np.r_[owner, text[first[at]]]
    return out, owner


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indexes of all items of the spans (start, length), one span after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def cut_table(*ranges: tuple[int, int]) -> np.ndarray:
    """True for the bytes of the given inclusive ranges."""
    return ~byte_class(*ranges)


#: A byte that is a character of its own and no letter or digit.
BREAK = cut_table((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))


def _cut(data: np.ndarray, at: int, stop: int, end: int, here: np.ndarray, before: np.ndarray
         ) -> int:
    """The last place in (at, stop] before which a cut is allowed, else the first one after."""
    step = 1 << 16
    high = stop
    while high > at:
        low = max(at, high - step)
        ok = np.flatnonzero(here[data[low + 1:high + 1]] & before[data[low:high]])
        if len(ok):
            return low + 1 + int(ok[-1])
        high = low
    low = stop
    while low + 1 < end:
        high = min(end - 1, low + step)
        ok = np.flatnonzero(here[data[low + 1:high + 1]] & before[data[low:high]])
        if len(ok):
            return low + 1 + int(ok[0])
        low = high
    return end


def parts(array, here: np.ndarray, before: np.ndarray | None = None, size: int = SLICE
          ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, bool, bool]]:
    """(row of each text, bytes, bounds, opens, closes) of about ``size`` bytes at once.

    Short texts come whole and together. A longer text comes alone in consecutive parts, cut only
    before a byte of ``here`` that follows a byte of ``before``, so memory does not follow the
    longest text unless it has no such place; ``opens`` and ``closes`` mark its first and last part.
    """
    before = np.ones(256, bool) if before is None else before
    data, bounds = utf8(array)
    first, rows = 0, len(bounds) - 1
    while first < rows:
        at, end = int(bounds[first]), int(bounds[first + 1])
        if end - at > size:
            opens = True
            while at < end:
                stop = end if end - at <= size else _cut(data, at, at + size, end, here, before)
                yield (np.array([first]), data[at:stop], np.array([0, stop - at]), opens,
                       stop == end)
                at, opens = stop, False
            first += 1
            continue
        last = int(np.searchsorted(bounds, at + size, "right")) - 1
        last = min(rows, max(last, first + 1))
        yield (np.arange(first, last), data[at:bounds[last]], bounds[first:last + 1] - at, True,
               True)
        first = last


def taken(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.StringArray:
    """The spans as Arrow strings."""
    length = end - start
    offsets = np.zeros(len(start) + 1, np.int32)
    np.cumsum(length, out=offsets[1:])
    raw = data[spread(start, length)]
    return pa.StringArray.from_buffers(len(start), pa.py_buffer(offsets.tobytes()),
                                       pa.py_buffer(raw.tobytes()))


class Memo:
    """Slots of distinct words in a process, forgotten as a whole when they hold too much."""

    def __init__(self, limit: int = 48 << 20) -> None:
        self.limit, self.slot, self.held = limit, {}, 0

    def missing(self, keys: np.ndarray, weight: int = 160) -> np.ndarray:
        """Places of the keys without a slot; all of them if the memo was full, and is now empty."""
        if self.held > self.limit:
            self.slot, self.held = {}, 0
        known = self.slot
        gone = np.flatnonzero([k not in known for k in keys.tolist()])
        self.held += weight * len(gone)
        return gone

    def add(self, keys: np.ndarray) -> None:
        at = len(self.slot)
        self.slot.update(zip(keys.tolist(), range(at, at + len(keys)), strict=True))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        known = self.slot
        return np.array([known[k] for k in keys.tolist()], np.int64)
