"""Alignment of two tokenizers on whole texts, with pair counts by external spill counting.

Texts are encoded where they are read, each distinct segment once; a segment begins with white space
and ends before the next, where both tokenizers always cut. Overlapping tokens give links, and tasks
reduce them to records (pair, document, links). These are dealt by a radix of the second tokenizer's id
and leave as runs: sorted blocks under zstd. The runs of a radix, or of a salt of a radix that
has too many, are counted by a k-way heap merge. The counts of a radix are merged likewise: in order of
the second side, each of its ids is complete when the next begins, which gives its maximum. Last, the
runs are read once more beside the counts of their radix, and each record sends its document's share
back.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm import text as T
from plumbline.llm.tables import kept, pieces
from plumbline.llm.tokens import ByteEncoder

#: Links of a task that are sorted and sent as runs together.
HELD = 1 << 22
#: Records of a block of a run, which is decompressed as a whole.
BLOCK = 1 << 14
#: Bytes of text for each radix, and radixes at most, so that runs do not become tiny; beyond, salts
#: split a radix further.
RADIX_TEXT = 64 << 20
RADIXES = 1024
#: Records of one merge at most, beyond which a radix is salted.
MERGED = 1 << 24
#: Runs of counts that one merge takes at once.
FAN = 64
#: Ids of either side have to be below.
IDS = 1 << 16

#: White space beyond ASCII.
WIDE_BLANK = [0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Long runs of what the first tokenizer's split pattern takes as white space.
BLANK = re.compile("[\\t-\\r %s]{4096,}" % "".join(map(chr, WIDE_BLANK)))
#: A segment begins with one of these. A carriage return can end a piece of the second tokenizer.
OPENS = T.cut_table((0x09, 0x0C), (0x20, 0x20))
#: ASCII bytes after which a segment may end; beyond ASCII, ``segments`` looks closer.
GRAPHIC = T.cut_table((0x21, 0x7E))
_BLANK_CODES = np.array([int.from_bytes(chr(c).encode(), "big") for c in WIDE_BLANK])

SEPARATORS = b",|;"
#: Encoders of this process by their files: a worker serves many tasks.
_LOADED: dict[tuple[str, str], Encoders] = {}


def solid(data: np.ndarray) -> np.ndarray:
    """True for each byte that ends a character other than white space, and for bytes within one."""
    wide = data.astype(np.int64)
    two = np.zeros(len(data), np.int64)
    two[1:] = wide[:-1] << 8 | wide[1:]
    three = two.copy()
    three[2:] |= wide[:-2] << 16
    return GRAPHIC[data] | (data >= 0x80) & ~np.isin(two, _BLANK_CODES) & ~np.isin(
        three, _BLANK_CODES)


def segments(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text of each segment; together they are all bytes.

    A text is cut before white space that follows a character that is none.
    """
    n = len(data)
    cut = OPENS[data]
    cut[1:] &= solid(data)[:-1]
    cut[bounds[:-1][bounds[:-1] < n]] = True
    start = np.flatnonzero(cut)
    return start, np.append(start[1:], n)[:len(start)], np.searchsorted(bounds, start, "right") - 1


class Encoders:
    """Both tokenizers, and what they make of the segments seen so far."""

    def __init__(self, path_a: str, path_b: str) -> None:
        import sentencepiece

        first = ByteEncoder.load(path_a)
        self.core, self.bytes_a = first.core, first.bytes_of
        self.model = sentencepiece.SentencePieceProcessor(model_file=path_b)
        if max(len(self.bytes_a), self.model.get_piece_size()) > IDS:
            raise ValueError(f"more than {IDS} ids")
        spelled = [self.piece_bytes(i) for i in range(self.model.get_piece_size())]
        self.bytes_b = np.array([len(p) for p in spelled])
        self.begin_b = np.cumsum(self.bytes_b) - self.bytes_b
        self.flat_b = np.frombuffer(b"".join(spelled), np.uint8)
        self.memo = T.Memo()
        self.forget()

    @classmethod
    def load(cls, path_a: str, path_b: str) -> Encoders:
        if (path_a, path_b) not in _LOADED:
            _LOADED[path_a, path_b] = cls(path_a, path_b)
        return _LOADED[path_a, path_b]

    def piece_bytes(self, i: int) -> bytes:
        if self.model.is_control(i) or self.model.is_unknown(i):
            return b""
        piece = self.model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace(
            "▁", " ").encode()

    def forget(self) -> None:
        none = np.zeros(0, np.int64)
        self.counts = np.zeros((0, 4), np.int64)  # ids of either side, groups, links
        self.item_at = self.link_at = none
        self.items, self.links = np.zeros(0, np.int32), np.zeros(0, np.uint32)
        self.bad = np.zeros(0, bool)
        self.fresh: list[tuple] = []

    def first_ids(self, text: str) -> np.ndarray:
        """Ids of the first tokenizer. A long run of white space is split as its pattern does: all
        but the last character are one word, and all of it at the end of the text."""
        out, at = [], 0
        for run in BLANK.finditer(text):
            stop = run.end() if run.end() == len(text) else run.end() - 1
            out += [self.core.encode_to_numpy(text[at:run.start()], disallowed_special=()),
                    np.array(self.core._encode_single_piece(text[run.start():stop]))]
            at = stop
        out.append(self.core.encode_to_numpy(text[at:], disallowed_special=()))
        return np.concatenate(out).astype(np.int64)

    def second_ids(self, text: str) -> np.ndarray | None:
        """Ids of the second tokenizer for a text that follows a letter; None if they do not part."""
        ids = np.array(self.model.encode("x" + text), np.int64)
        # The letter put before and the space that the model puts before it are a piece.
        return ids[1:] if self.bytes_b[ids[0]] == 2 else None

    def joined_b(self, ids: np.ndarray) -> bytes:
        return self.flat_b[T.spread(self.begin_b[ids], self.bytes_b[ids])].tobytes()

    def learn(self, words: list[bytes]) -> None:
        """Encode new segments in one call, or if that is not exact by halves."""
        raw = b"".join(words)
        stops = np.cumsum([len(w) for w in words])
        b = self.second_ids(raw.decode())
        if b is not None and self.joined_b(b) == raw:
            a = self.first_ids(raw.decode())
            if np.isin(stops, np.cumsum(self.bytes_a[a])).all() and np.isin(
                    stops, np.cumsum(self.bytes_b[b])).all():
                self.add(stops, a, b)
                return
        if len(words) > 1:
            half = len(words) // 2
            self.learn(words[:half])
            self.learn(words[half:])
        else:
            none = np.zeros(0, np.int64)
            self.add(stops, none, none, bad=True)

    def add(self, stops: np.ndarray, a: np.ndarray, b: np.ndarray, bad: bool = False) -> None:
        """Note the ids of segments that end at ``stops``."""
        end_a, end_b = np.cumsum(self.bytes_a[a]), np.cumsum(self.bytes_b[b])
        # Between two neighbouring ends of either side lies exactly one pair of tokens.
        ends = np.union1d(end_a, end_b)
        of_a, of_b = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
        links = (b[of_b] << 16 | a[of_a]).astype(np.uint32) if len(ends) else np.zeros(0, np.uint32)
        shared = np.intersect1d(end_a, end_b, assume_unique=True)
        before_a = np.r_[0, np.searchsorted(end_a, shared, "right")]
        before_b = np.r_[0, np.searchsorted(end_b, shared, "right")]
        items = np.zeros(len(a) + len(b), np.int32)
        group_a, group_b = np.searchsorted(shared, end_a), np.searchsorted(shared, end_b)
        items[np.arange(len(a)) + before_b[group_a]] = a * 4 + np.isin(end_a, shared)
        items[np.arange(len(b)) + before_a[group_b + 1]] = (
            b * 4 + 2 * np.isin(end_b, shared))
        each = np.stack([np.diff(np.searchsorted(e, stops, "right"), prepend=0)
                         for e in (end_a, end_b, shared, ends)], axis=1)
        self.fresh.append((each, items, links, np.full(len(stops), bad)))

    def slots(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Place of each segment in ``counts``."""
        code, keys = pd.factorize(T.span_hash(T.prefix(data, T.EXACT), start, end))
        first = np.zeros(len(keys), np.int64)
        first[code[::-1]] = np.arange(len(code))[::-1]
        new = self.memo.missing(keys)
        if not self.memo.slot:
            self.forget()
        if len(new):
            at = first[new]
            # A segment that ends with white space, or does not begin with it, is encoded alone.
            plain = OPENS[data[start[at]]] & solid(data)[end[at] - 1]
            raw = data.tobytes()
            order = np.r_[np.flatnonzero(plain), np.flatnonzero(~plain)]
            words = [raw[a:b] for a, b in zip(start[at[order]].tolist(), end[at[order]].tolist(),
                                              strict=True)]
            joined = int(plain.sum())
            if joined:
                self.learn(words[:joined])
            for word in words[joined:]:
                self.learn([word])
            self.memo.add(keys[new[order]])
            self.memo.held += sum(len(w) for w in words)
            self.counts, self.items, self.links, self.bad = (
                np.concatenate([old, *new]) for old, new in zip(
                    (self.counts, self.items, self.links, self.bad),
                    zip(*self.fresh, strict=True), strict=True))
            self.fresh = []
            size = self.counts[:, 0] + self.counts[:, 1]
            self.item_at = np.cumsum(size) - size
            self.link_at = np.cumsum(self.counts[:, 3]) - self.counts[:, 3]
        return self.memo.slots(keys)[code]


def _digits() -> tuple[np.ndarray, np.ndarray]:
    """Decimal letters of each id, to the left, and how many it has."""
    size = np.array([len(str(i)) for i in range(IDS)])
    table = np.zeros((IDS, 6), np.uint8)
    for i in range(IDS):
        table[i, :size[i]] = np.frombuffer(str(i).encode(), np.uint8)
    return table, size


DIGITS, SIZES = _digits()


def written(items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text of the items (id and what stands after it) as bytes, and the end of each."""
    ids = items >> 2
    size = SIZES[ids]
    table = DIGITS[ids]
    table[np.arange(len(ids)), size] = np.frombuffer(SEPARATORS, np.uint8)[items & 3]
    return table[np.arange(6) <= size[:, None]], np.cumsum(size + 1)


# --- runs ------------------------------------------------------------------------------


def _packed(column: np.ndarray) -> bytes:
    """Byte planes one after the other, which compress well."""
    return column.view(np.uint8).reshape(len(column), -1).T.tobytes()


def blocks_of(columns: list[np.ndarray]) -> list[bytes]:
    """Blocks of sorted records; the first column, uint32, is kept as differences."""
    out, zip_ = [], zstandard.ZstdCompressor(level=1)
    for low in range(0, len(columns[0]), BLOCK):
        part = [c[low:low + BLOCK] for c in columns]
        part[0] = np.diff(part[0], prepend=part[0].dtype.type(0))
        out.append(len(part[0]).to_bytes(4, "little") + zip_.compress(b"".join(map(_packed, part))))
    return out


def read_blocks(blocks: list[bytes], kinds: list[str]) -> Iterator[list[np.ndarray]]:
    unzip = zstandard.ZstdDecompressor()
    for block in blocks:
        n, raw, at, out = int.from_bytes(block[:4], "little"), unzip.decompress(block[4:]), 0, []
        for kind in map(np.dtype, kinds):
            size = n * kind.itemsize
            out.append(np.frombuffer(raw, np.uint8, size, at).reshape(kind.itemsize, n).T.copy()
                       .view(kind).ravel())
            at += size
        out[0] = np.cumsum(out[0], dtype=out[0].dtype)
        yield out


def merged_counts(runs: list[Iterator[tuple[np.ndarray, np.ndarray]]]
                  ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted (code, sum of counts) of sorted runs, by a heap over their open blocks.

    The heap gives the least last code of all open blocks; up to it every run is known, so the
    records up to there are taken from each and summed. Each run has one block open at a time.
    """
    open_, heap = {}, []

    def advance(i: int) -> None:
        for code, n in runs[i]:
            if len(code):
                open_[i] = (code, n)
                heapq.heappush(heap, (int(code[-1]), i))
                return
        open_.pop(i, None)

    for i in range(len(runs)):
        advance(i)
    last, held = -1, 0
    while heap:
        bound = heap[0][0]
        codes, counts = [], []
        for i, (code, n) in list(open_.items()):
            cut = int(np.searchsorted(code, bound, "right"))
            if cut:
                codes.append(code[:cut])
                counts.append(n[:cut])
                open_[i] = (code[cut:], n[cut:])
        done = []
        while heap and heap[0][0] <= bound:
            done.append(heapq.heappop(heap)[1])
        for i in done:
            advance(i)
        code, n = np.concatenate(codes), np.concatenate(counts).astype(np.int64)
        by = np.argsort(code, kind="stable")
        first = np.flatnonzero(np.r_[True, np.diff(code[by]) != 0])
        code, n = code[by][first], np.add.reduceat(n[by], first)
        if last == code[0]:  # the code goes on in a run's next block
            n[0] += held
        elif last >= 0:
            code, n = np.r_[code.dtype.type(last), code], np.r_[held, n]
        last, held = int(code[-1]), int(n[-1])
        yield code[:-1], n[:-1]
    if last >= 0:
        yield np.array([last], np.uint32), np.array([held])


def with_best(counts: Iterator[tuple[np.ndarray, np.ndarray]]
              ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Sorted counts with 1 for those that are the highest of their second-side id, once that id
    is complete."""
    code, n = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def told(code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        side = code >> np.uint32(16)
        first = np.flatnonzero(np.r_[True, side[1:] != side[:-1]])
        size = np.diff(np.r_[first, len(code)])
        return code, n, (n == np.repeat(np.maximum.reduceat(n, first), size)).astype(np.uint8)

    for more, m in counts:
        code, n = np.r_[code, more], np.r_[n, m]
        done = int(np.searchsorted(code, code[-1] >> np.uint32(16) << np.uint32(16))) if len(
            code) else 0
        if done:
            yield told(code[:done], n[:done])
            code, n = code[done:], n[done:]
    if len(code):
        yield told(code, n)


class Dealer:
    """Ranks of second-side ids: scattered, so that each radix is a range of ranks."""

    def __init__(self, radixes: int) -> None:
        self.radixes = radixes
        self.rank = np.empty(IDS, np.uint32)
        self.rank[np.argsort(T.mix(np.arange(IDS, dtype=np.uint64)))] = np.arange(IDS)
        self.id = np.argsort(self.rank)
        self.edge = -(-np.arange(radixes + 1, dtype=np.int64) * IDS // radixes) << 16

    def ranked(self, links: np.ndarray) -> np.ndarray:
        return self.rank[links >> 16] << np.uint32(16) | links & np.uint32(IDS - 1)


class Spill:
    """Links of a task: sorted, counted by document and cut into runs when there are many."""

    def __init__(self, dealer: Dealer) -> None:
        self.dealer, self.links, self.rows, self.many = dealer, [], [], 0

    def add(self, links: np.ndarray, row: np.ndarray) -> None:
        self.links.append(links)
        self.rows.append(row)
        self.many += len(links)

    def runs(self) -> Iterator[tuple[int, int, int, list[bytes]]]:
        """(radix, least row, records, blocks)."""
        if not self.many:
            return
        row = np.concatenate(self.rows)
        code = self.dealer.ranked(np.concatenate(self.links)).astype(np.uint64)
        base = int(row.min())
        key = np.sort(code << np.uint64(32) | (row - base).astype(np.uint64))
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        n = np.diff(np.r_[first, len(key)]).astype(np.uint32)
        key = key[first]
        code, row = (key >> np.uint64(32)).astype(np.uint32), key.astype(np.uint32)
        cuts = np.searchsorted(code, self.dealer.edge)
        for r in np.flatnonzero(np.diff(cuts)).tolist():
            some = slice(cuts[r], cuts[r + 1])
            yield r, base, int(cuts[r + 1] - cuts[r]), blocks_of([code[some], n[some], row[some]])
        self.links, self.rows, self.many = [], [], 0


RUN_KINDS = ["u4", "u4", "u4"]
LINE = "row_id long, doc_id long, n_a long, n_b long, n_groups long, n_links long"
RUN = "radix int, base long, records long, blocks array<binary>"


class Line:
    """Totals of one text; a long one adds its parts."""

    def __init__(self, digest: bool) -> None:
        self.totals = np.zeros(4, np.int64)
        self.text = hashlib.sha256() if digest else []
        self.open = False

    def add(self, totals: np.ndarray, text: bytes) -> None:
        self.totals += totals
        if text:
            put = self.text.append if isinstance(self.text, list) else self.text.update
            if self.open:
                put(b";")
            put(text[:-1])
            self.open = True

    def groups(self) -> str:
        if not self.open:
            return ""
        return self.text.hexdigest() if not isinstance(self.text, list) else b"".join(
            self.text).decode()


def encoded(documents: DataFrame, path_a: str, path_b: str, radixes: int, digest: bool
            ) -> DataFrame:
    """One row for each document (``doc_id`` and totals) or run (``radix`` and blocks)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, spill = Encoders.load(path_a, path_b), Spill(Dealer(radixes))
        next_row = TaskContext.get().partitionId() << 40
        names = [f.split()[0] for f in f"{LINE}, groups string, {RUN}".split(", ")]

        def out(lines: list, runs: list) -> pa.RecordBatch:
            kinds = [pa.int64()] * 6 + [pa.string(), pa.int32(), pa.int64(), pa.int64(),
                                        pa.list_(pa.binary())]
            rows = [(*x, None, None, None, None) for x in lines] + [
                (None,) * 7 + x for x in runs]
            return pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)

        def spaced(data: np.ndarray, bounds: np.ndarray, opens: bool
                   ) -> tuple[np.ndarray, np.ndarray]:
            """Each text that begins here with a space before it; a text of no bytes has none."""
            full = np.diff(bounds) > 0
            if not opens:
                return data, bounds
            return (np.insert(data, bounds[:-1][full], 0x20),
                    bounds + np.r_[0, np.cumsum(full)])

        def whole(array: pa.Array) -> Iterator[tuple]:
            """Segments of the parts, with the texts that do not come back whole left empty."""
            checked, refused = -1, False
            for rows, data, bounds, opens, closes in T.parts(array, OPENS, GRAPHIC):
                data, bounds = spaced(data, bounds, opens)
                start, end, text = segments(data, bounds)
                if not (opens and closes) and rows[0] != checked:
                    # A text in parts: look at all of them before any record leaves.
                    checked = int(rows[0])
                    refused = False
                    for _, d, b, o, _ in T.parts(array.slice(checked, 1), OPENS, GRAPHIC):
                        d, b = spaced(d, b, o)
                        some = coder.slots(d, *segments(d, b)[:2])
                        refused = refused or bool(coder.bad[some].any())
                slots = coder.slots(data, start, end)
                bad = np.zeros(len(rows), bool)
                bad[text[coder.bad[slots]]] = True
                if not (opens and closes):
                    bad[:] = refused
                keep = ~bad[text]
                yield rows, slots[keep], text[keep], opens, closes

        for batch in pieces(batches):
            ids, line = batch.column(0).to_pylist(), Line(digest)
            for rows, slots, text, opens, closes in whole(batch.column(1)):
                counts = coder.counts[slots]
                sums = np.r_[np.zeros((1, 4), np.int64), np.cumsum(counts, axis=0)]
                totals = np.diff(sums[np.searchsorted(text, np.arange(len(rows) + 1))], axis=0)
                size = counts[:, 0] + counts[:, 1]
                raw, ends = written(coder.items[T.spread(coder.item_at[slots], size)])
                cuts = np.r_[0, np.r_[0, ends][np.cumsum(totals[:, 0] + totals[:, 1])]]
                raw = raw.tobytes()
                spill.add(coder.links[T.spread(coder.link_at[slots], counts[:, 3])],
                          np.repeat(next_row + text, counts[:, 3]))
                lines = []
                for k in range(len(rows)):
                    if opens:
                        line = Line(digest)
                    line.add(totals[k], raw[cuts[k]:cuts[k + 1]])
                    if closes:
                        lines.append((next_row, ids[rows[k]], *line.totals.tolist(),
                                      line.groups()))
                        next_row += 1
                runs = list(spill.runs()) if spill.many >= HELD else []
                if lines or runs:
                    yield out(lines, runs)
        if runs := list(spill.runs()):
            yield out([], runs)

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, f"{LINE}, groups string, {RUN}")


def pair_counts(runs: DataFrame, salts: int) -> DataFrame:
    """(radix, pairs, blocks) from runs (radix, salt, blocks) with at most ``salts`` salts: the sorted
    pairs of a radix with their counts, and marks of the best of each id.

    A radix holds the pairs of its ids of the second side, 2**16 at most for each.
    """
    def merge(group: pa.Table, kinds: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        return merged_counts([((x[0], x[1]) for x in read_blocks(b, kinds))
                              for b in group["blocks"].to_pylist()])

    def summed(group: pa.Table, kinds: list[str]) -> pa.Table:
        code, n = (np.concatenate(x) for x in zip(*merge(group, kinds), strict=True))
        return pa.table({"radix": group["radix"][:1], "salt": group["salt"][:1],
                         "blocks": pa.array([blocks_of([code, n])], pa.list_(pa.binary()))})

    def count(group: pa.Table) -> pa.Table:
        return summed(group, RUN_KINDS)

    def again(group: pa.Table) -> pa.Table:
        return summed(group, ["u4", "i8"])

    def best(group: pa.Table) -> pa.Table:
        parts = list(with_best(merge(group, ["u4", "i8"])))
        code, n, top = (np.concatenate(x) for x in zip(*parts, strict=True))
        return pa.table({"radix": group["radix"][:1], "pairs": pa.array([len(code)], pa.int64()),
                         "blocks": pa.array([blocks_of([code, n, top])], pa.list_(pa.binary()))})

    partial = runs.groupBy("radix", "salt").applyInArrow(
        count, "radix int, salt int, blocks array<binary>")
    while salts > FAN:  # merge by merge, so that no task gets more than FAN runs of counts
        salts = -(-salts // FAN)
        partial = partial.withColumn("salt", F.floor(F.col("salt") / FAN).cast("int")).groupBy(
            "radix", "salt").applyInArrow(again, "radix int, salt int, blocks array<binary>")
    return partial.groupBy("radix").applyInArrow(
        best, "radix int, pairs long, blocks array<binary>")


def shares(runs: DataFrame, counts: DataFrame) -> DataFrame:
    """(row_id, n_best, count_sum) of the documents, from the counts of each run's radix.

    A run sends one row back; the runs of one spill, which hold the same documents, are added up
    together.
    """
    kinds = ["u4", "i8", "i8"]

    def added(row: np.ndarray, values: list[np.ndarray]) -> list[np.ndarray]:
        by = np.argsort(row, kind="stable")
        first = np.flatnonzero(np.r_[True, np.diff(row[by]) != 0])
        return [row[by][first], *(np.add.reduceat(v[by], first) for v in values)]

    def back(run: pa.Table, known: pa.Table) -> pa.Table:
        columns = list(zip(*read_blocks(known["blocks"][0].as_py(), ["u4", "i8", "u1"]),
                           strict=True))
        code, n, top = (np.concatenate(c) for c in columns)
        out = []
        for blocks in run["blocks"].to_pylist():  # none, if the salt has no run
            parts = [np.concatenate(c) for c in zip(*read_blocks(blocks, RUN_KINDS), strict=True)]
            at, links = np.searchsorted(code, parts[0]), parts[1].astype(np.int64)
            out.append(blocks_of(added(parts[2], [links * top[at], links * n[at]])))
        return pa.table({"base": run["base"], "blocks": pa.array(out, pa.list_(pa.binary()))})

    def summed(group: pa.Table) -> pa.Table:
        parts = [p for blocks in group["blocks"].to_pylist() for p in read_blocks(blocks, kinds)]
        row, top, total = (np.concatenate(c) for c in zip(*parts, strict=True))
        row, top, total = added(row, [top, total])
        return pa.table({"row_id": group["base"][0].as_py() + row.astype(np.int64),
                         "n_best": top, "count_sum": total})

    sent = runs.groupBy("radix", "salt").cogroup(counts.groupBy("radix", "salt")).applyInArrow(
        back, "base long, blocks array<binary>")
    return sent.groupBy("base").applyInArrow(summed, "row_id long, n_best long, count_sum long")


def align(documents: DataFrame, path_a: str, path_b: str, digests_only: bool = False,
          radix_text: int = RADIX_TEXT, merged: int = MERGED) -> DataFrame:
    """Both tokenizers' ids of every whole text of ``documents`` (doc_id, text), aligned by bytes.

    ``path_a`` is a byte-level BPE file, which gets the text after a space; ``path_b`` is a piece
    model, which adds that space itself. Rows: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    and ``groups``, the ids between common token ends as ``a1,a2|b1;a3|b2``; with ``digests_only``
    its SHA-256 in ``groups_sha256`` instead. ``n_best`` counts the links whose pair is the most
    frequent of its second id in the corpus, ties included; ``count_sum`` adds up the pairs' counts.
    A text that is null or empty, or that a tokenizer does not give back (as with U+2581), has zeros
    and an empty text; a null doc_id stays null; repeated rows count each; other columns are not
    read; an empty table gives no rows. Long texts are read in parts between segments.
    """
    spark = documents.sparkSession
    size = documents.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    radixes = int(min(RADIXES, max(1, -(-size // radix_text))))
    rows = kept(encoded(documents, path_a, path_b, radixes, digests_only), "alignment")
    lines = rows.where("radix is null").select(
        "row_id", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups")
    runs = rows.where("radix is not null").select("radix", "base", "records", "blocks")
    salts = runs.groupBy("radix").agg(
        F.ceil(F.sum("records") / merged).cast("int").alias("salts"))
    most = salts.agg(F.max("salts")).first()[0] or 1
    # At most RADIXES rows.
    salted = runs.join(F.broadcast(salts), "radix").select(
        "radix", "base", "blocks", F.pmod(F.xxhash64("base"), F.col("salts")).cast("int").alias("salt"))
    counts = kept(pair_counts(salted, most), "alignment-counts")
    dealt = counts.join(F.broadcast(salts), "radix").select(
        "radix", "blocks", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    back = shares(salted, dealt).groupBy("row_id").agg(
        F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = F.lit(0).cast("long")
    return lines.join(back, "row_id", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"),
        F.col("groups").alias("groups_sha256" if digests_only else "groups"))
