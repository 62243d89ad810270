"""Language-model scores from a log-frequency Bloom filter of bigram counts.

The training texts are counted whole. Each count c of a bigram is quantised to
q = 1 + floor(log_b c), and the pairs (bigram, 1) ... (bigram, q) are put into a Bloom filter; a
count is read back by probing j = 1, 2, ... until a pair is missing. The filter is cut into
blocks of equal size, a bigram's bits all lie in one block, and each block is made by one task
from the bigrams dealt to it: their expected number is a parameter, so the number of blocks grows
with the training tokens and the work of a task does not.

Word counts are exact (they fix the base score) and sit in sorted arrays. Filter blocks and word
arrays are broadcast as files of at most ``PART_BYTES`` each: more data make more files, not larger
ones. A file passes the driver alone, executors fetch it once, and their workers share it as
mapped memory, so that a worker's own memory does not grow with the model.

The score of a text is the sum over its tokens of log10 of the Witten-Bell interpolation of the
bigram's estimate with the base probability of the word.
"""

from __future__ import annotations

import math
import os
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import text as T
from plumbline.llm.tables import kept, pieces, remainder

#: Training tokens per filter block: an upper bound of its expected bigrams.
BLOCK_TOKENS = 1 << 20
#: Probes per entry, and how often a bigram that was never counted may be found: its bound, which a
#: filter reaches if no bigram repeats. Repeated ones make fewer entries than tokens.
PROBES, FALSE_POSITIVES = 4, 0.01
#: Bits of the filter per training token that keep the bound, 10.5. A count has no more steps than
#: occurrences, so the entries of a filter are at most its tokens.
BITS_PER_TOKEN = -PROBES / math.log(1 - FALSE_POSITIVES ** (1 / PROBES))
#: Base of the quantised counts.
LOG_BASE = 1.5
#: Largest broadcast.
PART_BYTES = 64 << 20
#: Hashes of the end of a text as a word, and of what comes before its first word.
END, BEGIN = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)


def quantise(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(counts) / math.log(LOG_BASE) + 1e-9).astype(np.int64)


def estimate(steps: np.ndarray) -> np.ndarray:
    """The middle of the counts that a step stands for; 0 for step 0."""
    low = np.ceil(LOG_BASE ** (np.maximum(steps, 1) - 1.0) - 1e-9)
    high = np.maximum(low, np.ceil(LOG_BASE ** np.maximum(steps, 1.0) - 1e-9) - 1)
    return np.where(steps > 0, (low + high) / 2, 0.0)


def sequence(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word before, word, and text number of every token of a slice, ends included."""
    hashes, text = T.word_hashes(data, bounds, T.SPACED, T.FOLDED)
    rows = len(bounds) - 1
    at = np.searchsorted(text, np.arange(rows), "right")
    word = np.insert(hashes, at, END)
    owner = np.insert(text, at, np.arange(rows))
    before = np.empty_like(word)
    before[1:] = word[:-1]
    before[np.r_[0, np.flatnonzero(owner[1:] != owner[:-1]) + 1]] = BEGIN
    return before, word, owner


def joint(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return T.mix(before * np.uint64(0x9E3779B97F4A7C15) + word)


def probe_bits(pair: np.ndarray, step: np.ndarray | int, block_bits: int) -> list[np.ndarray]:
    """Places of (pair, step) within its block, one array for each probe."""
    a = T.mix(pair + np.uint64(0xD1B54A32D192ED03) * np.asarray(step).astype(np.uint64))
    b = T.mix(a) | np.uint64(1)
    return [((a + np.uint64(i) * b) % np.uint64(block_bits)).astype(np.int64)
            for i in range(PROBES)]


def tokens_in(texts: DataFrame) -> int:
    """Tokens of all texts, ends included."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in pieces(batches):
            for _, _, data, bounds in T.slices(batch.column(0)):
                total += len(T.words(data, bounds, T.SPACED)[0]) + len(bounds) - 1
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.int64())], ["n"])

    return texts.mapInArrow(run, "n long").agg(F.sum("n").alias("n")).first().n or 0


#: Bigrams that a counting task holds. It sums them when they are so many, and hands them on only if
#: more than half are left: a bigram leaves a task once for at least HELD tokens.
HELD = 1 << 21


def bigram_counts(texts: DataFrame, blocks: int) -> DataFrame:
    """Bigrams of a task's texts with their counts, packed for each filter block."""
    def packed(before: np.ndarray, word: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
        block = (joint(before, word) >> np.uint64(20)) % np.uint64(blocks)
        order = np.lexsort((before, block))  # equal words before stand together and compress well
        before, word, count, block = before[order], word[order], count[order], block[order]
        edges = np.r_[0, np.flatnonzero(np.diff(block)) + 1, len(block)]
        blobs = [pa.compress(before[a:b].tobytes() + word[a:b].tobytes()
                             + count[a:b].astype("<i8").tobytes(), "zstd", asbytes=True)
                 for a, b in zip(edges[:-1], edges[1:], strict=True)]
        return pa.RecordBatch.from_arrays(
            [pa.array(block[edges[:-1]].astype(np.int64)),
             pa.array(np.diff(edges).astype(np.int64)), pa.array(blobs, pa.binary())],
            ["block", "n", "data"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in pieces(batches):
            for _, _, data, bounds in T.slices(batch.column(0)):
                before, word, _ = sequence(data, bounds)
                parts.append((before, word, np.ones(len(word), np.int64)))
                held += len(word)
                if held >= HELD:
                    parts = [merged(parts)]
                    held = len(parts[0][0])
                    if held > HELD // 2:
                        yield packed(*parts[0])
                        parts, held = [], 0
        if parts:
            yield packed(*merged(parts))

    return texts.mapInArrow(run, "block long, n long, data binary")


def summed(before: np.ndarray, word: np.ndarray, count: np.ndarray) -> tuple:
    """Each bigram once, with the sum of its counts."""
    codes, _ = pd.factorize(joint(before, word))
    first = np.zeros(int(codes.max()) + 1 if len(codes) else 0, np.int64)
    first[codes[::-1]] = np.arange(len(codes))[::-1]
    total = np.bincount(codes, weights=count).astype(np.int64)
    return before[first], word[first], total


def merged(parts: list[tuple]) -> tuple:
    """The parts' bigrams, each once."""
    return summed(*(np.concatenate(x) for x in zip(*parts, strict=True)))


_OPEN: dict[str, np.ndarray] = {}


def send(spark: SparkSession, array: np.ndarray) -> str:
    """Broadcast an array as a file of the session; its name."""
    name = f"lm-{uuid.uuid4().hex}.npy"
    path = os.path.join(SparkFiles.getRootDirectory(), name)
    np.save(path, array)
    spark.sparkContext.addFile(path)
    return name


def sent(name: str) -> np.ndarray:
    """The array of a broadcast file, mapped and not read."""
    if name not in _OPEN:
        _OPEN[name] = np.load(SparkFiles.get(name), mmap_mode="r")
    return _OPEN[name]


class Model:
    """Word counts and filter of a training set, in broadcast parts."""

    def __init__(self, total: int, distinct: int, blocks: int, block_bytes: int,
                 word_parts: list, filter_parts: list, blocks_per_part: int) -> None:
        self.total, self.distinct = total, distinct
        self.blocks, self.block_bytes = blocks, block_bytes
        self.word_parts, self.filter_parts = word_parts, filter_parts
        self.blocks_per_part = blocks_per_part

    def words(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count of each word, and its number of different followers."""
        codes, keys = pd.factorize(hashes)
        count, follow = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        for part in self.word_parts:
            known, c, f = (sent(name) for name in part)
            at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            hit = known[at] == keys
            count[hit], follow[hit] = c[at[hit]], f[at[hit]]
        return count[codes], follow[codes]

    def steps(self, pair: np.ndarray) -> np.ndarray:
        """Quantised count of each bigram, by probing step after step."""
        block = ((pair >> np.uint64(20)) % np.uint64(self.blocks)).astype(np.int64)
        out = np.zeros(len(pair), np.int64)
        for number, part in enumerate(self.filter_parts):
            bits = sent(part)
            here = np.flatnonzero(block // self.blocks_per_part == number)
            base = (block[here] % self.blocks_per_part) * self.block_bytes
            step = 0
            while len(here):
                step += 1
                live = np.ones(len(here), bool)
                for place in probe_bits(pair[here], step, self.block_bytes * 8):
                    seen = bits[base + (place >> 3)] >> (place & 7).astype(np.uint8) & 1
                    live &= seen.astype(bool)
                here, base = here[live], base[live]
                out[here] = step
        return out


def narrow(counts: np.ndarray) -> np.ndarray:
    """The same counts in 4 bytes each, if the largest fits."""
    return counts.astype(np.uint32) if not len(counts) or counts.max() < 1 << 32 else counts


def learn(texts: DataFrame) -> Model | None:
    """Count every token of ``texts`` (one column text) and build the model; None without texts."""
    spark = texts.sparkSession
    total = tokens_in(texts)
    if not total:
        return None
    blocks = -(-total // BLOCK_TOKENS)
    block_bytes = max(64, math.ceil(min(total, BLOCK_TOKENS) * BITS_PER_TOKEN / 8))

    def build(table: pa.Table) -> pa.Table:
        parts, held, limit = [], 0, BLOCK_TOKENS
        for blob, n in zip(table["data"], table["n"].to_pylist(), strict=True):
            raw = pa.decompress(blob.as_buffer(), 24 * n, "zstd", asbytes=True)
            parts.append((np.frombuffer(raw, np.uint64, n), np.frombuffer(raw, np.uint64, n, 8 * n),
                          np.frombuffer(raw, "<i8", n, 16 * n)))
            held += n
            if held >= limit:  # partial sums: a bigram of every task is held a few times
                parts = [merged(parts)]
                held = len(parts[0][0])
                limit = max(BLOCK_TOKENS, 2 * held)
        before, word, count = merged(parts)
        bits = np.zeros(block_bytes * 8, bool)
        pair, left = joint(before, word), quantise(count)
        step = 0
        while len(pair):
            step += 1
            for place in probe_bits(pair, step, block_bytes * 8):
                bits[place] = True
            more = left > step
            pair, left = pair[more], left[more]
        # What the block knows of each word: its occurrences as last word, its followers as first.
        codes, keys = pd.factorize(np.r_[word, before])
        n = len(word)
        seen = np.bincount(codes[:n], weights=count, minlength=len(keys)).astype(np.int64)
        follow = np.bincount(codes[n:], minlength=len(keys)).astype(np.int64)
        rows = len(keys) + 1
        return pa.table({
            "block": pa.array(np.r_[table["block"][0].as_py(), np.full(rows - 1, -1)]),
            "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()]
                             + [None] * (rows - 1), pa.binary()),
            "word": pa.array(np.r_[np.int64(0), keys.view(np.int64)]),
            "seen": pa.array(np.r_[0, seen]), "follow": pa.array(np.r_[0, follow])})

    built = kept(bigram_counts(texts, blocks).groupBy("block").applyInArrow(
        build, "block long, bits binary, word long, seen long, follow long"), "lm")
    words = built.where("block < 0").groupBy("word").agg(
        F.sum("seen").alias("seen"), F.sum("follow").alias("follow"))
    words = kept(words, "lm-words")
    sizes = words.agg(F.count("*").alias("n"), F.sum(
        (F.col("seen") > 0).cast("long")).alias("v")).first()
    parts = -(-sizes.n * 16 // PART_BYTES)
    word_parts = []
    for number in range(parts):
        own = words.where(F.pmod(F.col("word"), F.lit(parts)) == number).select(
            "word", "seen", "follow").toArrow()
        known = own["word"].to_numpy().view(np.uint64)
        order = np.argsort(known)
        word_parts.append(tuple(send(spark, column) for column in (
            known[order], narrow(own["seen"].to_numpy()[order]),
            narrow(own["follow"].to_numpy()[order]))))
    per_part = max(1, PART_BYTES // block_bytes)
    filters = []
    made = built.where("block >= 0").select("block", "bits")
    for first in range(0, blocks, per_part):
        bits = np.zeros(min(per_part, blocks - first) * block_bytes, np.uint8)
        rows = made.where(F.col("block").between(first, first + per_part - 1)).toArrow()
        for block, data in zip(rows["block"].to_pylist(), rows["bits"], strict=True):
            at = (block - first) * block_bytes
            bits[at:at + block_bytes] = np.frombuffer(data.as_buffer(), np.uint8)
        filters.append(send(spark, bits))
    return Model(total, sizes.v, blocks, block_bytes, word_parts, filters, per_part)


SCHEMA = ("doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, "
          "score double")


def score(documents: DataFrame, model: Model | None) -> DataFrame:
    """Scores of every whole text of ``documents`` (doc_id, text).

    Rows: doc_id, n_tokens, n_known (tokens whose word occurs in the training texts),
    train_tokens, base_score (smoothed unigram log10 probability) and score (the model's log10
    probability). A null text counts as empty, which still has its end; a null doc_id stays null;
    repeated rows are scored each; other columns are not read; an empty table gives no rows.
    Without training texts every word counts 0 of 0 tokens: log10(0.5 / 0.5) = 0.
    """
    total, distinct = (model.total, model.distinct) if model else (0, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            for first, end, data, bounds in T.slices(batch.column(1)):
                rows = end - first
                before, word, owner = sequence(data, bounds)
                if model:
                    count, _ = model.words(word)
                    steps = model.steps(joint(before, word))
                    history, follow = model.words(before)
                else:
                    count = steps = history = follow = np.zeros(len(word), np.int64)
                base = (count + 0.5) / (total + 0.5 * (distinct + 1))
                if model:
                    # The begin mark is no word: each training text has it once, as its end.
                    starts = before == BEGIN
                    history = np.where(starts, model.words(np.array([END]))[0][0], history)
                found = np.minimum(estimate(steps), np.maximum(history, 0))
                found = np.where(follow > 0, found, 0.0)
                weight = np.where(history + follow > 0, history / np.maximum(history + follow, 1),
                                  0.0)
                weight = np.where(follow > 0, weight, 0.0)
                own = weight * found / np.maximum(history, 1) + (1 - weight) * base
                add = lambda x: np.bincount(owner, weights=x, minlength=rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, rows),
                     pa.array(np.bincount(owner, minlength=rows).astype(np.int64)),
                     pa.array(add(count > 0).astype(np.int64)),
                     pa.array(np.full(rows, total, np.int64)),
                     pa.array(add(np.log10(base))), pa.array(add(np.log10(own)))],
                    [f.strip().split(" ")[0] for f in SCHEMA.split(",")])

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")
                            ).mapInArrow(run, SCHEMA)


def score_held_out(documents: DataFrame, by: int = 5, out: int = 1) -> DataFrame:
    """Scores of all ``documents``, learned from those whose crc32(doc_id) mod ``by`` is not
    ``out``; ``held_out`` marks the others."""
    train = documents.where(remainder(F.col("doc_id"), by) != out).select(
        F.col("text").cast("string"))
    scored = score(documents, learn(train))
    return scored.withColumn("held_out", remainder(F.col("doc_id"), by) == out)
