"""Toxicity: a linear-chain conditional random field tags toxic spans token by token.

The labels are of documents, so tokens are labelled first: in the training sample a word, or a
word beginning, is evidence if it occurs in enough toxic documents and hardly in clean ones;
tokens of toxic documents with such evidence are labelled toxic. The field is fitted to these
labelled tokens with hashed features of a word, its beginnings and end, and its neighbours'
beginnings. Forward-backward marginals give every token's probability. A document's score is a
calibrated function of the probability that at least one token is toxic; spans are the runs of
tokens at or above one half.

The fit reads a bounded sample of labelled rows (``SAMPLE`` documents and ``SAMPLE_BYTES`` bytes of
text per label, those of smallest hashed id) and uses every token of it, slice by slice; scoring reads
every whole text, and the fitted weights are of fixed size. Wording seen fewer than about 20 times in
2500 toxic documents (``EVIDENCE_SHARE``) is no evidence.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm import crf
from plumbline.llm import text as T
from plumbline.llm.tables import kept, pieces, remainder, result_schema, texts_of

#: Training documents per label, and bytes of their texts. A text over a 32nd of the bytes is not
#: taken for training.
SAMPLE, SAMPLE_BYTES = 2500, 16 << 20
#: Weights of the hashed features: bounds what is sent to the workers.
WEIGHTS = 1 << 18
#: Bytes of word beginnings and of the end that are features.
BEGINNINGS, ENDING = (4, 5, 7), 4
#: Evidence: occurrences in toxic documents at least, their least number per toxic document, and
#: how many times the number per clean document it must exceed.
EVIDENCE_DOCS, EVIDENCE_SHARE, EVIDENCE_RATIO = 3, 0.008, 40.0
STEPS, RATE, DECAY = 70, 0.15, 1e-7


@dataclass
class Model:
    weights: np.ndarray
    transitions: np.ndarray
    slope: float
    intercept: float


def token_parts(data: np.ndarray, bounds: np.ndarray
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text of each token, and its hashes: word, beginnings, end (one per row)."""
    start, end, text = T.words(data, bounds, T.ALNUM)
    sums = T.prefix(data, T.FOLDED)
    hashes = [T.span_hash(sums, start, end)]
    hashes += [T.span_hash(sums, start, np.minimum(start + n, end)) for n in BEGINNINGS]
    hashes.append(T.span_hash(sums, np.maximum(end - ENDING, start), end))
    return start, end, text, np.array(hashes, np.uint64).reshape(len(hashes), len(start))


def slots(hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Feature numbers of each token: its own hashes, one of each neighbour's, and a constant."""
    def neighbour(row: np.ndarray, by: int) -> np.ndarray:
        out = np.zeros_like(row)
        if by < 0:
            out[1:] = np.where(text[1:] == text[:-1], row[:-1], np.uint64(0))
        else:
            out[:-1] = np.where(text[1:] == text[:-1], row[1:], np.uint64(0))
        return out

    rows = [*hashes, neighbour(hashes[2], -1), neighbour(hashes[2], 1), np.zeros_like(hashes[0])]
    kind = np.arange(1, len(rows) + 1, dtype=np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)
    return (T.mix(np.array(rows).reshape(len(rows), -1) ^ kind) % np.uint64(WEIGHTS)
            ).astype(np.int32)


def evidence(rows: Iterable[np.ndarray], text: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """True for tokens of toxic documents whose word or a beginning marks toxic documents.

    ``rows`` gives the hashes of all tokens, of the words first and then of their beginnings.
    Occurrences between the same neighbours count once, so that copies of a document do not make
    its words evidence.
    """
    found, context = np.zeros(len(text), bool), None
    of = toxic[text].astype(bool)
    n_toxic, n_clean = max(1, int(toxic.sum())), max(1, int((1 - toxic).sum()))
    least = max(EVIDENCE_DOCS, EVIDENCE_SHARE * n_toxic)

    def occurrences(row: np.ndarray, at: np.ndarray, codes: np.ndarray, size: int) -> np.ndarray:
        _, first = np.unique(T.mix(row[at] ^ context[at]), return_index=True)
        return np.bincount(codes[first], minlength=size)

    for row in rows:
        if context is None:
            context = np.zeros_like(row)
            context[1:] += T.mix(row[:-1])
            context[:-1] += row[1:]
            context = T.mix(context)
        at = np.flatnonzero(of)
        keys, codes = np.unique(row[at], return_inverse=True)
        often = occurrences(row, at, codes, len(keys))
        keys, seen = keys[often >= least], often[often >= least]
        if not len(keys):
            continue
        known = np.minimum(np.searchsorted(keys, row), len(keys) - 1).astype(np.int32)
        among = keys[known] == row
        other = np.flatnonzero(among & ~of)
        clean = occurrences(row, other, known[other], len(keys))
        marks = seen / n_toxic > EVIDENCE_RATIO * (clean + 0.05) / n_clean
        found |= marks[known] & among & of
    return found


def summary(p: np.ndarray, text: np.ndarray, rows: int) -> np.ndarray:
    """Log odds that a document has a toxic token, from its tokens' marginals; bounded."""
    none = np.bincount(text, weights=np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=rows)
    some = -np.expm1(none)
    return np.clip(np.log(np.maximum(some, 1e-9)) - none, -20.0, 20.0)


def token_marginals(weights: np.ndarray, transitions: np.ndarray, features: np.ndarray,
                    text: np.ndarray, rows: int) -> np.ndarray:
    scores = weights[features].sum(0).astype(float)
    return crf.marginals(scores, np.bincount(text, minlength=rows), transitions)[0]


def training_sample(documents: DataFrame, labels: DataFrame, label: str, size: int, by: int,
                    out: int, most: int = SAMPLE_BYTES) -> DataFrame:
    """At most ``size`` labelled documents and ``most`` bytes of text of each label outside the
    held-out fold.

    Rows: doc_id, text, label. Those of smallest hashed id are taken, among the documents that
    have text rows; the choice moves ids only, and the chosen ids, bounded by ``size``, are joined
    with the texts where those are read. Of these, texts over a 32nd of ``most`` and what comes after
    ``most`` bytes are left out. Labels other than 0 and 1 are not used, null text counts
    as empty, and of repeated rows of a document the smallest text is taken.
    """
    ids = documents.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long"))
    marks = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long"), F.col(label).cast("int")).where(
        remainder(F.col("doc_id"), by) != out).distinct()
    known = marks.join(ids, "doc_id", "left_semi")
    chosen = [known.where(F.col(label) == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)
              for value in (0, 1)]
    texts = documents.select(F.col("doc_id").cast("long"),
                             F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    sample = kept(texts.join(F.broadcast(chosen[0].unionAll(chosen[1])), "doc_id").groupBy(
        "doc_id", label).agg(F.min("text").alias("text")), "sample")
    length = F.octet_length("text").cast("long")
    order = Window.partitionBy(label).orderBy(F.xxhash64("doc_id"), "doc_id")
    fitting = sample.where(length <= most // 32).select("doc_id", label, length.alias("length")).select(
        "doc_id", label, F.sum("length").over(order).alias("total")).where(F.col("total") <= most)
    return sample.join(F.broadcast(fitting.drop("total")), ["doc_id", label]).select(
        "doc_id", label, "text").orderBy("doc_id", label)


def fit(labelled: DataFrame) -> Model:
    """A model from a bounded sample of rows (text, toxic) with labels 0 and 1.

    Without rows of both labels every score is the share of toxic rows (0.5 without rows).
    """
    rows = labelled.select("text", "toxic").toArrow()
    first = {text: i for i, text in reversed(list(enumerate(rows["text"].to_pylist())))}
    rows = rows.take(pa.array(sorted(first.values()), pa.int64()))  # copies say nothing new
    toxic = rows["toxic"].to_numpy().astype(np.int64)
    if not len(toxic) or toxic.min() == toxic.max():
        share = float(toxic.mean()) if len(toxic) else 0.5
        side = np.clip(share, 1e-3, 1 - 1e-3)
        return Model(np.zeros(WEIGHTS, np.float32), np.zeros((2, 2)), 0.0,
                     float(np.log(side / (1 - side))))
    # Hashes are made anew for each look at them: kept for all tokens they fill more than the features.
    def column(i: int) -> np.ndarray:
        return np.concatenate([token_parts(data, bounds)[3][i]
                               for _, _, data, bounds in T.slices(rows["text"])])

    text = np.concatenate([(token_parts(data, bounds)[2] + first).astype(np.int32)
                           for first, _, data, bounds in T.slices(rows["text"])])
    marked = evidence((column(i) for i in range(1 + len(BEGINNINGS))), text, toxic).astype(np.int8)
    del text
    slices, parts, at = [], [], 0
    for first, end, data, bounds in T.slices(rows["text"]):
        _, _, own, hashes = token_parts(data, bounds)
        features = slots(hashes, own)
        slices.append((first, end, own.astype(np.int32), features))
        parts.append(crf.Part(
            lambda w, f=features: w[f].sum(0),
            lambda d, f=features: np.bincount(f.ravel(), weights=np.tile(d, len(f)),
                                              minlength=WEIGHTS),
            np.bincount(own, minlength=end - first), marked[at:at + len(own)]))
        at += len(own)
    weights, transitions = crf.fit_parts(WEIGHTS, parts, STEPS, RATE, DECAY)
    weights = weights.astype(np.float32)
    x = np.concatenate([
        summary(token_marginals(weights, transitions, f, own, end - first), own, end - first)
        for first, end, own, f in slices])
    return Model(weights, transitions, *crf.calibrate(x, toxic, np.ones(len(x))))


SCHEMA = ("doc_id long, score double, predicted int, "
          "spans array<struct<start:long,end:long,score:double>>")


def score(documents: DataFrame, model: Model, carry: bool = False) -> DataFrame:
    """Toxicity of every whole text of ``documents`` (doc_id, text).

    Rows: doc_id, score (0 to 1), predicted (1 from 0.5 on) and spans: code points [start, end)
    of runs of toxic tokens with their highest marginal. A null text counts as empty; a text
    without tokens has the score of one without toxic tokens; a null doc_id stays null; repeated
    rows are scored each; other columns are not read unless ``carry``
    puts the whole row into the struct ``row``; an empty table gives no rows.
    """
    rows_in = texts_of(documents, carry)
    sent = documents.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()),
                               ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in pieces(batches):
            for first, stop, data, bounds in T.slices(batch.column(1)):
                rows = stop - first
                start, end, text, hashes = token_parts(data, bounds)
                p = token_marginals(known.weights, known.transitions, slots(hashes, text), text,
                                    rows)
                x = known.slope * summary(p, text, rows) + known.intercept
                result = 1 / (1 + np.exp(-np.clip(x, -crf.BOUND, crf.BOUND)))
                hot = np.flatnonzero(p >= 0.5)
                offsets, values = np.zeros(rows + 1, np.int64), pa.array([], kind.value_type)
                if len(hot):
                    opens = np.r_[True, (np.diff(hot) > 1) | (np.diff(text[hot]) != 0)]
                    head = np.flatnonzero(opens)
                    tail = np.r_[head[1:], len(hot)] - 1
                    owner = text[hot[head]]
                    points = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
                    base = points[bounds[owner]]
                    values = pa.StructArray.from_arrays(
                        [pa.array(points[start[hot[head]]] - base),
                         pa.array(points[end[hot[tail]]] - base),
                         pa.array(np.maximum.reduceat(p[hot], head))], fields=list(kind.value_type))
                    offsets = np.searchsorted(owner, np.arange(rows + 1))
                columns = [batch.column(0).slice(first, rows), pa.array(result),
                     pa.array((result >= 0.5).astype(np.int32)),
                     pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)]
                names = ["doc_id", "score", "predicted", "spans"]
                if carry:
                    columns.append(batch.column(2).slice(first, rows))
                    names.append("row")
                yield pa.RecordBatch.from_arrays(columns, names)

    return rows_in.mapInArrow(run, result_schema(rows_in, SCHEMA))


def classify(documents: DataFrame, labels: DataFrame, size: int = SAMPLE, by: int = 5,
             out: int = 0, carry: bool = False) -> DataFrame:
    """Scores of all ``documents``, learned outside the fold crc32(doc_id) mod ``by`` = ``out``."""
    model = fit(training_sample(documents, labels, "toxic", size, by, out))
    return score(documents, model, carry).withColumn(
        "held_out", remainder(F.col("doc_id"), by) == out)
