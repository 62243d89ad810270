"""Classifiers, language model, license scan and pipeline."""

import itertools
import math
import random
import re
import textwrap
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from plumbline.llm import crf, language_model, licenses, quality, stages, toxicity

FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


@pytest.mark.parametrize("chunk", [2, 3, 32])
def test_marginals_equal_enumeration(chunk, monkeypatch):
    monkeypatch.setattr(crf, "CHUNK", chunk)
    draw = np.random.default_rng(0)
    lengths, t = np.array([1, 3, 5, 2, 7, 1]), draw.normal(size=(2, 2))
    e = draw.normal(size=lengths.sum()) * 2
    p, pairs = crf.marginals(e, lengths, t, pairs=True)
    at, expected, counts = 0, [], np.zeros((2, 2))
    for n in lengths:
        total, ones, both = 0.0, np.zeros(n), np.zeros((2, 2))
        for y in itertools.product([0, 1], repeat=int(n)):
            s = math.exp(sum(e[at + i] * y[i] for i in range(n))
                         + sum(t[y[i], y[i + 1]] for i in range(n - 1)))
            total += s
            ones += s * np.array(y)
            for i in range(n - 1):
                both[y[i], y[i + 1]] += s
        expected += list(ones / total)
        counts += both / total
        at += n
    assert np.allclose(p, expected) and np.allclose(pairs, counts)


def accuracy(found, labels, label):
    marks = {r.doc_id: r[label] for r in labels.collect() if r[label] is not None}
    held = [(r.predicted, marks[r.doc_id]) for r in found.collect()
            if r.held_out and r.doc_id in marks]
    return sum(a == b for a, b in held) / len(held)


@pytest.fixture(scope="module")
def larger(spark, sf):
    folder = sf.replace("sf0.001", "sf0.01")
    return (spark.read.parquet(f"{folder}/documents.parquet"),
            spark.read.parquet(f"{folder}/labels.parquet"))


def test_toxicity_on_held_out_rows(larger):
    docs, labels = larger
    found = toxicity.classify(docs, labels)
    assert found.count() == docs.count()
    assert accuracy(found, labels, "toxic") > 0.9
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in found.where("size(spans) > 0").limit(20).collect():
        for s in r.spans:
            assert 0 <= s.start < s.end <= len(text[r.doc_id])
            assert re.fullmatch(r"[^\W_]|.*[^\W_]", text[r.doc_id][s.start:s.end], re.S)
    for r in found.select("doc_id", "held_out").collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_toxicity_precision_and_recall(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf.replace('sf0.001', 'sf0.1')}/{name}.parquet")
                    for name in ("documents", "labels"))
    marks = labels.where("toxic IN (0, 1)").select("doc_id", "toxic")
    both = toxicity.classify(docs, labels).where("held_out").join(marks, "doc_id")
    count = {(r.toxic, r.predicted): r["count"]
             for r in both.groupBy("toxic", "predicted").count().collect()}
    right = count[1, 1]
    assert right / (right + count.get((0, 1), 0)) > 0.9
    assert right / (right + count.get((1, 0), 0)) > 0.9


def test_fit_by_parts_equals_one_part():
    draw = np.random.default_rng(5)
    features, labels = draw.integers(0, 40, (3, 90)), draw.integers(0, 2, 90)
    lengths = np.array([20, 0, 10, 25, 35])

    def part(a, b, sizes):
        own = features[:, a:b]
        return crf.Part(lambda w: w[own].sum(0), lambda d: np.bincount(
            own.ravel(), weights=np.tile(d, 3), minlength=40), sizes, labels[a:b])

    whole = crf.fit_parts(40, [part(0, 90, lengths)], 20, 0.1, 1e-5)
    cut = crf.fit_parts(40, [part(0, 30, lengths[:3]), part(30, 90, lengths[3:])], 20, 0.1, 1e-5)
    assert np.allclose(whole[0], cut[0]) and np.allclose(whole[1], cut[1])


def test_training_sample_is_bounded_in_rows_and_bytes(spark, make):
    docs = make(["a" * 100, "b" * 100, "c" * 5000, None, "d" * 100, "e"], [1, 2, 3, 4, 6, 7])
    marks = spark.createDataFrame([(i, 1) for i in (1, 2, 3, 4, 6, 7)], "doc_id long, toxic int")

    def found(**given):
        rows = toxicity.training_sample(docs, marks, "toxic", by=99991, out=5, **given).collect()
        return {r.doc_id: len(r.text) for r in rows}

    assert found(size=10) == {1: 100, 2: 100, 3: 5000, 4: 0, 6: 100, 7: 1}
    assert len(found(size=2)) == 2
    assert 3 not in found(size=10, most=32 * 1000)
    assert sum(found(size=10, most=32 * 101).values()) <= 32 * 101 and found(size=10, most=32) == {4: 0, 7: 1}


def test_quality_on_held_out_rows(larger):
    docs, labels = larger
    found = quality.classify(docs, labels)
    assert accuracy(found, labels, "quality") > 0.95
    size = {r.doc_id: len(r.text.encode()) for r in docs.collect()}
    lines = {r.doc_id: r.text.count("\n") + 1 for r in docs.collect()}
    for r in found.collect():
        assert r.lines[-1].end == size[r.doc_id] and len(r.lines) == lines[r.doc_id]
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)


@pytest.mark.parametrize("module, label", [(toxicity, "toxic"), (quality, "quality")])
def test_classifiers_on_odd_rows(spark, make, module, label):
    docs = make([None, "", " \n\n", "good text", "good text", "bad " * 20000, "\n"],
                [1, 2, None, 4, 4, 6, 7])
    none = spark.createDataFrame([], f"doc_id long, {label} int")
    marks = spark.createDataFrame([(1, 1), (2, 0), (4, 1), (6, 0), (6, 0), (99, 1), (None, 1),
                                   (7, None), (8, 5)], f"doc_id long, {label} int")
    for labels in (none, marks):
        found = module.classify(docs, labels, carry=True)
        assert found.count() == 7
        assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
                   for r in found.collect())
        assert found.select("row.*").columns == docs.columns
        assert module.classify(make([]), labels).count() == 0


def brute_language_model(rows, by=5, out=1):
    def tokens(text):
        low = (text or "").translate(FOLD)
        return [w for w in re.split("[\x20\x09-\x0d]+", low) if w] + [None]

    fold = {i: zlib.crc32(str(i).encode()) % by for i, _ in rows}
    count = Counter(w for i, t in rows if fold[i] != out for w in tokens(t))
    n, v = sum(count.values()), len(count)
    base = {}
    for i, t in rows:
        words = tokens(t)
        base[i] = (len(words), sum(count[w] > 0 for w in words), n,
                   sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words),
                   fold[i] == out)
    return base


def test_language_model_base_is_exact_and_score_is_better(larger):
    docs, _ = larger
    expected = brute_language_model([(r.doc_id, r.text) for r in docs.collect()])
    found = language_model.score_held_out(docs).collect()
    better = 0.0
    for r in found:
        n, known, train, base, held = expected[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (n, known, train, held)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        better += held * (r.score - r.base_score)
    assert better > 0


def test_language_model_reads_quantised_counts_back(spark, make):
    texts = [f"w{i % 50} v{i % 7} w{i % 50}" for i in range(400)] + ["", None, "A a A a"]
    docs = make(texts, range(len(texts)))
    model = language_model.learn(docs.select("text"))
    count = Counter()
    for t in texts:
        words = (t or "").translate(FOLD).split()
        count.update(zip(["<"] + words, words + [">"], strict=True))
    hashed = {}
    for w in {w for pair in count for w in pair}:
        hashed[w] = language_model.BEGIN if w == "<" else language_model.END if w == ">" else \
            language_model.sequence(np.frombuffer(w.encode(), np.uint8),
                                    np.array([0, len(w)]))[1][0]
    pairs = list(count)
    steps = model.steps(language_model.joint(np.array([hashed[a] for a, _ in pairs]),
                                             np.array([hashed[b] for _, b in pairs])))
    exact = language_model.quantise(np.array([count[p] for p in pairs]))
    assert (steps >= exact).all() and (steps == exact).mean() > 0.9
    assert language_model.learn(docs.select("text").limit(0)) is None
    got = language_model.score(make(["a", None]), None).collect()
    assert all(r.n_known == 0 and r.base_score == 0 for r in got)
    assert language_model.score_held_out(make([])).count() == 0


def test_language_model_rarely_finds_absent_bigrams(make):
    draw = np.random.default_rng(6)
    texts = [" ".join(f"w{i}" for i in draw.integers(0, 5000, 400)) for _ in range(150)]
    model = language_model.learn(make(texts).select("text"))
    absent = draw.integers(0, 1 << 63, 200_000).astype(np.uint64)
    found = (model.steps(absent) > 0).mean()
    assert found <= language_model.FALSE_POSITIVES + 0.002
    assert model.block_bytes * 8 >= 8 * model.total


def test_language_model_sends_a_bigram_once_per_flush(make, monkeypatch):
    monkeypatch.setattr(language_model, "HELD", 1 << 18)
    texts = make(["a " * 400_000] * 4 + ["a b"]).select("text").coalesce(1)
    sent = language_model.bigram_counts(texts, 1).collect()
    assert sum(r.n for r in sent) == 5  # begin a, a a, a end, a b, b end
    monkeypatch.setattr(language_model, "BLOCK_TOKENS", 1 << 17)
    model = language_model.learn(make(["a " * 400_000] * 4 + ["a b"]).select("text"))
    a = language_model.sequence(np.frombuffer(b"a", np.uint8), np.array([0, 1]))[1][:1]
    steps = language_model.quantise(np.array([4 * 399_999]))
    assert model.steps(language_model.joint(a, a))[0] >= steps[0]
    assert model.words(a)[0][0] == 4 * 400_000 + 1 and model.words(a)[1][0] == 3


def brute_licenses(text, templates, threshold, block):
    low = (text or "").translate(FOLD)
    words, lines = [], []
    for number, line in enumerate(low.split("\n")):
        own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", line)
        words += own
        lines += [number] * len(own)
    phrases = [(p.split(), label) for p, label in licenses.PHRASES.items()]
    places = sorted((i, label) for p, label in phrases for i in range(len(words))
                    if words[i:i + len(p)] == p)
    found = set()
    for number in set(lines):
        first = lines.index(number)
        own = words[first:first + lines.count(number)]
        for at in range(0, max(1, len(own)), block // 2):
            part = set(own[at:at + block])
            for t, label in templates:
                want, core = set(t.split()), set(licenses.REQUIRED.get(t, "").split())
                if len(want & part) >= threshold * len(want) - 1e-9:
                    found.add((label, first + at, len(want & part) / len(want), core <= part))
    return len(words), places, found


def test_license_scan_equals_brute_force(make, larger):
    mix = ["Released under the MIT\nLicense. Apache-License, version 2! CC BY-NC cc by nc",
           "permission is hereby granted, free of charge to any person obtaining a copy of this "
           "software and associated files", None, "", "under the mit license " * 50,
           "word " * 500 + "this work is licensed under gnu general public license version 3"]
    texts = mix + [r.text for r in larger[0].limit(300).collect()]
    found = licenses.scan(make(texts))
    short = {r.doc_id: r for r in licenses.labelled(found).collect()}
    for r in found.collect():
        n, places, blocks = brute_licenses(texts[r.doc_id], licenses.TEMPLATES,
                                           licenses.THRESHOLD, licenses.BLOCK)
        assert r.n_words == n
        assert sorted((p.first, p.label) for p in r.phrases) == places
        assert {(b.label, b.first, b.containment, b.named) for b in r.blocks} == blocks
        s = short[r.doc_id]
        assert (s.n_base, s.first_word, s.last_word) == (
            len(places), places[0][0] if places else None, places[-1][0] if places else None)
        assert s.base_labels == ",".join(sorted({label for _, label in places}))
        assert s.labels == ",".join(sorted({label for _, label in places}
                                           | {b[0] for b in blocks if b[3]}))
        assert 0 <= s.score <= 1
    assert licenses.scan(make([])).count() == 0
    assert licenses.scan(make(["x"]), templates=[], phrases={}).first().blocks == []


def test_whole_notices_are_labelled(make):
    for_label = {
        "mit": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR\nIMPLIED, '
               "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,\nFITNESS FOR A "
               "PARTICULAR PURPOSE AND NONINFRINGEMENT.",
        "bsd": "Redistribution and use in source and binary forms, with or without\n# modification, "
               "are permitted provided that the following conditions are met:",
        "lgpl-2.1": "under the terms of the GNU Lesser General Public License as published by the Free "
                    "Software Foundation; either version 2.1 of the License, or (at your option) any "
                    "later version.",
        "agpl-3": "under the terms of the GNU Affero General Public License as published\n * by the "
                  "Free Software Foundation, either version 3 of the License, or\n * (at your option) "
                  "any later version.",
        "epl-2": "This program and the accompanying materials are made available under the terms of "
                 "the Eclipse Public License 2.0 which is available at https://www.eclipse.org",
        "unlicense": "This is free and unencumbered software released into the public domain.",
        "apache-2": "// SPDX-License-Identifier: Apache-2.0",
        "gpl-3": "# SPDX-License-Identifier: GPL-3.0-or-later"}
    found = licenses.labelled(licenses.scan(make(list(for_label.values())))).collect()
    for r in found:
        assert list(for_label)[r.doc_id] in r.labels.split(","), r
    plain = ["released under the gpl license", "spdx license identifier proprietary",
             "creative commons attribution 4 0 international license",
             "you may copy this text for any purpose and share it with anyone"]
    labels = [r.labels for r in licenses.labelled(licenses.scan(make(plain))).orderBy("doc_id").collect()]
    assert labels == ["", "", "cc-by", ""]
    blocks = licenses.scan(make(plain[:1])).first().blocks
    assert [(b.label, b.named) for b in blocks] == [("mit", False)]


def brute_wrapped(text, templates, threshold, block):
    words, lines = [], []
    for number, line in enumerate((text or "").translate(FOLD).split("\n")):
        own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", line)
        words += own
        lines += [number] * len(own)
    found = set()
    for at in range(0, len(words), block // 2):
        part = set(words[at:at + block])
        if lines[at] == lines[at:at + block][-1]:
            continue
        for t, label in templates:
            want, core = set(t.split()), set(licenses.REQUIRED.get(t, "").split())
            if len(want & part) >= threshold * len(want) - 1e-9:
                found.add((label, at, len(want & part) / len(want), core <= part))
    return found


def test_license_scan_finds_wrapped_notices(make):
    draw = random.Random(8)
    texts, labels = [None, "", "\n\n", "one line"], [None] * 4
    for notice, label in licenses.TEMPLATES:
        for width in (30, 70, 80):
            before = " ".join(f"x{draw.randrange(99)}" for _ in range(draw.randrange(150)))
            for sign in ("\n", "\n * ", "\r\n# "):
                texts.append(sign.join(textwrap.wrap(f"{before} {notice} and more", width)))
                labels.append(label)
    grant = next(t for t, _ in licenses.TEMPLATES if t.startswith("permission is hereby")).split()
    texts.append(" ".join(grant[:14]) + "\n" + " ".join(grant[14:]))
    labels.append("mit")
    found = licenses.scan(make(texts))
    for r in found.collect():
        assert {(b.label, b.first, b.containment, b.named) for b in r.wrapped} == brute_wrapped(
            texts[r.doc_id], licenses.TEMPLATES, licenses.THRESHOLD, licenses.BLOCK)
    for r in licenses.labelled(found).collect():
        assert (labels[r.doc_id] or "") in r.labels.split(",")


def test_license_scan_needs_the_words_that_name_a_license(make):
    expected = {
        "Released under the GPL license": "", "released under an mit license": "mit",
        "Creative Commons Attribution 4.0 International License": "cc-by",
        "Creative Commons Attribution\n4.0 International License": "cc-by",
        "licensed under CC BY 4.0": "", "licensed under CC BY-NC 4.0": "cc-by-nc",
        "Creative Commons 4.0 International License": "",
        "Licensed under the Foo License, Version 2.0": "",
        "Licensed under the Apache License, Version 1.0": "",
        "Licensed under an Apache License, Version 2.0": "apache-2",
        "This work is licensed under the GNU General Public License version 2": "",
        "This work is licensed under GNU General Public License version 3": "gpl-3",
        "subject to the terms of the Eclipse Public License v 2.0": "",
        "subject to terms of the Mozilla Public License v 2.0": "mpl-2"}
    found = licenses.labelled(licenses.scan(make(list(expected)), phrases={}))
    got = {r.doc_id: r.labels for r in found.collect()}
    assert [got[i] for i in range(len(expected))] == list(expected.values())
    with pytest.raises(ValueError):
        licenses.Join([("a b", "x")], 0.8, 64, {"a b": "c"})


def test_pipeline_stages(spark, sf, corpus):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "quality classifier", "n-gram Jaccard join",
                     "suffix-array dedup", "packing"]
    docs = corpus
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, sf)
        assert after.columns == corpus.columns and after.dtypes == corpus.dtypes
        assert 0 < after.count() <= docs.count()
        docs = after
    assert docs.where("n_chars <> length(text)").isEmpty()
    packed = corpus_pipeline.run(spark, sf)
    assert packed.select("doc_id").distinct().count() == docs.count()


def test_pipeline_stages_on_odd_rows(spark, sf, make):
    odd = make([None, "", "plain words here", "plain words here", "é" * 60 + "x", "é" * 60 + "y"],
               [1, None, 3, 3, 5, 6])
    for stage in (stages.clean, stages.good, stages.distinct, stages.unrepeated):
        for docs in (odd, make([])):
            after = stage(spark, docs, sf)
            assert after.columns == docs.columns
            assert after.count() <= docs.count()
    left = {r.doc_id: r.text for r in stages.unrepeated(spark, odd, sf).collect()}
    assert left[5] == "é" * 60 + "x" and left[6] == "y"


def test_pipeline_dedup_keeps_replacement_characters(spark, sf, make):
    passage = "".join(f"{i:x}-" for i in range(900, 920))
    texts = ["\u00e9" + passage, "\ufffd \u0129" + passage + "\ufffd tail",  # both have byte A9
             "\ufffd" + passage + "\u20ac", "\U0001f600" * 20 + "\u00e9" * 40, "\u00e9" * 40 + "\ufffd"]
    left = {r.doc_id: r.text for r in stages.unrepeated(spark, make(texts), sf).collect()}
    assert left == {0: texts[0], 1: "\ufffd \ufffd tail", 2: "\ufffd\u20ac", 3: texts[3],
                    4: "\ufffd"}
