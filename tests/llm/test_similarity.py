"""Joins, fingerprints, neighbours and dedup against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from plumbline.llm import fingerprints, jaccard, neighbours, suffix_dedup
from plumbline.llm import text as T
from plumbline.llm.components import components


def near_texts(seed=3):
    """Copies from two to many, near copies in a chain, short and empty texts."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(4))
    base = [" ".join(word() for _ in range(120)) for _ in range(6)]
    texts = list(base)
    for b in base[:4]:
        for _ in range(12):
            words = b.split()
            for _ in range(draw.randint(0, 3)):
                words[draw.randrange(len(words))] = word()
            texts.append(" ".join(words))
    texts += [base[5]] * 30 + [base[5].upper(), base[5].replace(" ", "\n")]
    chain = base[4].split()
    for _ in range(10):
        chain = [*chain[4:], *(word() for _ in range(4))]
        texts.append(" ".join(chain))
    return texts + ["", None, " \n", "one two", "one two", "ONE two", "one two three", "x " * 3000]


def brute_classes(rows, size=5, threshold=0.8):
    sets = []
    for _, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        w = [x for x in re.split("[\x20\x09-\x0d]+", low) if x]
        sets.append({tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size
                    else {tuple(w)} if w else set())
    links, root = Counter(), list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and len(a & sets[j]) >= threshold * len(a | sets[j]) - 1e-9:
                links[i] += 1
                links[j] += 1
                root[max(top(i), top(j))] = min(top(i), top(j))
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[top(i)] = min(doc, least.get(top(i), doc))
    return Counter((rows[i][0], least[top(i)], links[i]) for i in range(len(rows)))


@pytest.mark.parametrize("block", [512, 7])
def test_jaccard_join_equals_brute_force(make, block):
    rows = list(enumerate(near_texts()))
    random.Random(1).shuffle(rows)
    found = jaccard.join(make([t for _, t in rows], [i for i, _ in rows]), block=block)
    got = Counter((r.doc_id, r.class_id, r.links) for r in found.collect())
    assert got == brute_classes(rows)


def test_jaccard_join_of_odd_tables(make):
    assert jaccard.join(make([])).count() == 0
    docs = make(["a b c d e f", "a b c d e f", None, "", "a b c d e f"], [5, 5, 2, None, None])
    classes = jaccard.join(docs)
    got = sorted((r.doc_id or -1, r.class_id or -1, r.links) for r in classes.collect())
    assert got == [(-1, -1, 0), (-1, 5, 2), (2, 2, 0), (5, 5, 2), (5, 5, 2)]
    left = jaccard.representatives(docs, classes)
    assert left.columns == docs.columns
    assert sorted((r.doc_id or -1) for r in left.collect()) == [-1, 2, 5]


def test_bands_reach_the_recall():
    bands, rows = jaccard.bands_for(0.8, 0.9999)
    assert 1 - (1 - 0.8 ** rows) ** bands >= 0.9999 and bands * rows <= 160


def test_components_of_paths_stars_and_rings(spark):
    draw = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)]
    edges += [(200 + i, 200 + (i + 1) % 9) for i in range(9)] + [(300, 300), (7, 6)]
    names = {n: draw.getrandbits(40) for e in edges for n in e}
    given = [(names[a], names[b]) for a, b in edges]
    found = dict(components(spark.createDataFrame(given, "u long, v long")).collect())
    for group in (range(41), range(100, 160), range(200, 209)):
        least = min(names[n] for n in group)
        assert all(found[names[n]] == least for n in group)
    assert names[300] not in found
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def brute_dedup(rows, length=50):
    first, out = {}, {}
    texts = [((-(1 << 63) if i is None else i), (t or "").encode()) for i, t in rows]
    for doc, raw in texts:
        for p in range(len(raw) - length + 1):
            w = raw[p:p + length]
            first[w] = min(doc, first.get(w, doc))
    for k, (doc, raw) in enumerate(texts):
        gone = [False] * len(raw)
        for p in range(len(raw) - length + 1):
            if first[raw[p:p + length]] < doc:
                gone[p:p + length] = [True] * length
        kept = bytes(c for c, g in zip(raw, gone, strict=True) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out[k] = (rows[k][0], len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return Counter(out.values())


def test_suffix_dedup_equals_brute_force(make, monkeypatch):
    for name, value in (("SHARD", 700), ("MERGED", 3000), ("GROUP", 8000), ("HELD", 5000)):
        monkeypatch.setattr(suffix_dedup, name, value)
    draw = random.Random(2)
    line = "".join(draw.choice("abcde \0é") for _ in range(70))
    passage = "".join(draw.choice("abcdefgh ") for _ in range(400))
    texts = [None, "", "short", "z" * 49, "z" * 50, "z" * 51, "z" * 200, line, line[:-1], "é" * 40]
    for _ in range(60):
        own = "".join(draw.choice("abcdefgh ") for _ in range(draw.randint(0, 300)))
        a, b = sorted(draw.randrange(400) for _ in range(2))
        texts.append(own[:100] + draw.choice(["", line, passage[a:b], passage]) + own[100:])
    texts += texts[-5:] * 3
    rows = list(enumerate(texts))
    rows += [(None, passage), (None, passage[20:]), (4, texts[12]), (4, texts[12])]
    draw.shuffle(rows)
    found = suffix_dedup.dedup(make([t for _, t in rows], [i for i, _ in rows]))
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
                  for r in found.collect())
    assert got == brute_dedup(rows)
    assert suffix_dedup.dedup(make([])).count() == 0


def test_suffix_dedup_of_a_context_that_two_later_documents_share(make):
    # 12 and 324 share 56 bytes, 11 the first 54 of them: 324 loses the windows at 5 and 6 too.
    head = "The and attion to thanedble the, anea. Eriner thanea.\n"
    texts = [head + "Thntblere of then, edtioner in inea that esly ndstnd nter inor eri",
             head + "Itrendndsh erineaing haan erre attionin oranst as nt atoust eseahe",
             head + "It anha reou stanat and at ing eresnt.\nAnd ornd.\nFrom ou onea of o"]
    rows = list(zip([11, 12, 324], texts, strict=True))
    found = suffix_dedup.dedup(make(texts, [11, 12, 324]))
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
                  for r in found.collect())
    assert got == brute_dedup(rows)
    assert {r.doc_id: r.n_removed for r in found.collect()}[324] == 56


@pytest.mark.parametrize("often", [1 << 18, 100])
def test_suffix_dedup_of_a_line_in_ever_new_surroundings(make, monkeypatch, often):
    monkeypatch.setattr(suffix_dedup, "HOT", 20)
    monkeypatch.setattr(suffix_dedup, "FREQUENT", often)
    monkeypatch.setattr(suffix_dedup, "SAMPLED", 2)
    monkeypatch.setattr(suffix_dedup, "GROUP", 8000)
    monkeypatch.setattr(suffix_dedup, "MERGED", 3000)
    compare = suffix_dedup.repeated
    draw = random.Random(9)
    word = lambda n: "".join(draw.choice("abcdefgh ") for _ in range(n))
    lines = [word(n) for n in (40, 47, 60, 90)]
    texts = [word(60) + draw.choice(lines) + draw.choice(["", "some", word(1)]) + word(60)
             for _ in range(250)]
    texts += [word(20) + lines[0] for _ in range(30)] + [lines[3]] * 3 + ["z" * 80] * 3
    rows = list(enumerate(texts)) + [(None, texts[3]), (4, texts[9]), (4, texts[9])]
    draw.shuffle(rows)
    docs = make([t for _, t in rows], [i for i, _ in rows])

    def bounded(contexts, docs, *rest):
        assert len(contexts) <= 70, len(contexts)
        return compare(contexts, docs, *rest)

    monkeypatch.setattr(suffix_dedup, "repeated", bounded)
    found = suffix_dedup.dedup(docs)
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
                  for r in found.collect())
    assert got == brute_dedup(rows)
    whole = docs.selectExpr("coalesce(doc_id, -1) doc_id", "xxhash64(doc_id, text) row_key", "text")
    assert (len(suffix_dedup.frequent(whole, 50, 24)) > 0) == (often == 100)


def test_merged_transforms_give_the_repeated_strings():
    draw = np.random.default_rng(4)
    shards = [draw.integers(1, 4, n).astype(np.uint16) for n in (40, 7, 90)]
    for s in shards:
        s[-1] = 0
    orders = [suffix_dedup.rotations(s, 6) for s in shards]
    suffix, block = suffix_dedup.merge([s[o - 1] for s, o in zip(shards, orders, strict=True)], 6)
    heads = [tuple(np.roll(s, -p)[:6].tolist()) for s, o in zip(shards, orders, strict=True)
             for p in o]
    count = Counter(h for h in heads if 0 not in h)
    assert sorted(suffix.tolist()) == [i for i, h in enumerate(heads) if count[h] > 1]
    numbers = {}
    for i, b in zip(suffix.tolist(), block.tolist(), strict=True):
        assert numbers.setdefault(b, heads[i]) == heads[i]
    assert [numbers[b] for b in sorted(numbers)] == sorted(set(numbers.values()))


def test_fingerprints_of_edited_texts(corpus):
    rows = sorted((r.doc_id, r.text) for r in corpus.collect())
    found = {r.doc_id: r for r in fingerprints.compare_edited(corpus).collect()}
    seen = {}
    for (doc, text), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        cut = len(text) // 4
        edited = text[:len(text) - cut] + after[:cut]
        r = found[doc]
        assert (r.n_chars, r.edited_sha256) == (len(text),
                                                hashlib.sha256(edited.encode()).hexdigest())
        assert seen.setdefault(text, r.fingerprint) == r.fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    mean = lambda name: np.mean([getattr(r, name) for r in found.values()])
    assert mean("near_edited") > 0.4 and mean("near_next") < 0.05


def test_fingerprints_across_ranges_and_odd_rows(make, monkeypatch):
    texts = [None, "", "a b c", "a b c", "x" * 1000, "π ρ σ τ " * 20, " ", "a"]
    ids = [9, 1, 4, 4, None, 12, 30, 31]
    whole = {(r.doc_id, r.n_chars, r.edited_sha256)
             for r in fingerprints.compare_edited(make(texts, ids)).collect()}
    monkeypatch.setattr(fingerprints, "RANGE_BYTES", 40)
    found = fingerprints.compare_edited(make(texts, ids)).collect()
    assert {(r.doc_id, r.n_chars, r.edited_sha256) for r in found} == whole
    order = sorted(zip(ids, texts, strict=True), key=lambda x: (
        x[0] is not None, x[0] or 0, (x[1] or "").encode()))
    expected = set()
    for (doc, text), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        text, after = text or "", after or ""
        cut = len(text) // 4
        expected.add((doc, len(text), hashlib.sha256(
            (text[:len(text) - cut] + after[:cut]).encode()).hexdigest()))
    assert whole == expected
    same = [r.fingerprint for r in found if r.doc_id == 4]
    assert same[0] == same[1]
    assert fingerprints.compare_edited(make([])).count() == 0
    one = fingerprints.compare_edited(make(["abcd"])).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"abca").hexdigest()


def brute_prints(texts, lexicon):
    """Kind, level and hashes of each text, term by term in plain integers."""
    mask = (1 << 64) - 1

    def mix(x):
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = ((x ^ (x >> shift)) * factor) & mask
        return x ^ (x >> 31)

    found = []
    for text in texts:
        words = set(re.findall(b"[0-9a-z\x80-\xff]+", text.encode().lower()))
        codes = {int(T.word_hashes(np.frombuffer(w, np.uint8), np.array([0, len(w)]), T.ALNUM,
                                   T.FOLDED)[0][0]) for w in words}
        kind = "b" if codes & lexicon else "a" if codes else "c"
        used = codes & lexicon or codes
        if not used:
            digest = hashlib.sha256(text.encode()).digest()[:4]
            hashes = [int.from_bytes(digest, "little") | 1] * 64
            found.append((kind, 0, hashes))
            continue
        level = max(1, int(np.floor(np.log2(len(used) / 0.5))))
        hashes = []
        for x in range(4):
            for s in range(16):
                seed = mix((s + 1) * 0xA24BAED4963EE407 & mask)
                inside = [c for c in used if mix((c + seed) & mask) < 1 << (64 - level - x)]
                total = mix(sum(mix(c ^ 0x2545F4914F6CDD1D) for c in inside) & mask)
                hashes.append(max(total >> 32, 1) if inside else 0)
        found.append((kind, level, hashes))
    return found


def brute_likeness(a, b):
    if a == b:
        return 1.0
    if a[0] != b[0]:
        return 0.0
    sets = [{(p[1] + k // 16, k % 16): h for k, h in enumerate(p[2])} for p in (a, b)]
    pairs = [(sets[0][k], sets[1][k]) for k in sets[0].keys() & sets[1].keys()]
    used = [p == q for p, q in pairs if p or q]
    return sum(used) / max(1, len(used))


def test_fingerprints_and_likeness_equal_brute_force(make):
    draw = random.Random(8)
    vocabulary = [f"Wort{i}" for i in range(60)] + ["\u00e9t\u00e9", "\u7d05\u8272", "x1"]
    texts = [" ".join(draw.choices(vocabulary, k=draw.choice([1, 3, 20, 90]))) for _ in range(60)]
    texts += ["", " \n", "...", texts[3], "alone"]
    docs = make(texts)
    lexicon = fingerprints.lexicon(docs, 0.05, 0.3)
    counts = Counter(w for t in texts for w in {x.lower() for x in t.split()})
    in_band = [w for w, n in counts.items() if 0.05 * len(texts) <= n <= 0.3 * len(texts)
               and w != "..."]
    assert len(lexicon) == len(in_band) > 10
    known = set(lexicon.tolist())
    edited = []
    for text, after in zip(texts, texts[1:] + texts[:1], strict=True):
        cut = len(text) // 4
        edited.append(text[:len(text) - cut] + after[:cut])
    own, other = brute_prints(texts, known), brute_prints(edited, known)
    prints = [fingerprints.fingerprints(pa.array(t, pa.large_string()), lexicon)
              for t in (texts, edited)]
    for mine, theirs in zip(prints, (own, other), strict=True):
        assert [("bac"[k], level, h.tolist()) for k, level, h in zip(
            mine.kind.tolist(), mine.level.tolist(), mine.hashes, strict=True)] == theirs
    at = np.arange(len(texts))
    assert prints[0].likeness(at, prints[1], at).tolist() == pytest.approx(
        [brute_likeness(a, b) for a, b in zip(own, other, strict=True)])
    assert prints[0].likeness(at, prints[0], np.roll(at, -1)).tolist() == pytest.approx(
        [brute_likeness(a, b) for a, b in zip(own, own[1:] + own[:1], strict=True)])


def test_edited_copies_need_no_driver_state(make, monkeypatch):
    """Ranges of a few bytes, one id for a third of all rows, and no rows sent to the driver."""
    draw = random.Random(5)
    texts = ["".join(draw.choices("ab \u00fc", k=draw.randint(0, 60))) for _ in range(150)]
    ids = [7 if k % 3 == 0 else None if k % 7 == 0 else 1000 + k for k in range(150)]
    docs = make(texts, ids)
    expected = {(r.doc_id, r.n_chars, r.edited_sha256, r.near_next): 0
                for r in fingerprints.compare_edited(docs).collect()}
    words = fingerprints.lexicon(docs)
    monkeypatch.setattr(fingerprints, "RANGE_BYTES", 16)
    monkeypatch.setattr(fingerprints, "lexicon", lambda _: words)
    monkeypatch.setattr(type(docs), "collect", None)
    monkeypatch.setattr(type(docs), "approxQuantile", None)
    found = fingerprints.compare_edited(docs)
    monkeypatch.undo()
    assert {(r.doc_id, r.n_chars, r.edited_sha256, r.near_next): 0
            for r in found.collect()} == expected
    assert found.count() == 150


def test_word_hashes_of_long_texts_in_stretches(monkeypatch):
    draw = random.Random(2)
    texts = ["".join(draw.choices("abC \u00e9", k=n)) for n in (0, 5, 3000, 40)] + ["y" * 500]
    data, bounds = T.utf8(pa.array(texts))
    whole = T.word_hashes(data, bounds, T.ALNUM, T.FOLDED)
    monkeypatch.setattr(T, "SLICE", 64)
    monkeypatch.setattr(T, "KEPT", 100)
    monkeypatch.setattr(T, "_POWERS", [])
    cut = T.word_hashes(data, bounds, T.ALNUM, T.FOLDED)
    assert (cut[0] == whole[0]).all() and (cut[1] == whole[1]).all()


def test_lexicon_counts_documents(make):
    docs = make(["rare common"] + ["Common common"] * 99)
    assert len(fingerprints.lexicon(docs, 0.005, 0.5)) == 1
    assert len(fingerprints.lexicon(docs, 0.5, 1.0)) == 1


def brute_nearest(ids, vectors, query, k):
    score = (vectors * vectors[query]).sum(1)
    order = [i for i in np.lexsort((ids, -score)) if ids[i] != ids[query]]
    return [(int(ids[i]), float(score[i])) for i in order[:k]]


def test_neighbours_reach_the_recall(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet")
    table = rows.orderBy("vec_id").collect()
    ids = np.array([r.vec_id for r in table])
    vectors = np.array([r.embedding for r in table], float)
    found = {}
    for r in neighbours.search(rows, rows.where("vec_id % 20 = 0"), block=200,
                               per_task=10).collect():
        found.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    hits = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        best = brute_nearest(ids, vectors, q, 20)
        got = [found[ids[q]][i + 1] for i in range(20)]
        assert got == sorted(got, key=lambda x: (-x[1], x[0]))
        assert all(abs(s - float(vectors[ids == v][0] @ vectors[q])) < 1e-12 for v, s in got)
        hits += len({v for v, _ in best} & {v for v, _ in got})
        total += 20
    assert hits >= 0.95 * total


def test_neighbours_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    given = [(0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]),
             (5, [None, 1.0]), (6, [2.0, 0.0]), (7, [2.0, 0.0]), (8, [-1.0, 3.0]), (9, [1.0]),
             (None, [1.0, 1.0]), (20, [0.5, 0.5]), (40, [0.0, 0.0])]
    rows = spark.createDataFrame(given, "vec_id long, embedding array<float>")
    found = neighbours.search(rows, rows.where("vec_id % 20 = 0"), k=3)
    assert [tuple(r) for r in found.orderBy("query_id", "rank").collect()] == [
        (0, 1, 6, 2.0), (0, 2, 7, 2.0), (0, 3, 20, 0.5),
        (20, 1, 6, 1.0), (20, 2, 7, 1.0), (20, 3, 8, 1.0)]
    assert neighbours.search(rows.limit(0), rows.limit(0)).count() == 0
    assert neighbours.search(rows.where("vec_id = 0"), rows.where("vec_id = 0")).count() == 0
