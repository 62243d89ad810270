"""License scan: exact set-similarity join of text blocks with license templates.

A block is a run of at most ``BLOCK`` words; runs overlap by half, so a notice of up to half a block
lies whole in one of them. Blocks are made of each line, and again of all words of the text, for
notices that are wrapped over lines. A template is a set of words. A block matches a template
if it contains at least ``threshold`` of its words. Tokens are ordered by their frequency in all
documents, rarest first. If the overlap is large enough, a block must hold one of the template's
first words in that order (prefix filter), hold enough template words at all (length filter), and
leave enough words after the first shared one on both sides (positional filter). The pairs left
are compared in full, so the join is exact and whole: every block that meets the threshold is a match.
A match says whether the block also holds the words that name the template's license (``REQUIRED``);
only such matches label a document, as the notices of several licenses share most of their wording.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm import text as T
from plumbline.llm.tables import pieces

THRESHOLD = 0.8
#: Words of a block; a template has at most half as many.
BLOCK = 64

#: Phrases whose words must stand consecutively, and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Label, words that name the license (empty: the wording is its own), and the wording of
#: its notices. Templates are cut from them. License texts that share wording share a label of the family.
NOTICES = [
    ("mit", "mit", "released under the mit license"),
    ("mit", "mit", "licensed under the mit license"),
    ("mit", "mit", "spdx license identifier mit"),
    ("mit", "", "permission is hereby granted free of charge to any person obtaining a copy of this "
     "software and associated documentation files"),
    ("mit", "", "to deal in the software without restriction including without limitation the rights "
     "to use copy modify merge publish distribute sublicense and or sell copies of the software and to "
     "permit persons to whom the software is furnished to do so subject to the following conditions"),
    ("mit", "", "the above copyright notice and this permission notice shall be included in all copies "
     "or substantial portions of the software"),
    ("mit", "", "the software is provided as is without warranty of any kind express or implied "
     "including but not limited to the warranties of merchantability fitness for a particular purpose "
     "and noninfringement in no event shall the authors or copyright holders be liable for any claim "
     "damages or other liability whether in an action of contract tort or otherwise arising from out "
     "of or in connection with the software or the use or other dealings in the software"),
    ("apache-2", "apache 2", "licensed under the apache license version 2 0"),
    ("apache-2", "apache 2", "spdx license identifier apache 2 0"),
    ("apache-2", "", "you may not use this file except in compliance with the license"),
    ("apache-2", "apache 2", "you may obtain a copy of the license at http www apache org licenses "
     "license 2 0"),
    ("apache-2", "", "unless required by applicable law or agreed to in writing software distributed "
     "under the license is distributed on an as is basis without warranties or conditions of any kind "
     "either express or implied see the license for the specific language governing permissions and "
     "limitations under the license"),
    ("bsd", "", "redistribution and use in source and binary forms with or without modification are "
     "permitted provided that the following conditions are met"),
    ("bsd", "source", "redistributions of source code must retain the above copyright notice this "
     "list of conditions and the following disclaimer"),
    ("bsd", "binary", "redistributions in binary form must reproduce the above copyright notice this "
     "list of conditions and the following disclaimer in the documentation and or other materials "
     "provided with the distribution"),
    ("bsd-3", "", "neither the name of the copyright holder nor the names of its contributors may be "
     "used to endorse or promote products derived from this software without specific prior written "
     "permission"),
    ("bsd", "", "this software is provided by the copyright holders and contributors as is and any "
     "express or implied warranties including but not limited to the implied warranties of "
     "merchantability and fitness for a particular purpose are disclaimed in no event shall the "
     "copyright holder or contributors be liable for any direct indirect incidental special exemplary "
     "or consequential damages"),
    ("bsd-3", "bsd 3 clause", "spdx license identifier bsd 3 clause"),
    ("bsd-2", "bsd 2 clause", "spdx license identifier bsd 2 clause"),
    ("gpl", "gnu general", "redistribute it and or modify it under the terms of the gnu general public "
     "license as published by the free software foundation"),
    ("gpl", "gnu general", "you should have received a copy of the gnu general public license along "
     "with this program if not see http www gnu org licenses"),
    ("gpl-2", "gnu general 2", "this program is free software you can redistribute it and or modify it "
     "under the terms of the gnu general public license version 2 as published by the free software "
     "foundation"),
    ("gpl-2", "gpl 2", "spdx license identifier gpl 2 0 or later"),
    ("gpl-3", "gnu general 3", "this work is licensed under the gnu general public license version 3"),
    ("gpl-3", "gpl 3", "spdx license identifier gpl 3 0 or later"),
    ("lgpl", "gnu lesser", "redistribute it and or modify it under the terms of the gnu lesser general "
     "public license as published by the free software foundation"),
    ("lgpl-2.1", "lesser 2 1", "under the terms of the gnu lesser general public license as published "
     "by the free software foundation either version 2 1 of the license or at your option any later "
     "version"),
    ("lgpl-3", "lesser 3", "licensed under the gnu lesser general public license version 3"),
    ("lgpl-2.1", "lgpl 2 1", "spdx license identifier lgpl 2 1 or later"),
    ("lgpl-3", "lgpl 3", "spdx license identifier lgpl 3 0 or later"),
    ("agpl-3", "affero", "under the terms of the gnu affero general public license as published by the "
     "free software foundation either version 3 of the license or at your option any later version"),
    ("agpl-3", "affero 3", "licensed under the gnu affero general public license version 3"),
    ("agpl-3", "agpl 3", "spdx license identifier agpl 3 0 or later"),
    ("mpl-2", "mozilla 2", "subject to the terms of the mozilla public license v 2 0"),
    ("mpl-2", "mpl", "if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("mpl-2", "mpl 2", "spdx license identifier mpl 2 0"),
    ("epl-2", "eclipse 2", "this program and the accompanying materials are made available under the "
     "terms of the eclipse public license 2 0 which is available at"),
    ("epl-2", "epl 2", "spdx license identifier epl 2 0"),
    ("isc", "", "permission to use copy modify and or distribute this software for any purpose with or "
     "without fee is hereby granted"),
    ("isc", "isc", "spdx license identifier isc"),
    ("unlicense", "", "this is free and unencumbered software released into the public domain"),
    ("unlicense", "", "anyone is free to copy modify publish use compile sell or distribute this "
     "software either in source code form or as a compiled binary for any purpose commercial or non "
     "commercial and by any means"),
    ("zlib", "", "this software is provided as is without any express or implied warranty in no event "
     "will the authors be held liable for any damages arising from the use of this software"),
    ("zlib", "", "the origin of this software must not be misrepresented you must not claim that you "
     "wrote the original software"),
    ("bsl-1.0", "boost 1", "distributed under the boost software license version 1 0"),
    ("bsl-1.0", "", "permission is hereby granted free of charge to any person or organization "
     "obtaining a copy of the software and accompanying documentation covered by this license"),
    ("artistic-2", "artistic 2", "licensed under the artistic license 2 0"),
    ("wtfpl", "fuck", "do what the fuck you want to public license"),
    ("eupl-1.2", "eupl 1 2", "licensed under the eupl version 1 2 or later"),
    ("ofl-1.1", "open font", "this font software is licensed under the sil open font license version 1 1"),
    ("cc0", "cc0", "dedicated to the public domain under cc0 1 0 universal"),
    ("cc0", "", "to the extent possible under law the author has waived all copyright and related or "
     "neighboring rights to this work"),
    ("cc-by-nc", "cc nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "noncommercial", "creative commons attribution noncommercial 4 0 international "
     "license"),
    ("cc-by-sa", "cc sa", "licensed under cc by sa 4 0"),
    ("cc-by-sa", "sharealike", "creative commons attribution sharealike 4 0 international license"),
    ("cc-by-nd", "cc nd", "licensed under cc by nd 4 0"),
    ("cc-by-nd", "noderivatives", "creative commons attribution noderivatives 4 0 international "
     "license"),
    ("cc-by", "attribution", "creative commons attribution 4 0 international license"),
]


def templates_of(notices: list[tuple[str, str, str]], block: int = BLOCK) -> list[tuple[str, str, str]]:
    """(template, label, naming words): notices cut into nearly equal parts of at most half a block.

    Only the part that holds all naming words asks for them; the others stand for the wording.
    """
    found = []
    for label, names, notice in notices:
        words = notice.split()
        n = -(-len(words) // (block // 2))
        edges = [len(words) * i // n for i in range(n + 1)]
        for i, j in zip(edges, edges[1:], strict=False):
            part = words[i:j]
            own = names if set(names.split()) <= set(part) else ""
            found.append((" ".join(part), label, own))
    return found


TEMPLATES = [(part, label) for part, label, _ in templates_of(NOTICES)]
#: Words of a template without which a block, though it matches, does not name the license: they tell
#: its notice from those of other licenses with the same wording. They decide labels only.
REQUIRED = {part: names for part, _, names in templates_of(NOTICES) if names}


def hashes_of(phrase: str) -> np.ndarray:
    data, bounds = T.utf8(pa.array([phrase]))
    return T.word_hashes(data, bounds, T.ALNUM, T.FOLDED)[0]


class Join:
    """Templates in the global order of their tokens, with the prefixes that candidates must hit."""

    def __init__(self, templates: list[tuple[str, str]], threshold: float, block: int,
                 required: dict[str, str]) -> None:
        self.threshold, self.block = threshold, block
        self.labels = [label for _, label in templates]
        self.sets = [np.unique(hashes_of(t)) for t, _ in templates]
        for words in self.sets:
            if not 0 < len(words) <= block // 2:
                raise ValueError("a template needs 1 to block / 2 different words")
        self.required = [np.unique(hashes_of(required.get(t, ""))) for t, _ in templates]
        for words, own in zip(self.required, self.sets, strict=True):
            if not np.isin(words, own).all():
                raise ValueError("required words must be words of their template")
        self.vocabulary = np.unique(np.concatenate([*self.sets, np.zeros(0, np.uint64)]))
        self.order_by(np.zeros(len(self.vocabulary), np.int64))

    def order_by(self, frequency: np.ndarray) -> None:
        """Order all tokens by their frequency in the corpus, rarest first."""
        size = len(self.vocabulary)
        self.rank = np.empty(size, np.int64)
        self.rank[np.lexsort((self.vocabulary, frequency))] = np.arange(size)
        self.need = np.array([math.ceil(self.threshold * len(s) - 1e-9) for s in self.sets])
        self.size = np.array([len(s) for s in self.sets])
        self.member = np.zeros((len(self.sets), size), bool)
        self.core = np.zeros((len(self.sets), size), bool)
        for number, words in enumerate(self.required):
            self.core[number, self.rank[np.searchsorted(self.vocabulary, words)]] = True
        token, template, place = [], [], []
        for number, words in enumerate(self.sets):
            ranks = np.sort(self.rank[np.searchsorted(self.vocabulary, words)])
            self.member[number, ranks] = True
            for i, r in enumerate(ranks[:len(ranks) - self.need[number] + 1].tolist()):
                token.append(r)
                template.append(number)
                place.append(i)
        by = np.argsort(np.array(token, np.int64), kind="stable")
        self.template, self.place = np.array(template, np.int64)[by], np.array(place, np.int64)[by]
        edges = np.searchsorted(np.array(token, np.int64)[by], np.arange(size + 1))
        self.first, self.count = edges[:-1], np.diff(edges)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the words that are in any template, and their ranks."""
        if not len(self.vocabulary):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        hit = np.flatnonzero(self.vocabulary[at] == hashes)
        return hit, self.rank[at[hit]]

    def matches(self, hashes: np.ndarray, line: np.ndarray
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(first word, words, template, containment, named) of all blocks that match; no block
        passes from one value of ``line`` to the next, which rises."""
        n, half = len(hashes), self.block // 2
        hit, rank = self.find(hashes)
        if not len(hit):
            none = np.zeros(0, np.int64)
            return none, none, none, none.astype(float), none.astype(bool)
        opens = np.flatnonzero(np.r_[True, line[1:] != line[:-1]])
        line_at = np.searchsorted(opens, hit, "right") - 1
        line_first, line_end = opens[line_at], np.r_[opens[1:], n][line_at]
        step = (hit - line_first) // half
        # A word lies in the block that starts in its own half and in the one before.
        earlier = step > 0
        start = np.r_[line_first + step * half, (line_first + (step - 1) * half)[earlier]]
        end = np.minimum(start + self.block, np.r_[line_end, line_end[earlier]])
        rank = np.r_[rank, rank[earlier]]
        pair, at = np.unique(start * len(self.vocabulary) + rank, return_index=True)
        rank, block_end, start = rank[at], end[at], pair // len(self.vocabulary)
        blocks, first, size = np.unique(start, return_index=True, return_counts=True)
        block = np.repeat(np.arange(len(blocks)), size)
        after = first[block] + size[block] - np.arange(len(rank))  # words from here on
        index = T.spread(self.first[rank], self.count[rank])
        source = np.repeat(np.arange(len(rank)), self.count[rank])
        template, place = self.template[index], self.place[index]
        need = self.need[template]
        long_enough = size[block[source]] >= need
        key = block[source] * len(self.sets) + template
        keys, lead = np.unique(key, return_index=True)  # the first shared word of each pair
        lead = lead[long_enough[lead]
                    & (np.minimum(self.size[template[lead]] - place[lead], after[source[lead]])
                       >= need[lead])]
        of_block, of_template = block[source[lead]], template[lead]
        words = T.spread(first[of_block], size[of_block])
        owner = np.repeat(np.arange(len(lead)), size[of_block])
        shared = np.bincount(owner, weights=self.member[of_template[owner], rank[words]],
                             minlength=len(lead))
        core = np.bincount(owner, weights=self.core[of_template[owner], rank[words]],
                           minlength=len(lead))
        share = shared / self.size[of_template]
        named = core == self.core.sum(1)[of_template]
        ok = shared >= self.need[of_template]
        begin = blocks[of_block[ok]]
        return begin, block_end[first[of_block[ok]]] - begin, of_template[ok], share[ok], named[ok]


def token_frequency(texts: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """Occurrences of each vocabulary word in all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary), np.int64)
        for batch in pieces(batches):
            for _, _, data, bounds in T.slices(batch.column(0)):
                hashes, _ = T.word_hashes(data, bounds, T.ALNUM, T.FOLDED)
                at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
                total += np.bincount(at[vocabulary[at] == hashes], minlength=len(vocabulary))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(total))), pa.array(total)], ["token", "n"])

    found = np.zeros(len(vocabulary), np.int64)
    if len(vocabulary):
        for row in texts.mapInArrow(run, "token long, n long").groupBy("token").agg(
                F.sum("n").alias("n")).collect():
            found[row.token] = row.n
    return found


def phrase_places(hashes: np.ndarray, text: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Words at which the phrase starts."""
    room = len(hashes) - len(phrase) + 1
    if room <= 0:
        return np.zeros(0, np.int64)
    at = np.flatnonzero(hashes[:room] == phrase[0])
    for i in range(1, len(phrase)):
        at = at[hashes[at + i] == phrase[i]]
    return at[text[at] == text[at + len(phrase) - 1]]


MATCHES = "array<struct<label:string,first:long,words:long,containment:double,named:boolean>>"
SCHEMA = (f"doc_id long, n_words long, phrases {MATCHES}, blocks {MATCHES}, wrapped {MATCHES}")


def scan(documents: DataFrame, templates: list[tuple[str, str]] | None = None,
         phrases: dict[str, str] | None = None, threshold: float = THRESHOLD,
         block: int = BLOCK, required: dict[str, str] | None = None) -> DataFrame:
    """All phrase places and all template matches of every whole text.

    ``documents`` has doc_id and text; other columns are not read. Rows: doc_id, n_words,
    ``phrases`` (label, first word, words, 1.0, true), ``blocks`` (label, first word and words of the
    block, containment, named) of blocks of single lines, and ``wrapped``, the same of those blocks of the
    whole text that pass a line end, all in text order and then in the order of the lists given. A
    notice of up to half a block lies whole in a block of one of the two kinds. A null text
    counts as empty and matches nothing; a null doc_id stays null; repeated rows give repeated
    results; an empty table gives no rows; blocks that match several templates are listed for each.
    """
    join = Join(TEMPLATES if templates is None else templates, threshold, block,
                REQUIRED if required is None else required)
    known = PHRASES if phrases is None else phrases
    fixed = [(hashes_of(p), label) for p, label in known.items()]
    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    join.order_by(token_frequency(rows.select("text"), join.vocabulary))
    kind = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()),
                               ("words", pa.int64()), ("containment", pa.float64()),
                               ("named", pa.bool_())]))

    def listed(found: list[tuple], n: int) -> pa.Array:
        out: list[list[dict]] = [[] for _ in range(n)]
        for owner, first, words, number, label, share, named in sorted(found):
            out[owner].append({"label": label, "first": first, "words": words,
                               "containment": share, "named": named})
        return pa.array(out, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            for first, end, data, bounds in T.slices(batch.column(1)):
                n = end - first
                start, stop, text = T.words(data, bounds, T.ALNUM)
                hashes = T.span_hash(T.prefix(data, T.FOLDED), start, stop)
                begins = np.searchsorted(text, np.arange(n))
                line = np.cumsum(data == 10)[start] + text if len(start) else start
                exact, similar, wrapped = [], [], []
                for number, (phrase, label) in enumerate(fixed):
                    for at in phrase_places(hashes, text, phrase).tolist():
                        own = int(text[at])
                        exact.append((own, at - int(begins[own]), len(phrase), number, label, 1.0,
                                      True))
                for found, within in (similar, line), (wrapped, text):
                    for at, words, number, share, named in zip(*(x.tolist() for x in join.matches(
                            hashes, within)), strict=True):
                        if found is wrapped and line[at] == line[at + words - 1]:
                            continue
                        own = int(text[at])
                        found.append((own, at - int(begins[own]), words, number,
                                      join.labels[number], share, named))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n),
                     pa.array(np.bincount(text, minlength=n).astype(np.int64)),
                     listed(exact, n), listed(similar, n), listed(wrapped, n)],
                    ["doc_id", "n_words", "phrases", "blocks", "wrapped"])

    return rows.mapInArrow(run, SCHEMA)


def labelled(found: DataFrame) -> DataFrame:
    """One line per document from ``scan``: places, and labels and best containment of the matches that
    name their license."""
    first = F.col("phrases.first")
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    named = F.filter(F.concat("phrases", "blocks", "wrapped"), lambda m: m["named"])
    of_all = lambda field: F.transform(named, lambda m: m[field])
    return found.select(
        "doc_id", "n_words", F.size("phrases").cast("long").alias("n_base"),
        F.array_min(first).alias("first_word"), F.array_max(first).alias("last_word"),
        joined(F.col("phrases.label")).alias("base_labels"),
        joined(of_all("label")).alias("labels"),
        F.coalesce(F.array_max(of_all("containment")), F.lit(0.0)).alias("score"))
