"""License scans by an exact set-similarity join of text blocks with license templates.

A block is as many consecutive words as the template has, and a tenth more, whatever lines they stand in (notices are wrapped);
every such block of a text is looked at, and words that lie further apart are no notice.
A template of n distinct tokens is contained in a block if at least ceil(t * n) of them occur there. Tokens
are put into one global order, rarest first, by the number of texts that hold them in the whole corpus, which Spark counts.
Then a block that contains a template holds one of the template's first n - ceil(t * n) + 1 tokens (the prefix filter), so only
the neighbourhoods of such tokens are read; there stand at least ceil(t * n) template tokens (the length filter); and after the
first shared token, at place i of the template and j of the neighbourhood, enough tokens are left in both (the positional filter).
In what passes the blocks are counted exactly, so none is missed.

Only tokens of templates can match, so the order is kept for those alone; templates are a fixed list of bounded size.
"""

from __future__ import annotations

from collections import Counter, defaultdict, deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm.common import base_columns, byte_texts, small_batches, table

#: Phrases whose words, standing consecutively, give a label.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Notices by label, as their licenses recommend them.
TEMPLATES = [
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License"),
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("all-rights-reserved", "All rights reserved."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above "
        "copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in "
        "the documentation and/or other materials provided with the distribution.",
    ),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    (
        "apache",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License.",
    ),
]
#: The share of a template's tokens that a block must hold: NUM / DEN.
NUM, DEN = 9, 10
_TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def tokens(text: bytes) -> list[bytes]:
    return text.translate(_TO_WORDS).split()


class Index:
    """The templates' prefixes under one order of tokens."""

    def __init__(self, templates: list[tuple[str, str]], texts_with: dict[bytes, int], num: int = NUM, den: int = DEN):
        sets = [(label, set(tokens(t.encode()))) for label, t in templates]
        vocabulary = sorted(set().union(*(s for _, s in sets)), key=lambda w: (texts_with.get(w, 0), w))
        self.rank = {w: i for i, w in enumerate(vocabulary)}
        self.labels = [label for label, _ in sets]
        self.sorted = [sorted(self.rank[w] for w in s) for _, s in sets]
        self.sets = [frozenset(s) for s in self.sorted]
        self.needed = [-(-len(s) * num // den) for s in self.sorted]
        self.spans = [(n := len(tokens(t.encode()))) + n // 10 for _, t in templates]
        self.postings: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for t, s in enumerate(self.sorted):
            for i, w in enumerate(s[: len(s) - self.needed[t] + 1]):
                self.postings[w].append((t, i))
        self.first_words = frozenset(vocabulary[w] for w in self.postings)

    def matches(self, block: set[bytes]) -> dict[int, int]:
        """Templates contained in a block, with the number of shared tokens."""
        mine = sorted(self.rank[w] for w in block if w in self.rank)
        seen: set[int] = set()
        out = {}
        for j, w in enumerate(mine):
            for t, i in self.postings.get(w, ()):
                need = self.needed[t]
                if t in seen or len(mine) < need:
                    continue
                seen.add(t)  # the first shared token in the common order
                if 1 + min(len(self.sorted[t]) - i, len(mine) - j) - 1 < need:
                    continue
                if (n := sum(x in self.sets[t] for x in mine[j:])) >= need:
                    out[t] = n
        return out

    def across(self, words: list[bytes]) -> dict[int, int]:
        """Templates contained in consecutive words, with the most tokens shared at one place."""
        out: dict[int, int] = {}
        for start, stop in self.neighbourhoods(words):
            near = words[start:stop]
            mine = [(p, self.rank[w]) for p, w in enumerate(near) if w in self.rank]
            for t in self.matches(set(near)):
                inside, count, best = deque(), Counter(), 0
                for p, w in mine:
                    if w in self.sets[t]:
                        inside.append((p, w))
                        count[w] += 1
                        while p - inside[0][0] >= self.spans[t]:
                            _, old = inside.popleft()
                            count[old] -= 1
                            if not count[old]:
                                del count[old]
                        best = max(best, len(count))
                if best >= self.needed[t]:
                    out[t] = max(best, out.get(t, 0))
        return out

    def neighbourhoods(self, words: list[bytes]) -> Iterator[tuple[int, int]]:
        """Ranges of words that hold every block with a prefix token."""
        wide, start, stop = max(self.spans, default=0), 0, 0
        for p, w in enumerate(words):
            if w in self.first_words:
                if p - wide + 1 > stop and stop:
                    yield start, stop
                    stop = 0
                if not stop:
                    start = max(0, p - wide + 1)
                stop = min(len(words), p + wide)
        if stop:
            yield start, stop


def _frequencies(vocabulary: frozenset[bytes]):
    """By token of the vocabulary: the texts that hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: Counter = Counter()
        for b in batches:
            for text in byte_texts(b.column(0)):
                count.update(vocabulary.intersection(tokens(text)))
        yield pa.RecordBatch.from_arrays([pa.array(list(count), pa.binary()), pa.array(list(count.values()), pa.int64())], ["token", "n"])

    return run


def places(joined: bytes, phrase: bytes) -> Iterator[int]:
    """The words (from 0) at which a phrase stands in words joined by, and within, single blanks; one pass over the text."""
    at, before, word = joined.find(phrase), 0, 0
    while at >= 0:
        word += joined.count(b" ", before, at)
        before = at
        yield word
        at = joined.find(phrase, at + 1)


def _scan(index: Index):
    phrases = [(b" " + p.encode() + b" ", label) for p, label in PHRASES.items()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text in byte_texts(b.column(1)):
                w = tokens(text)
                joined = b" " + b" ".join(w) + b" "
                found, base, more, score = [], set(), set(), 0.0
                for p, label in phrases:
                    if at := list(places(joined, p)):
                        found += at
                        base.add(label)
                if not index.first_words.isdisjoint(w):
                    for t, n in index.across(w).items():
                        more.add(index.labels[t])
                        score = max(score, n / len(index.sorted[t]))
                rows.append((len(w), len(found), min(found, default=None), max(found, default=None), ",".join(sorted(base)), ",".join(sorted(base | more)), 1.0 if base else score))
            cols = list(zip(*rows, strict=True)) or [()] * 7
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], ["doc_id", *names])

    return run


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """docs (doc_id, text) -> doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score; a row for each row.

    A null text is empty: no words, no labels, score 0. A document with a phrase scores 1, else its best containment. Equal rows
    and equal ids each give their row; ties in the order of tokens are broken by the tokens, and labels of equal score all stand.
    Extra columns play no part, whatever their names; an empty table gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    templates = TEMPLATES if templates is None else templates
    docs = base_columns(docs, doc_id=F.col("doc_id").cast("long"), text="text")
    vocabulary = frozenset(w for _, t in templates for w in tokens(t.encode()))
    counts = docs.select("text").mapInArrow(_frequencies(vocabulary), "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))
    index = Index(templates, {bytes(r.token): r.n for r in counts.collect()})
    held = spark.sparkContext.broadcast(index)
    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    return docs.mapInArrow(lambda batches: _scan(held.value)(batches), schema)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def license_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op10 that SQL can give."""
    return op10_license_scan(spark, sf_dir).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


BASE_ORACLE = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
p AS (SELECT string_split(phrase, ' ') AS ps, label FROM (VALUES {", ".join(f"('{p}', '{label}')" for p, label in PHRASES.items())}) v(phrase, label)),
m AS (SELECT doc_id, i - 1 AS place, label FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d), p WHERE w[i] = ps[1] AND w[i:i + len(ps) - 1] = ps)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(count(place) AS BIGINT) AS n_base, CAST(min(place) AS BIGINT) AS first_word, CAST(max(place) AS BIGINT) AS last_word,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS base_labels
FROM d LEFT JOIN m USING (doc_id) GROUP BY d.doc_id, len(w)
"""
