"""License scans: a positional rare-token index over licence templates.

Every template is a sequence of words. Its rarest words (highest IDF, measured over the whole corpus) are its anchors;
the index maps an anchor word to postings (template, position). A file looks its licence words up, each hit votes for
the start ``file position - template position``, votes are intersected by that relative position, and a start stands
when the template's mandatory key phrases are verified word by word at their places.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. Null and empty texts have no words, no label and
score 0. Repeated rows each get their own result row; other columns are ignored. Texts are scanned whole. An empty table
gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_slices

# Phrases and labels that every scan reports at all their places.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Customary notices and the sentences of public licence bodies, each a template of its own, so that a body
# pasted in part keeps its label; the parts in brackets are the mandatory key phrases, a star stands for any one word.
TEMPLATES = {
    "apache-2.0": [
        "licensed under the [apache license] version [2 0]",
        "you may [not use this file except in compliance with the license] you may obtain a copy of the license at",
        "unless required by applicable law or agreed to in writing software [distributed under the license is distributed on an as is "
        "basis] without warranties or conditions of any kind either express or implied",
        "subject to the terms and conditions of this license [each contributor hereby grants to you a perpetual worldwide non exclusive "
        "no charge royalty free irrevocable] copyright license to reproduce prepare derivative works of publicly display publicly perform "
        "sublicense and distribute the work and such derivative works in source or object form",
    ],
    "mit": [
        "released under the [mit license]",
        "licensed under the [mit license]",
        "[permission is hereby granted free of charge] to any person obtaining a copy of this software and associated "
        "documentation files the software to [deal in the software without restriction]",
        "the above copyright notice and this permission notice shall be [included in all copies or substantial portions of the software]",
        "[the software is provided as is without warranty of any kind] express or implied including but not limited to the warranties of "
        "merchantability fitness for a particular purpose and noninfringement",
        "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of "
        "contract tort or otherwise arising from out of or in connection with [the software or the use or other dealings in the software]",
    ],
    "bsd": [
        "[redistribution and use in source and binary forms] with or without modification are permitted provided that "
        "the following conditions are met",
        "licensed under the [bsd] 3 clause [license]",
        "licensed under the [bsd] 2 clause [license]",
        "[redistributions of source code must retain the above copyright notice] this list of conditions and the following disclaimer",
        "[redistributions in binary form must reproduce the above copyright notice] this list of conditions and the following disclaimer "
        "in the documentation and or other materials provided with the distribution",
        "this software is provided by the copyright holders and contributors as is and [any express or implied warranties] including but "
        "not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    ],
    "bsd-3-clause": [
        "neither the name of the copyright holder nor the names of its contributors may be used to [endorse or promote products derived "
        "from this software without specific prior written permission]",
    ],
    "bsd-4-clause": ["[all advertising materials mentioning features or use of this software must display the following acknowledgement]"],
    "isc": [
        "[permission to use copy modify and or distribute this software] for any purpose with or without fee is hereby granted",
        "the software is provided as is and the [author disclaims all warranties with regard to this software] including all implied "
        "warranties of merchantability and fitness",
    ],
    "zlib": ["[the origin of this software must not be misrepresented] you must not claim that you wrote the original software"],
    "bsl-1.0": ["distributed under the [boost software license] version 1 0"],
    "gpl-notice": [
        "this program is free software you can redistribute it and or modify it under the terms of the [gnu general "
        "public license] as published by the free software foundation",
        "this program is [distributed in the hope that it will be useful but without any warranty] without even the implied warranty of "
        "merchantability or fitness for a particular purpose",
        "you should have received a copy of the [gnu general public license] along with this program",
    ],
    "gpl-2.0": ["[the licenses for most software are designed to take away your freedom to share and change it]"],
    "gpl-3.0": ["the [gnu general public license is a free copyleft license for software and other kinds of works]"],
    "lgpl": ["under the terms of the [gnu lesser general public license]"],
    "agpl": ["under the terms of the [gnu affero general public license]"],
    "mpl-2.0": [
        "this source code form is subject to the terms of the [mozilla public license] v 2 0",
        "if a copy of the [mpl was not distributed with this file] you can obtain one at",
    ],
    "epl-2.0": ["made available under the terms of the [eclipse public license] v 2 0"],
    "unlicense": [
        "this is [free and unencumbered software] released into the public domain",
        "[anyone is free to copy modify publish use compile sell or distribute this software] either in source code form or as a compiled "
        "binary for any purpose commercial or non commercial and by any means",
    ],
    "cc-by-nc": ["licensed under [cc by nc] 4 0"],
    "cc-by-sa": ["licensed under [cc by sa] 4 0"],
    "cc0": ["released under [cc0] 1 0"],
    "proprietary": [f"copyright c {'* ' * n}[all rights reserved]" for n in range(7)],  # year and holder: up to six words
}

ANY = b"*"  # no word holds a star

_TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, matches array<struct<label:string,start:bigint,end:bigint,coverage:double>>"
)


def file_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TO_WORDS).split() if text else []


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]
    keys: tuple[tuple[int, tuple[bytes, ...]], ...]  # mandatory phrases: place in the template, words
    base: bool


def parse_templates(base: dict[str, str] = BASE_PHRASES, more: dict[str, list[str]] = TEMPLATES) -> list[Template]:
    out = []
    for phrase, label in base.items():
        words = tuple(phrase.encode().split())
        out.append(Template(label, words, ((0, words),), True))
    for label, sentences in more.items():
        for sentence in sentences:
            words, keys, open_at = [], [], None
            for token in sentence.split():
                if token.startswith("["):
                    open_at = len(words)
                words.append(token.strip("[]").encode())
                if token.endswith("]"):
                    keys.append((open_at, tuple(words[open_at:])))
            out.append(Template(label, tuple(words), tuple(keys), False))
    return out


def word_idf(docs: DataFrame, text_col: str, vocabulary: set[bytes]) -> dict[bytes, float]:
    """IDF of the licence words over all documents: counted per task, summed by Spark; one row per licence word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, df = 0, Counter()
        for batch in text_slices(batches):
            for text in batch.column(0).to_pylist():
                n += 1
                df.update(vocabulary.intersection(file_words(text)))
        words = [w.decode() for w in df]
        yield pa.RecordBatch.from_arrays([pa.array([*words, ""], pa.string()), pa.array([*df.values(), n], pa.int64())], names=["word", "n"])

    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    n_of = {r["word"]: r["n"] for r in rows}
    total = n_of.get("", 0)
    return {w: math.log((total + 1) / (n_of.get(w.decode(), 0) + 1)) for w in vocabulary}


class RareWordIndex:
    """Postings of each template's ``anchors`` rarest words. A base phrase needs one: all its words are verified."""

    def __init__(self, templates: list[Template], idf: dict[bytes, float], anchors: int = 3, min_coverage: float = 0.6):
        self.templates, self.min_coverage = templates, min_coverage
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        self.need: list[int] = []
        for t, tpl in enumerate(templates):
            named = [i for i, w in enumerate(tpl.words) if w != ANY]
            rarest = sorted(named, key=lambda i: (-idf[tpl.words[i]], i))[: 1 if tpl.base else anchors]
            for i in rarest:
                self.postings[tpl.words[i]].append((t, i))
            self.need.append(1 if tpl.base else min(2, len(rarest)))
        self.postings = dict(self.postings)

    def matches(self, words: list[bytes]) -> list[tuple[Template, int, float]]:
        postings, votes = self.postings, Counter()
        for at, word in enumerate(words):
            if word in postings:
                for t, i in postings[word]:
                    votes[t, at - i] += 1
        found = []
        for (t, start), n in votes.items():
            tpl = self.templates[t]
            if n < self.need[t]:
                continue
            if all(start + i >= 0 and tuple(words[start + i : start + i + len(key)]) == key for i, key in tpl.keys):
                same = sum(0 <= start + i < len(words) and words[start + i] == w for i, w in enumerate(tpl.words))
                named = len(tpl.words) - tpl.words.count(ANY)
                if tpl.base or same >= self.min_coverage * named:
                    found.append((tpl, start, same / named))
        return sorted(found, key=lambda m: (m[1], m[0].label, m[0].words))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: list[Template] | None = None, anchors: int = 3) -> DataFrame:
    """One row per document: counts, labels, score (best share of a template's words found in place) and all matches."""
    templates = templates or parse_templates()
    idf = word_idf(docs, text_col, {w for t in templates for w in t.words if w != ANY})
    index = RareWordIndex(templates, idf, anchors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("doc_id", pa.int64())] + [(c, pa.int64()) for c in ("n_words", "n_base", "first_word", "last_word")]
            + [("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
               ("matches", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("coverage", pa.float64())])))]
        )
        for batch in text_slices(batches):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = file_words(text)
                found = index.matches(words)
                base = [(t, s) for t, s, _ in found if t.base]
                starts = [s for _, s in base]
                rows.append({
                    "doc_id": doc_id, "n_words": len(words), "n_base": len(base),
                    "first_word": min(starts, default=None), "last_word": max(starts, default=None),
                    "base_labels": ",".join(sorted({t.label for t, _ in base})),
                    "labels": ",".join(sorted({t.label for t, _, _ in found})),
                    "score": max((c for _, _, c in found), default=0.0),
                    "matches": [{"label": t.label, "start": s, "end": s + len(t.words), "coverage": c} for t, s, c in found],
                })
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).drop("matches")
