"""Operators held against plain searches: licence templates, toxic patterns, a flat file of many blocks, the language sample."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fanpulse.llm import byte_language, license_scan, separator_scan, toxicity

# Customary licence bodies as files show them.
MIT_BODY = """The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""
BSD_CLAUSES = """1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
   following disclaimer.
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
   derived from this software without specific prior written permission."""
APACHE_BODY = """you may not use this file except in compliance with the License. You may obtain a copy of the License at
    http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."""


@pytest.mark.parametrize(
    "text, labels",
    [
        (MIT_BODY, "mit"), (BSD_CLAUSES, "bsd,bsd-3-clause"), (APACHE_BODY, "apache-2.0"),
        ("Copyright (c) 2031 Tideford Works Ltd. All rights reserved.", "proprietary,reserved"), ("Copyright (C), all rights reserved", "proprietary,reserved"),
        ("all rights reserved by the holder", "reserved"), ("the software is provided for fun without any kind of warranty", ""),
        ("you may use this file and obtain a copy at the desk", ""), ("under the terms of the GNU Affero General Public License", "agpl,gpl"),
    ],
)
def test_license_bodies(spark, text, labels):
    rows = [(1, text), (2, f"unrelated words before {text} and many after it " * 2)]
    assert {r.labels for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == {labels}


def _template_search(templates, idf, words, anchors=3, share=0.6):
    found = []
    for t in templates:
        named = [i for i, w in enumerate(t.words) if w != b"*"]
        rarest = sorted(named, key=lambda i: (-idf[t.words[i]], i))[: 1 if t.base else anchors]
        for start in range(-len(t.words), len(words)):
            same = {i for i in named if 0 <= start + i < len(words) and words[start + i] == t.words[i]}
            keys = {i + k for i, key in t.keys for k in range(len(key))}
            if keys <= same and len(same & set(rarest)) >= (1 if t.base else min(2, len(rarest))) and (t.base or len(same) >= share * len(named)):
                found.append((t.label, start, start + len(t.words), round(len(same) / len(named), 9)))
    return sorted(found)


def test_license_templates_match_plain_search(spark):
    rng, templates = random.Random(11), license_scan.parse_templates()
    texts = []
    for i in range(120):
        words = []
        for _ in range(rng.randrange(6)):
            part = [w.decode() if w != b"*" else "holder" for w in rng.choice(templates).words]
            for _ in range(rng.randrange(4)):
                part[rng.randrange(len(part))] = rng.choice(["other", "the", "license", "copyright"])
            words += part[rng.randrange(2) :] + ["filler"] * rng.randrange(3)
        texts.append(" ".join(words).title() if i % 2 else ", ".join(words))
    split = [license_scan.file_words(t) for t in texts]
    idf = {w: math.log((len(texts) + 1) / (sum(w in s for s in split) + 1)) for t in templates for w in t.words}
    got = license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)).collect()
    want = [_template_search(templates, idf, s) for s in split]
    assert sum(map(len, want)) > 200
    for r in got:
        assert sorted((m.label, m.start, m.end, round(m.coverage, 9)) for m in r.matches) == want[r.doc_id]
        assert abs(r.score - max((c for *_, c in want[r.doc_id]), default=0.0)) < 1e-8


def _naive_strength(folded, lexicon):
    """Every pattern at every place, one hit per place, places under an exception phrase left out."""
    places = range(len(folded))
    hits = {s: max(w for p, w in lexicon.weights.items() if folded.startswith(p, s)) for s in places if any(folded.startswith(p, s) for p in lexicon.weights)}
    under = {k for e in lexicon.exceptions for s in places if folded.startswith(f" {e} ", s) for k in range(s, s + len(e) + 1)}
    hits = {s: w for s, w in hits.items() if s not in under}
    return sum(hits.values()), len(hits), len(folded.split())


def test_toxicity_scores_match_plain_search(spark):
    rng = random.Random(4)
    words = ["idiot", "idiotic", "1d10t", "mоron", "stupid", "scum", "pond", "soap", "proof", "clown", "fish", "kind", "words", "st0p", "trash", "can", "7", "-"]
    texts = [" ".join(rng.choices(words, k=rng.randrange(40))) for _ in range(150)] + [None, "", "IDIOT", "idiot proof", "x " * 40_000 + "moron"]
    lexicon = toxicity.Lexicon({" idio": 3.5, " idiot ": 4.0, " moron ": 4.0, " stup": 2.0, " scum ": 1.5, " clown ": 2.5, " trash ": 1.0}, set(toxicity.EXCEPTIONS), 0.8, -1.5)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in toxicity.score(docs, lexicon).collect()}
    for i, text in enumerate(texts):
        w, n, size = _naive_strength(toxicity.fold(text), lexicon)
        want = 1 / (1 + math.exp(-(0.8 * w / (1 + math.log1p(size / 200)) - 1.5)))
        assert (got[i].n_hits, got[i].n_words) == (n, size) and abs(got[i].score - want) < 1e-12, text


def test_toxicity_weights_are_counted_log_odds(spark):
    rng = random.Random(9)
    rows = []
    for i in range(400):
        toxic = i % 4 == 0
        text = " ".join(rng.choices(["river", "market", "garden", "letter", "window"], k=12)) + (rng.choice([" gronkel", " vexwort", " gronkelish"]) if toxic else "")
        rows.append((i, text, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    lexicon = toxicity.fit(docs.drop("toxic"), docs.select("doc_id", "toxic"))
    n1, n0 = sum(r[2] for r in rows), sum(1 - r[2] for r in rows)
    for pattern, weight in lexicon.weights.items():
        if pattern.strip() in toxicity.SEED:
            continue
        a, b = (sum(pattern in toxicity.fold(t) for _, t, y in rows if y == label) for label in (1, 0))
        assert abs(weight - min(6.0, math.log((a + 0.5) / (n1 + 1)) - math.log((b + 0.5) / (n0 + 1)))) < 1e-9
    assert {" gron", " vexw"} <= set(lexicon.weights) and not any(p.strip() in "river market garden letter window" for p in lexicon.weights)


def test_one_file_of_many_blocks(spark):
    """All blocks in one file: the separators are not carried through the file's window."""
    rng = np.random.default_rng(6)
    ids = rng.integers(0, 40, 60_000)
    ids[20_000:24_000] = 1  # a document over many blocks
    blocks = [(3, k, bytearray(ids[a : a + 16].astype("<u2").tobytes())) for k, a in enumerate(range(0, len(ids), 16))]
    counts = separator_scan.count_tokens(spark.createDataFrame(blocks, "file int, block int, data binary").repartition(5), 9)
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert not any("ends" in line.split("windowspecdefinition")[0].replace("n_ends", "") for line in plan.splitlines() if "Window [" in line)
    ends = np.flatnonzero(ids == 9).tolist()
    starts = [0, *(e + 1 for e in ends)]
    want = [(i, s, e - s, False) for i, (s, e) in enumerate(zip(starts, ends))]
    if starts[-1] < len(ids):
        want.append((len(ends), starts[-1], len(ids) - starts[-1], True))
    assert sorted((r.ordinal, r.start, r.n_tokens, r.open) for r in counts.collect()) == want
    assert separator_scan.count_tokens(spark.createDataFrame([], "file int, block int, data binary"), 9).count() == 0
    names = [(3, k, list(range(k * 5, k * 5 + 5))) for k in range(300)] + [(4, 0, [7, None])]
    got = separator_scan.names_of(spark.createDataFrame(names, "file int, block int, doc_ids array<long>")).collect()
    assert {(r.file, r.ordinal, r.doc_id) for r in got} == {(3, i, i) for i in range(1500)} | {(4, 0, 7), (4, 1, None)} and len(got) == 1502


def test_language_sample_is_the_least_hashes(spark, monkeypatch):
    """A language of most rows is sampled in parts; the chosen texts are those of the least hashes, as without parts."""
    seen = {}
    monkeypatch.setattr(byte_language, "train", lambda segments, labels, languages, **more: seen.update(labels=labels, segments=segments, languages=languages))
    rows = [(f"text {i} of many words", "aa" if i % 10 else "bb") for i in range(900)]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(7)
    byte_language.fit(docs, bound=60)
    hashed = docs.withColumn("h", F.xxhash64("text")).orderBy("lang", "h").collect()
    chosen = [t for lang in ("aa", "bb") for t in [r.text for r in hashed if r.lang == lang][:30]]
    segments, counts = byte_language.segments_of(chosen)
    assert seen["languages"] == ["aa", "bb"] and (np.bincount(seen["labels"]) == [30, 30]).all()
    assert (counts == 1).all() and (seen["segments"] == segments).all()
