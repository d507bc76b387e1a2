"""Toxicity: a weighted lexicon matched by Aho-Corasick.

Texts are folded first: lower case, homoglyphs (Cyrillic, Greek, full-width) to Latin letters, digit and sign
substitutions inside words (``1d10t``, ``m@ron``) to letters, everything else that is no letter to one blank. Patterns
are word beginnings (`` idio``) or whole words (`` idiot ``); exception phrases cover hits that mean no harm. The score
is the weight of the uncovered hits, normalised by length and put on a 0-1 scale by a logistic curve.

The weights are log odds of a pattern's document frequency in toxic against other labelled documents. They, the learned
exceptions and the curve are fitted on the labelled rows the caller passes, at most ``TRAIN_DOCS`` of them in the order
of a hash of their ids (a documented bound); scoring covers every document and its whole text. Without usable labels the
seed lexicon alone scores.

Null and empty texts score like a text without a hit. Labels, lang, source and doc_id are never inputs of a score. A
document labelled twice counts as toxic if any of its labels says so; null labels are ignored. Repeated rows each get
their own result row.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored, table, text_slices

TRAIN_DOCS = 12_000
LEAST_TOXIC_DOCS = 4  # a pattern is learned from so many toxic documents at least,
LEAST_REPEATS = 6  # or from two, if their words show it so often and no clean document holds it
STEMS = (4, 5, 6, 7)  # lengths of the word beginnings that are tried

# Seed words with weights, and phrases in which such words mean no harm.
SEED = {"idiot": 4.0, "moron": 4.0, "stupid": 3.0, "worthless": 3.0, "pathetic": 3.0, "scum": 4.0}
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "idiot proof", "pond scum", "soap scum")

# Look-alike letters, and signs that stand for letters inside a word.
HOMOGLYPHS = dict(zip("аеорсхуіјѕһԁӏвмнткαορνικτυ", "aeopcxyijshdlbmhtkaopviktu"))
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}

_HOMO = str.maketrans(HOMOGLYPHS)
_FOREIGN = re.compile("[" + "".join(HOMOGLYPHS) + "̀-ͯ​-‍！-～]")
_MIXED = re.compile(r"[013457@$!]+(?=[^\W\d_])|(?<=[^\W\d_])[013457@$]+", re.UNICODE)
_SUB = str.maketrans(SUBSTITUTES)
_NO_LETTER = re.compile(r"[\W\d_]+")
_LETTER_SIGN = re.compile(r"[^\W\d_][0134557@$!]+[^\W\d_]|[01345$@][^\W\d_]{2}")
_LATIN = re.compile("[a-z]")


def _fold_word(word: str) -> str:
    """Look-alikes become Latin only inside words that hold Latin letters: real Greek or Cyrillic words stay."""
    return word.translate(_HOMO) if _LATIN.search(word) else word


def fold(text: str | None) -> str:
    """The folded text, words between single blanks, with a blank at either end."""
    if not text:
        return " "
    low = text.lower()
    if not low.isascii() and _FOREIGN.search(low):
        low = unicodedata.normalize("NFKC", low.replace("​", "").replace("‌", "").replace("‍", ""))
        low = re.sub(r"\w+", lambda m: _fold_word(m[0]), low)
    if _LETTER_SIGN.search(low):
        low = _MIXED.sub(lambda m: m[0].translate(_SUB), low)
    return f" {_NO_LETTER.sub(' ', low).strip()} "


def patterns_of(folded: str) -> Counter[str]:
    """Word beginnings and whole words with the number of places that show them."""
    out: Counter[str] = Counter()
    for word, n in Counter(folded.split()).items():
        for size in STEMS:
            if len(word) >= size:
                out[f" {word[:size]}"] += n
        out[f" {word} "] += n
    return out


@dataclass
class Lexicon:
    weights: dict[str, float]
    exceptions: set[str] = field(default_factory=set)
    slope: float = 1.0
    offset: float = -2.5

    def automaton(self) -> ahocorasick.Automaton:
        a = ahocorasick.Automaton()
        for pattern, weight in self.weights.items():
            a.add_word(pattern, (len(pattern), weight))
        for phrase in self.exceptions:
            a.add_word(f" {phrase} ", (len(phrase) + 2, None))
        a.make_automaton()
        return a


def strength(folded: str, automaton: ahocorasick.Automaton) -> tuple[float, int, int]:
    """(sum of weights of uncovered hits, one per word place, hits; words)."""
    hits: dict[int, float] = {}
    covered: list[tuple[int, int]] = []
    if len(automaton):
        for end, (length, weight) in automaton.iter(folded):
            start = end - length + 1
            if weight is None:
                covered.append((start, end))
            else:
                hits[start] = max(weight, hits.get(start, 0.0))
    for a, b in covered:
        hits = {s: w for s, w in hits.items() if not a <= s < b}
    return sum(hits.values()), len(hits), folded.count(" ") - 1 if len(folded) > 1 else 0


def normalised(weight: float, n_words: int) -> float:
    return weight / (1.0 + math.log1p(n_words / 200.0))


def _labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, bound: int) -> DataFrame:
    y = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("y_id")).agg(F.max(label_col).alias("y"))
    y = y.orderBy(F.xxhash64("y_id"), "y_id").limit(bound)
    one = docs.select(F.col(id_col).alias("y_id"), F.col(text_col).alias("text"))
    return one.join(F.broadcast(y), "y_id")  # at most ``bound`` rows of two numbers


def _counts(train: DataFrame, toxic: int, known: frozenset[str] | None, keep) -> dict[str, tuple[int, int]]:
    """(documents, places) of patterns among the training rows of one label; of all patterns, or of the known ones."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df: Counter[str] = Counter()
        tf: Counter[str] = Counter()
        for batch in text_slices(batches):
            for text in batch.column(0).to_pylist():
                found = patterns_of(fold(text))
                if known is not None:
                    found = {p: found[p] for p in known & found.keys()}
                df.update(found.keys())
                tf.update(found)
        arrays = [pa.array(list(df), pa.string()), *(pa.array([c[p] for p in df], pa.int64()) for c in (df, tf))]
        yield pa.RecordBatch.from_arrays(arrays, names=["pattern", "df", "tf"])

    rows = train.where((F.col("y") > 0) == F.lit(bool(toxic))).select("text").mapInArrow(count, "pattern string, df long, tf long")
    rows = rows.groupBy("pattern").agg(F.sum("df").alias("df"), F.sum("tf").alias("tf")).where(keep)
    return {r["pattern"]: (r["df"], r["tf"]) for r in rows.collect()}


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", bound: int = TRAIN_DOCS) -> Lexicon:
    """Learn the lexicon from labelled rows. What reaches the driver is bounded by ``bound`` (patterns of that sample)."""
    train = stored(_labelled(docs, labels, id_col, text_col, label_col, bound), "toxic-train")
    size = {r["t"]: r["n"] for r in train.groupBy((F.col("y") > 0).alias("t")).agg(F.count("*").alias("n")).collect()}
    n1, n0 = size.get(True, 0), size.get(False, 0)
    seed = Lexicon({f" {w} ": x for w, x in SEED.items()}, set(EXCEPTIONS))
    if n1 < LEAST_TOXIC_DOCS or n0 < LEAST_TOXIC_DOCS:
        return seed
    enough = (F.col("df") >= LEAST_TOXIC_DOCS) | ((F.col("df") >= 2) & (F.col("tf") >= LEAST_REPEATS))
    toxic = _counts(train, 1, None, enough)
    clean = _counts(train, 0, frozenset(toxic), F.lit(True))
    odds = {p: math.log((a + 0.5) / (n1 + 1)) - math.log((clean.get(p, (0, 0))[0] + 0.5) / (n0 + 1)) for p, (a, _) in toxic.items()}
    # a pattern must be rare in clean text: held by over four times as many toxic documents, and far likelier there
    good = {
        p for p, (a, _) in toxic.items()
        if odds[p] >= 2.5 and (a >= 4 * clean.get(p, (0, 0))[0] if a >= LEAST_TOXIC_DOCS else p not in clean)
    }
    kept: dict[str, float] = {}
    for p in sorted(good, key=lambda p: (len(p), p)):
        if not any(p[:n] in kept for n in range(min(STEMS) + 1, len(p))):  # the shortest beginning stands for the longer ones
            kept[p] = min(odds[p], 6.0)
    exceptions = set(EXCEPTIONS) | {p.strip() for p in toxic if p.endswith(" ") and any(p[:n] in kept for n in range(5, len(p))) and odds[p] < -0.5}
    for p, w in seed.weights.items():
        if p not in clean and not any(p[:n] in kept for n in range(5, len(p) + 1)):
            kept[p] = w
    lexicon = Lexicon(kept, exceptions)
    lexicon.slope, lexicon.offset = _curve(train, lexicon)
    return lexicon


def _curve(train: DataFrame, lexicon: Lexicon) -> tuple[float, float]:
    """Logistic curve over the normalised weight, fitted by Newton steps with a small ridge (one feature, bounded rows)."""

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = lexicon.automaton()
        for batch in text_slices(batches):
            x = [normalised(s[0], s[2]) for s in (strength(fold(t), a) for t in batch.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.float64()), batch.column(1).cast(pa.int64())], names=["x", "y"])

    rows = train.select("text", F.col("y").cast("long").alias("y")).mapInArrow(features, "x double, y long").collect()
    rows = sorted((min(r["x"], 30.0), float(r["y"] > 0)) for r in rows)  # one order of sums, whatever the partitions
    x = np.array([[1.0, a] for a, _ in rows])
    y = np.array([b for _, b in rows])
    beta = np.zeros(2)
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(2), x.T @ (y - p) - 0.05 * beta)
        beta += step
        if np.abs(step).max() < 1e-6:
            break
    return float(max(beta[1], 0.0)), float(beta[0])


def score(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text", score_col: str | None = None) -> DataFrame:
    """doc_id, score, n_hits, n_words; with ``score_col``, all columns of ``docs`` and the score under that name."""

    def of(texts: list[str | None], a: ahocorasick.Automaton) -> list[tuple[float, int, int]]:
        out = []
        for t in texts:
            w, n, words = strength(fold(t), a)
            out.append((1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, lexicon.slope * normalised(w, words) + lexicon.offset)))), n, words))
        return out

    if score_col:
        docs = docs.drop(score_col)
        at, names = docs.columns.index(text_col), [*docs.columns, score_col]

        def beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            a = lexicon.automaton()
            for batch in text_slices(batches):
                scores = [s for s, _, _ in of(batch.column(at).to_pylist(), a)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=names)

        return docs.mapInArrow(beside, T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = lexicon.automaton()
        for batch in text_slices(batches):
            got = of(batch.column(1).to_pylist(), a)
            cols = [batch.column(0), *(pa.array(c, t) for c, t in zip(zip(*got), (pa.float64(), pa.int64(), pa.int64())))]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "score", "n_hits", "n_words"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, score double, n_hits long, n_words long")


def held_out(id_col: str = "doc_id"):
    """Rows that are never learned from: crc32 of the id as text, mod 4, is 2. A null id is hashed as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    lexicon = fit(docs, labels.where(~held_out()))
    return score(docs, lexicon).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "n_hits", "n_words")
