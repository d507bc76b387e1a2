"""Language identification: a bidirectional gated recurrent network over bytes, trained in numpy.

A text's UTF-8 bytes are cut into segments of ``SEGMENT`` bytes; in each, two gated recurrent units (update and reset gates)
run over the bytes, one from either end, and a softmax over both states labels every byte. A document's probabilities are
the mean over all its bytes, so whole texts count, and memory is bounded by the segments worked on at once.

Training is backpropagation through time with Adam on the driver, over a bounded sample: at most ``TRAIN_DOCS`` documents in
all, the same number of each language in the order of a hash, ``TRAIN_SEGMENTS`` segments spread over each text. The sample,
the network (a few thousand numbers) and its cost stay the same whatever the corpus; prediction covers every document.

Nulls: null, empty and letterless texts are ``und`` with score 0; a null lang is never learned. If nothing can be learned
(empty tables, no languages) all are ``und``. Repeated rows get equal results, as a text's result depends on that text alone.
Ids, lang and source are no inputs of a prediction. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table, text_slices

SEGMENT = 64
HIDDEN = 8
TRAIN_DOCS = 1_600
TRAIN_SEGMENTS = 4
SALTS = 16  # parts of a language when its sample is taken
STEPS = 200
BATCH = 128
AT_ONCE = 2048  # segments in the network at once
PAD = 256  # the sign after a text's end: its update gate stays shut
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
_SHUT = -40.0


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Gates:
    """One direction: an input table per byte (update, reset, candidate), recurrent weights, the candidate's own bias."""

    table: np.ndarray  # (257, 3 * hidden)
    inner: np.ndarray  # (hidden, 3 * hidden)
    bias: np.ndarray  # (hidden,)

    @staticmethod
    def new(hidden: int, rng: np.random.Generator) -> Gates:
        table = rng.normal(0, 0.3, (PAD + 1, 3 * hidden)).astype(np.float32)
        table[PAD] = 0
        table[PAD, :hidden] = _SHUT
        return Gates(table, rng.normal(0, hidden**-0.5, (hidden, 3 * hidden)).astype(np.float32), np.zeros(hidden, np.float32))

    def states(self, ids: np.ndarray) -> tuple[np.ndarray, list]:
        """``ids``: (time, batch). States after each step, and what the way back needs."""
        h = self.inner.shape[0]
        state, out, kept = np.zeros((ids.shape[1], h), self.table.dtype), [], []
        for row in ids:
            x, u = self.table[row], state @ self.inner
            z, r = _sigmoid(x[:, :h] + u[:, :h]), _sigmoid(x[:, h : 2 * h] + u[:, h : 2 * h])
            own = u[:, 2 * h :] + self.bias
            n = np.tanh(x[:, 2 * h :] + r * own)
            kept.append((state, z, r, own, n))
            state = state + z * (n - state)
            out.append(state)
        return np.stack(out), kept

    def back(self, ids: np.ndarray, kept: list, grads: np.ndarray) -> list[np.ndarray]:
        """Gradients of table, inner and bias from those of all states, through time."""
        h = self.inner.shape[0]
        d_inner, d_bias, later = np.zeros_like(self.inner), np.zeros_like(self.bias), np.zeros_like(grads[0])
        d_inputs = np.zeros((*ids.shape, 3 * h), self.table.dtype)
        for t in range(len(ids) - 1, -1, -1):
            state, z, r, own, n = kept[t]
            d = grads[t] + later
            d_n = d * z * (1 - n * n)
            d_z, d_r = d * (n - state) * z * (1 - z), d_n * own * r * (1 - r)
            d_own = d_n * r
            d_inputs[t] = np.concatenate([d_z, d_r, d_n], axis=1)
            d_u = np.concatenate([d_z, d_r, d_own], axis=1)
            d_inner += state.T @ d_u
            d_bias += d_own.sum(axis=0)
            later = d * (1 - z) + d_u @ self.inner.T
        seen = (ids.reshape(-1, 1) == np.arange(PAD + 1)).astype(self.table.dtype)  # one sign per place
        d_table = seen.T @ d_inputs.reshape(-1, 3 * h)
        d_table[PAD] = 0
        return [d_table, d_inner, d_bias]


@dataclass
class Network:
    languages: list[str]
    ahead: Gates
    behind: Gates
    out: np.ndarray  # (2 * hidden, languages)
    offset: np.ndarray

    def step(self, ids: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross-entropy over all bytes of (time, batch) ids, and its gradients."""
        real = ids != PAD
        f, kept_f = self.ahead.states(ids)
        b, kept_b = self.behind.states(ids[::-1])
        both = np.concatenate([f, b[::-1]], axis=2)
        logits = both @ self.out + self.offset
        logits -= logits.max(axis=2, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(axis=2, keepdims=True)
        at = np.broadcast_to(labels, ids.shape)
        n = max(1, int(real.sum()))
        chosen = np.take_along_axis(p, at[:, :, None], axis=2)[:, :, 0]
        loss = float(-np.log(np.maximum(chosen[real], 1e-12)).sum() / n)
        d = p.copy()
        np.put_along_axis(d, at[:, :, None], chosen[:, :, None] - 1, axis=2)
        d *= (real / n).astype(d.dtype)[:, :, None]
        size = both.shape[2]
        d_out, d_offset = both.reshape(-1, size).T @ d.reshape(-1, d.shape[2]), d.sum(axis=(0, 1))
        d_both = d @ self.out.T
        h = size // 2
        grads_f = self.ahead.back(ids, kept_f, d_both[:, :, :h])
        grads_b = self.behind.back(ids[::-1], kept_b, d_both[::-1, :, h:])
        return loss, [*grads_f, *grads_b, d_out, d_offset]

    def parameters(self) -> list[np.ndarray]:
        return [self.ahead.table, self.ahead.inner, self.ahead.bias, self.behind.table, self.behind.inner, self.behind.bias, self.out, self.offset]


def train(segments: np.ndarray, labels: np.ndarray, languages: list[str], hidden: int = HIDDEN, steps: int = STEPS, seed: int = 5) -> Network:
    """``segments``: (number, SEGMENT) signs; ``labels``: places in ``languages``. Adam over random batches."""
    rng = np.random.default_rng(seed)
    net = Network(languages, Gates.new(hidden, rng), Gates.new(hidden, rng), rng.normal(0, 0.1, (2 * hidden, len(languages))).astype(np.float32), np.zeros(len(languages), np.float32))
    first = [np.zeros_like(p) for p in net.parameters()]
    second = [np.zeros_like(p) for p in net.parameters()]
    for t in range(1, steps + 1):
        at = rng.integers(0, len(segments), min(BATCH, len(segments)))
        _, grads = net.step(segments[at].T, labels[at])
        rate = 0.03 * min(1.0, t / 20) * (1 - 0.9 * t / steps)
        norm = max(1.0, float(np.sqrt(sum((g * g).sum() for g in grads))))  # a long step is cut back
        for p, g, m, v in zip(net.parameters(), grads, first, second):
            g = g / norm
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return net


def segments_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(segments of all texts one after another, padded; number of segments of each text)."""
    data = [t.encode("utf-8", "surrogatepass") for t in texts]
    counts = np.array([-(-len(d) // SEGMENT) for d in data], np.int64)
    out = np.full((int(counts.sum()), SEGMENT), PAD, np.uint16)
    flat, at = out.reshape(-1), 0
    for d, n in zip(data, counts.tolist()):
        flat[at : at + len(d)] = np.frombuffer(d, np.uint8)
        at += n * SEGMENT
    return out, counts


class Reader:
    """The network laid out for reading many segments at once, in single precision; a state is a column."""

    def __init__(self, net: Network):
        self.size = len(net.languages)
        self.parts = []
        for gates in (net.ahead, net.behind):
            h = gates.inner.shape[0]
            half = np.ones(3 * h)
            half[: 2 * h] = 0.5  # sigmoid(x) = (1 + tanh(x / 2)) / 2
            table = (gates.table * half).T
            self.parts.append((np.ascontiguousarray(table, np.float32), np.ascontiguousarray((gates.inner * half).T, np.float32), gates.bias.astype(np.float32)[:, None]))
        self.out, self.offset = np.ascontiguousarray(net.out.T, np.float32), net.offset.astype(np.float32)[:, None]

    def _run(self, part: tuple, ids: np.ndarray, out: np.ndarray, order: range) -> None:
        table, inner, bias = part
        h = bias.shape[0]
        state = np.zeros((h, ids.shape[1]), np.float32)
        x, u = (np.empty((3 * h, ids.shape[1]), np.float32) for _ in range(2))
        for t in order:
            np.take(table, ids[t], axis=1, out=x, mode="clip")
            np.matmul(inner, state, out=u)
            gates, own = u[: 2 * h], u[2 * h :]
            gates += x[: 2 * h]
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5
            own += bias
            own *= gates[h:]
            own += x[2 * h :]
            np.tanh(own, out=own)
            own -= state
            own *= gates[:h]
            state += own
            out[:, t] = state

    def probabilities(self, segments: np.ndarray) -> np.ndarray:
        """(languages, SEGMENT, number): the label probabilities of every byte."""
        n = len(segments)
        ids = np.ascontiguousarray(segments.T).astype(np.int64)
        h = self.parts[0][2].shape[0]
        states = np.empty((2 * h, SEGMENT, n), np.float32)
        self._run(self.parts[0], ids, states[:h], range(SEGMENT))
        self._run(self.parts[1], ids, states[h:], range(SEGMENT - 1, -1, -1))
        p = np.matmul(self.out, states.reshape(2 * h, -1))
        p += self.offset
        np.exp(p, out=p)  # weights are small: no overflow in single precision
        p /= p.sum(axis=0)
        return p.reshape(self.size, SEGMENT, n)

    def read(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(text of each segment, segments, probabilities of their bytes), a bounded number of segments at a time."""
        segments, counts = segments_of(texts)
        of = np.repeat(np.arange(len(texts)), counts)
        for a in range(0, len(segments), AT_ONCE):
            part = segments[a : a + AT_ONCE]
            yield of[a : a + AT_ONCE], part, self.probabilities(part)


def held_out(id_col: str = "doc_id"):
    """Rows that are never learned from: crc32 of the id as text, mod 4, is 2. A null id is hashed as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", bound: int = TRAIN_DOCS, steps: int = STEPS) -> Network | None:
    """Train on a sample of at most ``bound`` documents; None if there is no language to learn."""
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).where("lang is not null and text is not null")
    rows = rows.where(F.col("text").rlike(r"\p{L}")).withColumn("h", F.xxhash64("text"))
    languages = [r["lang"] for r in rows.select("lang").distinct().orderBy("lang").limit(bound + 1).collect()]
    if not languages:
        return None
    if len(languages) > bound:
        raise ValueError(f"more languages than the {bound} documents of the sample")
    each = bound // len(languages)
    # the first ``each`` of a language are among the first ``each`` of its salts: no window sees a whole language
    chosen = rows.select("lang", "h").distinct().withColumn("salt", F.pmod("h", F.lit(SALTS)))
    chosen = chosen.withColumn("k", F.row_number().over(Window.partitionBy("lang", "salt").orderBy("h"))).where(F.col("k") <= each)
    chosen = chosen.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(F.col("k") <= each)
    chosen = chosen.select(F.col("lang").alias("c_lang"), F.col("h").alias("c_h"), "k")
    rows = rows.join(F.broadcast(stored(chosen, "chosen")), (F.col("lang") == F.col("c_lang")) & (F.col("h") == F.col("c_h")))  # at most ``bound`` rows

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            segments, counts = segments_of(batch.column(2).to_pylist())
            first = np.cumsum(counts) - counts
            for lang, k, a, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), first.tolist(), counts.tolist()):
                at = a + np.unique(np.linspace(0, n - 1, TRAIN_SEGMENTS).astype(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([k], pa.int32()), pa.array([segments[at].tobytes()], pa.binary())], names=["lang", "k", "segments"])

    rows = rows.select("lang", "k", "text").mapInArrow(cut, "lang string, k int, segments binary").dropDuplicates(["lang", "k"]).orderBy("lang", "k").collect()
    labels, parts = [], []
    for r in rows:
        part = np.frombuffer(r["segments"], np.uint16).reshape(-1, SEGMENT)
        parts.append(part)
        labels += [languages.index(r["lang"])] * len(part)
    return train(np.concatenate(parts).astype(np.int64), np.array(labels), languages, steps=steps)


def predict(docs: DataFrame, net: Network | None, id_col: str = "doc_id", text_col: str = "text", spans: bool = False) -> DataFrame:
    """id, lang_pred, score (its mean probability), agree (share of the bytes labelled so); with ``spans``, the runs of
    bytes with equal label: array of (start, end, lang), offsets in UTF-8 bytes, end exclusive."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(net) if net else None
        for batch in text_slices(batches):
            texts = batch.column(1).to_pylist()
            known = [bool(reader and t and _LETTER.search(t)) for t in texts]
            given = [t if k else "" for t, k in zip(texts, known)]
            n = len(texts)
            size = reader.size if reader else 1
            total, votes, length = np.zeros((n, size)), np.zeros((n, size), np.int64), np.zeros(n, np.int64)
            runs: list[list[np.ndarray]] = [[] for _ in texts]
            for of, segments, p in reader.read(given) if reader else ():
                real = segments.T != PAD  # (SEGMENT, number)
                label = p.argmax(axis=0)
                first = np.flatnonzero(np.diff(of, prepend=-1))  # segments of a text stand together
                np.add.at(length, of[first], np.add.reduceat(real.sum(axis=0), first))
                for c in range(size):
                    total[of[first], c] += np.add.reduceat((p[c] * real).sum(axis=0), first)
                    votes[of[first], c] += np.add.reduceat(((label == c) & real).sum(axis=0), first)
                if spans:
                    for a, b in zip(first, [*first[1:], len(of)]):
                        runs[of[a]].append(label[:, a:b].T.reshape(-1)[real[:, a:b].T.reshape(-1)])
            top = total.argmax(axis=1)
            safe = np.maximum(length, 1)
            langs = [net.languages[c] if k else UNKNOWN for c, k in zip(top.tolist(), known)]
            score = np.clip(np.where(known, total[np.arange(n), top] / safe, 0.0), 0, 1)
            agree = np.where(known, votes[np.arange(n), top] / safe, 0.0)
            columns = [batch.column(0), pa.array(langs, pa.string()), pa.array(score, pa.float64()), pa.array(agree, pa.float64())]
            if spans:
                columns.append(pa.array([_spans(r, net.languages if net else []) for r in runs], kind))
            yield pa.RecordBatch.from_arrays(columns, names=["id", "lang_pred", "score", "agree", *(["spans"] if spans else [])])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, lang_pred string, score double, agree double" + (", spans array<struct<start:bigint,end:bigint,lang:string>>" if spans else ""))


def _spans(parts: list[np.ndarray], languages: list[str]) -> list[dict]:
    if not parts:
        return []
    labels = np.concatenate(parts)
    edges = np.flatnonzero(np.diff(labels, prepend=-1, append=-1))
    return [{"start": int(a), "end": int(b), "lang": languages[labels[a]]} for a, b in zip(edges[:-1], edges[1:])]


def op13_byte_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = fit(docs.where(~held_out()))
    out = predict(docs, net)
    return out.select(F.col("id").alias("doc_id"), held_out("id").alias("held_out"), "lang_pred", "score", "agree")
