import numpy as np
import pytest
from pyspark.sql import functions as F

from fanpulse.llm import byte_language as B


def _net(seed=1, languages=("aa", "bb", "cc"), hidden=4):
    rng = np.random.default_rng(seed)
    net = B.Network(list(languages), B.Gates.new(hidden, rng), B.Gates.new(hidden, rng), rng.normal(0, 1, (2 * hidden, len(languages))), rng.normal(0, 1, len(languages)))
    for g in (net.ahead, net.behind):
        g.table, g.inner, g.bias = g.table.astype(float), g.inner.astype(float), rng.normal(0, 1, hidden)
    return net


def test_gradients_match_differences():
    net, rng = _net(), np.random.default_rng(2)
    ids = rng.integers(97, 101, (9, 5))
    ids[6:, 0] = B.PAD
    labels = np.array([0, 1, 2, 0, 1])
    _, grads = net.step(ids, labels)
    for p, g in zip(net.parameters(), grads):
        for at in list(np.ndindex(p.shape))[:: max(1, p.size // 12)] + ([(98, 1), (99, 6), (100, 9)] if p.shape[0] == B.PAD + 1 else []):
            if p.shape[0] == B.PAD + 1 and at[0] == B.PAD:
                continue
            old = p[at]
            p[at] = old + 1e-5
            up, _ = net.step(ids, labels)
            p[at] = old - 1e-5
            down, _ = net.step(ids, labels)
            p[at] = old
            assert abs((up - down) / 2e-5 - g[at]) < 1e-6


def _naive(net, text):
    """Label probabilities of every byte, byte by byte in plain double precision."""
    data, out = text.encode(), []
    sig = lambda x: 1 / (1 + np.exp(-x))
    for a in range(0, len(data), B.SEGMENT):
        part = data[a : a + B.SEGMENT]
        sides = []
        for gates, order in ((net.ahead, range(len(part))), (net.behind, range(len(part) - 1, -1, -1))):
            h, state, got = len(gates.bias), np.zeros(len(gates.bias)), {}
            for t in order:
                x, u = gates.table[part[t]], state @ gates.inner
                z, r = sig(x[:h] + u[:h]), sig(x[h : 2 * h] + u[h : 2 * h])
                n = np.tanh(x[2 * h :] + r * (u[2 * h :] + gates.bias))
                state = (1 - z) * state + z * n
                got[t] = state
            sides.append(got)
        for t in range(len(part)):
            e = np.exp(np.concatenate([sides[0][t], sides[1][t]]) @ net.out + net.offset)
            out.append(e / e.sum())
    return np.array(out)


def test_prediction_matches_naive_network(spark):
    net = _net(7)
    texts = ["a", "hello world", "x" * 64, "y " * 33, "Grüße, Ærø " * 300, "mixed\n" * 21, "ab" * 9000]
    docs = spark.createDataFrame([(i, t, "zz") for i, t in enumerate(texts)], "doc_id long, text string, lang_pred string").repartition(2)
    for r in B.predict(docs, net, spans=True).collect():
        p = _naive(net, texts[r.id])
        mean, label = p.mean(axis=0), p.argmax(axis=1)
        assert r.lang_pred == net.languages[mean.argmax()] and abs(r.score - mean.max()) < 1e-4
        assert abs(r.agree - (label == mean.argmax()).mean()) < 0.01
        assert r.spans[0].start == 0 and r.spans[-1].end == len(p) and all(a.end == b.start and a.lang != b.lang for a, b in zip(r.spans, r.spans[1:]))
        assert sum(s.end - s.start for s in r.spans for c in [net.languages.index(s.lang)] if (label[s.start : s.end] == c).mean() > 0.99) > 0.98 * len(p)


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, "en"), (2, "", "en"), (3, " 12, 3!", "de"), (None, "words here", None), (4, "words here", None), (4, "words here", None)], "doc_id long, text string, lang string")
    got = {(r.id, r.lang_pred, round(r.score, 6)) for r in B.predict(docs, _net()).collect()}
    assert {g[1:] for g in got if g[0] in (1, 2, 3)} == {("und", 0.0)} and len({g[1:] for g in got if g[0] in (None, 4)}) == 1
    assert B.fit(docs) is None  # no letters in any text with a language
    assert {r.lang_pred for r in B.predict(docs, None, spans=True).collect()} == {"und"}
    assert B.predict(docs.limit(0), _net()).count() == 0 and B.fit(docs.limit(0)) is None
    with pytest.raises(ValueError):
        B.fit(spark.createDataFrame([(f"text {i}", f"l{i}") for i in range(4)], "text string, lang string"), bound=3)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    out = B.op13_byte_language(spark, sf)
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    n, hits = out.where("held_out").join(truth, "doc_id").agg(F.count("*"), F.count_if(F.col("lang") == F.col("lang_pred"))).first()
    assert n > 200 and hits >= 0.98 * n and out.count() == 1000
