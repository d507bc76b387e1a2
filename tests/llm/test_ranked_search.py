import random
import re
from collections import Counter
from math import floor, log

import pytest

from fanpulse.llm import ranked_search as R

LOW = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def _terms(text):
    return re.findall(R.TERM, (text or "").translate(LOW))


def _ranked(docs, items, k):
    tf = [(d, Counter(_terms(t))) for d, t in docs]
    sizes = [sum(c.values()) for _, c in tf]
    n_docs, n_terms = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for _, c in tf for t in c)
    out = []
    for item_id, text in {(i, t) for i, t in items if t is not None}:
        rows = []
        for (d, c), n in zip(tf, sizes):
            score = 0
            for t, times in Counter(_terms(text)).items():
                if t in c:
                    m = 75 + (25 * n * n_docs) // n_terms
                    score += times * floor(1000 * log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
            rows.append((score, d))
        rows = sorted((r for r in rows if r[0] > 0), key=lambda r: (-r[0], r[1] is not None, r[1] or 0))[:k]
        out += [(item_id, i + 1, d, s) for i, (s, d) in enumerate(rows)]
    return sorted(out, key=str)


def _tables(n_docs, seed):
    rng = random.Random(seed)
    word = lambda: f"w{int(rng.paretovariate(0.6))}"  # few frequent, many rare
    docs = [(i, " ".join(word() for _ in range(rng.randrange(1, 120)))) for i in range(n_docs)]
    docs += [(n_docs, docs[0][1]), (0, docs[0][1]), (0, docs[0][1]), (None, docs[1][1]), (None, None), (-5, docs[1][1].upper() + "!"), (7000, ""), (7001, " \n. "), (7002, "long w3 " * 40_000)]
    items = [(i, " ".join(word() for _ in range(rng.randrange(1, 30)))) for i in range(12)]
    items += [(3, items[3][1]), (3, "w1 w2 w90 w91"), (None, "w1 Straße w2"), (90, None), (91, ""), (92, "notthere at all"), (93, docs[5][1])]
    return docs, items


@pytest.mark.parametrize(("block", "k", "query_bytes"), [(16, 5, 1 << 20), (64, 20, 200), (8192, 3, 1 << 20)])
def test_ranks_match_brute_force(spark, monkeypatch, block, k, query_bytes):
    monkeypatch.setattr(R, "BLOCK_DOCS", block)  # limits are carried from block to block
    docs, items = _tables(300, k)
    left = spark.createDataFrame([(d, t, 1, 2) for d, t in docs], "doc_id long, text string, score int, item_id int").repartition(3)
    right = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    got = R.search(left, right, k, query_bytes=query_bytes).collect()
    assert sorted((tuple(r) for r in got), key=str) == _ranked(docs, items, k)


def test_accumulators_stop_and_survivors_stay_exact():
    import numpy as np

    n = 400  # term 0 is rare and weighs much, term 1 stands in all documents
    sizes = np.array([2 if d % 50 == 0 else 1 for d in range(n)])
    terms = np.concatenate([[0, 1] if d % 50 == 0 else [1] for d in range(n)])
    block = R.Block(np.full(n, 10), sizes, terms, np.ones(len(terms), np.int64), n, 10 * n, 2)
    seen = []
    real, np_partition = np.partition, lambda a, k: (seen.append(len(a)), real(a, k))[1]
    R.np.partition = np_partition
    try:
        found, scores = block.search((np.array([0, 1]), np.array([6000, 2])), 0, 5)
    finally:
        R.np.partition = real
    assert sorted(found) == list(range(0, n, 50)) and len(set(scores.tolist())) == 1 and scores[0] == 6002 * block.most[0]
    assert seen == [n // 50]  # one look at the kth partial score; no accumulator for documents that hold the frequent term only


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert R.search(docs.limit(0), items).count() == 0
    assert R.search(docs, items.limit(0)).count() == 0
    assert sorted(tuple(r)[:3] for r in R.search(docs.unionByName(docs), items).collect()) == [(1, 1, 1), (1, 2, 1)]
    assert [tuple(r)[:3] for r in R.search(docs, items).collect()] == [(1, 1, 1)]
