import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from fanpulse.llm import merkle_manifest as M

LOW = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
COLS = "doc_id long, text string, lang string, source string, n_chars long"


def _h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def _leaf(row, text):
    return _h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[3], row[2], row[4], text)))


def _tree(nodes):
    """(root, proof of every node as (before, after) by level)."""
    proofs, level, row = [[] for _ in nodes], 0, nodes
    while len(row) > 1:
        for i, p in enumerate(proofs):
            k = i // 16**level
            run = row[k // 16 * 16 : k // 16 * 16 + 16]
            p.append(("".join(run[: k % 16]), "".join(run[k % 16 + 1 :])))
        row, level = [_h("".join(row[i : i + 16])) for i in range(0, len(row), 16)], level + 1
    return row[0], proofs


def _expected(rows):
    by = defaultdict(list)
    for r in rows:
        by[r[3]].append((r[0] is not None, r[0] or 0, _leaf(r, r[1]), r))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: _tree([x[2] for x in sorted(by[s], key=lambda x: x[:3])]) for s in order}
    root, upper = _tree([trees[s][0] for s in order])
    out = []
    for s, up in zip(order, upper):
        for (_, _, leaf, r), own in zip(sorted(by[s], key=lambda x: x[:3]), trees[s][1]):
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[1] is not None
            h = _leaf(r, r[1].translate(LOW)) if hit else leaf
            for a, b in own + up:
                h = _h(a + h + b)
            out.append((r[0], leaf, trees[s][0], root, _h("".join(a + b for a, b in own + up)), h, h == root))
    return sorted(out, key=str)


def _rows():
    rows = [(i, f"Text {i}" if i % 9 else "", "en", "hot", i) for i in range(700)]  # several superblocks when small
    rows += [(i, f"UPPER {i}", None, f"s{i % 23}", None) for i in range(100)]
    rows += [(None, "a", "en", None, 1), (None, None, None, None, None), (5, None, "en", "", 1), (5, "Ärger", "de", "é", 1), (5, "Ärger", "de", "é", 1), (-3, "X" * 50_000, "en", "lone", 9)]
    return rows


@pytest.mark.parametrize("levels", [1, 3])
def test_matches_brute_force(spark, monkeypatch, levels):
    monkeypatch.setattr(M, "LEVELS", levels)
    monkeypatch.setattr(M, "BLOCK", 16**levels)
    rows = _rows()
    docs = spark.createDataFrame([(*r, 1, 2, "x", "y") for r in rows], COLS + ", node int, place int, tree string, claim string").repartition(3)
    claims = {"text": F.when(M.tampered(), F.translate("text", *M.LOWER)).otherwise(F.col("text"))}
    got = M.manifest(docs, claims=claims)
    assert sorted((tuple(r)[:7] for r in got.collect()), key=str) == _expected(rows)
    for r in got.limit(50).collect():  # the proof itself leads to the root
        assert M.fold(r.leaf, r.lefts, r.rights) == r.root


def test_empty_and_single(spark):
    docs = spark.createDataFrame([(1, "a", "en", "s", 1)], COLS)
    assert M.manifest(docs.limit(0)).count() == 0
    (r,) = M.manifest(docs).collect()
    assert r.leaf == r.subroot == r.root == r.folded_root and r.verified and r.proof_sha256 == _h("") and r.lefts == []
