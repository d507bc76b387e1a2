import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fanpulse.llm import decontaminate, jaccard_join, toxicity


def _sets(rows):
    low = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    out = []
    for doc_id, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(low))
        out.append((doc_id, frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i : i + 5]) for i in range(len(w) - 4)])))
    return out


def _components(rows):
    sets = _sets(rows)
    label = list(range(len(sets)))
    for (i, (a, x)), (j, (b, y)) in itertools.combinations(enumerate(sets), 2):
        if (a is not None and a == b) or (x and y and 100 * len(x & y) >= 80 * len(x | y)):
            old, new = label[j], label[i]
            label = [new if k == old else k for k in label]
    least = {k: min((d for (d, _), c in zip(sets, label) if c == k and d is not None), default=None) for k in set(label)}
    return sorted(((d, len(s), least[k]) for (d, s), k in zip(sets, label)), key=str)


def test_jaccard_join_matches_brute_force(spark):
    rng = random.Random(11)
    word = lambda: f"w{rng.randrange(4000)}"
    shared = [word() for _ in range(60)]
    rows = []
    for base in range(25):
        text = [word() for _ in range(rng.randrange(20, 300))] + (shared if base % 2 else [])
        for _ in range(rng.randrange(1, 7)):  # near copies around the threshold
            copy = list(text)
            for _ in range(rng.randrange(0, 1 + len(copy) // 45)):
                copy[rng.randrange(len(copy))] = word()
            rows.append((len(rows), " ".join(copy)))
    for k in range(60):  # a group of near copies, few of which link directly
        copy = [f"g{i}" for i in range(120)]
        for at in range(k, k + 3):
            copy[(at * 7) % 120] = f"h{at}"
        rows.append((len(rows), " ".join(copy)))
    rows += [(900, None), (901, ""), (902, " \n"), (903, "A b"), (904, "a B"), (905, "a b c"), (906, "x " * 20_000), (907, "X " * 19_000)]
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, n_shingles int")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.join(docs).collect()), key=str)
    assert got == _components(rows)


def test_jaccard_join_counts_every_link(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", 40 * jaccard_join.MIN_WEIGHT)  # several blocks in the group
    rng = random.Random(3)
    rows = []
    for k in range(150):  # one component; members link with some of the others only
        copy = [f"g{i}" for i in range(200 + k % 40)]
        for at in rng.sample(range(200), rng.randrange(4)):
            copy[at] = f"h{rng.randrange(10)}"
        rows.append((len(rows), " ".join(copy)))
    rows += [(200, rows[0][1]), (201, rows[0][1].upper()), (202, "a b"), (203, "A  b"), (204, "a b c"), (205, None), (206, ""), (207, "")]
    rows += [(300 + k, " ".join(f"p{i}" for i in range(60 + k))) for k in range(2)]
    sets = _sets(rows)
    expected = {d: sum(a != d and bool(x & y) and 100 * len(x & y) >= 80 * len(x | y) for a, y in sets) for d, x in sets}
    got = {r.doc_id: r.n_links for r in jaccard_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == expected and got[202] == 1 and 0 < got[10] < 149


def test_jaccard_join_nulls_and_repeats(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(None, text), (5, text), (5, text), (None, "only null ids here " * 3), (None, "only null ids here " * 3), (-4, text + " more"), (8, "alone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id) for r in jaccard_join.join(docs).collect()), key=str)
    assert got == sorted([(None, -4), (5, -4), (5, -4), (None, None), (None, None), (-4, -4), (8, 8)], key=str)
    assert jaccard_join.join(docs.limit(0)).count() == 0


def test_representatives_keep_one(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(5, text), (2, text + " x"), (5, text), (9, "other"), (10, None), (11, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in jaccard_join.representatives(docs).collect()) == [2, 9, 10, 11]


def test_containment_matches_brute_force(spark):
    rng = random.Random(4)
    items = [(i, " ".join(f"b{rng.randrange(900)}" for _ in range(rng.randrange(5, 50)))) for i in range(30)] + [(70, "two words"), (71, None), (72, ""), (3, "other text of a repeated id here now"), (None, "item without any id at all")]
    rows = [(i, " ".join(f"d{rng.randrange(900)}" for _ in range(rng.randrange(3000)))) for i in range(40)]
    for k in range(40):  # passages whole, shortened and changed
        w = items[k % 30][1].split()
        cut = w[: max(5, int(len(w) * rng.choice([1, 0.95, 0.9, 0.8, 0.6])))]
        rows.append((100 + k, f"before. {' '.join(cut).upper()}, after it"))
    rows += [(300, "Two, words!"), (301, "two words more"), (302, None), (303, ""), (100, "item without any id at all"), (100, "item without any id at all")]
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())
    runs = lambda w, k: {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}
    size = lambda u: min(5, len(words(u)))  # words of an item's shingles
    held = lambda t, u: size(u) > 0 and len(runs(words(t), size(u)) & runs(words(u), size(u))) >= 0.8 * len(runs(words(u), size(u))) - 1e-9
    want = {(d, i) for (d, t), (i, u) in itertools.product(rows, items) if held(t, u)}
    assert {(300, 70), (301, 70)} <= want  # a short item alone and inside a longer text
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contained(docs, bench)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want
    kept = decontaminate.clean(docs, bench)
    assert kept.columns == docs.columns
    assert sorted((d, t or "") for d, t, _ in kept.collect()) == sorted((d, t or "") for d, t in rows if not any(held(t, u) for _, u in items))
    assert decontaminate.contained(docs, bench.limit(0)).count() == 0 and decontaminate.contained(docs.limit(0), bench).count() == 0


def test_folding():
    assert toxicity.fold("You 1D10T, m0r0n & сlоwn") == " you idiot moron clown "
    assert toxicity.fold(None) == " " and toxicity.fold("  ") .strip() == ""
    assert toxicity.fold("год 2024") == " год "  # real Cyrillic words stay


def test_exceptions_cover_hits():
    lex = toxicity.Lexicon({" tras": 3.0}, {"trash can"})
    a = lex.automaton()
    assert toxicity.strength(toxicity.fold("put it in the trash can"), a)[0] == 0
    assert toxicity.strength(toxicity.fold("you are trash"), a)[0] == 3.0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    out = toxicity.op6_toxicity(spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    n = {(r.toxic, r.predicted): r["count"] for r in out.groupBy("toxic", "predicted").count().collect()}
    assert n.get((1, 1), 0) >= 0.9 * (n.get((1, 1), 0) + n.get((1, 0), 0)) and n.get((0, 1), 0) <= 0.02 * n[(0, 0)]


def test_toxicity_edges(spark):
    docs = spark.createDataFrame([(1, None, 0.5), (2, "", 0.5), (None, "you idiot", 0.5), (3, "you idiot", 0.5)], "doc_id long, text string, score double")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.score(docs, toxicity.fit(docs, none)).collect()
    assert len(got) == 4 and {r.score >= 0.3 for r in got if r.n_hits} == {True} and all(0 <= r.score < 0.3 for r in got if not r.n_hits)
    assert toxicity.score(docs.limit(0), toxicity.fit(docs.limit(0), none)).count() == 0


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_pipeline_stages(spark, sf):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    ids = None
    for i, (_, stage) in enumerate(P.STAGES):
        docs = stage(spark, docs, sf).cache()
        assert docs.count() > 0
        if i < len(P.STAGES) - 1:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        got = {r.doc_id for r in docs.select("doc_id").collect()}
        assert ids is None or got <= ids
        ids = got
        if i == 1:
            rows = [(r.doc_id, r.text) for r in docs.collect()]
            assert all(d == c or n == 0 for d, n, c in _components(rows))
    assert {"shard", "slot"} <= set(docs.columns)


def _expected_links(rows):
    sets = _sets(rows)
    return {d: sum(a != d and bool(x & y) and 100 * len(x & y) >= 80 * len(x | y) for a, y in sets) for d, x in sets}


def test_jaccard_join_of_one_shared_passage(spark, monkeypatch):
    """Many texts around one passage, linked with some of the others or none: more than HOT classes hold its shingles."""
    monkeypatch.setattr(jaccard_join, "HOT", 8)
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", 30 * jaccard_join.MIN_WEIGHT)
    rng, rows = random.Random(9), []
    passage = [f"p{i}" for i in range(90)]
    for k in range(120):
        tail = [f"t{k % 7 if k % 3 else k}x{i}" for i in range(rng.randrange(0, 26))]
        cut = rng.randrange(0, 20)
        rows.append((k, " ".join(passage[cut:] + tail)))
    rows += [(500 + k, " ".join(f"q{k}w{i}" for i in range(50))) for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = jaccard_join.join(docs).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == _components(rows)
    assert {r.doc_id: r.n_links for r in got} == _expected_links(rows)
    kept = sorted(r.doc_id for r in jaccard_join.representatives(docs).collect())
    assert kept == sorted({c for _, _, c in _components(rows)})


def test_representatives_of_shared_ids_and_clashing_names(spark):
    text, other = " ".join(f"w{i}" for i in range(40)), " ".join(f"v{i}" for i in range(40))
    rows = [(5, text), (5, text + " x"), (5, other), (5, other), (7, other + " y"), (8, None), (8, None), (None, text), (9, "short")]
    names = ["doc_id", "text", "n", "size", "row", "cid", "comp", "__gone", "gone_id", "first", "token", "own_0"]
    docs = spark.createDataFrame([(d, t, *range(10)) for d, t in rows], "doc_id long, text string, " + ", ".join(f"{c} int" for c in names[2:]))
    got = jaccard_join.representatives(docs)
    assert got.columns == names
    left = [(r.doc_id, r.text) for r in got.collect()]
    assert left.count((5, other)) == 1 and sum(d == 5 and t in (text, text + " x") for d, t in left) == 1
    assert (7, other + " y") not in left and (9, "short") in left and (None, text) in left and left.count((8, None)) == 2
    assert jaccard_join.join(docs).count() == len(rows)


def test_parity_filter_keeps_every_link(spark):
    rng, rows = np.random.default_rng(5), []
    for k in range(400):
        n = int(rng.integers(1, 700))
        one = rng.integers(0, 1 << 64, n, dtype=np.uint64)
        kept = rng.random(n) >= rng.choice([0.0, 0.05, 0.1, 0.11, 0.2, 0.5])
        two = np.concatenate([one[kept], rng.integers(0, 1 << 64, int(rng.integers(0, 1 + n // 8)), dtype=np.uint64)])
        same = int(kept.sum())
        rows.append((100 * same >= 80 * (len(one) + len(two) - same), len(one), len(two), jaccard_join.parity(one).tolist(), jaccard_join.parity(two).tolist()))
    pairs = spark.createDataFrame(rows, "linked boolean, n1 int, n2 int, one array<long>, two array<long>").withColumn("near", jaccard_join.near("one", "n1", "two", "n2"))
    count = {(r.linked, r.near): r["count"] for r in pairs.groupBy("linked", "near").count().collect()}
    assert count[True, True] > 100 and (True, False) not in count and count[False, False] > 100


def test_texts_around_rare_passages_are_not_all_verified(spark, monkeypatch):
    """Few texts share each passage, and it is in their prefixes: their pairs are known to be far apart without their texts."""
    rng, rows = random.Random(2), []
    for g in range(30):
        passage = [f"g{g}p{i}" for i in range(70)]
        rows += [(len(rows) + k, " ".join(passage + [f"g{g}t{k}w{rng.randrange(10**6)}" for _ in range(70)])) for k in range(8)]
    rows += [(1000 + k, " ".join([f"c{i}" for i in range(150 - k)] + [f"d{k}" for _ in range(k)])) for k in range(8)]
    made, real = [], jaccard_join.verified
    monkeypatch.setattr(jaccard_join, "verified", lambda pairs, texts: (made.append(pairs.count()), real(pairs, texts))[1])
    got = jaccard_join.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {r.doc_id: r.n_links for r in got} == _expected_links(rows)
    assert len(made) == 2 and made[1] < 30  # pairs of different neighbourhoods


def test_fine_parity_keeps_every_link(spark):
    """Sets of all sizes, those of a pair with different numbers of buckets among them."""
    rng, rows = np.random.default_rng(8), []
    for k in range(300):
        n = int(rng.choice([rng.integers(1, 700), rng.integers(900, 1200), rng.integers(1800, 9000)]))
        one = rng.integers(0, 1 << 64, n, dtype=np.uint64)
        kept = rng.random(n) >= rng.choice([0.0, 0.05, 0.1, 0.19, 0.5, 1.0])
        other = rng.integers(0, 1 << 64, int(rng.integers(0, 2 + n // 8)) if 2 * kept.sum() > n else n, dtype=np.uint64)
        two = np.concatenate([one[kept], other]) if k % 3 or not kept.any() else one[kept]
        same = int(kept.sum())
        rows.append((100 * same >= 80 * (len(one) + len(two) - same), len(one), len(two), jaccard_join.parity(one).tolist(), jaccard_join.parity(two).tolist()))
    assert any(r[0] and len(r[3]) != len(r[4]) for r in rows)
    pairs = spark.createDataFrame(rows, "linked boolean, n1 int, n2 int, one array<long>, two array<long>").withColumn("near", jaccard_join.nearer("one", "n1", "two", "n2"))
    assert pairs.where("linked and not near").isEmpty() and pairs.where("linked").count() > 50
    assert pairs.where("not linked and not near and n1 > 3000").count() > 20


def test_only_texts_of_possible_pairs_are_read(spark, monkeypatch):
    """Texts that share half of their words with a hub's text or others', short and long ones: few pairs are verified, and few texts read."""
    rng, rows = random.Random(6), []
    for g, size in enumerate([60] * 12 + [1500] * 4):
        passage = [f"g{g}p{i}" for i in range(size)]
        rows += [(len(rows) + k, " ".join(passage + [f"g{g}t{k}w{rng.randrange(10**6)}" for _ in range(size)])) for k in range(6)]
    for size in (100, 3000):
        rows += [(len(rows) + k, " ".join([f"c{size}x{i}" for i in range(size - k)] + [f"d{size}x{k}"] * k)) for k in range(4)]
    made, real = [], jaccard_join.verified
    monkeypatch.setattr(jaccard_join, "verified", lambda pairs, texts: (made.append((pairs.count(), texts.count())), real(pairs, texts))[1])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = jaccard_join.join(docs).collect()
    assert {r.doc_id: r.n_links for r in got} == _expected_links(rows)
    assert max(pairs for pairs, _ in made) <= 20 and max(texts for _, texts in made) <= 20  # of 104 texts


def test_sketch_is_packed():
    rng = np.random.default_rng(1)
    counts = rng.poisson(0.6, 1 << 16).astype(np.uint32)  # a slice of one task's counters
    counts[:3] = 0, 1 << 20, (1 << 32) - 1
    data = jaccard_join.packed(counts)
    assert (jaccard_join.unpacked(data, 1 << 16) == counts).all() and len(data) < 1 << 15


def test_no_task_takes_two_python_workers(spark, monkeypatch):
    """Steps in Python never follow each other inside a stage: executors would keep a worker for each."""
    docs = spark.createDataFrame([(i, " ".join(f"w{i // 2}x{k}" for k in range(40 + i % 2))) for i in range(20)], "doc_id long, text string")
    made, real = [], type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, *a, **b: (made.append(out := real(self, *a, **b)), out)[1])
    assert jaccard_join.representatives(docs).count() == 10
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in made]
    assert len(plans) >= 4 and max(p.count("MapInArrow") for p in plans) == 1


def test_batches_of_long_texts_are_small(spark):
    docs = spark.range(0, 4000, 1, 1).select(F.col("id").alias("doc_id"), F.concat_ws(" ", *[F.concat(F.lit(f"w{k}x"), "id") for k in range(400)]).alias("text"))
    docs.limit(1).transform(jaccard_join.join).collect()
    sizes = docs.mapInArrow(lambda it: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"]) for b in it), "n long").collect()
    assert sum(r.n for r in sizes) > 10 << 20 and max(r.n for r in sizes) < 3 << 20


def test_jaccard_join_of_one_tied_passage(spark, monkeypatch):
    """The same where its shingles tie their texts to one neighbourhood."""
    monkeypatch.setattr(jaccard_join, "TIED", 8)
    test_jaccard_join_of_one_shared_passage(spark, monkeypatch)


def test_shingles_hidden_by_the_sketch_tie_no_unrelated_texts(spark, monkeypatch):
    """More than HOT texts share each passage, and the sketch, as full as on large inputs, leaves them in prefixes: only real links make neighbourhoods."""
    monkeypatch.setattr(jaccard_join, "frequency_classes", lambda *_: np.zeros(1 << jaccard_join.SKETCH_BITS, np.uint8))
    passages = [[f"p{g}w{i}" for i in range(30)] for g in range(10)]
    rows = [(k, " ".join(passages[k % 5] + passages[5 + k // 5 % 5] + [f"t{k}w{i}" for i in range(60)])) for k in range(400)]
    long = [f"l{i}" for i in range(1200)]
    rows += [(1000 + k, " ".join(long + [f"u{k}w{i}" for i in range(1200)])) for k in range(70)]
    rows += [(2000 + k, rows[k][1] + " end" * k) for k in range(1, 5)] + [(2010 + k, rows[400 + k // 2][1] + f" end{k}") for k in range(6)]
    compared, real = [], jaccard_join.blocks_of
    monkeypatch.setattr(jaccard_join, "blocks_of", lambda nodes: (compared.append(nodes.count()), real(nodes))[1])
    verified, check = [], jaccard_join.verified
    monkeypatch.setattr(jaccard_join, "verified", lambda pairs, texts: (verified.append(pairs.count()), check(pairs, texts))[1])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = jaccard_join.join(docs).collect()
    assert {r.doc_id: r.n_links for r in got} == _expected_links(rows)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == _components(rows)
    assert compared == [9] and max(verified) <= 30  # three texts with two copies each


def test_a_full_sketch_shows_what_stands_out(spark, tmp_path):
    """Counters with 150 over a mean of 400 are told from the others."""
    rng, part = np.random.default_rng(3), (1 << jaccard_join.SKETCH_BITS) // jaccard_join.SLICES
    counts = rng.poisson(400, part).astype(np.uint32)
    counts[:50] = 550
    rows = [("sketch", None, None, None, None, None, i, bytearray(jaccard_join.packed(counts))) for i in range(jaccard_join.SLICES)]
    spark.createDataFrame(rows, jaccard_join.FIRST).repartition(1).write.partitionBy("kind").parquet(f"{tmp_path}/sets")
    classes = jaccard_join.frequency_classes(spark, f"{tmp_path}/sets").reshape(jaccard_join.SLICES, part)
    assert (classes[:, :50] > 0).all() and (classes[:, 50:] > 0).mean() < 0.001


@pytest.mark.parametrize("query", ["join", "representatives"])
def test_scratch_tables_of_texts_and_shingles_are_freed(spark, query):
    """What is left on disk beside the result is narrow: a row per document or class, no text, shingle, parity or sketch."""
    from pathlib import Path
    from urllib.parse import urlparse

    from fanpulse.llm.common import shared_folder

    top = Path(urlparse(shared_folder(spark)).path)
    was = set(top.iterdir())
    shared = [f"s{i}" for i in range(12)]
    rows = [(k, " ".join([f"w{k // 3}x{i}" for i in range(80 - k % 3)] + shared)) for k in range(90)] * 2 + [(500 + k, " ".join(shared)) for k in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = getattr(jaccard_join, query)(docs)
    assert out.count() == (189 if query == "join" else 31)
    left = {d.name.split("-")[1] for d in set(top.iterdir()) - was}
    assert "names" in left and not left & {"classes", "tokens", "open", "texts"}
    assert not [d for d in set(top.iterdir()) - was if (d / "kind=sketch").exists()]
    assert len(out.collect()) == out.count()


def test_only_scratch_is_freed(spark, tmp_path):
    from fanpulse.llm.common import freed

    spark.range(3).write.parquet(f"{tmp_path}/mine")
    with pytest.raises(ValueError):
        freed(spark, spark.read.parquet(f"{tmp_path}/mine"))
    assert spark.read.parquet(f"{tmp_path}/mine").count() == 3
