import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from fanpulse.llm import hilbert_shards, mixing, separator_scan, token_codes
from fanpulse.llm.common import scratch_path
from fanpulse.llm.tokens import tokenizer_path

ROWS = [
    (3, "Hello, world! it's 42 déjà-vu", "b"), (1, None, "a"), (2, "", None), (2, "twice the same id", "a"), (2, "twice the same id", "a"),
    (7, "<|endoftext|> ΣΑΣ ²³ ٣٤ İstanbul é ﬁne x", "b"), (9, "word " * 30_000, "c"), (None, "no id", "c"),
]


def _docs(spark, rows=ROWS):
    return spark.createDataFrame([(i, t, s, "en", 5) for i, t, s in rows], "doc_id long, text string, source string, lang string, n_tokens int")


def _ids():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_codes_random_access():
    for ids in (np.arange(5), np.array([], int), np.random.default_rng(1).integers(0, 1 << 30, 5000), np.full(2000, 300)):
        block = token_codes.Block(token_codes.encode(ids.astype(np.uint32)))
        places = np.random.default_rng(2).permutation(len(ids))
        assert (block.access(places) == ids[places]).all() and block.n == len(ids)


def test_codes_files(spark):
    path = scratch_path(spark, "codes-test")
    token_codes.write(_docs(spark), path, tokenizer_path(), end_id=2, block_tokens=64)
    enc = _ids()
    rows = token_codes.read_documents(spark, path).join(token_codes.block_starts(spark, path), ["part", "block"])
    got = [(r.doc_id, r.block_start + r.offset, r.n_tokens, r.ids_crc32) for r in rows.collect()]
    want, start = [], 0
    for doc_id, text, _ in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, zlib.crc32((r[1] or "").encode()) if r[1] is not None else -1)):
        ids = np.array([*enc(text), 2], "<u4")
        want.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(got, key=lambda r: r[1]) == want


def test_separator_scan_stitches_blocks(spark):
    path, enc = scratch_path(spark, "flat-test"), _ids()
    separator_scan.write_token_files(_docs(spark), path, tokenizer_path(), 65535, block_tokens=7)
    read = lambda kind: spark.read.schema(separator_scan.FILES).parquet(path).where(F.col("kind") == kind)
    counts = separator_scan.count_tokens(read("tokens"), 65535).join(separator_scan.names_of(read("names")), ["file", "ordinal"])
    assert sorted((r.doc_id or -1, r.n_tokens) for r in counts.collect()) == sorted((i or -1, len(enc(t))) for i, t, _ in ROWS)


def test_separator_scan_open_tail(spark):
    blocks = [(0, k, bytes(bytearray(np.array(b, "<u2").tobytes()))) for k, b in enumerate([[1, 2, 9], [3], [4, 9, 9], [5, 6]])]
    got = separator_scan.count_tokens(spark.createDataFrame(blocks, "file int, block int, data binary"), 9).collect()
    assert sorted((r.ordinal, r.start, r.n_tokens, r.open) for r in got) == [(0, 0, 2, False), (1, 3, 2, False), (2, 6, 0, False), (3, 7, 2, True)]


def test_hilbert_neighbours(spark):
    cell = [F.expr("cast(id div 64 as int)"), F.expr("cast(id div 8 % 8 as int)"), F.expr("cast(id % 8 as int)")]
    rows = sorted((r.h, r.id) for r in spark.range(512).select("id", hilbert_shards.hilbert_index(cell, 3).alias("h")).collect())
    at = [(i // 64, i // 8 % 8, i % 8) for _, i in rows]
    assert [h for h, _ in rows] == list(range(512)) and all(sum(abs(a - b) for a, b in zip(x, y)) == 1 for x, y in zip(at, at[1:]))


def test_shards(spark):
    rng = random.Random(3)
    rows = [(i, "x" * rng.randrange(200), rng.choice(["a", "b", None])) for i in range(500)] + [(7, "same", "a")] * 40 + ROWS
    for law in ("rows", "bytes"):
        out = hilbert_shards.shard_documents(_docs(spark, rows), 7, law).collect()
        assert len(out) == len(rows)
        slots = [sorted(r.slot for r in out if r.shard == s) for s in range(7)]
        assert all(s == list(range(len(s))) for s in slots)
        sizes = [sum(len((r.text or "").encode()) + 8 for r in out if r.shard == s) for s in range(7)]
        if law == "rows":
            assert max(map(len, slots)) - min(map(len, slots)) <= 1
    none = _docs(spark, rows).limit(0)
    assert hilbert_shards.shard_documents(none).count() == 0


def test_bytes_law_is_even(spark):
    rows = [(i, "x" * (i % 90), "a") for i in range(800)]
    out = hilbert_shards.shard_documents(_docs(spark, rows), 4, "bytes").groupBy("shard").agg(F.sum(F.length("text") + 8).alias("n")).collect()
    n = [r.n for r in out]
    assert len(n) == 4 and max(n) - min(n) <= 2 * 98


def test_targets():
    assert mixing.targets([("a", 100), ("b", 100), ("c", 100)]) == {"a": 187.5, "b": 75.0, "c": 37.5}
    capped = mixing.targets([("a", 10), ("b", 500), (None, 0)])
    assert capped["a"] == 30 and capped["b"] == 480 and capped[None] == 0
    assert mixing.targets([]) == {}


def test_permutation_and_shards_cover():
    for n in (1, 2, 7, 1000):
        assert sorted(mixing.permuted(np.arange(n), n, [1, 2])) == list(range(n))
    draws = np.array([50, 0, 333, 7])
    total = np.zeros(4, int)
    for s in range(10):
        counts, before = mixing.shard_counts(draws, 39, s, 5)
        assert (before == total).all() and counts.sum() == min(39, 390 - 39 * s)
        total += counts
    assert (total == draws).all()


def test_splits_are_drawn_at_every_size():
    counts = np.array([0, 700_000_000, 0, 1_300_000_000, 5, 1, 0])  # 2e9 slots, with empty sources
    drawn = []
    for seed in range(300):
        left = mixing._split(counts, 1_000_000_007, np.random.default_rng(seed))
        assert left.sum() == 1_000_000_007 and (left >= 0).all() and (left <= counts).all()
        drawn.append(left)
    p, n, total = 0.35, 1_000_000_007, int(counts.sum())
    sd = (n * p * (1 - p) * (total - n) / total) ** 0.5
    first = np.array([d[1] for d in drawn], float)
    assert abs(first.mean() - n * p) < 5 * sd / 300**0.5 and 0.8 < first.std() / sd < 1.2
    assert 1.5 < np.mean([d[4] for d in drawn]) < 3.5 and 0.3 < np.mean([d[5] for d in drawn]) < 0.7
    small = [mixing._hypergeometric(30, 50, 20, np.random.default_rng(s)) for s in range(4000)]
    assert abs(np.mean(small) - 7.5) < 0.15 and abs(np.var(small) - 20 * 0.375 * 0.625 * 60 / 79) < 0.4
    shards = [mixing.shard_counts(counts, 1 << 14, s, 5) for s in (0, 1, 61_035, 122_070)]
    assert all((c >= 0).all() and (b + c <= counts).all() and not c[counts == 0].any() for c, b in shards)
    assert (shards[0][0] == shards[1][1]).all() and (shards[3][0] + shards[3][1] == counts).all()


def test_mix_meets_targets(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(f"w{i}-{k}" for k in range(rng.randrange(150))), rng.choice(["a", "a", "a", "b", "c", None])) for i in range(400)] + [(3, "one two", "a")] * 2 + [(4, None, "b")]
    docs = _docs(spark, rows)
    packed = mixing.packed(docs).cache()
    sources = mixing.plan(packed)
    mix = mixing.mix(spark, packed, sources)
    taken = {r.src: r.n for r in mix.groupBy("src").agg(F.sum("n").alias("n")).collect()}
    for number, _, size, target, _, _ in sources:
        assert abs(taken.get(number, 0) - target) <= 1.5 * mixing.BLOCK_WORDS and target <= 3 * size + 1e-6
    most = {(r.src, r.start): r.n for r in mix.groupBy("src", "start").agg(F.sum("n").alias("n")).collect()}
    size = {(s[0], r.start): r.size for s in sources for r in packed.collect() if r.source == s[1] and r.size}
    assert all(n <= 3 * size[k] for k, n in most.items())
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns and sum(len(r.text.split()) for r in out.collect()) == sum(taken.values())
    words: dict[int, set[str]] = {}  # some ids have two texts
    for i, t, _ in rows:
        words.setdefault(i, set()).update((t or "").split())
    assert all(set(r.text.split()) <= words[r.doc_id] for r in out.collect())
    assert mixing.mixed_documents(docs.limit(0)).count() == 0


def test_source_table_needs_no_python_worker(spark):
    sources = [(0, "a", 640, 1280.0, 10, 20), (1, None, 64, 192.0, 1, 3)]
    got = mixing.source_table(spark, sources)
    assert got.dtypes == [("src", "int"), ("s_source", "string"), ("source_size", "bigint"), ("target", "double")]
    assert sorted(map(tuple, got.collect())) == [s[:4] for s in sources]
    assert "ExistingRDD" not in got._jdf.queryExecution().executedPlan().toString()
    assert mixing.source_table(spark, []).count() == 0
