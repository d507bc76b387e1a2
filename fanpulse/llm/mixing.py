"""Mixing sources to target weights.

The words of each source are packed, document after document, into blocks of fixed length. The mix has as many slots of
each source as its target asks for. Slots are dealt to output shards by multinomial draws, conditioned on the totals (a
seeded binary tree of hypergeometric draws, so any shard finds its own counts without the others). A slot's running
number within its source is mapped through a pseudorandom permutation of the source's blocks (a keyed Feistel network,
another key each time the source starts anew), and blocks join slots by (source, block index).

Sources by code point, null last, weigh 5, 2, 1, 5, 2, 1, ...; targets share all words by weight, stop at 3 times their
source's size, and the excess is reshared by weight until none is above. A block is thus taken 3 times at most, and so is
every word. The only error against the targets is the rounding to whole blocks: at most one and a half per source.

Words are ``[^\\x20\\x09-\\x0D]+``. Null and empty texts have size 0 and are never taken. A null source is a source of its
own. Repeated rows are documents of their own. All draws depend on ``seed`` alone, so reruns agree. The driver holds one
row per source.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import entered, own, restored, stored, table

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
BLOCK_WORDS = 64
SHARD_SLOTS = 1 << 14
WORD = r"[^\x20\x09-\x0D]+"
_M = (1 << 64) - 1


def targets(sizes: list[tuple[str | None, int]], weights: tuple[int, ...] = WEIGHTS, cap: float = MOST_REPEATS) -> dict[str | None, float]:
    """Target words by source."""
    order = sorted(sizes, key=lambda s: (s[0] is None, s[0] or ""))
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(order)}
    size = dict(order)
    total, out = float(sum(size.values())), {}
    open_, left = [s for s in size if size[s] > 0], total
    out.update({s: 0.0 for s in size if size[s] == 0})
    while open_:
        unit = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if weight[s] * unit > cap * size[s]]
        if not over:
            out.update({s: weight[s] * unit for s in open_})
            break
        for s in over:
            out[s] = float(cap * size[s])
            left -= out[s]
        open_ = [s for s in open_ if s not in over]
    return out


def _mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """Places of ``index`` in a keyed permutation of 0..n-1: a four-round Feistel network, walked until inside."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    keys = [np.uint64(k) for k in np.random.default_rng(key).integers(0, 1 << 63, 4)]
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> shift, out[todo] & mask
        for k in keys:
            left, right = right, left ^ (_mix64(right + k) & mask)
        out[todo] = (left << shift) | right
        todo = todo[out[todo] >= np.uint64(n)]
    return out.astype(np.int64)


def _hypergeometric(good: int, bad: int, n: int, rng: np.random.Generator) -> int:
    """How many of ``n`` slots drawn without replacement are among the ``good`` ones, for totals beyond numpy's range.

    Inversion over all counts within nine standard deviations and 100 of the mode; what lies outside has less chance than
    a double's resolution. Chances follow from their exact ratios, so no large factorials are subtracted.
    """
    total = good + bad
    least, most = max(0, n - bad), min(n, good)
    mode = (n + 1) * (good + 1) // (total + 2)
    reach = 100 + int(9 * math.sqrt(n / total * good * (bad / total) * ((total - n) / max(1, total - 1))))
    lo, hi = max(least, mode - reach), min(most, mode + reach)
    k = np.arange(lo, hi, dtype=np.float64)  # ratio of k + 1 to k
    step = np.log((good - k) * (n - k)) - np.log((k + 1) * (bad - n + k + 1))
    logs = np.concatenate([[0.0], np.cumsum(step)])
    chance = np.cumsum(np.exp(logs - logs.max()))
    return lo + int(np.searchsorted(chance, rng.random() * chance[-1], side="right"))


def _split(counts: np.ndarray, n_left: int, rng: np.random.Generator) -> np.ndarray:
    """Counts of a part of ``n_left`` slots out of sum(counts), drawn source by source until the rest is in numpy's range."""
    out = np.zeros(len(counts), np.int64)
    total, n = int(counts.sum()), n_left
    for i, count in enumerate(map(int, counts)):
        if total < 10**9:
            out[i:] = rng.multivariate_hypergeometric(counts[i:], n, method="marginals")
            break
        out[i] = _hypergeometric(count, total - count, n, rng) if count and n else 0
        total, n = total - count, n - int(out[i])
    return out


def shard_counts(draws: np.ndarray, per_shard: int, shard: int, seed: int, known: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(draws of each source in this shard, those in the shards before it). ``known`` keeps the left counts of nodes that
    neighbouring shards share, for as long as the caller likes."""
    lo, hi = 0, max(1, math.ceil(int(draws.sum()) / per_shard))
    counts, before, known = draws.astype(np.int64), np.zeros(len(draws), np.int64), {} if known is None else known
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if (lo, hi) not in known:
            if len(known) >= 256:
                known.clear()
            known[lo, hi] = _split(counts, (mid - lo) * per_shard, np.random.default_rng([seed, lo, hi]))
        left = known[lo, hi]
        if shard < mid:
            counts, hi = left, mid
        else:
            before, counts, lo = before + left, counts - left, mid
    return counts, before


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, text_hash, source, size, start: where each document's words begin in its source's stream (by doc_id)."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash"), F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )
    rows = rows.repartitionByRange("source", "doc_id", "text_hash").sortWithinPartitions("source", "doc_id", "text_hash")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, totals = TaskContext.get().partitionId(), {}
        for batch in batches:
            starts = np.zeros(batch.num_rows, np.int64)
            sizes = batch.column(3).to_numpy()
            coded = batch.column(2).dictionary_encode(null_encoding="encode")
            codes = coded.indices.to_numpy()
            for code, source in enumerate(coded.dictionary.to_pylist()):
                at = np.flatnonzero(codes == code)
                ends = totals.get(source, 0) + np.cumsum(sizes[at])
                starts[at] = ends - sizes[at]
                totals[source] = int(ends[-1])
            yield pa.RecordBatch.from_arrays([pa.array([part] * batch.num_rows, pa.int32()), *batch.columns, pa.array(starts)], names=["part", "doc_id", "text_hash", "source", "size", "start"])

    rows = stored(rows.mapInArrow(run, "part int, doc_id long, text_hash long, source string, size long, start long"), "packed")
    parts = rows.groupBy("part", "source").agg(F.sum("size").alias("n"))  # few sources each, as rows are sorted by source
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("part").alias("p_part"), F.col("source").alias("p_source"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    rows = rows.join(parts, (F.col("part") == F.col("p_part")) & F.col("source").eqNullSafe(F.col("p_source")))
    return rows.select("doc_id", "text_hash", "source", "size", (F.col("first") + F.col("start")).alias("start"))


def plan(rows: DataFrame, block_words: int = BLOCK_WORDS) -> list[tuple]:
    """(number, source, size, target, blocks, draws) of each source."""
    sizes = [(r["source"], r["n"]) for r in rows.groupBy("source").agg(F.sum("size").alias("n")).collect()]
    goal = targets(sizes)
    out = []
    for i, (source, size) in enumerate(sorted(sizes, key=lambda s: (s[0] is None, s[0] or ""))):
        blocks = -(-size // block_words)
        # the last block may be short: a whole run over the source takes `size` words, the rest is rounded to blocks
        runs, rest = divmod(goal[source], size) if size else (0, 0)
        draws = int(runs) * blocks + min(blocks, round(rest / block_words))
        out.append((i, source, size, float(goal[source]), blocks, min(draws, MOST_REPEATS * blocks)))
    return out


def slots(spark: SparkSession, sources: list[tuple], seed: int = 17, per_shard: int = SHARD_SLOTS) -> DataFrame:
    """shard, slot, src (number of the source), epoch (which run over the source), block."""
    blocks, draws = np.array([s[4] for s in sources], np.int64), np.array([s[5] for s in sources], np.int64)
    n_shards = max(1, math.ceil(int(draws.sum()) / per_shard)) if len(draws) else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                counts, before = shard_counts(draws, per_shard, shard, seed, known)
                cols: list[list[np.ndarray]] = [[], [], []]
                for src in np.flatnonzero(counts):
                    number = before[src] + np.arange(counts[src])
                    epochs, index = np.divmod(number, blocks[src])
                    for e in np.unique(epochs):
                        at = index[epochs == e]
                        cols[0].append(np.full(len(at), src, np.int32))
                        cols[1].append(np.full(len(at), e, np.int32))
                        cols[2].append(permuted(at, int(blocks[src]), [seed, int(src), int(e)]))
                if cols[0]:
                    src, epoch, block = map(np.concatenate, cols)
                    order = np.random.default_rng([seed, shard, 1]).permutation(len(src))
                    n = len(src)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, shard, np.int64)), pa.array(np.arange(n, dtype=np.int32)), *(pa.array(c[order]) for c in (src, epoch, block))], names=["shard", "slot", "src", "epoch", "block"])

    tasks = max(1, min(n_shards, 4 * spark.sparkContext.defaultParallelism))
    return spark.range(0, n_shards, 1, tasks).mapInArrow(run, "shard long, slot int, src int, epoch int, block long")


def source_table(spark: SparkSession, sources: list[tuple]) -> DataFrame:
    """src, s_source, source_size, target; made from Arrow, which needs no Python worker on the executors."""
    types = [("src", pa.int32()), ("s_source", pa.string()), ("source_size", pa.int64()), ("target", pa.float64())]
    return spark.createDataFrame(pa.table({name: pa.array([s[i] for s in sources], t) for i, (name, t) in enumerate(types)}))


def mix(spark: SparkSession, rows: DataFrame, sources: list[tuple], seed: int = 17, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mixed corpus as slices: shard, slot, src, epoch, doc_id, text_hash, start, from_word, n (words of that document)."""
    known = F.broadcast(source_table(spark, sources).select("src", "s_source"))  # a row per source
    docs = rows.where("size > 0").join(known, F.col("source").eqNullSafe(F.col("s_source")))
    size = F.lit(block_words)
    docs = docs.withColumn("block", F.explode(F.sequence(F.expr(f"start div {block_words}"), F.expr(f"(start + size - 1) div {block_words}"))))
    first, last = F.greatest("start", F.col("block") * size), F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * size)
    pieces = docs.select("src", "block", "doc_id", "text_hash", "start", (first - F.col("start")).alias("from_word"), (last - first).alias("n"))
    return slots(spark, sources, seed).join(pieces.hint("merge"), ["src", "block"])  # both sides grow with the corpus


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stored(packed(table(spark, sf_dir, "documents")), "sizes")
    sources = plan(rows)
    taken = mix(spark, rows, sources).groupBy("src", "start").agg(F.sum("n").alias("taken"))
    known = F.broadcast(source_table(spark, sources))
    rows = rows.join(known, F.col("source").eqNullSafe(F.col("s_source"))).withColumn("key", F.when(F.col("size") > 0, F.col("start")))
    taken = taken.select(F.col("src").alias("t_src"), F.col("start").alias("t_start"), "taken")
    out = rows.join(taken, (F.col("src") == F.col("t_src")) & (F.col("key") == F.col("t_start")), "left")
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, seed: int = 17) -> DataFrame:
    """The mix as documents with the columns of ``docs``: for every run over a source, a document's taken words.

    A document taken whole keeps its text; of one taken in part, the taken words stay in order with the blanks after
    them, and blanks before its first word are left out. ``n_chars`` follows where there is such a column. Other columns
    pass through, whatever their names; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    rows = stored(packed(docs), "sizes")
    sources = plan(rows)
    key = ["doc_id", "text_hash", "source"]
    copy = Window.partitionBy(*key)
    numbered = rows.where("size > 0").withColumn("copy", F.row_number().over(copy.orderBy("start")))  # equal rows are told apart by number
    taken = mix(spark, rows, sources, seed).groupBy("src", "start", "epoch").agg(F.sum("n").alias("n"), F.array_sort(F.collect_list(F.struct("from_word", "n"))).alias("pieces"))
    known = F.broadcast(source_table(spark, sources).select("src", "s_source"))
    taken = numbered.join(known, F.col("source").eqNullSafe(F.col("s_source"))).join(taken, ["src", "start"]).select(
        F.col("doc_id").alias("t_id"), F.col("text_hash").alias("t_hash"), F.col("source").alias("t_source"), F.col("copy").alias("t_copy"), "epoch", "n", "size", "pieces")
    doc_id, text, source = (own(docs, c) for c in ("doc_id", "text", "source"))
    mine = entered(docs).withColumn("own_hash", F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    mine = mine.withColumn("own_copy", F.row_number().over(Window.partitionBy(doc_id, "own_hash", source).orderBy("own_hash")))
    on = F.col(doc_id).eqNullSafe(F.col("t_id")) & (F.col("own_hash") == F.col("t_hash")) & F.col(source).eqNullSafe(F.col("t_source")) & (F.col("own_copy") == F.col("t_copy"))
    words = F.regexp_extract_all(F.col(text), F.lit(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"), F.lit(0))
    cut = F.array_join(F.transform("pieces", lambda p: F.array_join(F.slice("own_words", p["from_word"].cast("int") + 1, p["n"].cast("int")), "")), "")
    out = mine.join(taken, on)
    out = out.withColumn("own_words", F.when(F.col("n") < F.col("size"), words)).withColumn(text, F.when(F.col("n") < F.col("size"), cut).otherwise(F.col(text)))
    if "n_chars" in docs.columns:
        out = out.withColumn(own(docs, "n_chars"), F.length(text).cast(docs.schema["n_chars"].dataType))
    return restored(out, docs)
