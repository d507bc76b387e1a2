"""Ranked lexical search: accumulator-limited term-at-a-time.

Each item of a query table ranks all documents. Steps:

1. One pass over the whole texts writes a forward index: per document its length and the numbers and frequencies of those
   of its terms that some item holds. Document counts, lengths and document frequencies come from that table.
2. Tasks read the index in blocks of documents and turn each into postings by term, with the exact greatest impact of every
   term in the block. An item's terms are worked off rarest first. While the bounds of the terms still to come could lift
   an unseen document to the kth best partial score, a posting may open an accumulator; from then on no accumulator is
   opened, and the terms left only update the survivors, exactly. A document without an accumulator lies strictly under
   the kth score, so ties are never lost. The kth score of the blocks before carries over as the first limit.
3. The best k of every task are reduced in two steps by item, salted first: no task sees an item's candidates of all tasks.

Items are taken in blocks of about ``QUERY_BYTES`` of text (one item of any length is a block of its own at worst), and only
a block's terms are shared with the tasks, so nothing that is broadcast grows with the corpus or with the query table.

Terms are the maximal matches of ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` in the whole text, only A-Z lower-cased. Null and
empty texts have no terms; they neither count nor are found, and such items find nothing. Equal scores rank by ascending
id, null ids first. Repeated rows of a document are documents of their own; a repeated row of an item gives one result,
rows that share an item's id but not its text are ranked apart. Empty tables give an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table, text_slices

K = 20
QUERY_BYTES = 8 << 20
BLOCK_DOCS = 8192
SALTS = 64
# Fixed values of the score.
SCALE, UNIT, LENGTH_WEIGHT = 1000, 1_000_000_000, 25
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


#: An item's terms, rarest first, and their weights (times their occurrences in the item).
Query = tuple[np.ndarray, np.ndarray]


def forward_index(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n (all terms), terms (numbers of the known ones), tfs."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        for batch in text_slices(batches):
            n, ends, found, counts = [], [0], [], []
            for text in batch.column(1).to_pylist():
                terms = terms_of(text)
                known = Counter(t for t in terms if t in number)
                n.append(len(terms))
                found += [number[t] for t in known]
                counts += known.values()
                ends.append(len(found))
            offsets = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(v, pa.int32())) for v in (found, counts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), *lists], names=["doc_id", "n", "terms", "tfs"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>")


class Block:
    """Postings by term of one block of documents."""

    def __init__(self, lengths: np.ndarray, sizes: np.ndarray, terms: np.ndarray, tfs: np.ndarray, n_docs: int, n_terms: int, vocabulary: int):
        m = 100 - LENGTH_WEIGHT + (LENGTH_WEIGHT * lengths * n_docs) // n_terms
        docs = np.repeat(np.arange(len(lengths)), sizes)
        impact = (UNIT * tfs.astype(np.int64)) // (SCALE * tfs.astype(np.int64) + 12 * m[docs])
        order = np.argsort(terms, kind="stable")  # by term, then by document
        self.docs, self.impact = docs[order], impact[order]
        self.starts = np.searchsorted(terms[order], np.arange(vocabulary + 1))
        self.most = np.zeros(vocabulary, np.int64)
        held = np.flatnonzero(np.diff(self.starts))
        if len(held):
            self.most[held] = np.maximum.reduceat(self.impact, self.starts[held])
        self.scores = np.zeros(len(lengths), np.int64)
        self.open = np.zeros(len(lengths), bool)

    def search(self, query: Query, limit: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, exact scores) of all that reach ``limit`` or the kth best score of this block."""
        terms, weights = query
        bounds = weights * self.most[terms]
        rest = np.cumsum(bounds[::-1])[::-1]  # what a document can still get from this term on
        scores, opened = self.scores, self.open
        i, n_open = 0, 0
        while i < len(bounds) and rest[i] >= limit:
            a, b = self.starts[terms[i]], self.starts[terms[i] + 1]
            if b > a:
                docs = self.docs[a:b]
                scores[docs] += weights[i] * self.impact[a:b]
                n_open += len(docs) - int(opened[docs].sum())
                opened[docs] = True
                if n_open >= k:
                    partial = scores[opened]
                    limit = max(limit, int(np.partition(partial, len(partial) - k)[len(partial) - k]))
            i += 1
        survivors = np.flatnonzero(opened)
        for j in range(i, len(bounds)):
            a, b = self.starts[terms[j]], self.starts[terms[j] + 1]
            if b > a and len(survivors):
                at = np.minimum(np.searchsorted(self.docs[a:b], survivors), b - a - 1)
                hit = self.docs[a:b][at] == survivors
                scores[survivors[hit]] += weights[j] * self.impact[a:b][at[hit]]
        found = scores[survivors].copy()
        scores[survivors], opened[survivors] = 0, False
        keep = found >= max(limit, 1)
        return survivors[keep], found[keep]


def best(scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, ~nulls, -scores))[:k]


def candidates(index: DataFrame, queries: list[Query], n_docs: int, n_terms: int, vocabulary: int, k: int) -> DataFrame:
    """part, item (number of the query), doc_id, score: the best ``k`` of every task."""
    shared = index.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        tops: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for batch in text_slices(batches, BLOCK_DOCS):
            ids, nulls = batch.column(0).fill_null(0).to_numpy(), batch.column(0).is_null().to_numpy(zero_copy_only=False)
            sizes = batch.column(2).value_lengths().to_numpy()
            block = Block(batch.column(1).to_numpy(), sizes, batch.column(2).flatten().to_numpy(), batch.column(3).flatten().to_numpy(), n_docs, n_terms, vocabulary)
            for number, query in enumerate(shared.value):
                top = tops.get(number)
                docs, scores = block.search(query, int(top[0][-1]) if top and len(top[0]) == k else 0, k)
                if len(docs):
                    new = (scores, ids[docs], nulls[docs])
                    if top:
                        new = tuple(np.concatenate(x) for x in zip(top, new))
                    order = best(*new, k)
                    tops[number] = tuple(x[order] for x in new)
        for number, (scores, ids, nulls) in tops.items():
            n = len(scores)
            yield pa.RecordBatch.from_arrays([pa.array([part] * n, pa.int32()), pa.array([number] * n, pa.int32()), pa.array(ids, pa.int64(), mask=nulls), pa.array(scores, pa.int64())], names=["part", "item", "doc_id", "score"])

    return index.mapInArrow(run, "part int, item int, doc_id long, score long")


def weight(n_docs: int, df: int) -> int:
    return math.floor(SCALE * math.log((2 * n_docs + 2) / (2 * df + 1)))


def search_block(docs: DataFrame, items: list[str], id_col: str, text_col: str, k: int) -> DataFrame:
    """item (place in ``items``), rank, doc_id, score."""
    spark = docs.sparkSession
    counted = [Counter(terms_of(text)) for text in items]
    words = sorted(set().union(*counted)) if counted else []
    vocabulary = {t: i for i, t in enumerate(words)}
    index = stored(forward_index(docs, vocabulary, id_col, text_col), "forward")
    n_docs, n_terms = index.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = {r["t"]: r["df"] for r in index.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).collect()}  # a number per term of the block
    queries = []
    for counts in counted:
        terms = sorted((df[i], t, i) for t in counts if (i := vocabulary[t]) in df)
        rows = [(i, w * counts[t]) for n, t, i in terms if (w := weight(n_docs, n)) > 0]
        queries.append((np.array([i for i, _ in rows], np.int64), np.array([w for _, w in rows], np.int64)))
    found = candidates(index, queries, n_docs, max(n_terms, 1), len(words), k)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_first()]
    of_part = Window.partitionBy("item", F.col("part") % SALTS).orderBy(*order)
    found = found.withColumn("rank", F.row_number().over(of_part)).where(F.col("rank") <= k)
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k).select("item", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", query_bytes: int = QUERY_BYTES) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the ``k`` best documents of every item, those with a score above 0."""
    spark = docs.sparkSession
    rows = items.select(F.col(item_col).alias("item_id"), F.col(item_text).cast("string").alias("t")).where("t is not null").distinct()
    total = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, -(-total // query_bytes))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("item_id", "t"), F.lit(blocks)))
    out = None
    for number in range(blocks):
        block = rows.where(F.col("block") == number).select("item_id", "t").collect()
        found = search_block(docs, [r["t"] for r in block], id_col, text_col, k)
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(block)], f"item int, item_id {items.schema[item_col].dataType.simpleString()}")
        found = found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")  # a block's items
        out = found if out is None else out.unionByName(found)
    return out


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS t FROM documents WHERE text IS NOT NULL),
     i AS (SELECT row_number() OVER () AS q, item_id, {_TERMS} AS t FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL)),
     s AS (SELECT count(*) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS n_terms FROM d WHERE len(t) > 0),
     p AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(t) AS n, unnest(t) AS term FROM d) GROUP BY ALL),
     w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, s GROUP BY term),
     q AS (SELECT q, item_id, term, count(*) AS times FROM (SELECT q, item_id, unnest(t) AS term FROM i) GROUP BY ALL),
     x AS (SELECT q, item_id, r, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms)))) AS BIGINT) AS score
           FROM q JOIN w USING (term) JOIN p USING (term), s GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER o AS INTEGER) AS rank, doc_id, score FROM x WHERE score > 0
WINDOW o AS (PARTITION BY q ORDER BY score DESC, doc_id NULLS FIRST) QUALIFY row_number() OVER o <= 20
"""
