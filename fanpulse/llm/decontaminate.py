"""Benchmark decontamination: containment search of short test items inside long documents (DataFrame operations only).

Sets are distinct shingles of ``width`` words of the lower-cased text (words are runs without ASCII signs and blanks). An
item with fewer words is one shingle, the whole sequence; documents are then also cut into shingles of such items' word
counts, so a two-word item is found inside any document that holds the two words in a row. An item is contained in a
document when the document holds at least ``share`` of the item's shingles.

Items are partitioned by the power of two of their set size. A partition's sketch is the item's k least shingle hashes
(bottom-k MinHash), with k = floor((1 - share) * largest size of the partition) + 1: a document that holds ``share`` of
the item lacks fewer than k of its shingles, so it shares at least one sketch value. The containment search therefore
misses nothing; what it finds is verified by the exact share of shingles.

The benchmark's sketches are broadcast only when counted to at most ``BROADCAST_ROWS`` rows, else joined by shuffle.
Nulls: a null or empty text on either side has no shingles and matches nothing; null ids stay null and match like any
other. Repeated rows of a document or item give one result row. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import entered, own, restored, stored, table

BROADCAST_ROWS = 1_000_000  # rows of three longs: about 30 MB
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), NO_WORD), lambda w: w != "")


def shingle_hashes(words: Column, width: int) -> Column:
    """Hashes of all runs of ``width`` words; null where there are fewer words."""
    n = F.size(words)
    return F.when(n >= width, F.transform(F.sequence(F.lit(1), n - F.lit(width - 1)), lambda i: F.xxhash64(F.slice(words, i, width))))


def item_hashes(words: Column, width: int) -> Column:
    n = F.size(words)
    return F.when(n >= width, shingle_hashes(words, width)).when(n > 0, F.array(F.xxhash64(words)))


def maybe_broadcast(small: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint where the counted size allows it; without, Spark joins by shuffle."""
    return F.broadcast(small) if small.limit(rows + 1).count() <= rows else small


def item_shingles(items: DataFrame, id_col: str, text_col: str, width: int, share: float) -> DataFrame:
    """item, item_id, words (of a shingle), h, n_item (set size), in_sketch."""
    texts = items.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("t")).where("t is not null").distinct()
    texts = texts.select("item_id", F.xxhash64("item_id", "t").alias("item"), words_of(F.col("t")).alias("w"))
    rows = texts.select("item", "item_id", F.least(F.size("w"), F.lit(width)).alias("words"), F.explode(F.array_distinct(item_hashes(F.col("w"), width))).alias("h"))
    of_item = Window.partitionBy("item")
    rows = rows.withColumn("n_item", F.count("*").over(of_item))
    largest = F.pow(F.lit(2.0), F.floor(F.log2("n_item")) + 1) - 1  # of the item's size partition
    k = F.floor(F.lit(1 - share + 1e-9) * largest) + 1
    return rows.withColumn("in_sketch", F.row_number().over(of_item.orderBy("h")) <= k)


def contained(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", width: int = 5, share: float = 0.8) -> DataFrame:
    """doc_id, text_hash (of the document's text), item_id, n_item, n_shared, containment: every contained item."""
    shingles = stored(item_shingles(items, item_col, item_text, width, share), "items")
    short = [r["words"] for r in shingles.where(F.col("words") < width).select("words").distinct().collect()]  # at most width - 1 numbers
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t")).where("t is not null")
    rows = rows.select("doc_id", F.xxhash64("t").alias("text_hash"), "t")

    def exploded(df: DataFrame, *more: str) -> DataFrame:
        words = df.select("doc_id", "text_hash", *more, words_of(F.col("t")).alias("w"))
        runs = [F.coalesce(shingle_hashes(F.col("w"), k), F.array().cast("array<bigint>")) for k in sorted({width, *short})]
        return words.select("doc_id", "text_hash", *more, F.explode(F.concat(*runs) if len(runs) > 1 else runs[0]).alias("h"))

    sketch = shingles.where("in_sketch").select("item", "h")
    found = exploded(rows).join(maybe_broadcast(sketch), "h").select("doc_id", "text_hash", "item").distinct()
    found = stored(found, "candidates")
    # verification: only documents with a candidate are read again as shingles
    same = [F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")), F.col("d.text_hash") == F.col("c.text_hash")]
    of_doc = found.groupBy("doc_id", "text_hash").agg(F.collect_set("item").alias("items"))
    chosen = rows.alias("d").join(maybe_broadcast(of_doc).alias("c"), same).select("d.doc_id", "d.text_hash", "c.items", "d.t")
    hits = exploded(chosen, "items").join(maybe_broadcast(shingles.select("item", "item_id", "h", "n_item")), "h").where(F.array_contains("items", F.col("item")))
    hits = hits.groupBy("doc_id", "text_hash", "item", "item_id", "n_item").agg(F.count_distinct("h").alias("n_shared"))
    hits = hits.withColumn("containment", F.col("n_shared") / F.col("n_item"))
    return hits.where(F.col("n_shared") >= F.lit(share - 1e-9) * F.col("n_item")).drop("item")


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that contain no item, with all their columns."""
    bad = stored(contained(docs, items, id_col, text_col, **options).select("doc_id", "text_hash").distinct(), "contaminated")
    bad = bad.select(F.col("doc_id").alias("bad_id"), F.col("text_hash").alias("bad_hash"))
    doc_id, text = own(docs, id_col), own(docs, text_col)
    out = entered(docs).join(maybe_broadcast(bad), F.col(doc_id).eqNullSafe(F.col("bad_id")) & (F.xxhash64(text) == F.col("bad_hash")), "left_anti")
    return restored(out, docs)


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    best = found.groupBy("doc_id", "item_id").agg(F.max(F.struct("containment", "n_shared", "n_item")).alias("m"))
    return best.select("doc_id", "item_id", "m.n_item", "m.n_shared", "m.containment")


_WORDS = r"list_filter(regexp_split_to_array(lower(text), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"
_SHINGLES = """SELECT DISTINCT id, array_to_string(w[i:i + 4], ' ') AS s FROM {0}, range(1, greatest(len(w) - 4, 1) + 1) r(i) WHERE len(w) > 0"""
_SHORT = "SELECT DISTINCT least(len(w), 5) AS k FROM b WHERE len(w) > 0"
ORACLE = f"""
WITH d AS (SELECT doc_id AS id, {_WORDS} AS w FROM documents WHERE text IS NOT NULL),
     b AS (SELECT item_id AS id, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
     ds AS (SELECT DISTINCT id, array_to_string(w[i:i + k - 1], ' ') AS s FROM (SELECT id, w, k FROM d JOIN ({_SHORT}) ON len(w) >= k), range(1, len(w) - k + 2) r(i)),
     bs AS ({_SHINGLES.format("b")}),
     n AS (SELECT id, count(*) AS n_item FROM bs GROUP BY id)
SELECT ds.id AS doc_id, bs.id AS item_id, any_value(n_item) AS n_item, count(*) AS n_shared,
       count(*)::DOUBLE / any_value(n_item) AS containment
FROM ds JOIN bs USING (s) JOIN n ON n.id = bs.id
GROUP BY ds.id, bs.id HAVING count(*) >= 0.8 * any_value(n_item)
"""
