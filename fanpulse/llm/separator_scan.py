"""Token counts by a separator scan over flat, unindexed token files.

A token file is a stream of little-endian ids, each document followed by the end-of-document id; nothing tells where
documents begin. Files are read as blocks of fixed length that cut documents anywhere. Each block is searched for the end
id at once (numpy) and yields its separators, the tokens before its first and after its last one. A prefix scan over the
blocks' summaries (separators before a block; open tokens carried into it) stitches the documents that cross blocks. The
scan runs per file over one row of four numbers per block; the separators themselves, stored beside the summaries, are
joined back by (file, block), so a file of any length is spread over many tasks. The table of names is numbered likewise.

The files are stored by Spark's committer as Parquet rows (file, block, bytes), so lost executors leave no halves and
readers need no local path. A file's last document may lack its end id: it is counted and marked ``open``.

Nulls: a null text is an empty document (its end id alone, 0 tokens); a null doc_id stays null. An end id among a text's
own ids would split its document, so the writer raises then; the query uses an id outside the vocabulary. Repeated rows
are documents of their own. Other columns are ignored. Empty tables and empty blocks give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import scratch_path, stored, table, text_slices
from .tokens import PieceEncoder, tokenizer_path

BLOCK_TOKENS = 1 << 19
FILES = "kind string, file int, block int, data binary, doc_ids array<long>"


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", block_tokens: int = BLOCK_TOKENS) -> None:
    """One flat stream per input partition, no shuffle; the ids' order goes to a table of names beside it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, file = PieceEncoder.shared(tokenizer), TaskContext.get().partitionId()
        if end_id >= 1 << 8 * encoder.dtype.itemsize:
            raise ValueError("the end id doesn't fit the files' id width")
        end, width = np.array([end_id], encoder.dtype).tobytes(), block_tokens * encoder.dtype.itemsize
        open_block, block, names, seq = bytearray(), 0, [], 0

        def row(kind: str, at: int, data: bytes | None, ids: list | None) -> pa.RecordBatch:
            values = [([kind], pa.string()), ([file], pa.int32()), ([at], pa.int32()), ([data], pa.binary()), ([ids], pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in values], names=["kind", "file", "block", "data", "doc_ids"])

        for batch in text_slices(batches, 4096):
            tokens, lengths = encoder.encode(batch.column(1))
            if len(tokens) and (tokens == end_id).any():
                raise ValueError("a text's own ids hold the end id; choose another one")
            start = 0
            for doc_id, n in zip(batch.column(0).to_pylist(), lengths.tolist()):
                open_block += tokens[start : start + n].tobytes()
                open_block += end
                names.append(doc_id)
                start += n
                while len(open_block) >= width:
                    yield row("tokens", block, bytes(open_block[:width]), None)
                    del open_block[:width]
                    block += 1
            if len(names) >= 8192:
                yield row("names", seq, None, names)
                names, seq = [], seq + 1
        if open_block:
            yield row("tokens", block, bytes(open_block), None)
        if names:
            yield row("names", seq, None, names)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, FILES)
    rows.write.partitionBy("kind").option("compression", "zstd").parquet(path)


def count_tokens(files: DataFrame, end_id: int, id_bytes: int = 2) -> DataFrame:
    """``files``: file, block, data. Per document: file, ordinal in the file, start, n_tokens (without the end id), open."""
    dtype = np.dtype(f"<u{id_bytes}")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, 1):
            ids = np.frombuffer(batch.column(2)[0].as_buffer(), dtype)
            ends = np.flatnonzero(ids == end_id)
            values = [
                (batch.column(0), None), (batch.column(1), None), ([len(ids)], pa.int64()), ([len(ends)], pa.int64()),
                ([int(ends[-1]) + 1 if len(ends) else None], pa.int64()), ([ends], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays([v if t is None else pa.array(v, t) for v, t in values], names=["file", "block", "n", "n_ends", "after_last", "ends"])

    blocks = files.select("file", "block", "data").mapInArrow(scan, "file int, block int, n long, n_ends long, after_last long, ends array<long>")
    blocks = stored(blocks, "separators")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file").orderBy("block")
    first = F.coalesce(F.sum("n").over(before), F.lit(0))  # the block's first token in its file
    stitched = blocks.select("file", "block", "n", "n_ends", "after_last", first.alias("first"), F.coalesce(F.sum("n_ends").over(before), F.lit(0)).alias("docs_before"), F.lead("block").over(whole).alias("next"))
    # the place after the last end before this block: where the document begins that is open at its first token
    stitched = stitched.withColumn("open_at", F.coalesce(F.max(F.col("first") + F.col("after_last")).over(before), F.lit(0)))
    closed = stitched.select("file", "block", "docs_before", "first", "open_at").join(blocks.where("n_ends > 0").select("file", "block", "ends"), ["file", "block"])
    closed = closed.select(
        "file", "docs_before", "first", "open_at",
        F.posexplode(F.transform("ends", lambda e, i: F.struct((e).alias("end"), F.when(i > 0, F.get("ends", i - 1) + 1).alias("own_start")))).alias("i", "d"),
    )
    start = F.coalesce(F.col("first") + F.col("d.own_start"), F.col("open_at"))
    closed = closed.select("file", (F.col("docs_before") + F.col("i")).alias("ordinal"), start.alias("start"), (F.col("first") + F.col("d.end") - start).alias("n_tokens"), F.lit(False).alias("open"))
    tail_at = F.coalesce(F.col("first") + F.col("after_last"), F.col("open_at"))
    tail = stitched.where(F.col("next").isNull() & (F.col("first") + F.col("n") > tail_at))
    tail = tail.select("file", (F.col("docs_before") + F.col("n_ends")).alias("ordinal"), tail_at.alias("start"), (F.col("first") + F.col("n") - tail_at).alias("n_tokens"), F.lit(True).alias("open"))
    return closed.unionByName(tail)


def names_of(files: DataFrame) -> DataFrame:
    """file, ordinal, doc_id from the table of names."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = files.select("file", "block", F.size("doc_ids").alias("n"))
    sizes = sizes.select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("names_before"))
    rows = files.select("file", "block", "doc_ids").join(sizes, ["file", "block"])
    rows = rows.select("file", "names_before", F.posexplode("doc_ids").alias("i", "doc_id"))
    return rows.select("file", (F.col("names_before") + F.col("i")).alias("ordinal"), "doc_id")


def op9_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents: doc_id, file, ordinal, start, n_tokens."""
    path, end_id = scratch_path(spark, "token-files"), 2**16 - 1
    write_token_files(table(spark, sf_dir, "documents"), path, tokenizer_path("word_bpe_49k.json"), end_id)
    read = lambda kind: spark.read.schema(FILES).parquet(path).where(F.col("kind") == kind)
    counts = count_tokens(read("tokens"), end_id)
    return counts.join(names_of(read("names")), ["file", "ordinal"]).select("doc_id", "file", "ordinal", "start", "n_tokens")
