"""Token-ID output in a binary format with directly addressable codes.

Ids are cut into chunks of ``CHUNK`` bits. Level 0 holds the lowest chunk of every id; a bitmap tells which ids go on,
and level 1 holds the next chunk of only those, and so on. A rank directory over each bitmap (ones before every
512-bit superblock) gives the place of an id's next chunk, so any token is read from a block with a few array accesses
and no block is decoded for it.

A file (Parquet, written by Spark's committer, so lost executors do no harm) holds the ids of a range of documents in
ascending doc_id order, cut into blocks. A block is one row: ``part`` and ``block`` say its place, ``n_tokens`` its
length, ``data`` the levels, ``doc_ids``/``doc_tokens`` its documents. Every document ends with the end id.

Nulls: a null text has only its end id; rows with a null doc_id stand first. Repeated rows and ids are each kept, in a
fixed order of their texts. Other columns are ignored. An empty table gives an empty file set.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import scratch_path, table, text_slices
from .tokens import PieceEncoder, tokenizer_path

CHUNK = 8
SUPER = 512  # bits between entries of a rank directory
MAGIC = b"DAC1"
BLOCK_TOKENS = 1 << 18

BLOCKS = "part int, block int, first_doc long, n_tokens long, data binary, doc_ids array<long>, doc_tokens array<long>"


def encode(ids: np.ndarray) -> bytes:
    """Header: magic, levels, tokens; then per level: entries, chunk bytes, bitmap words, rank directory."""
    out, rest = [], ids.astype(np.uint32)
    levels = 0
    while True:
        more = rest >> CHUNK
        goes_on = more > 0
        bits = np.packbits(goes_on, bitorder="little")
        bits = np.pad(bits, (0, -len(bits) % (SUPER // 8)))
        ones = np.add.reduceat(np.unpackbits(bits), np.arange(0, len(bits) * 8, SUPER), dtype=np.uint32) if len(bits) else np.zeros(0, np.uint32)
        ranks = (np.cumsum(ones, dtype=np.uint32) - ones).astype("<u4")
        out += [struct.pack("<Q", len(rest)), (rest & 255).astype(np.uint8).tobytes(), bits.tobytes(), ranks.tobytes()]
        levels += 1
        if not goes_on.any():
            return MAGIC + struct.pack("<IQ", levels, len(ids)) + b"".join(out)
        rest = more[goes_on]


class Block:
    """Random access to the tokens of an encoded block."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a block of directly addressable codes")
        levels, self.n = struct.unpack_from("<IQ", data, 4)
        at, self.levels = 16, []
        for _ in range(levels):
            (n,) = struct.unpack_from("<Q", data, at)
            chunks = np.frombuffer(data, np.uint8, n, at + 8)
            n_bits = -(-n // SUPER) * (SUPER // 8)
            bits = np.frombuffer(data, np.uint8, n_bits, at + 8 + n)
            ranks = np.frombuffer(data, "<u4", n_bits * 8 // SUPER, at + 8 + n + n_bits)
            self.levels.append((chunks, bits, ranks))
            at += 8 + n + n_bits + 4 * len(ranks)

    @staticmethod
    def _rank(bits: np.ndarray, ranks: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Ones before each place: the directory's entry, plus those of the places' own superblock."""
        block = places // SUPER
        used, where = np.unique(block, return_inverse=True)
        own = np.unpackbits(bits.reshape(-1, SUPER // 8)[used], axis=1, bitorder="little")
        before = np.cumsum(own, axis=1, dtype=np.uint16) - own
        return ranks[block].astype(np.int64) + before[where, places % SUPER]

    def access(self, places: np.ndarray) -> np.ndarray:
        """The ids at ``places``, by following continuation bits; only superblocks that hold a place are looked at."""
        places = np.asarray(places, dtype=np.int64)
        if len(places) and (places.min() < 0 or places.max() >= self.n):
            raise IndexError("no such token")
        out = np.zeros(len(places), np.uint32)
        live = np.arange(len(places))
        for level, (chunks, bits, ranks) in enumerate(self.levels):
            out[live] |= chunks[places].astype(np.uint32) << np.uint32(CHUNK * level)
            on = (bits[places >> 3] >> (places & 7).astype(np.uint8)) & 1 == 1
            if not on.any():
                break
            places, live = self._rank(bits, ranks, places[on]), live[on]
        return out


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", block_tokens: int = BLOCK_TOKENS) -> None:
    """Tokenise and write all documents in ascending doc_id order: range-partitioned by id, a file set per partition."""
    small = np.uint32(end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, block = PieceEncoder.shared(tokenizer), TaskContext.get().partitionId(), 0
        held: list[np.ndarray] = []
        ids: list[int | None] = []
        sizes: list[int] = []

        def flush() -> pa.RecordBatch:
            tokens = np.concatenate(held)
            row = [[part], [block], [ids[0]], [len(tokens)], [encode(tokens)], [list(ids)], [list(sizes)]]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            names = ["part", "block", "first_doc", "n_tokens", "data", "doc_ids", "doc_tokens"]
            held.clear(), ids.clear(), sizes.clear()
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], names=names)

        for batch in text_slices(batches, 4096):
            tokens, lengths = encoder.encode(batch.column(1))
            start = 0
            for doc_id, n in zip(batch.column(0).to_pylist(), lengths.tolist()):
                held += [tokens[start : start + n].astype(np.uint32), np.array([small], np.uint32)]
                ids.append(doc_id)
                sizes.append(n + 1)
                start += n
                if sum(sizes[-64:]) >= block_tokens or len(sizes) % 64 == 0 and sum(sizes) >= block_tokens:
                    yield flush()
                    block += 1
        if ids:
            yield flush()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.crc32(F.col("text").cast("binary")), "text")
    rows.mapInArrow(run, BLOCKS).write.option("compression", "zstd").parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, part, block, place in the block, n_tokens, ids_crc32, read by direct access."""
    schema = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("place", pa.int64()), ("doc_id", pa.int64()), ("offset", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, 1):
            row = batch.to_pylist()[0]
            block = Block(row["data"])
            sizes = np.array(row["doc_tokens"], np.int64)
            starts = np.cumsum(sizes) - sizes
            crc: list[int] = []
            for at in range(0, len(sizes), 64):  # the ids of some documents at a time
                first, last = int(starts[at]), int(starts[min(at + 64, len(sizes)) - 1] + sizes[min(at + 64, len(sizes)) - 1])
                data = block.access(np.arange(first, last)).astype("<u4").tobytes()
                crc += [zlib.crc32(data[4 * (s - first) : 4 * (s - first + n)]) for s, n in zip(starts[at : at + 64].tolist(), sizes[at : at + 64].tolist())]
            n = len(sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["part"]] * n, pa.int32()), pa.array([row["block"]] * n, pa.int32()), pa.array(range(n), pa.int64()),
                 pa.array(row["doc_ids"], pa.int64()), pa.array(starts), pa.array(sizes), pa.array(crc, pa.int64())], schema=schema)

    return spark.read.schema(BLOCKS).parquet(path).select("part", "block", "data", "doc_ids", "doc_tokens").mapInArrow(
        run, "part int, block int, place long, doc_id long, offset long, n_tokens long, ids_crc32 long")


def block_starts(spark: SparkSession, path: str) -> DataFrame:
    """First token of each block in the whole output: totals of parts first, then of the blocks inside a part.

    The window over parts has a row per written partition; that over blocks is split by part.
    """
    blocks = spark.read.schema(BLOCKS).parquet(path).select("part", "block", "n_tokens")
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("part_start"))
    return blocks.join(parts, "part").select("part", "block", (F.col("part_start") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).alias("block_start"))


def op5_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-codes")
    write(table(spark, sf_dir, "documents"), path, tokenizer_path("word_bpe_49k.json"), end_id=2)
    docs, starts = read_documents(spark, path), block_starts(spark, path)
    return docs.join(starts, ["part", "block"]).select("doc_id", (F.col("block_start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")
