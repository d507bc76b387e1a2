"""Quality rules: compression bands.

The zstandard ratio (raw bytes / compressed bytes) of a whole text and of its fixed chunks must stay inside a band that
depends on the length: repetitive text lies above it, incompressible text (keys, encoded data) below. A rest after the
last chunk is tested in a chunk that ends with the text, so chunks cover every byte; texts under a chunk's length have
shorter chunks, those under 512 bytes only the whole ratio. Base counts that the rules also use: words, characters in words, symbols, repeated lines and repeated 5-word windows.

Words are ``[^\\x20\\x09-\\x0D]+``. A text with no words fails the base rule (under 10 words). Null counts as empty: its
ratio is null. A text is compressed in pieces, whole however long. Repeated rows each get their own result row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACES, table, text_slices

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Bands:
    """Limits by length in bytes: (from this length on, least ratio, most ratio). Chunks: (from this length of the text on,
    bytes of a chunk, least ratio, most ratio); their least ratios lie between base64 (1.18 and 1.29) and prose (1.39 and 1.6)."""

    whole: tuple[tuple[int, float, float], ...] = ((0, 0.0, 2.5), (128, 0.9, 3.5), (512, 1.15, 4.0), (2048, 1.4, 5.0), (16384, 1.45, 6.0))  # text in base64 has 1.33
    chunk: tuple[tuple[int, int, float, float], ...] = ((512, 512, 1.25, 6.0), (2048, 2048, 1.4, 6.0))
    one_outside: int = 8192  # from this length on a single chunk may lie outside,
    most_outside: float = 0.02  # or this share of the chunks, where it is more
    level: int = 3

    def limits(self, n_bytes: int) -> tuple[float, float]:
        return next((low, high) for least, low, high in reversed(self.whole) if n_bytes >= least)

    def chunks(self, n_bytes: int) -> tuple[int, float, float] | None:
        return next((rest for least, *rest in reversed(self.chunk) if n_bytes >= least), None)

    def may_lie_outside(self, n_bytes: int, n_chunks: int) -> int:
        return max(1, int(self.most_outside * n_chunks)) if n_bytes >= self.one_outside else 0


def repeated_windows(words: list[bytes], width: int = 5) -> int:
    """Words that lie in a window of ``width`` words found twice or more, the first finding included."""
    if len(words) <= width:
        return 0
    grams = list(zip(*(words[i:] for i in range(width))))
    first: dict[tuple[bytes, ...], int] = {}
    twice: list[int] = []
    for at, gram in enumerate(grams):
        if (seen := first.setdefault(gram, at)) != at:
            twice.append(at)
            if seen >= 0:
                twice.append(seen)
                first[gram] = -1
    covered, end = 0, 0
    for at in sorted(twice):
        covered += at + width - max(at, end)
        end = at + width
    return covered


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.encode("utf-8", "surrogatepass").split()
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return (
        len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated_windows(words)
    )


def ratios(data: bytes, bands: Bands, coder: zstandard.ZstdCompressor) -> tuple[float | None, list[float]]:
    if not data:
        return None, []
    whole = len(data) / len(coder.compress(data))
    if (chunk := bands.chunks(len(data))) is None:
        return whole, []
    n = chunk[0]
    starts = [*range(0, len(data) - n + 1, n)] + ([len(data) - n] if len(data) % n else [])
    return whole, [n / len(coder.compress(data[i : i + n])) for i in starts]


def in_bands(n_bytes: int, whole: float | None, chunks: list[float], bands: Bands) -> bool:
    if whole is None:
        return False
    low, high = bands.limits(n_bytes)
    _, least, most = bands.chunks(n_bytes) or (0, 0.0, 0.0)
    outside = sum(not least <= r <= most for r in chunks)
    return low <= whole <= high and outside <= bands.may_lie_outside(n_bytes, len(chunks))


SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "kept boolean, whole_ratio double, n_chunks long, least_chunk_ratio double, most_chunk_ratio double"
)


def rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bands: Bands = Bands()) -> DataFrame:
    """One row per document: base counts, ratios and the verdict."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = zstandard.ZstdCompressor(level=bands.level)
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        types = [{"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}[x.split()[1]] for x in SCHEMA.split(", ")]
        for batch in text_slices(batches):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = text or ""
                counts = base_counts(text)
                data = text.encode("utf-8", "surrogatepass")
                whole, chunks = ratios(data, bands, coder)
                failed = counts[0] < 10 or 100 * counts[4] > 20 * counts[0]
                kept = not failed and in_bands(len(data), whole, chunks, bands)
                rows.append((doc_id, *counts, failed, kept, whole, len(chunks), min(chunks, default=None), max(chunks, default=None)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules(table(spark, sf_dir, "documents"))
