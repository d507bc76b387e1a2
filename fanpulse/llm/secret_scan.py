"""Secret scans with multipart credential linking.

Strong candidates stand alone: ``assign``, ``access`` and ``hex`` (the base kinds). Weak candidates are parts of a
credential that say nothing by themselves: ``user`` (an e-mail address used as an account name), ``endpoint`` (a URL,
an IP address with or without port), ``key`` (a mixed-case, digit-bearing run of 20+ characters). Inside a scope
(a paragraph, split at blank lines) parts are joined by interval: two parts meet when the gap between their spans is at
most ``reach`` code points. A weak part is reported only when it meets a part of a complementary role:
identifier (access, user) with secret (assign, hex, key), and endpoint with both an identifier and a secret.

The interval join is a merge over starts with binary search, so its work grows with the candidates, not their pairs.
Null and empty texts have no spans. Offsets are code points, end exclusive. Repeated rows each get their own row.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_slices

# The base kinds in their order, then the weak ones.
KINDS = ("assign", "access", "hex", "endpoint", "user", "key")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # maximal runs, so a match under 18 characters hides none
HEX = re.compile(r"[0-9a-f]{16,}")
# No count limits a part: a scheme is walked back from its ``://``, runs are matched possessively from their beginning.
AUTHORITY = re.compile(r"://[^\s\"'<>]+", re.ASCII)
SCHEME = frozenset("abcdefghijklmnopqrstuvwxyz0123456789+.-")
ADDRESS = re.compile(r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?::\d{1,5})?(?![\d.])", re.ASCII)
USER = re.compile(r"(?<![A-Za-z0-9._+-])[A-Za-z0-9._+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", re.ASCII)
KEY = re.compile(r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{20,}", re.ASCII)
BLANK = re.compile(r"\n[ \t\r]*\n")

ROLE = {"assign": "secret", "hex": "secret", "key": "secret", "access": "id", "user": "id", "endpoint": "endpoint"}
NEEDS = {"key": ("id",), "user": ("secret",), "endpoint": ("id", "secret")}

SCHEMA = (
    "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
    "found array<struct<kind:string,start:bigint,end:bigint>>"
)

Span = tuple[int, int, int]  # start, rank of the kind, end


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each base kind; the whole match is the span."""
    out: list[Span] = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def endpoints(text: str) -> list[tuple[int, int]]:
    """(start, end) of URLs, whole, and of IP addresses outside of them."""
    out, at = [], 0
    while m := AUTHORITY.search(text, at):
        start = m.start()
        while start > at and text[start - 1] in SCHEME:
            start -= 1
        while start < m.start() and not text[start].isalpha():  # a scheme begins with a letter
            start += 1
        if m.start() - start >= 2:
            out.append((start, m.end()))
            at = m.end()
        else:
            at = m.start() + 3
    inside = _Parts([(s, 0, e) for s, e in out])
    return sorted(out + [(m.start(), m.end()) for m in ADDRESS.finditer(text) if not inside.covers(m.start(), m.end())])


def weak_spans(text: str) -> list[Span]:
    out: list[Span] = [(s, 3, e) for s, e in endpoints(text)] if "." in text or "://" in text else []
    if "@" in text:
        out += [(m.start(), 4, m.end()) for m in USER.finditer(text)]
    out += [
        (m.start(), 5, m.end()) for m in KEY.finditer(text)
        if (s := m[0]) != s.lower() and s != s.upper() and any(c.isdigit() for c in s)
    ]
    return out


class _Parts:
    """Spans of one role within a scope, by start, with the running maximum of their ends."""

    def __init__(self, spans: list[Span]):
        spans = sorted(spans)
        self.starts = [s for s, _, _ in spans]
        self.last: list[int] = []
        for _, _, end in spans:
            self.last.append(max(end, self.last[-1]) if self.last else end)

    def meets(self, start: int, end: int, reach: int) -> bool:
        i = bisect_right(self.starts, end + reach)
        return i > 0 and self.last[i - 1] >= start - reach

    def covers(self, start: int, end: int) -> bool:
        """One span holds the whole of start..end."""
        i = bisect_right(self.starts, start)
        return i > 0 and self.last[i - 1] >= end


def linked(text: str, strong: list[Span], weak: list[Span], reach: int) -> list[Span]:
    """The weak parts that meet all roles they need inside their scope."""
    breaks = [m.start() for m in BLANK.finditer(text)] if "\n" in text else []
    scopes: dict[int, list[Span]] = {}
    covered = _Parts([s for s in strong])
    for span in strong + [w for w in weak if not covered.covers(w[0], w[2])]:  # a part of a strong span adds nothing
        scopes.setdefault(bisect_left(breaks, span[0]), []).append(span)
    out: list[Span] = []
    for spans in scopes.values():
        parts = {role: _Parts([s for s in spans if ROLE[KINDS[s[1]]] == role]) for role in ("id", "secret")}
        out += [s for s in spans if KINDS[s[1]] in NEEDS and all(parts[r].meets(s[0], s[2], reach) for r in NEEDS[KINDS[s[1]]])]
    return out


def scan_text(text: str | None, reach: int = 200) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans), each by start, then kind."""
    if not text:
        return [], []
    base = base_spans(text)
    if not base:  # every link needs at least one identifier and one secret; users with keys need a look
        if "@" not in text:
            return [], []
    return base, sorted(base + linked(text, base, weak_spans(text), reach))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = 200) -> DataFrame:
    """One row per document with its base counts, the digest of the base spans, and all spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string()),
             ("spans", pa.string()), ("found", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))]
        )
        for batch in text_slices(batches):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                base, spans = scan_text(text, reach)
                n = [sum(k == kind for _, k, _ in base) for kind in range(3)]
                rows.append({
                    "doc_id": doc_id, "n_assign": n[0], "n_access": n[1], "n_hex": n[2],
                    "base_sha256": hashlib.sha256(joined(base).encode()).hexdigest(), "spans": joined(spans),
                    "found": [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans],
                })
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).drop("found")
