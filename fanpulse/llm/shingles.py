"""Hashes of word shingles of whole texts, vectorised over a batch.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z. A word's hash is a polynomial over its bytes (random odd base,
random value per byte, 64 bits), mixed; a shingle's hash combines its words' hashes by place and is mixed again. Equal
shingles always have equal hashes; different ones share a hash with a chance of about 2**-64.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_BASE = int(_RNG.integers(1 << 60, 1 << 62)) * 2 + 1
_PLACE = _RNG.integers(1, 1 << 63, 64, dtype=np.uint64) * _U(2) + _U(1)
_GAP = np.zeros(256, dtype=bool)
_GAP[[9, 10, 11, 12, 13, 32]] = True
_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse mod 2**64, for at most one slice of text at a time."""
    if len(_POWERS["up"]) < n:
        size = 1 << (n - 1).bit_length()
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            full = np.full(size, base & ((1 << 64) - 1), dtype=np.uint64)
            full[0] = 1
            _POWERS[name] = np.multiply.accumulate(full)
    return _POWERS["up"], _POWERS["down"]


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first byte) of each word of ``data``."""
    if not data:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    raw = np.frombuffer(data, np.uint8)
    gap = _GAP[raw]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], gap, [True]])))
    starts, ends = edge[::2], edge[1::2]
    up, down = _powers(len(raw) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[raw] * up[: len(raw)], dtype=np.uint64)])
    return mix64((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64)), starts


def shingle_sets(texts: list[str | None], width: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a text with fewer words is one shingle, one without any is empty."""
    data = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    bounds = np.cumsum([0] + [len(d) + 1 for d in data])
    hashes, starts = word_hashes(b"\n".join(data))
    first = np.searchsorted(starts, bounds)
    n = len(hashes)
    rolled = np.zeros(max(0, n - width + 1), np.uint64)
    for k in range(width):
        rolled += hashes[k : n - width + 1 + k] * _PLACE[k] if n >= width else 0
    rolled = mix64(rolled)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(rolled[a : b - width + 1]))
        elif b > a:
            short = np.concatenate([hashes[a:b] * _PLACE[: b - a], _PLACE[63 - (b - a) : 64 - (b - a)]])
            out.append(mix64(short.sum(dtype=np.uint64, keepdims=True)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
