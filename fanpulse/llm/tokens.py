"""Token ids of whole texts by a public tokenizer file, with the encodings of words kept per worker.

The tokenizer in use drops white space, so a text's ids are those of its blank-separated chunks in order. Chunks are cut
further into letter runs, digits and signs only where that cannot change the result (each such piece is exactly one
pre-token); all other chunks go to the library as they are. New pieces are encoded many at a time. Arrow does the cutting
and the laying out; Python sees each distinct piece of a batch once.
"""

from __future__ import annotations

import os
import re
import sys
import types
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Encodings of pieces that a worker keeps at most (about 200 MB); beyond that it starts anew.
KEPT_PIECES = 1_200_000

_PLAIN = re.compile(r"[a-z]+|[0-9]|[!-/:-@\[-`{-~]+")
_SIMPLE = re.compile(r"[a-z]+|[0-9]|[!-&(-/:-@\[-`{-~]+")
_LETTERS = re.compile(r"[^\W\d_]+|[0-9]|[!-/:-@\[-`{-~]+")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class PieceEncoder:
    """Ids of many texts at once. Exact for tokenizers that drop white space and mark word ends (``</w>``)."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        for word, i in vocabulary.items():
            self.ends[i] = word.endswith("</w>")
        self.pieces: dict[str, bytes] = {"": b""}
        self.dtype = np.dtype("<u2") if len(self.ends) <= 1 << 16 else np.dtype("<u4")

    @staticmethod
    def shared(path: str) -> PieceEncoder:
        """One per worker process and file, so that later tasks find the pieces of earlier ones."""
        state = sys.modules.setdefault("_fanpulse_worker_state", types.ModuleType("_fanpulse_worker_state"))
        key = f"encoder:{path}"
        if key not in state.__dict__:
            state.__dict__[key] = PieceEncoder(path)
        return state.__dict__[key]

    def _cut(self, chunk: str) -> list[str]:
        """Pieces that are one pre-token each, or the chunk itself where that isn't certain."""
        if "'" in chunk or "<|" in chunk:
            return [chunk]
        if chunk.isascii():
            pieces = _PLAIN.findall(chunk.lower())
            return pieces if sum(map(len, pieces)) == len(chunk) else [chunk]
        if unicodedata.is_normalized("NFC", chunk):
            pieces = _LETTERS.findall(chunk)
            if sum(map(len, pieces)) == len(chunk) and all(p.isascii() or (p.isalpha() and p.lower().isalpha()) for p in pieces):
                return pieces
        return [chunk]

    def _learn(self, new: list[str]) -> None:
        """Encode unknown pieces: simple ones many at a time, others cut up where that is certain, else one by one."""
        known = self.pieces
        simple, rest, parts = [], set(), {}
        seen: set[str] = set()
        for p in new:
            if _SIMPLE.fullmatch(p) and "<|" not in p:
                simple.append(p)
                continue
            cut = self._cut(p)
            if len(cut) == 1 and cut[0] == p and not p.isalnum():
                rest.add(p)
                continue
            seen.update(c for c in cut if c not in known)
            if cut != [p]:
                parts[p] = cut
        simple = list(seen.union(simple)) if seen else simple
        for at in range(0, len(simple), 4096):
            part = simple[at : at + 4096]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, dtype=self.dtype)
            ends = (np.flatnonzero(self.ends[ids]) + 1) * self.dtype.itemsize
            if len(ends) == len(part):
                data, start = ids.tobytes(), 0
                for piece, end in zip(part, ends.tolist()):
                    known[piece] = data[start:end]
                    start = end
            else:  # some piece was no single pre-token after all: each by itself
                rest.update(part)
        if rest:
            one_by_one = list(rest)
            for piece, e in zip(one_by_one, self.tokenizer.encode_batch_fast(one_by_one, add_special_tokens=False)):
                known[piece] = np.array(e.ids, dtype=self.dtype).tobytes()
        for p, cut in parts.items():
            known[p] = b"".join([known[c] for c in cut])

    def _ids_of(self, pieces: list[str]) -> list[bytes]:
        if len(self.pieces) > KEPT_PIECES:
            self.pieces = {"": b""}
        known = self.pieces
        self._learn([p for p in pieces if p not in known])
        return [known[p] for p in pieces]

    def _bytes_of(self, chunks: pa.Array) -> pa.Array:
        """The ids' bytes of each chunk. Chunks of ASCII signs are cut into pieces by Arrow, others are one piece."""
        plain = pc.and_not(pc.match_substring_regex(chunks, r"^[a-zA-Z0-9!-&(-/:-@\[-`{-~]+$"), pc.match_substring(chunks, "<|"))
        spaced = pc.replace_substring_regex(pc.ascii_lower(chunks), r"([0-9]|[!-/:-@\[-`{-~]+)", r" \1 ")
        cut = pc.ascii_split_whitespace(pc.if_else(plain, spaced, chunks))
        coded, at = cut.flatten().dictionary_encode(), np.asarray(cut.offsets)
        laid = pa.array(self._ids_of(coded.dictionary.to_pylist()), pa.large_binary()).take(coded.indices)
        ends = np.frombuffer(laid.buffers()[1], np.int64, len(laid) + 1)
        return pa.Array.from_buffers(pa.large_binary(), len(chunks), [None, pa.py_buffer(ends[at - at[0]]), laid.buffers()[2]])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, number of ids of each text); null texts have none."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
        flat, offsets = split.flatten(), np.asarray(split.offsets)
        if not len(flat):
            return np.zeros(0, self.dtype), np.zeros(len(texts), np.int64)
        coded = flat.dictionary_encode()
        # the ids' bytes of each chunk, laid one after another by Arrow
        laid = self._bytes_of(coded.dictionary).take(coded.indices)
        ends = np.frombuffer(laid.buffers()[1], np.int64, len(laid) + 1) // self.dtype.itemsize
        tokens = np.frombuffer(laid.buffers()[2], self.dtype, int(ends[-1])) if ends[-1] else np.zeros(0, self.dtype)
        return tokens, np.diff(ends[offsets - offsets[0]])
