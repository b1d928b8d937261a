"""Byte-level BPE by a sentencepiece model that is written from a rank file.

Each byte stands for one character, each vocabulary entry becomes a piece of those characters with the
score -rank, and normalisation is identity, so the model merges as the ranks say. Pre-tokens are encoded
one by one; an entry that is itself a pre-token is taken whole, as the rank format's own library does.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
from pyspark.sql import DataFrame

from tidemark.llm.common import map_rows, pick
from tidemark.llm.sp_model import BPE, UNKNOWN, Piece, model_file

#: Pre-tokens whose ids a task remembers before it starts afresh, and characters of the longest that it remembers.
_REMEMBERED, _LONGEST = 200_000, 64
#: The character that stands for byte b has this code point plus b.
_SHIFT = 0x3400
_TO_CHARS = {b: _SHIFT + b for b in range(256)}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def mapped(data: bytes) -> str:
    """One character for each byte."""
    return data.decode("latin-1").translate(_TO_CHARS)


def unmapped(text: str) -> bytes:
    return bytes(ord(c) - _SHIFT for c in text)


class ByteBpe:
    """Encoder and decoder of one vocabulary; one per task, so that a worker that goes on to other work holds none."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex
        import sentencepiece

        self._ranks, self._split = ranks, regex.compile(pattern)
        by_rank = sorted(ranks, key=ranks.get)
        pieces = [Piece("<unk>", 0.0, UNKNOWN), *[Piece(mapped(b), -float(ranks[b])) for b in by_rank]]
        self._model = sentencepiece.SentencePieceProcessor(
            model_proto=model_file(pieces, BPE, dummy_prefix=False, escape=False, byte_fallback=False)
        )
        self._rank_of = np.array([0, *[ranks[b] for b in by_rank]], np.uint32)
        self._bytes_of = {ranks[b]: unmapped(self._model.id_to_piece(i + 1)) for i, b in enumerate(by_rank)}
        self._seen: dict[str, bytes] = {}

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        parts, seen = self._split.findall(text), self._seen
        new = [p for p in dict.fromkeys(parts) if p not in seen]
        if len(seen) + len(new) > _REMEMBERED:
            seen.clear()
            new = list(dict.fromkeys(parts))
        long: dict[str, bytes] = {}  # of this text alone
        if new:
            raw = [p.encode("utf-8") for p in new]
            split = [i for i, b in enumerate(raw) if b not in self._ranks]
            for p, b in zip(new, raw, strict=True):
                if b in self._ranks:
                    (seen if len(p) <= _LONGEST else long)[p] = self._ranks[b].to_bytes(4, "little")
            for i, ids in zip(split, self._model.encode([mapped(raw[i]) for i in split], num_threads=1), strict=True):
                (seen if len(new[i]) <= _LONGEST else long)[new[i]] = self._rank_of[ids].astype("<u4").tobytes()
        if long:
            return b"".join([long[p] if p in long else seen[p] for p in parts])
        return b"".join(map(seen.__getitem__, parts))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self._bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", checked: bool = False) -> DataFrame:
    """(doc_id, ids array<int>, n_tokens) for each row; null and empty texts have no ids.

    With checked, ids are decoded again, and where that doesn't give the text both are NULL.
    """

    def make():
        bpe = ByteBpe(read_ranks(ranks_path), pattern)

        def step(c):
            coded = [bpe.encode(t) for t in c["text"]]
            if checked:
                coded = [x if bpe.decode(x) == (t or "").encode("utf-8") else None for x, t in zip(coded, c["text"], strict=True)]
            ids = [None if x is None else np.frombuffer(x, "<u4").astype(np.int32) for x in coded]
            return {"doc_id": c["doc_id"], "ids": ids, "n_tokens": [None if x is None else len(x) for x in ids]}

        return step

    return map_rows(pick(docs, doc_id=id_col, text=text_col), make, "doc_id long, ids array<int>, n_tokens long")


def decode(encoded: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) from ids; bytes that are no UTF-8 become replacement marks, null ids a null text."""

    def make():
        bpe = ByteBpe(read_ranks(ranks_path), pattern)
        text = lambda ids: None if ids is None else bpe.decode(np.array(ids, "<u4").tobytes()).decode("utf-8", "replace")
        return lambda c: {"doc_id": c["doc_id"], "text": [text(x) for x in c["ids"]]}

    return map_rows(pick(encoded, doc_id=id_col, ids=ids_col), make, "doc_id long, text string")


def digests(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) for each row: ids encoded, then decoded again.

    Whole texts; null and empty ones have no ids and the digest of nothing. No shuffle; rows may repeat,
    and other columns are not looked at.
    """

    def make():
        bpe = ByteBpe(read_ranks(ranks_path), pattern)

        def step(c):
            ids = [bpe.encode(t) for t in c["text"]]
            return {
                "doc_id": c["doc_id"],
                "n_tokens": [len(x) // 4 for x in ids],
                "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids],
                "decoded_sha256": [hashlib.sha256(bpe.decode(x)).hexdigest() for x in ids],
            }

        return step

    return map_rows(pick(docs, doc_id=id_col, text=text_col), make, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
