"""The few fields of a sentencepiece model file that are needed to write one or read its pieces."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

# Fixed values of the public model format: kinds of pieces and of models.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


@dataclass(frozen=True)
class Piece:
    text: str
    score: float
    kind: int = NORMAL


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _block(field: int, data: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(data)) + data


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def model_file(pieces: list[Piece], model_type: int, *, dummy_prefix: bool, escape: bool, byte_fallback: bool) -> bytes:
    """A model with identity normalisation; white space is neither merged nor trimmed."""
    body = b"".join(
        _block(1, _block(1, p.text.encode("utf-8")) + _varint(2 << 3 | 5) + struct.pack("<f", p.score) + _number(3, p.kind)) for p in pieces
    )
    unknown = next(i for i, p in enumerate(pieces) if p.kind == UNKNOWN)
    trainer = _number(3, model_type) + _number(4, len(pieces)) + _number(35, byte_fallback) + _number(40, unknown)
    normalizer = _block(1, b"identity") + _number(3, dummy_prefix) + _number(4, 0) + _number(5, escape)
    return body + _block(2, trainer) + _block(3, normalizer)


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    at = 0

    def varint() -> int:
        nonlocal at
        n = shift = 0
        while True:
            b = data[at]
            at += 1
            n |= (b & 0x7F) << shift
            shift += 7
            if b < 0x80:
                return n

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield key >> 3, data[at : at + size]
        at += size


def pieces_of(data: bytes) -> list[Piece]:
    out = []
    for field, value in _fields(data):
        if field == 1:
            f = dict(_fields(value))
            out.append(Piece(f.get(1, b"").decode("utf-8"), struct.unpack("<f", f.get(2, b"\0" * 4))[0], f.get(3, NORMAL)))
    return out
