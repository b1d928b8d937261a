"""Token counts of a unigram tokenizer without building its tokens.

An Aho-Corasick automaton over the vocabulary enumerates every piece that ends at each place; the best
score and its number of pieces are carried along. Ties fall as in the tokenizer: of candidates for the
same end, an earlier start stays unless a later one scores strictly higher, with scores kept as 32-bit
floats.

No unigram vocabulary is public here, so the default takes the pieces of a public vocabulary file and
gives each the score -ln(place + 2), rounded to 1/32. Any list of pieces with scores serves as well.
"""

from __future__ import annotations

import math
import re
import struct

from pyspark.sql import DataFrame

from tidemark.llm.common import map_rows, pick
from tidemark.llm.sp_model import BYTE, NORMAL, USER, Piece, pieces_of

SPACE = "▁"
#: Scores are multiples of this in the default vocabulary; sums below 2**24 of it are exact as 32-bit floats.
GRAIN = 1 / 32
_UNKNOWN_COST = 10.0  # fixed value of the tokenizer: below the least score of a piece
_REMEMBERED, _LONGEST = 400_000, 64  # chunks that a task remembers, and characters of the longest of them
_FLOAT = struct.Struct("<f")


def _single(x: float) -> float:
    """As a 32-bit float holds it."""
    return _FLOAT.unpack(_FLOAT.pack(x))[0]


def unigram_pieces(model_path: str) -> list[Piece]:
    """Pieces of a model file with scores by their place in it."""
    with open(model_path, "rb") as f:
        pieces = pieces_of(f.read())
    out, place = [], 0
    for p in pieces:
        if p.kind == NORMAL:
            out.append(Piece(p.text, -round(math.log(place + 2) / GRAIN) * GRAIN))
            place += 1
        else:
            out.append(Piece(p.text, 0.0, p.kind))
    return out


class Counter:
    """Counts of one tokenizer; one per task."""

    def __init__(self, pieces: list[Piece], dummy_prefix: bool = True):
        import ahocorasick

        self.prefix = SPACE if dummy_prefix else ""
        usable = [p for p in pieces if p.kind in (NORMAL, USER) and p.text]
        self._find = ahocorasick.Automaton()
        for p in usable:
            self._find.add_word(p.text, (len(p.text), _single(p.score)))
        self._find.make_automaton()
        self.unknown = _single(_single(min((p.score for p in usable), default=0.0)) - _UNKNOWN_COST)
        self.by_bytes = sum(p.kind == BYTE for p in pieces) == 256
        # Cut where no piece can lie across: before a space mark that follows anything else, and around line ends.
        self.cuts = all(SPACE not in p.text.lstrip(SPACE) and "\n" not in p.text for p in usable) and self.by_bytes
        self.cuts &= all((p.score / GRAIN).is_integer() and p.score <= 0 for p in usable) and not any(p.kind == USER for p in pieces)
        self._chunk = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")
        self._seen: dict[str, tuple[float, int]] = {}

    def count(self, text: str | None) -> tuple[int, float]:
        """(pieces, score); nothing has none."""
        if not text:
            return 0, 0.0
        text = self.prefix + text.replace(" ", SPACE)
        if self.cuts:
            score, pieces, seen = 0.0, 0, self._seen
            for chunk in self._chunk.findall(text):
                if (known := seen.get(chunk)) is None:
                    known = self._exact(chunk)
                    if len(chunk) <= _LONGEST:
                        if len(seen) >= _REMEMBERED:
                            seen.clear()
                        seen[chunk] = known
                score += known[0]
                pieces += known[1]
            if abs(score + self.unknown) < GRAIN * (1 << 24):
                return pieces, score
        score, pieces = self._best(text)
        return pieces, score

    def _exact(self, text: str) -> tuple[float, int]:
        """As _best for scores on the grain, whose sums need no rounding, and a vocabulary with bytes."""
        size, unknown = len(text), self.unknown
        best, pieces = [0.0] * (size + 1), [0] * (size + 1)
        end, top, n, longest, alone = 0, 0.0, 0, 0, True  # the end whose candidates are being seen; before it all is settled
        for last, (length, score) in self._find.iter(text):
            if last >= end:
                if not alone and (other := best[end - 1] + unknown) > top:
                    top, n = other, pieces[end - 1] + len(text[end - 1].encode("utf-8"))
                best[end], pieces[end] = top, n
                while end < last:  # ends of no piece
                    end += 1
                    best[end], pieces[end] = best[end - 1] + unknown, pieces[end - 1] + len(text[end - 1].encode("utf-8"))
                end, top, longest, alone = last + 1, -math.inf, 0, False
            start = end - length
            now = best[start] + score
            if now > top or (now == top and length > longest):
                top, n, longest = now, pieces[start] + 1, length
            if length == 1:
                alone = True
        if not alone and (other := best[end - 1] + unknown) > top:
            top, n = other, pieces[end - 1] + len(text[end - 1].encode("utf-8"))
        rest = text[end:]
        return top + unknown * len(rest), n + len(rest.encode("utf-8"))

    def _best(self, text: str) -> tuple[float, int]:
        """The best way through a whole text, its sums held as 32-bit floats."""
        size = len(text)
        best, pieces, loose = [0.0] * (size + 1), [0] * (size + 1), [False] * (size + 1)
        done = 0  # all ends up to here are settled

        def settle(end: int, found: list[tuple[int, float]]) -> None:
            """The best way to an end; found: lengths and scores, longest first."""
            top, n, unknown, reached, alone = 0.0, 0, False, False, False
            for length, score in found:
                start = end - length
                now = _single(score + best[start])
                alone |= length == 1
                if not reached or now > top:
                    top, n, unknown, reached = now, pieces[start] + 1, False, True
            if not alone:
                now = _single(self.unknown + best[end - 1])
                if not reached or now > top:
                    top, unknown = now, True
                    n = pieces[end - 1] + (len(text[end - 1].encode("utf-8")) if self.by_bytes else int(not loose[end - 1]))
            best[end], pieces[end], loose[end] = top, n, unknown

        found: list[tuple[int, float]] = []
        for last, value in self._find.iter(text):
            if last + 1 != done + 1:
                if found:
                    settle(done + 1, sorted(found, reverse=True))
                    done, found = done + 1, []
                while done < last:
                    settle(done + 1, [])
                    done += 1
            found.append(value)
        if found:
            settle(done + 1, sorted(found, reverse=True))
            done += 1
        while done < size:
            settle(done + 1, [])
            done += 1
        return best[size], pieces[size]


def count_tokens(docs: DataFrame, pieces: list[Piece], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, n_tokens, score) for each row of docs, over whole texts.

    Null and empty texts have 0 tokens and score 0. Ids pass as they are; rows may repeat; other columns
    are not looked at. There is no shuffle: the vocabulary (of fixed size) goes to every task.
    """

    def make():
        counter = Counter(pieces)

        def step(c):
            got = [counter.count(t) for t in c["text"]]
            return {
                "doc_id": c["doc_id"],
                "n_chars": [len(t or "") for t in c["text"]],
                "n_tokens": [n for n, _ in got],
                "score": [s for _, s in got],
            }

        return step

    return map_rows(pick(docs, doc_id=id_col, text=text_col), make, "doc_id long, n_chars long, n_tokens long, score double")

