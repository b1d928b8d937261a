"""Secret scans: fixed patterns, and runs of characters that look random.

Two first-order character models, one of random strings and one of ordinary identifiers, are compared by
log-likelihood ratio on every run of key characters, or part of one, that no pattern has matched.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, pick

KINDS = ("assign", "access", "hex", "random")

# The patterns and least lengths of the contract.
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST, ACCESS_LEAST = 6, 20

_SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
_SIZE = len(_SYMBOLS) + 1  # 0 is what stands before a run, and every separator within one: identifiers are words between separators
_PLACE = np.zeros(256, np.uint8)
for _i, _c in enumerate(_SYMBOLS):
    _PLACE[ord(_c)] = _i + 1


@dataclass(frozen=True)
class Markov:
    """Log-probabilities of the next symbol for both models, and what a run must reach to be a secret."""

    ratio: np.ndarray  # random minus ordinary, [before, next]
    least_length: int = 12  # shorter runs hold too little to tell
    least_ratio: float = 14.0  # odds of a million to one

    def scores(self, runs: list[str]) -> np.ndarray:
        x = _PLACE[np.frombuffer("\n".join(["", *runs]).encode("ascii"), np.uint8)]
        begins = np.cumsum([0, *[len(r) + 1 for r in runs[:-1]]])
        return np.add.reduceat(self.ratio[x[:-1], x[1:]], begins)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the patterns, leftmost and non-overlapping per kind, code points."""
    found = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        found += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return sorted(found, key=_order)


def _order(span: tuple) -> tuple:
    return span[0], KINDS.index(span[2]), span[1]


def find_spans(text: str | None, model: Markov) -> list[tuple[int, int, str]]:
    """The patterns' spans, and of what they leave of each run the parts that the models call random."""
    if not text:
        return []
    found = base_spans(text)
    parts = _uncovered(text, found, model.least_length)
    if parts:
        random = model.scores([text[a:b] for a, b in parts]) >= model.least_ratio
        found += [(a, b, "random") for (a, b), yes in zip(parts, random.tolist(), strict=True) if yes]
    return sorted(found, key=_order)


def _uncovered(text: str, spans: list[tuple[int, int, str]], least: int) -> list[tuple[int, int]]:
    """Parts of runs outside all spans, in one pass over both; spans come in order of their starts."""
    out, i, reach = [], 0, 0
    for m in re.finditer(f"[A-Za-z0-9+/_=-]{{{least},}}", text):
        at, end = max(m.start(), reach), m.end()
        while i < len(spans) and spans[i][0] < end:
            if spans[i][0] - at >= least:
                out.append((at, spans[i][0]))
            reach = max(reach, spans[i][1])
            at = max(at, reach)
            i += 1
        if end - at >= least:
            out.append((at, end))
    return out


def likely_key(value: str) -> bool:
    """A label for the random model: of some length, with letters and digits; words given as passwords are none."""
    return len(value) >= 12 and any(c.isdigit() for c in value) and any(c.isalpha() for c in value)


def train(docs: DataFrame, text_col: str = "text", smoothing: float = 0.5, **limits) -> Markov:
    """Both models from labelled samples taken from all of docs.

    Label random: what the patterns match (values, keys and digests), if it has some length, letters and
    digits. Label ordinary: every run of key characters outside the matches. Each task counts transitions of its own texts and returns at most
    two square tables; their sums, some thousand cells, are all that reaches the driver. Without samples
    a model is even over all symbols. Null texts count as empty.
    """

    def make() -> Callable:
        def step(c):
            tables = np.zeros((2, _SIZE * _SIZE), np.int64)
            plain, keys = [], []
            for text in c["text"]:
                if not text:
                    continue
                at = 0
                for start, end, kind in base_spans(text):
                    run = _ASSIGN.match(text, start)[2] if kind == "assign" else text[start:end]
                    if likely_key(run):
                        keys.append(run)
                    if start > at:
                        plain.append(text[at:start])
                    at = max(at, end)
                plain.append(text[at:])
            for label, runs in enumerate((plain, keys)):
                x = _PLACE[np.frombuffer("\n".join(["", *runs]).encode("utf-8"), np.uint8)].astype(np.int32)
                pair = x[:-1] * _SIZE + x[1:]
                tables[label] = np.bincount(pair[x[1:] > 0], minlength=_SIZE * _SIZE)
            label, cell = np.nonzero(tables)
            return {"label": label.tolist(), "cell": cell.tolist(), "n": tables[label, cell].tolist()}

        return step

    counts = map_rows(pick(docs, text=text_col), make, "label int, cell int, n long").groupBy("label", "cell").agg(F.sum("n").alias("n"))
    table = np.full((2, _SIZE, _SIZE), smoothing)
    for r in counts.toLocalIterator():  # 2 * 63 * 63 cells at most
        table[r.label, r.cell // _SIZE, r.cell % _SIZE] += r.n
    table[:, :, 0] = 0
    table /= table.sum(axis=2, keepdims=True)
    with np.errstate(divide="ignore"):
        logs = np.log(table)
    logs[:, :, 0] = 0
    return Markov(ratio=logs[1] - logs[0], **limits)


def scan(docs: DataFrame, model: Markov, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans) for each row.

    spans joins kind:start:end of all spans by start, then kind, with commas; base_sha256 digests the same
    of the patterns alone. Null and empty texts have none. Ids and rows pass as they are; other columns
    are not looked at.
    """

    def make():
        def step(c):
            spans = [find_spans(t, model) for t in c["text"]]
            base = [[s for s in x if s[2] != "random"] for x in spans]
            count = lambda kind: [sum(s[2] == kind for s in x) for x in spans]
            return {
                "doc_id": c["doc_id"],
                "n_assign": count("assign"),
                "n_access": count("access"),
                "n_hex": count("hex"),
                "n_random": count("random"),
                "base_sha256": [hashlib.sha256(_said(x).encode()).hexdigest() for x in base],
                "spans": [_said(x) for x in spans],
            }

        return step

    schema = "doc_id long, n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string"
    return map_rows(pick(docs, doc_id=id_col, text=text_col), make, schema)


def _said(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def redact(docs: DataFrame, model: Markov, text_col: str = "text", mark: str = "[REDACTED]") -> DataFrame:
    """docs with every span in text_col replaced by the mark; overlapping spans are one. Nulls stay null."""

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: _redacted(t, model, mark), na_action="ignore")

    return docs.withColumn(text_col, clean(F.col(f"`{text_col}`")))


def _redacted(text: str, model: Markov, mark: str) -> str:
    out, at = [], 0
    for start, end, _ in find_spans(text, model):
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], mark]
        at = end
    return "".join([*out, text[at:]]) if at else text


def finite(model: Markov) -> bool:
    return bool(np.isfinite(model.ratio).all() and not math.isnan(model.least_ratio))
