"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's probability is logistic in its words and their
beginnings; the document's is their noisy-or, 1 - product(1 - p). Weights are trained from document labels alone; afterwards the same
weights tell which sentences offend.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, pick

#: The classifier is fitted on so many labelled documents of each class at most, those of the least hashed ids.
SAMPLE_PER_CLASS = 4000
#: Besides itself a word has its beginnings of these lengths as features, so that inflected forms share weight.
BEGINNINGS = (3, 4, 5, 6)
#: Features that a smaller share of the sampled documents have carry no weight.
LEAST_SHARE = 1 / 800
ROUNDS, RATE = 100, 0.1
#: A weight stays 0 unless the likelihood pulls at it by more than this share of what one document of the smaller class can.
LEAST_PULL = 0.1

_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W_]+")
_REMEMBERED = 100_000


@dataclass(frozen=True)
class Model:
    """Weights by the 64-bit hash of a feature; those that aren't there are 0, so unknown words say nothing."""

    weights: dict[int, float]
    bias: float


def features(word: str) -> list[int]:
    """Hashes of a word's features."""
    names = ["=" + word, *["<" + word[:n] for n in BEGINNINGS if len(word) > n]]
    return [xxhash.xxh3_64_intdigest(n) for n in names]


class _Weights(dict):
    """Words' summed weights, remembered; emptied when full."""

    def __init__(self, weights: dict[int, float]):
        self._weights = weights

    def __missing__(self, word: str) -> float:
        if len(self) >= _REMEMBERED:
            self.clear()
        value = self[word] = sum(self._weights.get(f, 0.0) for f in features(word))
        return value


def sentences(text: str | None) -> list[tuple[int, int]]:
    """Spans of the parts between full stops, exclamation and question marks and line ends that hold words."""
    return [m.span() for m in _SENTENCE.finditer(text or "") if _WORD.search(m[0])]


def _sentence_words(text: str | None) -> list[set[str]]:
    """Distinct lower-case words of each sentence that has some."""
    return [w for part in _SENTENCE.findall(text or "") if (w := set(_WORD.findall(part.lower())))]


def held_out(doc_id: Column) -> Column:
    """Rows whose label is never learnt from: crc32 of the id as text leaves 0 when divided by 5."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_class: int = SAMPLE_PER_CLASS) -> Model:
    """Fit on at most per_class labelled rows of each class outside the held-out fold.

    Ids of the sample are chosen first, so only their texts are turned into bags, where they lie; the
    bags (numbers, bounded by the sample) meet in one task. Repeated labels of an id count as the larger;
    null labels and ids are left out. Of the texts of a repeated id the least hashed one is learnt from, so the model
    is the same however rows are dealt to tasks. Without labels of both classes every score is the bias alone.
    """
    known = pick(labels, doc_id="doc_id", label=label_col).where("doc_id IS NOT NULL AND label IS NOT NULL").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    chosen = [known.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)]
    rows = pick(docs, doc_id=id_col, text=text_col).join(F.broadcast(chosen[0].union(chosen[1])), "doc_id")
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("one")
    sample = rows.groupBy("doc_id", "label").agg(one).select("doc_id", "label", "one.text")

    def make():
        def step(c):
            out = {**c, "words": [], "flat": [], "counts": []}
            for text in out.pop("text"):
                place: dict[str, int] = {}
                bag = _sentence_words(text)
                out["flat"].append([place.setdefault(w, len(place)) for s in bag for w in sorted(s)])
                out["counts"].append([len(s) for s in bag])
                out["words"].append(" ".join(place))  # one string a document: far smaller in the fit than a list of words
            return out

        return step

    bags = map_rows(sample, make, "doc_id long, label int, words string, flat array<int>, counts array<int>")
    fitted = bags.withColumn("all", F.lit(1)).groupBy("all").applyInPandas(_fit, "names binary, weights binary, bias double").first()
    if fitted is None:
        return Model({}, -8.0)
    return Model(dict(zip(np.frombuffer(fitted.names, np.uint64).tolist(), np.frombuffer(fitted.weights, np.float64).tolist(), strict=True)), fitted.bias)


def _fit(bags: pd.DataFrame) -> pd.DataFrame:
    """Full-batch Adam on the documents' log-likelihood; each step cuts the weights towards 0, so that few are left."""
    bags = bags.sort_values("doc_id")
    bags = bags[bags["counts"].map(len) > 0]
    label = bags["label"].to_numpy(float)
    names, w, bias = np.empty(0, np.uint64), np.empty(0), -4.0
    if 0 < label.sum() < len(label):
        vocabulary: dict[str, int] = {}
        held = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words.split(" ")]) for words in bags["words"]]
        flat = np.concatenate([words[f] for words, f in zip(held, bags["flat"], strict=True)])
        counts, parts = np.concatenate(bags["counts"].to_list()), bags["counts"].map(len).to_numpy()
        of_word = [features(w) for w in vocabulary]
        owner, place = np.repeat(np.arange(len(of_word)), [len(f) for f in of_word]), np.concatenate([np.array(f, np.uint64) for f in of_word])
        docs_with = np.bincount(np.concatenate(held), minlength=len(of_word))
        del held, bags["words"], bags["flat"]
        _, place_of = np.unique(place, return_inverse=True)
        common = np.bincount(place_of, docs_with[owner])[place_of] >= LEAST_SHARE * len(bags)
        owner, (names, place) = owner[common], np.unique(place[common], return_inverse=True)
        sentence, doc_of = np.repeat(np.arange(len(counts)), counts), np.repeat(np.arange(len(parts)), parts)
        begins = np.concatenate(([0], np.cumsum(parts)[:-1]))
        w = np.zeros(len(names))
        m, v, mb, vb = np.zeros(len(w)), np.zeros(len(w)), 0.0, 0.0
        balance = np.where(label > 0, 0.5 / label.mean(), 0.5 / (1 - label.mean())) / len(label)
        least = LEAST_PULL * balance.max()
        for t in range(1, ROUNDS + 1):
            word = np.bincount(owner, w[place], len(of_word))
            z = np.bincount(sentence, word[flat], len(counts)) + bias
            p = 1 / (1 + np.exp(-z))
            clean = np.add.reduceat(-np.logaddexp(0, z), begins)  # log of the product of 1 - p
            any_ = np.clip(-np.expm1(clean), 1e-9, 1)
            slope = balance * np.where(label > 0, -np.exp(clean) / any_, 1.0)  # by the sum of log-odds terms
            gz = slope[doc_of] * p
            gw = np.bincount(flat, gz[sentence], len(of_word))
            g, gb = np.bincount(place, gw[owner], len(w)), gz.sum()
            m, v, mb, vb = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g, 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
            scale = RATE * np.sqrt(1 - 0.99**t) / (1 - 0.9**t)
            pace = scale / (np.sqrt(v) + 1e-8)
            w -= pace * m
            w = np.sign(w) * np.maximum(np.abs(w) - least * pace, 0)
            bias -= scale * mb / (np.sqrt(vb) + 1e-8)
        names, w = names[w != 0], w[w != 0]
    return pd.DataFrame({"names": [names.tobytes()], "weights": [w.tobytes()], "bias": [float(bias)]})


def _probabilities(text: str | None, bias: float, weights: _Weights) -> np.ndarray:
    z = np.array([sum(map(weights.__getitem__, words)) for words in _sentence_words(text)]) + bias
    return 1 / (1 + np.exp(-z))


def _noisy_or(p: np.ndarray) -> float:
    return float(-np.expm1(np.log1p(-np.minimum(p, 1 - 1e-15)).sum()))


def _score(text: str | None, bias: float, weights: _Weights) -> float:
    return _noisy_or(_probabilities(text, bias, weights))


def accepted(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of docs below the threshold, all columns as they are; decided row by row, so ids don't matter. No shuffle."""
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = _Weights(model.weights)
        for batch in batches:
            yield batch.filter(pa.array([_score(t.as_py(), model.bias, weights) < threshold for t in batch.column(place)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_offending, offending) for each row; whole texts, no shuffle.

    offending joins start:end of the sentences at or above the threshold, n_offending of them (code points,
    end exclusive). Null and empty texts, and those without words, hold no sentence and score 0. A null id
    isn't held out. Repeated rows have equal rows; other columns are not looked at.
    """

    def make():
        weights = _Weights(model.weights)

        def step(c):
            out = {"doc_id": c["doc_id"], "score": [], "predicted": [], "n_offending": [], "offending": []}
            for text in c["text"]:
                p = _probabilities(text, model.bias, weights)
                offending = [f"{a}:{b}" for (a, b), x in zip(sentences(text), p, strict=True) if x >= threshold] if (p >= threshold).any() else []
                out["score"].append(s := _noisy_or(p))
                out["predicted"].append(int(s >= threshold))
                out["n_offending"].append(len(offending))
                out["offending"].append(",".join(offending))
            return out

        return step

    out = map_rows(pick(docs, doc_id=id_col, text=text_col), make, "doc_id long, score double, predicted int, n_offending long, offending string")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "n_offending", "offending")


def locate(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """(doc_id, start, end, score) of each sentence at or above the threshold; code points, end exclusive."""

    def make():
        weights = _Weights(model.weights)

        def step(c):
            out = {"doc_id": [], "start": [], "end": [], "score": []}
            for doc, text in zip(c["doc_id"], c["text"], strict=True):
                for start, end in sentences(text):
                    if len(p := _probabilities(text[start:end], model.bias, weights)) and (most := float(p.max())) >= threshold:
                        for name, value in zip(out, (doc, start, end, most), strict=True):
                            out[name].append(value)
            return out

        return step

    return map_rows(pick(docs, doc_id=id_col, text=text_col), make, "doc_id long, start int, end int, score double")


def accuracy(predicted: Iterable[int], actual: Iterable[int]) -> float:
    pairs = list(zip(predicted, actual, strict=True))
    return sum(a == b for a, b in pairs) / len(pairs) if pairs else float("nan")
