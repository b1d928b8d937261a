"""Benchmark decontamination by a distributed positional inverted index.

The index is parted by documents, as search engines part theirs: a segment holds, for every word of its
documents, the sorted places of that word, documents laid end to end with gaps between them. It knows
nothing of any test set and is written once; each block of test items is then searched in all segments.
In a segment a window of test terms begins with its rarest term, whose list, less the term's offset, is
intersected with the lists of the others in order of their lengths. Only windows whose terms all have a
list there are looked at, and windows that share their rarest term share its list.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_schema, pick, written

#: Words after which a segment is closed, and places left free between documents; no span looked at is longer.
SEGMENT_WORDS, GAP = 1 << 20, 64
#: Bytes of test text that are searched for at a time; they go to every task.
BLOCK_BYTES = 8 << 20
#: Windows, and places of rarest terms, that a task looks at in one step.
_WINDOWS, _PAIRS = 1 << 16, 1 << 22

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: terms: joined by line ends; counts: places of each; places: of all lists, as differences. The last three are 32-bit integers or text, compressed.
SEGMENT = "rows array<long>, doc_ids array<long>, begins array<long>, n_words array<long>, terms binary, counts binary, places binary"
HITS = "row long, hits array<int>, items array<string>, near array<string>"


def words_of(text: str | None) -> list[bytes]:
    """Words of digits, letters a to z (A to Z lowered) and all code points above x7F, as UTF-8."""
    return _WORD.findall(text.encode("utf-8").lower()) if text else []


class _Numbers(dict):
    """Terms numbered as they come."""

    def __missing__(self, term: bytes) -> int:
        n = self[term] = len(self)
        return n


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """Segments of the positional index of all words; a document lies in one segment whole.

    Rows are told apart by row_col, or where there is none by numbers that the written index fixes. A task
    closes a segment at SEGMENT_WORDS words, so a segment is bounded by that and its longest text. There is
    no shuffle: the segments are where the documents are.
    """
    target = arrow_schema(docs.sparkSession, SEGMENT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, ids, begins, counts, found, number, end = [], [], [], [], [], _Numbers(), 0

        def segment() -> pa.RecordBatch:
            term = np.concatenate(found)
            place = np.arange(len(term), dtype=np.int32) + np.repeat(np.arange(len(counts), dtype=np.int32) * GAP, counts)
            steps = np.diff(place[np.argsort(term, kind="stable")], prepend=np.int32(0))
            packed = pack(b"\n".join(number), np.bincount(term, minlength=len(number)).astype("<i4").tobytes(), steps.astype("<i4").tobytes())
            row = {"rows": rows, "doc_ids": ids, "begins": begins, "n_words": counts} | dict(zip(("terms", "counts", "places"), packed, strict=True))
            return pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in target], schema=target)

        for batch in batches:
            for row, doc, text in zip(*batch.columns, strict=True):
                words = words_of(text.as_py())
                rows.append(row.as_py())
                ids.append(doc.as_py())
                begins.append(end)
                counts.append(len(words))
                found.append(np.fromiter(map(number.__getitem__, words), np.int32, len(words)))
                end += len(words) + GAP
                if end >= SEGMENT_WORDS:
                    yield segment()
                    rows, ids, begins, counts, found, number, end = [], [], [], [], [], _Numbers(), 0
        if ids:
            yield segment()

    row = F.monotonically_increasing_id() if row_col is None else F.col(f"`{row_col}`")
    return docs.select(row.alias("row"), F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(run, SEGMENT)


def pack(*parts: bytes) -> list[bytes]:
    import zstandard

    compressor = zstandard.ZstdCompressor(level=1)
    return [compressor.compress(p) for p in parts]


def unpack(*parts) -> list[bytes]:
    import zstandard

    decompressor = zstandard.ZstdDecompressor()
    return [decompressor.decompress(p) for p in parts]


class Items:
    """Some test items: their words numbered and laid end to end, with -1 before, between and after them."""

    def __init__(self, items: list[tuple[str, str | None]], width: int):
        self.number, self.names, flat, begins, self._width = _Numbers(), [], [-1], [], width
        for name, text in items:
            if words := words_of(text):
                self.names.append(name)
                begins.append(len(flat))
                flat += map(self.number.__getitem__, words)
                flat.append(-1)
        self.words, self.begins = np.array(flat, np.int32), np.array([*begins, len(flat)], np.int64)
        self._made: dict[int, dict[int, np.ndarray]] = {}  # filled where it is used, once a worker

    def windows(self, step: int = 1) -> Iterator[tuple[int, np.ndarray]]:
        """(width, first words): windows begin every ``step`` words and where the last one must; a short item is one."""
        if step not in self._made:
            by_width: dict[int, list[np.ndarray]] = {}
            for a, b in zip(self.begins[:-1].tolist(), (self.begins[1:] - 1).tolist(), strict=True):
                width = min(self._width, b - a)
                by_width.setdefault(width, []).append(np.unique(np.append(np.arange(a, b - width + 1, step), b - width)))
            self._made[step] = {width: np.concatenate(starts) for width, starts in by_width.items()}
        for width, starts in self._made[step].items():
            for at in range(0, len(starts), _WINDOWS):
                yield width, starts[at : at + _WINDOWS]

    def owner(self, starts: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.begins, starts, "right") - 1


class Lists:
    """The posting lists of one segment for the terms of some items, as one sorted array of term and place.

    The same lists are laid out by place as well, so that whether a list has a place takes one look.
    """

    def __init__(self, terms, counts, places, items: Items):
        words, counts, steps = unpack(terms, counts, places)
        terms, counts, places = words.split(b"\n") if words else [], np.frombuffer(counts, "<i4").astype(np.int64), np.cumsum(np.frombuffer(steps, "<i4"), dtype=np.int32)
        offsets = np.concatenate(([0], np.cumsum(counts)))
        self.items, get = items, items.number.get
        number = np.fromiter((get(t, -1) for t in terms), np.int64, len(terms))
        held = np.nonzero(number >= 0)[0]
        held = held[np.argsort(number[held])]
        length = np.diff(offsets)[held]
        self.n, self._first = np.zeros(len(items.number) + 1, np.int64), np.zeros(len(items.number) + 1, np.int64)
        self.n[number[held]], self._first[number[held]] = length, np.cumsum(length) - length
        at = np.repeat(offsets[:-1][held] - (np.cumsum(length) - length), length) + np.arange(length.sum())
        term, place = np.repeat(number[held], length), places[at]
        self._keys = (term << 32) | place.astype(np.int64)
        self._term_at = np.full(int(place.max(initial=-1)) + 2, -1, np.int32)  # the last one stands for all places beyond
        self._term_at[place] = term

    def _below(self, term: np.ndarray, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self._keys, (term.astype(np.int64) << 32) + np.maximum(place, 0))

    def has(self, term: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Whether the term's list has the place; term -1 has no list."""
        inside = (place >= 0) & (place < len(self._term_at))
        return (self._term_at[np.where(inside, place, -1)] == term) & (term >= 0)

    def places(self, term: int, low: int, high: int) -> np.ndarray:
        """Places of the term from low to high, both inclusive."""
        a, b = np.searchsorted(self._keys, [(term << 32) + max(low, 0), (term << 32) + high + 1])
        return self._keys[a:b] - (term << 32)

    def _rarest(self, starts: np.ndarray, width: int):
        """Of the windows whose terms all have lists: first words, terms, and offsets in order of their lists' lengths."""
        terms = self.items.words[starts[:, None] + np.arange(width)]
        n = self.n[terms]
        alive = n.all(axis=1)
        return starts[alive], terms[alive], np.argsort(n[alive], axis=1, kind="stable")

    def _spread(self, term: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(index into term, place) of all places of the terms, so many at a time that memory is bounded."""
        n, at = self.n[term], 0
        total = np.cumsum(n)
        while at < len(term):
            to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + _PAIRS, "right")))
            which = np.repeat(np.arange(at, to), n[at:to])
            inner = np.arange(len(which)) - np.repeat(np.cumsum(n[at:to]) - n[at:to], n[at:to])
            yield which, self._keys[self._first[term[which]] + inner] & 0xFFFFFFFF
            at = to

    def exact(self, starts: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(first word of a window, place) of each occurrence of a window's terms in a row."""
        starts, terms, order = self._rarest(starts, width)
        if not len(starts):
            return
        rarest = starts + order[:, 0]
        shared, which = np.unique(rarest, return_inverse=True)
        by_shared, count = np.argsort(which, kind="stable"), np.bincount(which)
        first = np.cumsum(count) - count
        words = self.items.words
        for i, place in self._spread(words[shared]):
            if width > 1:  # every window around a word holds the word before or after it
                p = shared[i]
                beside = self.has(words[p + 1], place + 1) | self.has(words[p - 1], place - 1)
                i, place = i[beside], place[beside]
            w = by_shared[np.repeat(first[i], count[i]) + np.arange(count[i].sum()) - np.repeat(np.cumsum(count[i]) - count[i], count[i])]
            begin = np.repeat(place, count[i]) - order[w, 0]
            for j in range(1, width):
                offset = order[w, j]
                there = self.has(terms[w, offset], begin + offset)
                w, begin = w[there], begin[there]
            if len(w):
                yield starts[w], begin

    def near(self, starts: np.ndarray, width: int, slack: int, doc_of: Callable[[np.ndarray], np.ndarray], known: set[tuple[int, int]]) -> None:
        """Add to known (document, item) where width + slack words hold all terms of a window, each as often as it does."""
        starts, terms, order = self._rarest(starts, width)
        reach = width - 1 + slack
        for w, place in self._spread(terms[np.arange(len(starts)), order[:, 0]]):
            for j in range(1, width):
                term = terms[w, order[w, j]]
                often = (terms[w] == term[:, None]).sum(axis=1)
                there = self._below(term, place + reach + 1) - self._below(term, place - reach) >= often
                w, place = w[there], place[there]
            for i, at, pair in zip(w.tolist(), place.tolist(), zip(doc_of(place).tolist(), self.items.owner(starts[w]).tolist(), strict=True), strict=True):
                if pair in known:
                    continue
                need = Counter(terms[i].tolist())
                around = [(p, t) for t in need for p in self.places(t, at - reach, at + reach).tolist()]
                spans = (Counter(t for p, t in around if s <= p <= s + reach) for s, _ in around if s <= at)
                if any(all(span[t] >= n for t, n in need.items()) for span in spans):
                    known.add(pair)


def search(index: DataFrame, items: list[tuple[str, str | None]], width: int = 10, slack: int | None = None) -> DataFrame:
    """(row, hits, items, near) of the index's documents that hold something of a bounded block of test items.

    hits are the words inside exact occurrences of windows, items the items with such a window. With slack,
    near are the items of which a passage (every width words from its first, and its last ones) has all its
    words, in any order, within width + slack words of the document.
    """
    if width + (slack or 0) > GAP:
        raise ValueError(f"width and slack may come to {GAP} words")
    target = arrow_schema(index.sparkSession, HITS)
    block = index.sparkSession.sparkContext.broadcast(Items(items, width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = block.value
        for batch in batches:
            for r in range(batch.num_rows):
                get = lambda name, r=r, batch=batch: batch.column(name)[r]
                lists = Lists(*(get(name).as_buffer() for name in ("terms", "counts", "places")), items)
                yield pa.RecordBatch.from_pylist(_found(lists, np.array(get("begins").as_py()), get("rows").as_py(), width, slack), schema=target)

    return index.select("rows", "begins", "terms", "counts", "places").mapInArrow(run, HITS)


def _found(lists: Lists, begins: np.ndarray, rows: list[int], width: int, slack: int | None) -> list[dict]:
    hits, owners, near, items = [], [], set(), lists.items
    doc_of = lambda place: np.searchsorted(begins, place, "right") - 1
    if len(items.number):
        for n, starts in items.windows():
            for start, place in lists.exact(starts, n):
                hits.append(np.unique(place[:, None] + np.arange(n)))
                owners.append(np.unique(np.stack([doc_of(place), items.owner(start)], axis=1), axis=0))
        if slack is not None:
            for n, starts in items.windows(width):
                lists.near(starts, n, slack, doc_of, near)
    out: dict[int, dict] = {}
    of = lambda d: out.setdefault(d, {"row": rows[d], "hits": [], "items": set(), "near": set()})
    for place in np.unique(np.concatenate(hits)).tolist() if hits else ():
        d = int(doc_of(place))
        of(d)["hits"].append(place - int(begins[d]))
    for d, i in (x for pairs in owners for x in pairs.tolist()):
        of(d)["items"].add(items.names[i])
    for d, i in near:
        of(d)["near"].add(items.names[i])
    return [x | {"items": sorted(x["items"]), "near": sorted(x["near"])} for x in out.values()]


def item_blocks(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text") -> Iterator[list[tuple[str, str | None]]]:
    """The test set's (item, text) pairs in blocks of bounded bytes; a longer item is a block of its own."""
    held, size = [], 0
    for r in pick(benchmark, item=item_col, text=text_col).where("item IS NOT NULL").select(F.col("item").cast("string"), "text").toLocalIterator():
        held.append((r.item, r.text))
        size += len(r.text or "")
        if size >= BLOCK_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def contaminated_rows(index: DataFrame, benchmark: DataFrame, width: int = 10, item_col: str = "item_id", item_text_col: str = "text", slack: int | None = None) -> DataFrame:
    """(row, hits, items, near) for each document of a written index that holds something of the test set.

    The test set is a stated query set, searched block after block; what a block finds is written, and the
    finds of a row are put together by its number.
    """
    spark = index.sparkSession
    found = spark.createDataFrame([], HITS)
    for block in item_blocks(benchmark, item_col, item_text_col):
        found = found.union(written(search(index, block, width, slack)))
    together = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
    return found.groupBy("row").agg(together("hits"), together("items"), together("near"))


def contamination(
    docs: DataFrame, benchmark: DataFrame, width: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", slack: int = 2
) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near) for each row of docs.

    A window is width consecutive words of an item; an item of fewer words, but not none, is one window.
    n_near counts items near a passage of the row (see search). Null and empty texts have no words; null
    item ids are left out, repeated items count once. Rows whose ids repeat or are null have each a row of
    their own, numbered when the index is written. No documents give no rows, no items give rows without
    hits; other columns are not looked at. Texts aren't shuffled: the index lies where they are, and finds
    meet ids and lengths alone.
    """
    index = written(build_index(docs, id_col, text_col))
    found = contaminated_rows(index, benchmark, width, item_col, item_text_col, slack)
    rows = index.select(F.explode(F.arrays_zip("rows", "doc_ids", "n_words")).alias("r")).select(
        F.col("r.rows").alias("row"), F.col("r.doc_ids").alias("doc_id"), F.col("r.n_words").alias("n_words")
    )
    none = F.array().cast("array<string>")
    items, n_hit = F.coalesce("items", none), F.size(F.coalesce("hits", F.array().cast("array<int>"))).cast("long")
    return rows.join(found, "row", "left").select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.encode(F.array_join(items, ","), "UTF-8"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
        F.size(F.coalesce("near", none)).cast("long").alias("n_near"),
    )


def digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
