"""Spelling variants: words that differ by one code point, grouped under the frequent form.

Two words are one edit apart exactly when their common prefix and common suffix together reach the longer length
less one. Words are cut into PARTS parts; the edit lies in one of them, so two such words share a key made of all the
other parts. Words of a key meet in dense tiles: their code points, padded to one width, stand in two
matrices, and prefix and suffix lengths of all rows of one against all of the other come from array
comparisons. A key with more than TILE words is dealt to blocks, and each pair of blocks is a tile of
its own, wherever Spark puts it.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_schema, map_rows, pick, written
from tidemark.operators.storage import discard

#: Parts of a word, one of which an edit may touch.
PARTS = 4
#: Words of a tile's side on the average, and their code points.
TILE, TILE_POINTS = 512, 1 << 20
#: Cells that a comparison holds at once.
CELLS = 1 << 22
_REMEMBERED = 100_000


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 7, least_n: int = 2, one_in: int = 31) -> DataFrame:
    """(word, n): words of whole texts with at least least_n occurrences and least_length code points.

    A word is a maximal run of letters with A to Z in lower case. Where one_in divides h, the crc32 of id, colon and run, the code
    point h % length of the run is missing from it (0: never). Null texts have no words; a null id counts as an empty one.
    Tasks count before the shuffle, so that a frequent word is a few rows of each.
    """
    runs = re.compile(r"[A-Za-zÀ-ÿ]{%d,}" % least_length)

    def make():
        def step(c):
            total: Counter[str] = Counter()
            for doc, text in zip(c["doc"], c["text"], strict=True):
                if not text:
                    continue
                start = zlib.crc32(f"{doc or ''}:".encode())
                for run, n in Counter(runs.findall(text.encode().lower().decode())).items():
                    if one_in and not (h := zlib.crc32(run.encode(), start)) % one_in:
                        run = run[: h % len(run)] + run[h % len(run) + 1 :]
                        if len(run) < least_length:
                            continue
                    total[run] += n
            return {"word": list(total), "n": list(total.values())}

        return step

    slim = pick(docs, doc=id_col, text=text_col).select(F.col("doc").cast("string").alias("doc"), "text")
    return map_rows(slim, make, "word string, n long", rows=4096).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_n)


def _keys(words: DataFrame) -> DataFrame:
    """(word, n, s, longer, key, side): each word under all keys at which words of its own or a neighbouring length meet.

    s is the shorter length of a pair; side 1 are the words that are longer than it where longer is true.
    """
    roles = []
    for longer, side in ((False, 0), (True, 0), (True, 1)):
        s = F.char_length("word") - side
        for part in range(PARTS):
            a, b = F.floor(s * part / PARTS).cast("int"), F.floor(s * (part + 1) / PARTS).cast("int")
            rest = F.concat(F.substring("word", F.lit(1), a), F.lit("\n"), F.substring("word", b + 1 + side, s))
            roles.append(F.struct(s.alias("s"), F.lit(longer).alias("longer"), F.xxhash64(F.lit(part), rest).alias("key"), F.lit(side).alias("side")))
    return words.select("word", "n", F.explode(F.array(*roles)).alias("r")).select("word", "n", "r.*")


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, other, other_n) in both directions for all words that are one edit apart, each pair once.

    words has distinct words (word, n). Keys of one word only are left out by a count before words meet.
    """
    keyed = _keys(words)
    sides = [F.count(F.when(F.col("side") == x, 1)) for x in (0, 1)]
    able = F.when(F.col("longer"), F.least(*sides) > 0).otherwise(sides[0] > 1)
    shared = keyed.groupBy("s", "longer", "key").agg(F.count("*").alias("size"), able.alias("able")).where("able").drop("able")
    met = keyed.join(shared, ["s", "longer", "key"])
    blocks = F.greatest(F.ceil(F.col("size") / TILE), F.ceil(F.col("size") * F.col("s") / TILE_POINTS)).cast("long")
    dealt = met.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("word"), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    tiles = dealt.select("s", "longer", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "side", "word", "n")
    by = ["s", "longer", "key", "i", "j"]
    schema = "word string, other string, other_n long"
    target = arrow_schema(words.sparkSession, schema)
    found = tiles.repartition(*by).sortWithinPartitions(*by).mapInArrow(lambda batches: _compared(batches, target), schema)
    return found.distinct()


def _compared(batches: Iterator[pa.RecordBatch], target: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Pairs of each tile of a sorted stream; memory holds a batch and one tile."""
    left: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        left = table if left is None else pa.concat_tables([left, table])
        cut = _last_tile(left)
        if cut:
            yield from _pairs(left.slice(0, cut), target)
            left = left.slice(cut)
    if left is not None and left.num_rows:
        yield from _pairs(left, target)


def _starts(table: pa.Table) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for c in ("s", "longer", "key", "i", "j"):
        values = table[c].to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def _last_tile(table: pa.Table) -> int:
    return int(_starts(table)[-1]) if table.num_rows else 0


def _pairs(table: pa.Table, target: pa.Schema) -> Iterator[pa.RecordBatch]:
    starts = _starts(table)
    ends = np.append(starts[1:], table.num_rows)
    own, side, i, j = (table[c].to_numpy() for c in ("own", "side", "i", "j"))
    longer, n = table["longer"].to_numpy(), table["n"].to_numpy()
    words = table["word"].to_pylist()
    out: dict[str, list] = {f.name: [] for f in target}
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
        if b - a < 2:
            continue
        rows = np.arange(a, b)
        if longer[a]:  # shorter words against longer ones; those of one block only in its own tile
            sides = [(rows[side[a:b] == 0], rows[side[a:b] == 1])]
            if i[a] != j[a]:
                x, y = sides[0]
                sides = [(x[own[x] == p], y[own[y] == q]) for p, q in ((i[a], j[a]), (j[a], i[a]))]
        elif i[a] == j[a]:
            sides = [(rows, rows)]
        else:
            sides = [(rows[own[a:b] == i[a]], rows[own[a:b] == j[a]])]
        for x, y in sides:
            for p, q in single_edits([words[r] for r in x], [words[r] for r in y]):
                for u, v in ((x[p], y[q]), (y[q], x[p])):
                    out["word"].append(words[u])
                    out["other"].append(words[v])
                    out["other_n"].append(int(n[v]))
        if len(out["word"]) >= 20_000:
            yield pa.RecordBatch.from_pydict(out, target)
            out = {f.name: [] for f in target}
    yield pa.RecordBatch.from_pydict(out, target)


def _matrix(words: list[str], width: int, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points padded on the right, and on the left."""
    left, right = (np.full((len(words), width), pad, np.int32) for _ in range(2))
    for row, w in enumerate(words):
        points = np.frombuffer(w.encode("utf-32-le"), np.int32)
        left[row, : len(points)] = points
        right[row, width - len(points) :] = points
    return left, right


def single_edits(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places (in a, in b) of words that are one edit apart: prefix plus suffix reaches the longer length less one."""
    if not a or not b:
        return []
    width = max(map(len, a + b))
    la, lb = np.array([*map(len, a)]), np.array([*map(len, b)])
    (al, ar), (bl, br) = _matrix(a, width, -1), _matrix(b, width, -2)
    out = []
    step = max(1, CELLS // (len(b) * width))
    wide = max(1, CELLS // width)
    for at in range(0, len(a), step):
        for to in range(0, len(b), wide):
            x, y = slice(at, at + step), slice(to, to + wide)
            prefix = _run(al[x, None, :] != bl[None, y, :], width)
            suffix = _run((ar[x, None, :] != br[None, y, :])[:, :, ::-1], width)
            most, least = np.maximum(la[x, None], lb[None, y]), np.minimum(la[x, None], lb[None, y])
            near = (most - least <= 1) & (prefix + suffix >= most - 1) & ~((prefix == most) & (most == least))
            p, q = np.nonzero(near)
            out += zip((p + at).tolist(), (q + to).tolist(), strict=True)
    return out


def _run(differs: np.ndarray, width: int) -> np.ndarray:
    """Equal cells before the first that differs."""
    return np.where(differs.any(axis=2), differs.argmax(axis=2), width)


def grouped(words: DataFrame, dominance: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each of the distinct words (word, n).

    n_near counts words one edit apart. form is the one of them of largest n (ties: smallest in code-point
    order) if that n is at least dominance times the word's, else null; root is the last form of the chain
    that begins with the word. A chain's n grows by that factor each time, so it ends; chains are followed by
    doubling, each round written to shared storage and the one before it deleted. No words give no rows.
    """
    words = written(words)
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form")))
    near = near_pairs(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    joined = words.join(near, "word", "left").withColumn("form_n", -F.col("best.less"))
    judged = written(
        joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n", F.col("best.form").alias("form"))
        .withColumn("form", F.when(F.col("form_n") >= dominance * F.col("n"), F.col("form")))
        .withColumn("form_n", F.when(F.col("form").isNotNull(), F.col("form_n")))
    )
    chain = written(judged.where("form IS NOT NULL").select("word", F.col("form").alias("root"), F.lit(True).alias("open")))
    while chain.where("open").limit(1).count():
        ahead = chain.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = chain.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("open"))
        before, chain = chain, written(moved)
        discard(before)
    out = judged.join(chain.select("word", "root"), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
