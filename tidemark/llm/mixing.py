"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Each source's words lie on a line, its documents in pseudo-random order, cut into blocks of equal length. A source gives whole passes
of its line and, of one more, as many permuted blocks as reach its quota, the last cut to fit. A tree over the output shards
splits the vector of block quotas: each node deals half of its places by a multivariate-hypergeometric
draw, so quotas are met exactly and every shard is a fair sample. A shard then takes the next blocks of each
source's permutation and shuffles them within itself.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Sequence
from fractions import Fraction
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import lined, map_rows, pick, written

WEIGHTS = (3, 1, 2)
#: Words of a block. numpy's draws take fewer than 10 ** 9 blocks: 4 * 10 ** 12 words; beyond that blocks must be longer.
BLOCK_WORDS = 4096
SEED = 17


def targets(sizes: Sequence[int], weights: Sequence[int], share: Fraction = Fraction(3, 2), most: int = 2) -> list[Fraction]:
    """Shares by weight of ``share`` of all sizes; none above ``most`` times its size, the excess shared anew by weight."""
    out, rest, free = [Fraction(0)] * len(sizes), share * sum(sizes), set(range(len(sizes)))
    while free:
        unit = rest / sum(weights[i] for i in free)
        full = {i for i in free if unit * weights[i] > most * sizes[i]}
        for i in full or free:
            out[i] = Fraction(most * sizes[i]) if full else unit * weights[i]
        if not full:
            break
        rest -= sum(out[i] for i in full)
        free -= full
    return out


def split(quotas: Sequence[int], shards: int, seed: int = SEED) -> list[list[int]]:
    """Blocks of each source for each shard: shards differ by one block at most, and columns add up to the quotas."""

    def deal(node: int, counts: np.ndarray, lo: int, hi: int) -> list[list[int]]:
        if hi - lo == 1:
            return [counts.tolist()]
        mid = (lo + hi) // 2
        left = int(sum(rows[lo:mid]))
        draw = np.random.default_rng([seed, node]).multivariate_hypergeometric(counts, left, method="marginals") if len(counts) else counts
        return deal(2 * node, draw, lo, mid) + deal(2 * node + 1, counts - draw, mid, hi)

    total = sum(quotas)
    rows = [total * (i + 1) // shards - total * i // shards for i in range(shards)]
    return deal(1, np.array(quotas, np.int64), 0, shards)


class Permutation:
    """A bijection of 0 .. n - 1 in constant memory: four Feistel rounds over the next square, walked until inside."""

    def __init__(self, n: int, *seed: int):
        self.n, self.side = n, max(1, math.isqrt(max(n - 1, 0)) + 1)
        self.keys = np.random.default_rng([*seed, n]).integers(1, 1 << 31, 4).tolist()

    def __call__(self, i: int) -> int:
        while True:
            a, b = divmod(i, self.side)
            for k in self.keys:
                x = (b + 1) * k * 0x9E3779B1 & 0xFFFFFFFFFFFF
                a, b = b, (a + ((x ^ x >> 23) * 0x85EBCA6B >> 7)) % self.side
            i = a * self.side + b
            if i < self.n:
                return i


class Source:
    """What one source gives: its passes, and the shard of each block."""

    def __init__(self, number: int, size: int, target: Fraction, block: int, seed: int = SEED):
        self.size, self.block, self.target = size, block, target
        self.taken = round(target)
        self.passes, self.rest = divmod(self.taken, size) if size else (0, 0)
        self.blocks = -(-size // block)
        self.order = Permutation(self.blocks, seed, number, 1)
        self.short = self.order(self.blocks - 1) if self.rest else 0  # where the line's last block stands in that order
        self.drawn = self._drawn() if self.rest else 0
        self.quota = self.passes * self.blocks + self.drawn
        self.places = Permutation(self.quota, seed, number, 2)
        self.number, self.ends = number, []

    def _length(self, block: int) -> int:
        return min(self.block, self.size - block * self.block)

    def _drawn(self) -> int:
        """Blocks of the permuted order that the last pass opens; all but the line's last block have full length."""
        n = -(-self.rest // self.block)
        return n if n <= self.short else -(-(self.rest + self.block - self._length(self.blocks - 1)) // self.block)

    def words(self, block: int) -> int:
        """Words that the last pass takes from a block, from its beginning on."""
        place = self.order(block)
        if place >= self.drawn:
            return 0
        before = place * self.block - (self.block - self._length(self.blocks - 1) if place > self.short else 0)
        return max(0, min(self._length(block), self.rest - before))

    def pieces(self, at: int, size: int):
        """(pass, first, end, shard, draw) of the stretches taken of a document that lies at ``at``."""
        for block in range(at // self.block, -(-(at + size) // self.block) if size else 0):
            first, end = max(at, block * self.block), min(at + size, (block + 1) * self.block)
            for turn in range(self.passes + (self.drawn > 0)):
                to = end if turn < self.passes else min(end, block * self.block + self.words(block))
                if to > first:
                    draw = self.places(turn * self.blocks + (block if turn < self.passes else self.order(block)))
                    yield turn, first - at, to - at, bisect_right(self.ends, draw), draw


def mix(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[int] = WEIGHTS, block_words: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, size, source_size, target, taken, pieces) for each row of docs.

    size is the text's words (null, empty: 0); sources by code point, null last, take the weights in turn. A piece (turn, first,
    end, shard, draw) is a stretch of the document's words that a shard takes in one pass; taken adds up their
    lengths and is at most twice the size. A source's taken words are its target rounded. Documents without words give
    no piece. Rows alike in id and text may change places; reruns give the same rows otherwise, whatever
    the partitions. No rows give no rows; other columns are not looked at. The driver sees one row for each
    source; ids, sizes and hashes are all that is shuffled.
    """
    slim = pick(docs, doc_id=id_col, text=text_col, source=source_col)
    rows = written(
        slim.select(
            "doc_id", F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("line"),
            F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("size"),
            F.xxhash64(F.lit(seed), "doc_id", "text").alias("order"), F.monotonically_increasing_id().alias("tie"),
        )
    )
    sums = {r.line: r.sum for r in rows.groupBy("line").agg(F.sum("size").alias("sum")).collect()}  # a row for each source
    names = sorted(sums, key=lambda n: (not n, n))
    of = targets([sums[n] for n in names], [weights[i % len(weights)] for i in range(len(names))])
    sources = {n: Source(i, sums[n], t, block_words, seed) for i, (n, t) in enumerate(zip(names, of, strict=True))}
    shares = split([sources[n].quota for n in names], shards, seed)
    for i, n in enumerate(names):
        sources[n].ends = list(accumulate(s[i] for s in shares))[:-1]

    def make():
        def step(c):
            out = {"doc_id": c["doc_id"], "size": c["size"], "source_size": [], "target": [], "taken": [], "pieces": []}
            for line, size, at in zip(c["line"], c["size"], c["at"], strict=True):
                source = sources[line]
                pieces = list(source.pieces(at, size))
                out["source_size"].append(source.size)
                out["target"].append(float(source.target))
                out["taken"].append(sum(p[2] - p[1] for p in pieces))
                out["pieces"].append([dict(zip(("turn", "first", "end", "shard", "draw"), p, strict=True)) for p in pieces])
            return out

        return step

    placed = lined(rows, "order", "doc_id", "tie").select("doc_id", "line", "size", "at")
    kind = rows.schema["doc_id"].dataType.simpleString()
    piece = "array<struct<turn:int,first:long,end:long,shard:int,draw:long>>"
    return map_rows(placed, make, f"doc_id {kind}, size long, source_size long, target double, taken long, pieces {piece}")


def shuffled(mixed: DataFrame, shards: int = 8, seed: int = SEED) -> DataFrame:
    """(shard, doc_id, turn, first, end) of all pieces, each shard in one partition and in a pseudo-random order of its own."""
    pieces = mixed.select("doc_id", F.explode("pieces").alias("p")).select("p.shard", "doc_id", "p.turn", "p.first", "p.end", "p.draw")
    order = F.xxhash64(F.lit(seed), "draw", "doc_id", "turn", "first")
    return pieces.withColumn("order", order).repartition(shards, "shard").sortWithinPartitions("shard", "order").drop("order", "draw")
