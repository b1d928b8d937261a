"""MinHash near-duplicates by SetSketch registers.

A document's set of word shingles becomes ``bands * rows`` registers: for each register an exponential
variable is drawn for every shingle, and the register keeps the minimum on an exponentially spaced,
truncated scale. Equal registers are as likely as the sets are alike, and the maximum of two sketches is
the sketch of the union. Bands of registers give buckets; documents that share one become candidates,
are estimated jointly by likelihood, and those the estimate doesn't rule out by six deviations are
verified on their full sets.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WordHashes, discard, distinct, map_rows, pick, shingles, space_words, with_maybe, written
from tidemark.operators.graph import connected_components

#: A block of a candidate cluster that one task solves holds about so many bytes of text and so many rows.
BLOCK_BYTES, BLOCK_ROWS = 4 << 20, 512
#: Members of a large cluster, at most, that all its blocks are compared with first.
PIVOTS = 8


class SetSketch:
    """Registers of 16 bits: base b, rate a, values 0 to q + 1."""

    def __init__(self, size: int, base: float = 1.001, rate: float = 20.0, limit: int = 65_534, seed: int = 7):
        draw = np.random.default_rng(seed)
        self.size, self.base, self.rate, self.limit = size, base, rate, limit
        self._flip = draw.integers(0, 1 << 32, size, np.uint64).astype(np.uint32)
        self._first = draw.integers(0, 1 << 32, size, np.uint64).astype(np.uint32) | np.uint32(1)
        self._second = draw.integers(0, 1 << 32, size, np.uint64).astype(np.uint32) | np.uint32(1)

    def registers(self, hashes: np.ndarray) -> np.ndarray:
        """Of a set of 64-bit hashes; the empty set has zeros."""
        if not len(hashes):
            return np.zeros(self.size, np.uint16)
        low = np.full(self.size, 0xFFFFFFFF, np.uint32)
        folded = (hashes ^ (hashes >> np.uint64(32))).astype(np.uint32)
        for at in range(0, len(folded), 256):
            x = folded[at : at + 256, None] ^ self._flip
            x *= self._first
            x ^= x >> np.uint32(15)
            x *= self._second
            x ^= x >> np.uint32(13)
            np.minimum(low, x.min(axis=0), out=low)
        least = -np.log1p(-(low.astype(np.float64) + 0.5) / 2.0**32) / self.rate
        return np.clip(np.floor(1 - np.log(least) / np.log(self.base)), 0, self.limit + 1).astype(np.uint16)

    @staticmethod
    def merge(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.maximum(left, right)

    def jaccard(self, one: np.ndarray, n_one: int, many: np.ndarray, n_many: np.ndarray) -> np.ndarray:
        """Most likely Jaccard similarity of one sketch with each of many, given the sizes of the sets."""
        above, below = (one > many).sum(axis=1), (one < many).sum(axis=1)
        same = self.size - above - below
        u = n_one / (n_one + n_many)
        v = 1 - u
        scale, log_base = (self.base - 1) / self.base, np.log(self.base)
        low, high = np.zeros(len(n_many)), np.minimum(u / v, v / u) * (1 - 1e-9)
        for _ in range(24):  # the likelihood is concave: halve towards the zero of its slope
            mid = (low + high) / 2
            x, y = np.maximum(u - v * mid, 1e-12), np.maximum(v - u * mid, 1e-12)
            p, q = -np.log1p(-x * scale) / log_base, -np.log1p(-y * scale) / log_base
            dp, dq = scale / log_base / (1 - x * scale), scale / log_base / (1 - y * scale)
            slope = same * (v * dp + u * dq) / np.maximum(1 - p - q, 1e-12) - v * above * dp / p - u * below * dq / q
            low, high = np.where(slope > 0, mid, low), np.where(slope > 0, high, mid)
        return (low + high) / 2


def _band_keys(registers: np.ndarray, bands: int) -> np.ndarray:
    x = registers.reshape(len(registers), bands, -1).astype(np.uint64)
    out = np.broadcast_to((np.arange(bands, dtype=np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93), x.shape[:2]).copy()
    for j in range(x.shape[2]):
        out = (out ^ x[:, :, j]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(31)
    return out.view(np.int64)


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, size: int = 288) -> DataFrame:
    """(doc_id, text_hash, n_shingles, set_key binary, registers binary): equal sets have equal keys.

    Null and empty texts have no shingles, fewer than k words one.
    """

    def make():
        hashes, sketch = WordHashes(), SetSketch(size)

        def step(c):
            sets = [distinct(shingles(space_words(t), k, hashes)) for t in c["text"]]
            return {
                "doc_id": c["doc_id"],
                "text_hash": c["text_hash"],
                "n_shingles": [len(s) for s in sets],
                "set_key": [xxhash.xxh3_128_digest(s.tobytes()) for s in sets],
                "registers": [sketch.registers(s).tobytes() for s in sets],
            }

        return step

    return map_rows(_hashed(docs, id_col, text_col), make, "doc_id long, text_hash long, n_shingles long, set_key binary, registers binary")


def _hashed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text, text_hash): rows that share an id are told apart by their texts."""
    return pick(docs, doc_id=id_col, text=text_col).withColumn("text_hash", F.xxhash64("text"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80, bands: int = 48, rows: int = 6
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of docs.

    Two documents are linked when 100 * shared shingles >= percent * all their shingles; the component is
    the smallest id that links reach. With 48 bands of 6 registers a pair at 0.8 shares no bucket with
    probability 5e-7, and more alike ones far less.

    1. Equal sets become one class (a minimum per set key), so copies are never compared.
    2. Each bucket of classes points to its smallest class; components of these pointers are candidate
       clusters. No pair of a bucket is written out.
    3. A cluster of one block of bounded size is walked in one task (see _walk). Of a larger one each block
       is walked with a few pivots that all blocks share; what that leaves apart from the cluster's largest
       group is then compared with all its blocks. Labels are joined by another run of components.

    Null and empty texts have no shingles and are linked with nothing. A null id takes no part, and is its
    own component (null) and kept. Rows of one id with different texts each take part with their own text;
    repeated rows give equal rows. No rows give no rows; other columns are not looked at.
    """
    base = _hashed(docs, id_col, text_col)
    all_rows = written(sketches(base, k=k, size=bands * rows))
    one = all_rows.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("set_key").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("least"), F.first("registers").alias("registers")
    )
    classes = written(one.select(F.monotonically_increasing_id().alias("node"), "set_key", "least.doc_id", "least.text_hash", "registers"))

    def make():
        def step(c):
            if not c["node"]:
                return {"node": [], "keys": []}
            registers = np.frombuffer(b"".join(c["registers"]), np.uint16).reshape(len(c["node"]), -1)
            return {"node": c["node"], "keys": list(_band_keys(registers, bands))}

        return step

    keyed = map_rows(classes.select("node", "registers"), make, "node long, keys array<long>").select("node", F.explode("keys").alias("key"))
    hubs = keyed.groupBy("key").agg(F.min("node").alias("hub"), F.count("*").alias("n")).where("n > 1").select("key", "hub")
    pointers = written(keyed.join(hubs, "key").where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct())
    clusters = connected_components(pointers)
    discard(pointers)
    labels = _labels(_members(clusters, base, classes), k, percent, bands * rows)
    found = (
        all_rows.select("doc_id", "n_shingles", "set_key")
        .join(classes.select("set_key", "node", F.col("doc_id").alias("least")), "set_key", "left")
        .join(labels, "node", "left")
    )
    component = F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.coalesce("component_id", "least")).otherwise(F.col("doc_id"))
    out = found.select("doc_id", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _members(clusters: DataFrame, base: DataFrame, classes: DataFrame) -> DataFrame:
    """(node, component, doc_id, text, registers) of the clusters' members, written.

    Ids of members grow with the documents, so they meet the texts by a shuffle at any size; a map of fixed
    size rules out nearly all texts of other documents first.
    """
    wanted = written(clusters.join(classes.select("node", "doc_id", "text_hash"), "node"))
    likely = with_maybe(base, wanted, "doc_id", "text_hash").where("_maybe")
    texts = likely.join(wanted.hint("merge"), ["doc_id", "text_hash"]).select("node", "component", "doc_id", "text").dropDuplicates(["node"])
    members = written(texts.join(classes.select("node", "registers"), "node"))
    discard(wanted)
    return members


def _labels(members: DataFrame, k: int, percent: int, size: int) -> DataFrame:
    """(node, component_id) of the members."""
    least = lambda n, per: F.ceil(n / per)
    blocks = F.greatest(least(F.sum(F.octet_length("text")), BLOCK_BYTES), least(F.count("*"), BLOCK_ROWS)).cast("int").alias("blocks")
    # Only clusters of several blocks are in this table, so it is small beside the members.
    large = written(members.groupBy("component").agg(blocks).where("blocks > 1"))
    solved = lambda dealt, *keys: _solved(dealt, keys, k, percent, size)
    alone = written(solved(members.join(large, "component", "left_anti"), "component"))
    found = alone.select("node", F.col("least").alias("component_id"))
    if large.isEmpty():
        discard(members)
        return found
    slot = lambda seed, n: F.pmod(F.xxhash64("node", F.lit(seed)), n).cast("int")
    several = members.join(large, "component").withColumn("own", slot(1, F.col("blocks")))
    chosen = several.groupBy("component", slot(2, F.lit(PIVOTS)).alias("slot")).agg(F.min("node").alias("node")).select("node")
    pivots = several.join(written(chosen), "node", "left_semi").withColumn("own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    edges = written(solved(several.unionByName(pivots), "component", "own"))
    groups = _joined(edges)
    tagged = several.join(groups, "node", "left").withColumn("group", F.coalesce("group", "node"))
    sizes = tagged.groupBy("component", "group").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    # Clusters that are still in several groups, with the largest; the others' members are the rest.
    open_ = sizes.groupBy("component").agg(
        F.max(F.struct("n", "group", "bytes")).alias("top"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes")
    ).where("n > top.n")
    parts = F.greatest(least(F.col("bytes") - F.col("top.bytes"), BLOCK_BYTES), least(F.col("n") - F.col("top.n"), BLOCK_ROWS)).cast("int")
    open_ = written(open_.select("component", F.col("top.group").alias("main"), parts.alias("parts")))
    if not open_.isEmpty():
        left = tagged.join(open_, "component")
        rest = left.where("group <> main").withColumn("part", slot(3, F.col("parts"))).withColumn("own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        every = left.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        edges = edges.unionByName(written(solved(every.unionByName(rest), "component", "own", "part")))
        groups = _joined(edges)
    joined = written(members.join(large, "component", "left_semi").join(groups, "node", "left").select("node", "doc_id", F.coalesce("group", "node").alias("group")).distinct())
    discard(members)
    smallest = written(joined.groupBy("group").agg(F.min("doc_id").alias("component_id")))
    return found.union(joined.join(smallest, "group").select("node", "component_id"))


def _joined(edges: DataFrame) -> DataFrame:
    """(node, group) of the nodes that have a link."""
    return connected_components(edges.select(F.col("node").alias("a"), F.col("label").alias("b"))).withColumnRenamed("component", "group")


def _solved(dealt: DataFrame, keys: tuple[str, ...], k: int, percent: int, size: int) -> DataFrame:
    """(node, label, least): for each node of a block the node with the smallest id that links reach there, and that id.

    The number of partitions is stated, as Python work behind few bytes would be coalesced into a few long tasks.
    """

    def solve(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates("node").sort_values(["doc_id", "node"], ignore_index=True)
        hashes = WordHashes()
        sets = [distinct(shingles(space_words(t), k, hashes)) for t in group["text"]]
        registers = np.frombuffer(b"".join(group["registers"]), np.uint16).reshape(len(group), -1)
        label = _walk(sets, registers, SetSketch(size), percent)
        return pd.DataFrame({"node": group["node"], "label": group["node"].to_numpy()[label], "least": group["doc_id"].to_numpy()[label]})

    parts = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.select(*keys, "node", "doc_id", "text", "registers").repartition(parts, *keys)
    return dealt.groupBy(*keys).applyInPandas(solve, "node long, label long, least long")


def _walk(sets: list[np.ndarray], registers: np.ndarray, sketch: SetSketch, percent: int) -> np.ndarray:
    """For each set the place of the first one that links reach.

    Breadth first. A set is only ever compared with those not reached yet, so a large group of copies
    costs its size times what stays apart from it, not its square.
    """
    n = np.array([len(s) for s in sets], np.int64)
    margin = percent / 100 - 6 * np.sqrt(percent / 100 * (1 - percent / 100) / sketch.size)
    label, open_ = np.full(len(sets), -1), np.arange(len(sets))
    for start in range(len(sets)):
        if label[start] >= 0:
            continue
        label[start], queue = start, [start]
        open_ = open_[label[open_] < 0]
        while queue and len(open_):
            q = queue.pop()
            fits = open_[(100 * np.minimum(n[open_], n[q]) >= percent * np.maximum(n[open_], n[q]))]
            if len(fits):
                fits = fits[sketch.jaccard(registers[q], n[q], registers[fits], n[fits]) >= margin]
            if not len(fits):
                continue
            flat = np.concatenate([sets[i] for i in fits])
            at = np.searchsorted(sets[q], flat)
            at[at == n[q]] = 0
            shared = np.add.reduceat((sets[q][at] == flat).astype(np.int64), np.concatenate(([0], np.cumsum(n[fits])[:-1])))
            linked = fits[100 * shared >= percent * (n[fits] + n[q] - shared)]
            label[linked] = start
            queue.extend(linked.tolist())
            open_ = open_[label[open_] < 0]
    return label
