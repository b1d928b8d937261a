"""A Merkle manifest of a dataset, its blocks in van Emde Boas layout.

Rows are leaves of a tree for each group (language), whose roots are leaves of one more tree. A tree is cut into aligned
subtrees of LEVELS levels, the blocks; a block's nodes are stored in the order that splits it recursively
at half its height, so that a path from leaf to root touches few stretches of memory whatever the size of a cache
line. The roots of blocks are the leaves of the next blocks, until one is left.
"""

from __future__ import annotations

import hashlib
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_schema, crc32_of, lined, map_rows, pick, written

#: Children of a node, and levels above the leaves that a block holds: 4096 leaves.
ARITY, LEVELS = 8, 4
_DIGEST = 32


def H(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def _nodes(rows: int) -> int:
    """Nodes of a full tree with so many rows of nodes."""
    return (ARITY**rows - 1) // (ARITY - 1)


@cache
def _split(rows: int) -> tuple[int, int, int]:
    """Rows of the upper half, its nodes, and the nodes of each subtree below it."""
    top = rows // 2
    return top, _nodes(top), _nodes(rows - top)


def address(rows: int, depth: int, index: int) -> int:
    """Where the node at a depth (root: 0) stands in the layout of a full tree with so many rows of nodes."""
    base = 0
    while rows > 1:
        top, above, below = _split(rows)
        if depth < top:
            rows = top
        else:
            subtree, index = divmod(index, ARITY ** (depth - top))
            base += above + subtree * below
            rows, depth = rows - top, depth - top
    return base


def height_of(leaves: int) -> int:
    """Levels until one node is left."""
    height = 0
    while leaves > 1:
        leaves, height = -(-leaves // ARITY), height + 1
    return height


class Block:
    """A block's nodes by level (leaves: 0) and index, at their addresses in one run of bytes."""

    def __init__(self, height: int, leaves: int, data: bytearray | bytes | None = None):
        self.height = height
        self.counts = [leaves]
        for _ in range(height):
            self.counts.append(-(-self.counts[-1] // ARITY))
        self.data = bytearray(_nodes(height + 1) * _DIGEST) if data is None else data

    def _place(self, level: int, index: int) -> int:
        return address(self.height + 1, self.height - level, index) * _DIGEST

    def get(self, level: int, index: int) -> str:
        at = self._place(level, index)
        return self.data[at : at + _DIGEST].hex()

    def put(self, level: int, index: int, digest: str) -> None:
        at = self._place(level, index)
        self.data[at : at + _DIGEST] = bytes.fromhex(digest)

    def run(self, level: int, index: int) -> range:
        first = index - index % ARITY
        return range(first, min(first + ARITY, self.counts[level]))

    def build(self, digests: list[str]) -> str:
        """Fill the block from its leaves; its root."""
        for i, d in enumerate(digests):
            self.put(0, i, d)
        for level in range(1, self.height + 1):
            for i in range(self.counts[level]):
                self.put(level, i, H("".join(self.get(level - 1, j) for j in self.run(level - 1, i * ARITY)).encode()))
        return self.get(self.height, 0)

    def step(self, level: int, index: int) -> str:
        """A node's place in its run and its siblings, left to right."""
        return str(index % ARITY) + "".join(self.get(level, j) for j in self.run(level, index) if j != index)

    def paths(self, above: list[str]):
        """A function from a leaf's index to its steps up to the block's root, and from there those above; runs share them."""
        known: dict[tuple[int, int], list[str]] = {}

        def up(level: int, index: int) -> list[str]:
            if level == self.height:
                return above
            if level == 0:
                return [self.step(0, index), *up(1, index // ARITY)]
            if (level, index) not in known:
                known[level, index] = [self.step(level, index), *up(level + 1, index // ARITY)]
            return known[level, index]

        return lambda index: up(0, index)


def fold(digest: str, path: list[str]) -> str:
    """The root that a leaf and its path give."""
    for step in path:
        cut = 1 + len(digest) * int(step[0])
        digest = H((step[1:cut] + digest + step[cut:]).encode())
    return digest


def build(nodes: DataFrame, height: int = LEVELS) -> list[DataFrame]:
    """Blocks (line, block, total, leaves, tree, root) of each level, lowest first, from nodes (line, at, total, digest).

    Each level is grouped by block, at most 8 ** height digests, and written; of it the driver sees one number.
    """
    most = ARITY**height
    schema = "line string, block long, total long, leaves int, tree binary, root string"
    target = arrow_schema(nodes.sparkSession, schema)

    def one(group: pa.Table) -> pa.Table:
        digests = group.sort_by("at")["digest"].to_pylist()
        line, total, at = (group[c][0].as_py() for c in ("line", "total", "at"))
        block = Block(min(height, height_of(total)), len(digests))
        root = block.build(digests)
        return pa.Table.from_pylist([{"line": line, "block": at // most, "total": total, "leaves": len(digests), "tree": bytes(block.data), "root": root}], target)

    levels = []
    while True:
        grouped = nodes.select("line", "at", "total", "digest", F.expr(f"at div {most}").alias("block")).groupBy("line", "block")
        blocks = written(grouped.applyInArrow(one, schema))
        levels.append(blocks)
        nodes = blocks.where(F.col("total") > most).select(
            "line", F.col("block").alias("at"), F.expr(f"(total + {most - 1}) div {most}").alias("total"), F.col("root").alias("digest")
        )
        if not (blocks.agg(F.max("total")).first()[0] or 0) > most:
            return levels


def roots(levels: list[DataFrame], height: int = LEVELS) -> DataFrame:
    """(line, root) of every tree."""
    out = None
    for level in levels:
        own = level.where(F.col("total") <= ARITY**height).select("line", "root")
        out = own if out is None else out.unionByName(own)
    return out


def with_paths(levels: list[DataFrame], tops: DataFrame, height: int = LEVELS) -> DataFrame:
    """Blocks of the lowest level with ``path``, the steps above their roots.

    tops (line, path) has those above the trees' roots. Blocks are walked from the top; each hands its path down to the blocks
    whose roots are its leaves, by an equi-join on line and block.
    """
    down = None
    for level in reversed(levels):
        above = level.where(F.col("total") <= ARITY**height).join(tops.select("line", "path"), "line")
        if down is not None:
            above = above.unionByName(level.where(F.col("total") > ARITY**height).join(down, ["line", "block"]))
        down = leaf_paths(above, height).withColumnRenamed("at", "block")
    return above


def leaf_paths(blocks: DataFrame, height: int = LEVELS) -> DataFrame:
    """(line, at, path) of each leaf of blocks that have a path."""

    def make():
        def step(c):
            out = {"line": [], "at": [], "path": []}
            for line, number, total, leaves, tree, above in zip(*(c[k] for k in ("line", "block", "total", "leaves", "tree", "path")), strict=True):
                path = Block(min(height, height_of(total)), leaves, tree).paths(above)
                for i in range(leaves):
                    for name, value in zip(out, (line, number * ARITY**height + i, path(i)), strict=True):
                        out[name].append(value)
            return out

        return step

    return map_rows(blocks.select("line", "block", "total", "leaves", "tree", "path"), make, "line string, at long, path array<string>", rows=1)


def leaf(*fields: Column) -> Column:
    """H of the fields: ``-`` for null, else length in UTF-8 bytes, a colon and the value."""
    text = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in text]).cast("binary"), 256)


def audited(docs: DataFrame, height: int = LEVELS) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) for each row of docs.

    docs has doc_id, source, lang, n_chars and text; ``changed_text``, where there is such a column, is the
    text that stands there now (null: also a text). Leaves stand by (doc_id, digest) with null ids first, so the order of
    repeated ids is stated and equal rows may change places. A null language comes first and is a group of
    its own; empty texts are leaves like others. No rows give no rows; other columns are not looked at.
    Digests are all that is shuffled, never texts.
    """
    changed = "changed_text" if "changed_text" in docs.columns else "text"
    slim = pick(docs, doc_id="doc_id", source="source", lang="lang", n_chars="n_chars", text="text", now=changed)
    base = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    rows = written(
        slim.select(
            "doc_id", F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")).alias("line"), leaf(*base, F.col("text")).alias("leaf"),
            leaf(*base, F.col("now")).alias("now"), F.lit(1).cast("long").alias("size"), F.monotonically_increasing_id().alias("tie"),
        )
    )
    leaves = written(lined(rows, "doc_id", "leaf", "tie").drop("tie", "size"))
    levels = build(leaves.withColumnRenamed("leaf", "digest"), height)
    groups = written(roots(levels, height).select(F.lit("").alias("line"), F.col("line").alias("name"), F.col("root").alias("digest"), F.lit(1).cast("long").alias("size")))
    groups = written(lined(groups, "name"))
    upper = build(groups, height)
    top = roots(upper, height).first()  # one row: the root of all
    root = top.root if top else None
    start = docs.sparkSession.createDataFrame([("", [])], "line string, path array<string>")
    tops = written(leaf_paths(with_paths(upper, start, height), height).select("at", "path").join(groups.select("at", "name", F.col("digest").alias("subroot")), "at"))
    blocks = with_paths(levels, tops.select(F.col("name").alias("line"), "path"), height)
    blocks = blocks.join(tops.select(F.col("name").alias("line"), "subroot"), "line")
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    target = arrow_schema(docs.sparkSession, schema)

    def prove(mine: pa.Table, block: pa.Table) -> pa.Table:
        b = block.to_pylist()[0]
        path_of = Block(min(height, height_of(b["total"])), b["leaves"], b["tree"]).paths(b["path"])
        proof, folded = [], []
        for at, now in zip(mine["at"].to_pylist(), mine["now"].to_pylist(), strict=True):
            path = path_of(at % ARITY**height)
            proof.append(H("".join(s[1:] for s in path).encode()))
            folded.append(fold(now, path))
        n = len(proof)
        columns = [mine["doc_id"], mine["leaf"], [b["subroot"]] * n, [root] * n, proof, folded, [f == root for f in folded]]
        return pa.Table.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else pa.array(c, f.type) for c, f in zip(columns, target, strict=True)], schema=target)

    mine = leaves.withColumn("block", F.expr(f"at div {ARITY**height}")).groupBy("line", "block")
    return mine.cogroup(blocks.groupBy("line", "block")).applyInArrow(prove, schema)


def tampered(docs: DataFrame) -> DataFrame:
    """docs with ``changed_text``: A to Z in lower case where 3 divides crc32 of the id (null ids: as it is)."""
    hit = F.coalesce(crc32_of(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False)) & F.col("doc_id").isNotNull()
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return pick(docs, **{c: c for c in ("doc_id", "source", "lang", "n_chars", "text")}).withColumn("changed_text", F.when(hit, lower).otherwise(F.col("text")))
