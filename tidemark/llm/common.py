"""What several corpus operators share: reading columns in tasks, hashing words, shared storage, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.storage import discard, shared_folder, written  # noqa: F401  for the operators

#: Rows of an Arrow batch, and bytes of their texts, that are turned into Python objects at once.
SLICE, SLICE_BYTES = 512, 8 << 20
#: Bits of the map that tells which rows of a large table may have a partner in a join: 2000 parts of 4 KB, 8 MB.
FILTER_BITS = 2000 << 15
#: Words whose hashes a task remembers before it starts afresh.
REMEMBERED = 150_000

_EMPTY = np.empty(0, np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xC2B2AE3D27D4EB4F)


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named input columns, under fixed internal names, so that extra columns can't clash."""
    return df.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()])


def map_rows(df: DataFrame, make: Callable[[], Callable[[dict[str, list]], dict[str, list]]], schema: str, rows: int = SLICE) -> DataFrame:
    """Run a function over column lists of at most ``rows`` rows and about SLICE_BYTES of texts.

    ``make`` is called once a task, so what it sets up (tokenizers, caches) is shared by the task's
    rows. The rows stream: memory holds one Arrow batch and one slice.
    """
    target = arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            for part in _slices(batch, rows):
                out = step({n: c.to_pylist() for n, c in zip(part.schema.names, part.columns, strict=True)})
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in target], schema=target)

    return df.mapInArrow(run, schema)


def _slices(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    size = np.zeros(batch.num_rows, np.int64)
    for c in batch.columns:
        if pa.types.is_string(c.type) or pa.types.is_binary(c.type):
            size += pc.fill_null(pc.binary_length(c), 0).to_numpy(zero_copy_only=False)
    total, at = np.cumsum(size), 0
    while at < batch.num_rows:
        full = int(np.searchsorted(total, (total[at - 1] if at else 0) + SLICE_BYTES, "right"))
        to = min(at + rows, batch.num_rows, max(at + 1, full))
        yield batch.slice(at, to - at)
        at = to


def arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def with_maybe(df: DataFrame, keys_of: DataFrame, *keys: str) -> DataFrame:
    """df with ``_maybe``: false where its keys are surely not among those of keys_of.

    The keys' hashes set bits of a map of FILTER_BITS bits, whatever their number, so what is broadcast has a
    fixed size: rows that can't meet a partner needn't be shuffled for a join. With very many keys the map
    fills up and rules out less.
    """
    place = F.pmod(F.xxhash64(*keys), F.lit(FILTER_BITS))
    bits = keys_of.select(place.alias("_place")).select(F.shiftright("_place", 15).alias("_part"), F.col("_place").bitwiseAND(0x7FFF).alias("_bit"))
    maps = written(bits.groupBy("_part").agg(F.bitmap_construct_agg("_bit").alias("_map")))
    marked = df.withColumn("_place", place).withColumns({"_part": F.shiftright("_place", 15), "_bit": F.col("_place").bitwiseAND(0x7FFF)})
    byte = "cast(conv(hex(substring(_map, cast(_bit div 8 AS int) + 1, 1)), 16, 10) AS int)"
    is_set = F.coalesce(F.expr(f"shiftright({byte}, cast(_bit % 8 AS int)) & 1 = 1"), F.lit(False))
    return marked.join(F.broadcast(maps), "_part", "left").withColumn("_maybe", is_set).drop("_place", "_part", "_bit", "_map")


def crc32_of(column: Column) -> Column:
    return F.crc32(F.encode(F.coalesce(column, F.lit("")), "UTF-8"))


class WordHashes(dict):
    """64-bit hashes of words, remembered; emptied when full, so that memory is bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def space_words(text: str | None) -> list[bytes]:
    """Words parted by ASCII white space (x20, x09 to x0D), A to Z in lower case, as UTF-8."""
    return text.encode("utf-8").lower().split() if text else []


def shingles(words: list[bytes], k: int, hashes: WordHashes) -> np.ndarray:
    """Hash of the shingle at each place; fewer than k words are one shingle, none are none."""
    n = len(words)
    if not n:
        return _EMPTY
    span = min(n, k)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    out = np.full(n - span + 1, span, np.uint64)
    out *= _MIX2
    for j in range(span):
        out ^= h[j : j + n - span + 1]
        out *= _MIX
        out ^= out >> np.uint64(29)
    out *= _MIX2
    out ^= out >> np.uint64(32)
    return out


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted without repeats."""
    if len(values) < 2:
        return values
    values = np.sort(values)
    return values[np.concatenate(([True], values[1:] != values[:-1]))]


def lined(rows: DataFrame, *order: str) -> DataFrame:
    """rows with ``at`` and ``total``: sizes before a row and in all, on its line by the order columns.

    Needs the columns line and size. Range partitions keep running sums for each line; their totals, one row for each
    line and partition, say where a partition begins on it, so no line meets in one task. Rows alike in
    line and order may change places.
    """
    laid = rows.repartitionByRange("line", *order).sortWithinPartitions("line", *order)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    run = written(map_rows(laid, _running_sums, f"{ddl}, part int, before long"))
    sums = run.groupBy("line", "part").agg(F.sum("size").alias("here"))
    line = Window.partitionBy("line")
    begins = sums.select(
        "line", "part", F.sum("here").over(line).alias("total"),
        F.coalesce(F.sum("here").over(line.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("begin"),
    )
    return run.join(begins, ["line", "part"]).withColumn("at", F.col("begin") + F.col("before")).drop("part", "before", "begin")


def _running_sums():
    from pyspark import TaskContext

    part, now, total = TaskContext.get().partitionId(), None, 0

    def step(c):
        nonlocal now, total
        before = []
        for line, size in zip(c["line"], c["size"], strict=True):
            if line != now:
                now, total = line, 0
            before.append(total)
            total += size
        return {**c, "part": [part] * len(before), "before": before}

    return step
