"""Contiguous shards of near equal bytes by a global prefix sum."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import crc32_of, map_rows, pick, written


def shard_by_bytes(
    docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", group_share: float = 0.01
) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for each row of docs.

    Rows are laid out by (text digest, id), so equal texts lie together. Each range partition keeps its own
    running sums; the partitions' totals, one row each, give where it begins in the whole, and the line of
    all bytes is cut at equal targets. A cut that falls inside a group of equal texts moves to the nearer
    end of the group if that shifts it by no more than ``group_share`` of a shard; larger groups are
    split, since sizes come first. Ids and digests are all that is shuffled, never texts.

    size is the text's UTF-8 bytes plus 1 (null: 1); slot counts the rows of a shard from 0 without gaps;
    grown_shard is null, as the law is bytes. Rows that are alike in id and text are interchangeable. No
    rows give no rows; other columns are not looked at.
    """
    slim = pick(docs, doc_id=id_col, text=text_col).select(
        "doc_id",
        F.coalesce(F.octet_length("text").cast("long"), F.lit(0).cast("long")).__add__(1).alias("size"),
        crc32_of(F.col("text")).alias("text_crc32"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("digest"),
    )
    laid = slim.repartitionByRange("digest", "text_crc32", "doc_id").sortWithinPartitions("digest", "text_crc32", "doc_id")
    run = written(map_rows(laid, _running, "doc_id long, size long, text_crc32 long, digest long, part int, before long, place long"))
    spark = docs.sparkSession
    begins, byte, row = [], 0, 0
    for p in sorted(run.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect()):  # a row for each partition
        begins.append((p.part, byte, row))
        byte, row = byte + p.bytes, row + p.rows
    starts = spark.createDataFrame(begins, "part int, first_byte long, first_row long")
    line = run.join(F.broadcast(starts), "part").select(
        "doc_id", "size", "text_crc32", "digest", (F.col("first_byte") + F.col("before")).alias("at"), (F.col("first_row") + F.col("place")).alias("row")
    )
    shard = sum(((F.col("at") >= c).cast("int") for c in _snapped(line, [byte * i // shards for i in range(1, shards)], group_share * byte / shards)), F.lit(0))
    placed = line.withColumn("shard", shard)
    firsts = {r.shard: r.first_row for r in placed.groupBy("shard").agg(F.min("row").alias("first_row")).collect()}  # a row for each shard
    first = F.element_at(F.create_map(*[F.lit(x).cast("long") for pair in firsts.items() for x in pair]), F.col("shard").cast("long")) if firsts else F.lit(0)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("row") - first).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _running():
    from pyspark import TaskContext

    part, total, rows = TaskContext.get().partitionId(), 0, 0

    def step(c):
        nonlocal total, rows
        before = []
        for size in c["size"]:
            before.append(total)
            total += size
        place = list(range(rows, rows + len(before)))
        rows += len(before)
        return {**c, "part": [part] * len(before), "before": before, "place": place}

    return step


def _snapped(line: DataFrame, cuts: list[int], most: float) -> list[int]:
    """Each cut at a row's beginning; one row per cut reaches the driver."""
    if not cuts:
        return []
    inside = [(F.col("at") <= c) & (F.col("at") + F.col("size") > c) for c in cuts]
    cut = [r.digest for r in line.where(F.array_contains(F.array(*inside), True)).select("digest").distinct().collect()]
    groups = line.where(F.col("digest").isin(cut)).groupBy("digest", "text_crc32")
    spans = groups.agg(F.min("at").alias("a"), F.max(F.col("at") + F.col("size")).alias("b")).collect()
    out = []
    for c in cuts:
        for s in spans:
            if s.a < c < s.b:
                near = s.a if c - s.a <= s.b - c else s.b
                c = near if abs(near - c) <= most else c
                break
        out.append(c)
    return out
