"""Connected components as joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.storage import discard, written


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) from edges (a, b) of longs; the component is its smallest node.

    Alternates two star operations, each a minimum per node and an equi-join, until nothing changes
    (rounds grow as the logarithm of the diameter). Every round is written to shared storage, and the one
    before it deleted; the driver sees a count and a checksum. No edges give no rows, loops and repeats do no harm, edges with a null
    end are left out.
    """
    spark = edges.sparkSession
    now = written(_small_star(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v").distinct()))
    seen = None
    while True:
        state = tuple(now.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first())
        if state == seen or state[0] == 0:
            break
        seen = state
        before, now = now, written(_small_star(_large_star(now)))
        discard(before)
    if not state[0]:
        return spark.createDataFrame([], "node long, component long")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()
