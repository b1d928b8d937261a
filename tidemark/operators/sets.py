"""Key sets put together and held against one another."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stacked(frames: Mapping[str, DataFrame], source: str = "source") -> DataFrame:
    """All rows of the frames, columns by name, each with its frame's name."""
    return reduce(DataFrame.unionByName, [df.select(F.lit(name).alias(source), "*") for name, df in frames.items()])


def spine_left_join(spine: DataFrame, keys: Sequence[str], *frames: DataFrame) -> DataFrame:
    """The spine's rows with what each frame has for their keys; no frame adds or takes rows away, its keys must not repeat."""
    return reduce(lambda left, right: left.join(right, list(keys), "left"), frames, spine)


def set_difference(expected: DataFrame, present: DataFrame) -> DataFrame:
    """Keys that only one side has, with ``kind``: missing or extra. Repeats count once."""
    keys = expected.columns
    a, b = expected.distinct(), present.select(*keys).distinct()
    return a.join(b, keys, "left_anti").withColumn("kind", F.lit("missing")).unionByName(b.join(a, keys, "left_anti").withColumn("kind", F.lit("extra")))


def set_intersection(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct keys of a that b has as well."""
    return a.distinct().join(b.select(*a.columns).distinct(), a.columns, "left_semi")


def key_set_compare(before: DataFrame, after: DataFrame, keys: Sequence[str], *by: str) -> DataFrame:
    """(by, lost, gained): keys that went and that came, per group."""
    a = before.select(*keys).distinct().withColumn("_a", F.lit(1))
    b = after.select(*keys).distinct().withColumn("_b", F.lit(1))
    return a.join(b, list(keys), "full_outer").groupBy(*by).agg(F.count_if(F.col("_b").isNull()).alias("lost"), F.count_if(F.col("_a").isNull()).alias("gained"))
