"""As-of joins by union and carry: one sort per key, no range join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


def _stacked(left: DataFrame, right: DataFrame, keys: list[str], at: str, right_at: str, values: list[str], first: str) -> DataFrame:
    """Rows of both sides in one frame; _side orders equal instants, first naming the side that comes first."""
    mark = {"left": (0, 1), "right": (1, 0)}[first]
    own = [c for c in left.columns if c not in (*keys, at)]
    a = left.select(*keys, F.col(at).alias("_at"), F.lit(mark[0]).alias("_side"), F.struct(*own).alias("_own") if own else F.struct(F.lit(1).alias("_")).alias("_own"), F.lit(None).cast(right.select(F.struct(*[F.col(v) for v in values])).schema[0].dataType).alias("_value"))
    b = right.select(*keys, F.col(right_at).alias("_at"), F.lit(mark[1]).alias("_side"), F.lit(None).cast(a.schema["_own"].dataType).alias("_own"), F.struct(*[F.col(v) for v in values]).alias("_value"))
    return a.unionByName(b)


def _asof(left, right, keys, at, right_at, values, *, first, forward=False):
    rows = _stacked(left, right, keys, at, right_at, values, first)
    order = [F.desc("_at"), F.desc("_side")] if forward else [F.col("_at"), F.col("_side")]
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    found = rows.withColumn("_found", F.last("_value", ignorenulls=True).over(w)).where(F.col("_own").isNotNull())
    own = [F.col(f"_own.{c}").alias(c) for c in left.columns if c not in (*keys, at)]
    return found.select(*keys, F.col("_at").alias(at), *own, *[F.col(f"_found.{v}").alias(v) for v in values])


def asof_prior_strict(left: DataFrame, right: DataFrame, keys: list[str], at: str, right_at: str, values: list[str]) -> DataFrame:
    """left with the values of the latest right row strictly before it (NULL: none)."""
    return _asof(left, right, keys, at, right_at, values, first="left")


def asof_prior(left: DataFrame, right: DataFrame, keys: list[str], at: str, right_at: str, values: list[str]) -> DataFrame:
    """left with the values of the latest right row at or before it."""
    return _asof(left, right, keys, at, right_at, values, first="right")


def asof_next(left: DataFrame, right: DataFrame, keys: list[str], at: str, right_at: str, values: list[str]) -> DataFrame:
    """left with the values of the earliest right row at or after it."""
    return _asof(left, right, keys, at, right_at, values, first="left", forward=True)
