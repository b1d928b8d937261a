"""A registry that query modules fill: a name, a function of (spark, sf_dir), and its SQL if SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def put(f: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: rounded(f(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return f

    return put


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six digits, so that the order of a sum doesn't show."""
    return df.select(*[(F.round(F.col(f"`{c}`"), 6) + F.lit(0.0)).alias(c) if k == "double" else F.col(f"`{c}`") for c, k in df.dtypes])


def r(expression: str, name: str | None = None) -> str:
    """SQL for the same."""
    return f"(round({expression}, 6) + 0.0) AS {name or expression}"
