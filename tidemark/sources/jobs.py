"""Jobs over several sources, their status, logs of JSON lines, and dimension tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.storage import written
from tidemark.sources.versioned import backfill_write, pending_sessions, stored, write_versioned


def read_status(status: DataFrame, hours: float = 20) -> DataFrame:
    """(kind, n) of failures within so many hours of the newest outcome; name[x] counts under name."""
    newest = status.agg(F.max("at").alias("newest"))
    fresh = status.crossJoin(F.broadcast(newest)).where((F.unix_timestamp("newest") - F.unix_timestamp("at") < hours * 3600) & ~F.col("ok"))
    return fresh.groupBy(F.split_part("name", F.lit("["), F.lit(1)).alias("kind")).agg(F.count("*").alias("n"))


def append_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def dimension(rows: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """A row per key with its sorted distinct values."""
    return rows.groupBy(key).agg(F.array_sort(F.collect_set(value)).alias(out))


class Refused(Exception):
    """A source that won't answer; a backfill stops there and goes on when it is run again."""


def backfill_job(
    spark: SparkSession, path: str, calendar: DataFrame, fetch: Callable[[dt.date, dt.date], DataFrame], days: int = 90,
    normalise: Callable[[DataFrame], DataFrame] = lambda df: df, checks: Callable[[DataFrame], DataFrame] | None = None, session: str = "date", revise: bool = False,
) -> DataFrame:
    """(start, end, rows, written, failed, state) of each chunk: pending sessions are fetched, normalised, checked and written.

    Chunks of so many days run one after another from the first pending session to the last. Failed checks
    are counted and don't stop the job; a refused source does, and leaves its chunk and the later ones for
    the next run. With nothing pending there are no chunks.
    """
    held = stored(spark, path)
    todo = calendar.select("session_date") if held is None or revise else pending_sessions(calendar, held, session)
    first, last = todo.agg(F.min("session_date"), F.max("session_date")).first()
    out, at = [], first
    while at is not None and at <= last:
        end = min(last, at + dt.timedelta(days=days - 1))
        try:
            df = written(normalise(fetch(at, end)))
        except Refused as e:
            out.append((at, end, 0, 0, 0, f"stopped: {e}"))
            break
        failed = checks(df).where("NOT passed").count() if checks else 0
        out.append((at, end, df.count(), backfill_write(df, path, session, revise), failed, "done"))
        at = end + dt.timedelta(days=1)
    return spark.createDataFrame(out, "start date, end date, rows long, written long, failed long, state string")


def collect(spark: SparkSession, sources: Mapping[str, Callable[[], DataFrame]], root: str, keys: Sequence[str] = ("date", "ticker"), session: str = "date", checks: Mapping[str, Callable[[DataFrame], DataFrame]] | None = None) -> DataFrame:
    """(source, ok, rows, new, revised, failed, detail): each source's rows are written under root, or why not.

    new and revised count sessions. One source's failure doesn't stop the others; failed checks are counted
    and the rows still written.
    """
    out = []
    for name, load in sources.items():
        try:
            df = written(load())
            failed = checks[name](df).where("NOT passed").count() if checks and name in checks else 0
            counts = write_versioned(df, f"{root}/{name}", keys, session)
            out.append((name, True, df.count(), counts.get("new", 0), counts.get("revised", 0), failed, None))
        except Exception as e:  # the outcome is a row
            out.append((name, False, None, None, None, None, f"{type(e).__name__}: {e}"[:200]))
    return spark.createDataFrame(out, "source string, ok boolean, rows long, new long, revised long, failed long, detail string")


def candidates(pairs: DataFrame, articles: DataFrame, names: DataFrame) -> DataFrame:
    """pairs (article_id, ticker) with the article's fields and the entity's name; what is missing is empty."""
    fields = [c for c in articles.columns if c != "article_id"]
    got = pairs.select("article_id", "ticker").join(articles, "article_id").join(names.select("ticker", "name"), "ticker", "left")
    return got.select("article_id", "ticker", F.coalesce("name", F.lit("")).alias("name"), *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in fields])


def write_candidates(pairs: DataFrame, articles: DataFrame, names: DataFrame, path: str) -> int:
    """Write candidates as JSON lines; how many."""
    made = written(candidates(pairs, articles, names))
    made.write.mode("overwrite").json(path)
    return made.count()
