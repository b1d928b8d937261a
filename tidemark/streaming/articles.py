"""The article feed as streams: deduplicated arrivals, feed progress, entity counts, quality counters."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemark.operators.entity import resolve_entities
from tidemark.operators.quality import structural
from tidemark.sources.articles import NEWS


def stream_articles(spark: SparkSession, path: str, files_per_trigger: int = 64) -> DataFrame:
    """JSON lines that polls drop into a folder."""
    return spark.readStream.schema(NEWS).option("maxFilesPerTrigger", files_per_trigger).option("recursiveFileLookup", "true").json(path)


def new_articles(articles: DataFrame, within: str = "2 days") -> DataFrame:
    """First arrival of each id; ids are forgotten once the watermark has passed them."""
    return articles.withWatermark("published_at", within).dropDuplicatesWithinWatermark(["article_id"])


def entity_counts(articles: DataFrame, entries: DataFrame, within: str = "2 days") -> DataFrame:
    """(day, ticker, n): articles of a day whose title or description names an entity of the dictionary.

    The dictionary is static and each article is resolved where it arrives. A polled-again article counts
    once; rows later than the watermark are dropped. Runs in update mode too: a group's last row counts.
    """
    keyed = articles.select(F.struct("article_id", "published_at").alias("article_id"), "title", "description")
    found = resolve_entities(keyed, entries).where("status = 'matched'").select("article_id.article_id", "article_id.published_at", "ticker")
    once = found.withWatermark("published_at", within).dropDuplicatesWithinWatermark(["article_id", "ticker"])
    counts = once.groupBy(F.window("published_at", "1 day"), "ticker").agg(F.count("*").alias("n"))
    return counts.select(F.to_date("window.start").alias("day"), "ticker", "n")


def quality_counters(articles: DataFrame, path: str, now: str):
    """A writer that keeps each micro-batch's structural counters under ``epoch=<number>``.

    A batch that is replayed overwrites its own epoch, so counters never double. One stream to a path:
    epochs are numbered by the checkpoint.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        structural(batch, now).write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return articles.writeStream.foreachBatch(write)


class FeedProgress(StatefulProcessor):
    """Per feed: the newest article so far, hours that a poll's buffer leaves uncovered, and silence.

    A timer stands at the moment when the feed will have been silent too long. The watermark lags behind the
    clock by ``late``, so the timer is set that much earlier.
    """

    def __init__(self, silence: pd.Timedelta, late: pd.Timedelta):
        self._wait = int((silence - late) / pd.Timedelta("1ms"))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._newest = handle.getValueState("newest", "at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts = [(int(part["at"].min()), int(part["at"].max())) for part in rows if len(part)]
        if not parts:
            return
        oldest, newest = min(low for low, _ in parts), max(high for _, high in parts)
        before = self._newest.get()[0] if self._newest.exists() else oldest
        self._newest.update((newest := max(newest, before),))
        for due in list(self._handle.listTimers()):
            self._handle.deleteTimer(due)
        self._handle.registerTimer(newest // 1000 + self._wait)
        yield self._said(key, newest, max(0, oldest - before) / 3.6e9, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self._said(key, self._newest.get()[0], 0.0, True)

    @staticmethod
    def _said(key, newest: int, lost_hours: float, silent: bool) -> pd.DataFrame:
        return pd.DataFrame({"feed": [key[0]], "at": [newest], "lost_hours": [lost_hours], "silent": [silent]})

    def close(self) -> None:
        pass


def feed_progress(articles: DataFrame, silence: str = "24 hours", late: str = "7 days") -> DataFrame:
    """(feed, newest, lost_hours, silent) after each micro-batch that has rows of a feed, and once when a feed falls silent.

    The clock is the newest article of any feed: a feed is silent when its own newest is older than that by
    ``silence``. Articles older than the clock by ``late`` are dropped. A feed that speaks again is watched
    again. Articles without a moment are left out. Needs the RocksDB state store.
    """
    wait, lag = pd.Timedelta(silence), pd.Timedelta(late)
    clocked = articles.where("published_at IS NOT NULL").withWatermark("published_at", f"{int(lag.total_seconds())} seconds")
    timed = clocked.select("feed", "published_at", F.unix_micros("published_at").alias("at")).groupBy("feed")
    got = timed.transformWithStateInPandas(FeedProgress(wait, lag), "feed string, at long, lost_hours double, silent boolean", "Update", "EventTime")
    return got.select("feed", F.timestamp_micros("at").alias("newest"), "lost_hours", "silent")
