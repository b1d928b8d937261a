"""The trading calendar as a table: (session_date, open_utc, close_utc), one row a session."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window, WindowSpec

from tidemark.operators.asof import asof_next

def _all() -> WindowSpec:
    """A calendar has some thousand rows, whatever the data's size."""
    return Window.orderBy("session_date")


def sessions_of(dates: DataFrame, date: str = "date", open_at: str = "9 hours", close_at: str = "15 hours 30 minutes") -> DataFrame:
    """A calendar from the distinct dates of a table."""
    day = dates.select(F.col(date).alias("session_date")).where(F.col(date).isNotNull()).distinct()
    at = F.col("session_date").cast("timestamp")
    return day.select("session_date", (at + F.expr(f"interval {open_at}")).alias("open_utc"), (at + F.expr(f"interval {close_at}")).alias("close_utc"))


def trading_days(calendar: DataFrame, start: dt.date | str, end: dt.date | str, closed: DataFrame | None = None) -> DataFrame:
    """Sessions of the range, both ends in it, without those that a correction list closes."""
    days = calendar.where(F.col("session_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return days if closed is None else days.join(closed, "session_date", "left_anti")


def with_neighbours(calendar: DataFrame) -> DataFrame:
    """Sessions with the one before and after."""
    return calendar.select("*", F.lag("session_date").over(_all()).alias("previous_date"), F.lead("session_date").over(_all()).alias("next_date"))


def is_trading_day(df: DataFrame, calendar: DataFrame, date: str = "date") -> DataFrame:
    return df.join(F.broadcast(calendar.select(F.col("session_date").alias(date), F.lit(True).alias("_open"))), date, "left").withColumn("is_session", F.col("_open").isNotNull()).drop("_open")


def session_stamp(df: DataFrame, calendar: DataFrame, date: str = "date", out: str = "known_at_utc", which: str = "close_utc") -> DataFrame:
    """The session's open or close instant; NULL off session."""
    return df.join(F.broadcast(calendar.select(F.col("session_date").alias(date), F.col(which).alias(out))), date, "left")


def last_closed_session(calendar: DataFrame, at: str) -> DataFrame:
    """(session_date) of the latest close at or before an instant; NULL if there is none."""
    return calendar.where(F.col("close_utc") <= F.lit(at).cast("timestamp")).agg(F.max("session_date").alias("session_date"))


def next_tradeable_open(df: DataFrame, calendar: DataFrame, at: str, within_days: int = 21) -> DataFrame:
    """df with the earliest open at or after the instant; NULL where that is further off than within_days."""
    one = F.lit(0).alias("_all")
    day = F.to_date(at)
    # Rows of one UTC day only ask for that day's open or the next session's, so the join is on the day.
    opens = calendar.select("session_date", F.col("open_utc"))
    days = df.select(day.alias("_day")).distinct()
    later = asof_next(days.select(one, F.date_add("_day", 1).alias("_after"), "_day"), opens.select(one, "session_date", F.col("open_utc").alias("_later")), ["_all"], "_after", "session_date", ["_later"])
    near = later.join(opens.select(F.col("session_date").alias("_day"), F.col("open_utc").alias("_own")), "_day", "left").select("_day", "_own", "_later")
    found = F.when(F.col("_own") >= F.col(at), F.col("_own")).otherwise(F.col("_later"))
    out = df.withColumn("_day", day).join(near, "_day", "left").withColumn("known_at_utc", found)
    return out.withColumn("known_at_utc", F.when(F.col("known_at_utc") <= F.col(at) + F.make_dt_interval(F.lit(within_days)), F.col("known_at_utc"))).drop("_day", "_own", "_later")


def visible_as_of(df: DataFrame, as_of: str | dt.datetime | None, known_at: str = "known_at_utc") -> DataFrame:
    """Rows known strictly before an instant; None sets no boundary, an instant without zone is refused."""
    if as_of is None:
        return df
    if isinstance(as_of, dt.datetime) and as_of.tzinfo is None:
        raise ValueError("as_of needs a time zone")
    return df.where(F.col(known_at) < F.lit(as_of).cast("timestamp"))


def date_chunks(spark, start: str, end: str, days: int) -> DataFrame:
    """(start, end) ranges of at most so many days that cover a range."""
    span = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.make_interval(days=F.lit(days)))).alias("start"))
    return span.select("start", F.least(F.date_add("start", days - 1), F.lit(end).cast("date")).alias("end"))


def options_expiration(calendar: DataFrame) -> DataFrame:
    """(month, expires): the third Friday of each month, or the session before it where that is none."""
    from tidemark.operators.asof import asof_prior

    months = calendar.select(F.trunc("session_date", "month").alias("month")).distinct()
    friday = months.select(F.lit(0).alias("_all"), "month", F.date_add(F.next_day(F.date_sub("month", 1), "FRI"), 14).alias("friday"))
    found = asof_prior(friday, calendar.select(F.lit(0).alias("_all"), "session_date", F.col("session_date").alias("expires")), ["_all"], "friday", "session_date", ["expires"])
    return found.select("month", "friday", "expires")
