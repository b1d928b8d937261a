"""Vendor tables to the library's schemas. Types are declared, NaN becomes NULL, nothing is guessed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import clean
from tidemark.operators.asof import asof_next
from tidemark.operators.sessions import session_stamp

PRICE = {"open": "bigint", "high": "bigint", "low": "bigint", "close": "bigint", "volume": "bigint"}


def _missing(df: DataFrame, *names: str) -> None:
    if lost := [n for n in names if n not in df.columns]:
        raise KeyError(f"missing fields: {', '.join(lost)}")


def normalize_price(raw: DataFrame, names: dict[str, str], calendar: DataFrame, kinds: dict[str, str] = PRICE) -> DataFrame:
    """Vendor names to ours, typed, with the session's close as the instant it is known."""
    _missing(raw, *names)
    picked = raw.select(*[F.col(f"`{v}`").alias(n) for v, n in names.items()])
    typed = picked.withColumns({c: F.col(c).cast(k) for c, k in kinds.items() if c in picked.columns}).withColumn("date", F.col("date").cast("date"))
    if "change_pct" in typed.columns:
        typed = typed.withColumn("change_pct", clean(F.col("change_pct").cast("double")))
    return session_stamp(typed, calendar)


def normalize_flow(flow: DataFrame, cap: DataFrame, short: DataFrame, fundamental: DataFrame, calendar: DataFrame) -> DataFrame:
    """One row per (ticker, date) of the market-value table, the others joined to it.

    A halted session (no flow row and no volume) has flows of 0; a flow that is missing though there was
    volume stays NULL.
    """
    keys = ["ticker", "date"]
    nets = [c for c in flow.columns if c not in keys]
    joined = cap.join(flow.withColumn("_flow", F.lit(True)), keys, "left").join(short, keys, "left").join(fundamental, keys, "left")
    halted = F.col("_flow").isNull() & (F.col("volume") == 0)
    return session_stamp(joined.withColumns({c: F.when(halted, F.lit(0)).otherwise(F.col(c)).cast("bigint") for c in nets}).drop("_flow"), calendar)


def normalize_two_pass(raw: DataFrame, adjusted: DataFrame, zone: str = "America/New_York") -> tuple[DataFrame, DataFrame]:
    """(bars, unmatched): raw bars with their adjusted close; an adjusted bar without a raw one is in error."""
    keys = ["symbol", "t"]
    both = raw.join(adjusted.select(*keys, F.col("c").alias("adj_close")), keys, "left")
    bars = both.select(F.to_date(F.from_utc_timestamp("t", zone)).alias("date"), F.col("symbol").alias("ticker"), F.col("o").alias("open"), F.col("h").alias("high"), F.col("l").alias("low"), F.col("c").alias("close"), F.col("v").cast("bigint").alias("volume"), "adj_close")
    return bars, adjusted.join(raw.select(*keys), keys, "left_anti").select(*keys)


def normalize_macro(observations: DataFrame, calendar: DataFrame) -> DataFrame:
    """(date, series, value, known_at_utc): a dot, an empty or a null value is no observation; known at the next open after the day."""
    good = observations.where(~F.coalesce(F.trim("value"), F.lit("")).isin("", ".")).select(F.col("date").cast("date").alias("date"), "series", F.col("value").cast("double").alias("value"), F.date_add(F.col("date").cast("date"), 1).alias("_after"), F.lit(0).alias("_all"))
    days = good.select("_all", "_after").distinct()
    opens = asof_next(days, calendar.select(F.lit(0).alias("_all"), "session_date", F.col("open_utc").alias("known_at_utc")), ["_all"], "_after", "session_date", ["known_at_utc"])
    return good.join(opens.select("_after", "known_at_utc"), "_after", "left").select("date", "series", "value", "known_at_utc")


# How calendar rows are labelled.
RELEASE_LABELS = {"cpi": "CPI 발표"}
OTHER_RELEASE, MEETING, PROJECTIONS = "고용지표 발표", "FOMC 회의", " (경제전망요약)"


def normalize_meetings(cells: DataFrame) -> DataFrame:
    """(event, date, date_start, has_sep, label) from (year, month_text, date_text) such as Apr/May and 30-1*.

    A star marks projections; a note in parentheses, such as a vote's, makes a day of its own. Cells
    without a day or a month are left out.
    """
    first, last = F.regexp_extract("month_text", "^([A-Za-z]{3})", 1), F.regexp_extract("month_text", "([A-Za-z]{3})[a-z]*$", 1)
    last = F.when(F.contains("month_text", F.lit("/")), F.regexp_extract("month_text", "/([A-Za-z]{3})", 1)).otherwise(first)
    number = lambda m: F.month(F.try_to_timestamp(F.concat(m, F.lit(" 2000 01")), F.lit("MMM yyyy dd")))
    note = F.regexp_extract("date_text", "\\(([^)]*)\\)", 1)
    a, b = F.regexp_extract("date_text", "^(\\d+)", 1).try_cast("int"), F.regexp_extract("date_text", "-(\\d+)", 1).try_cast("int")
    got = cells.withColumns({"_a": a, "_b": F.coalesce(b, a), "_m": number(first), "_n": F.when(b.isNull(), number(first)).otherwise(number(last)), "_note": note})
    year = F.col("year") + F.when(F.col("_n") < F.col("_m"), 1).otherwise(0)
    dated = got.where("_a IS NOT NULL AND _m IS NOT NULL").select(
        F.make_date(year, "_n", "_b").alias("date"), F.make_date("year", "_m", "_a").alias("date_start"), F.contains("date_text", F.lit("*")).alias("has_sep"), "_note"
    )
    day = lambda c: F.date_format(c, "MM/dd")
    met = F.concat(F.lit(f"{MEETING} ("), day("date_start"), F.lit("~"), day("date"), F.lit(")"), F.when(F.col("has_sep"), PROJECTIONS).otherwise(""))
    noted = F.concat(F.lit("FOMC "), "_note", F.lit(" ("), day("date"), F.lit(")"))
    return dated.select(F.lit("fomc").alias("event"), "date", "date_start", "has_sep", F.when(F.col("_note") != "", noted).otherwise(met).alias("label"))


def normalize_releases(dates: DataFrame) -> DataFrame:
    """(event, date, date_start, has_sep, label) from release dates (event, date string); unreadable dates are left out."""
    day = F.try_to_timestamp("date", F.lit("yyyy-MM-dd")).cast("date")
    label = F.lit(OTHER_RELEASE)
    for event, said in RELEASE_LABELS.items():
        label = F.when(F.col("event") == event, said).otherwise(label)
    return dates.select("event", day.alias("date"), day.alias("date_start"), F.lit(False).alias("has_sep"), label.alias("label")).where("date IS NOT NULL")


def normalize_calendar(releases: DataFrame, meetings: DataFrame) -> DataFrame:
    """Release dates and meeting cells as one table of events."""
    return normalize_releases(releases).unionByName(normalize_meetings(meetings))
