"""Tables of the daily report, as DataFrames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemark.functions.columns import flags, safe_ratio, shown, signed, signed_percent
from tidemark.operators.asof import asof_prior_strict
from tidemark.operators.rolling import by, change_over, correlation, pct_change, placed


def transmission(kr: DataFrame, us: DataFrame, mapping: DataFrame, tail: int = 60, least: int = 30) -> DataFrame:
    """(us, sector, n, corr, reading) of each mapped pair.

    kr (sector, date, ret), us (us, date, ret), mapping (us, sector). A session pairs with the other
    market's last session strictly before it that has a return; the last ``tail`` pairs count.
    """
    left = kr.where("ret IS NOT NULL").join(F.broadcast(mapping), "sector").select("us", "sector", "date", F.col("ret").alias("y"))
    right = us.where("ret IS NOT NULL").select("us", F.col("date").alias("d"), F.col("ret").alias("x")).join(F.broadcast(mapping), "us")
    pairs = asof_prior_strict(left, right, ["us", "sector"], "date", "d", ["x"]).where("x IS NOT NULL")
    last = pairs.withColumn("_r", F.row_number().over(Window.partitionBy("us", "sector").orderBy(F.desc("date")))).where(F.col("_r") <= tail)
    got = correlation(last, "x", "y", "us", "sector").withColumn("corr", F.when(F.col("n") >= least, F.col("corr")))
    reading = F.when(F.col("corr").isNull(), "insufficient").when(F.col("corr") >= 0.3, "valid").when(F.col("corr") >= 0.1, "weak").otherwise("broken")
    return mapping.join(got, ["us", "sector"], "left").select("us", "sector", F.coalesce("n", F.lit(0)).alias("n"), "corr", reading.alias("reading"))


def regime(series: DataFrame, back: int = 120) -> DataFrame:
    """(series, last, change) over so many non-null observations."""
    return change_over(series, "series", "date", "value", back)


#: From where on a value is flagged.
HOT, REVISED, BAND_EDGE, SPIKE = 1.5, 0.03, 0.8, 2.0


def scan_flags(z, vol, hot: float = HOT):
    return flags([("inflow", z > hot), ("outflow", z < -hot), ("volatility", vol > hot)])


def more_flags(filed, revision, band, news_z):
    """Flags of a filing the day before, a moved estimate, a valuation in the lowest or highest tenth of its band, and a news spike.

    band runs from -1 to 1 over the percentiles, so that its tenths begin at 0.8 to either side.
    """
    return flags([("filing", filed), ("earnings_revision", F.abs(revision) > REVISED), ("valuation_band", F.abs(band) >= BAND_EDGE), ("news_spike", news_z > SPIKE)])


def scan(scores: DataFrame, news: DataFrame) -> DataFrame:
    """(date, ticker, flow_z, vol_z, articles, flags) from scores of ``features.scan_scores``; rows without any value are dropped."""
    got = scores.select("date", "ticker", F.col("foreign_flow_5d_z").alias("flow_z"), F.col("volatility_z").alias("vol_z")).join(news.select("date", "ticker", F.col("n").alias("articles")), ["date", "ticker"], "left")
    return got.where("flow_z IS NOT NULL OR vol_z IS NOT NULL OR articles IS NOT NULL").withColumn("flags", F.array_join(scan_flags(F.col("flow_z"), F.col("vol_z")), ","))


def calendar_table(events: DataFrame, day: str) -> DataFrame:
    """(when, event, date) of the day and the next."""
    d = F.lit(day).cast("date")
    return events.where((F.col("date") == d) | (F.col("date") == F.date_add(d, 1))).select(F.when(F.col("date") == d, "today").otherwise("tomorrow").alias("when"), "event", "date")


def index_returns(prices: DataFrame, key: str = "ticker") -> DataFrame:
    """(key, date, ret_1, ret_20)."""
    one = pct_change(prices, "close", 1, by(key), "ret_1")
    return pct_change(one, "close", 20, by(key), "ret_20").select(key, "date", "ret_1", "ret_20")


def newest_dates(*tables: tuple[str, DataFrame, str]) -> DataFrame:
    """(source, newest, rows) of each named table; its date column is given."""
    rows = [df.agg(F.max(F.col(date).cast("date")).alias("newest"), F.count("*").alias("rows")).select(F.lit(name).alias("source"), "newest", "rows") for name, df, date in tables]
    return reduce(DataFrame.unionByName, rows)


def market_line(series: DataFrame) -> DataFrame:
    """(series, last, change) of each series' last value, and its change against the one before."""
    place = F.row_number().over(Window.partitionBy("series").orderBy(F.desc("date")))
    last = series.where("value IS NOT NULL").withColumn("_r", place).where("_r <= 2").groupBy("series").agg(F.max(F.when(F.col("_r") == 1, F.col("value"))).alias("last"), F.max(F.when(F.col("_r") == 2, F.col("value"))).alias("_before"))
    return last.select("series", "last", (safe_ratio("last", "_before") - 1).alias("change"))


def header_facts(
    dates: DataFrame, market: DataFrame, failures: DataFrame, gaps: DataFrame, disagreements: DataFrame, coverage: DataFrame, status: DataFrame, limit: float = 0.3
) -> DataFrame:
    """(severity, key, text) rows of what a report's header states; what has nothing to say has no row.

    dates (source, newest, rows), market (series, last, change), failures (kind, n), gaps (feed, lost_hours),
    disagreements (ticker, n), coverage (kind, weight, present, missing), status (articles, ambiguous).
    """
    joined = lambda df, part, order, sep=", ": df.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), part.alias("p")))), lambda x: x["p"]), sep).alias("text"))
    fact = lambda df, severity, key: df.where("text <> ''").select(severity.alias("severity"), F.lit(key).alias("key"), "text")
    info, warn = F.lit("info"), F.lit("warning")
    times = F.when(F.col("n") > 1, F.concat("kind", F.lit("×"), "n")).otherwise(F.col("kind"))
    active = coverage.where("kind = 'active'")
    supported = F.concat(F.format_string("%.2f/%.2f (%.0f%%)", "present", "weight", 100 * safe_ratio("present", "weight")), F.when(F.col("missing") != "", F.concat(F.lit(" without "), "missing")).otherwise(""))
    share = safe_ratio("ambiguous", "articles")
    return reduce(DataFrame.unionByName, [
        fact(joined(market, F.concat("series", F.lit(" "), shown("last"), F.lit(" ("), signed_percent("change"), F.lit(")")), "series", " | "), info, "market"),
        fact(joined(dates.where("newest IS NOT NULL"), F.concat("source", F.lit(" "), F.col("newest").cast("string")), "source"), info, "data"),
        fact(joined(failures, times, "kind"), warn, "failures"),
        fact(joined(gaps.where("lost_hours > 0"), F.concat("feed", F.lit(" "), F.format_string("%.1f", "lost_hours"), F.lit(" h")), "feed"), warn, "lost news"),
        fact(joined(disagreements, F.concat(F.col("ticker").cast("string"), F.lit(" on "), "n", F.lit(" days")), "ticker"), warn, "vendors disagree"),
        fact(active.select(supported.alias("text"), "missing"), F.when(F.col("missing") != "", "warning").otherwise("info"), "coverage"),
        fact(status.select(F.concat(F.format_string("%.1f%% of ", 100 * share), "articles", F.lit(" articles")).alias("text"), (share > limit).alias("over")), F.when(F.col("over"), "warning").otherwise("info"), "ambiguous"),
    ])


def gate_report_coverage(calendar: DataFrame, reports: DataFrame, date: str = "date") -> DataFrame:
    """(session_date, has_report) of each session."""
    days = reports.select(F.col(date).cast("date").alias("session_date")).distinct().withColumn("_has", F.lit(True))
    return calendar.select("session_date").join(days, "session_date", "left").select("session_date", F.coalesce("_has", F.lit(False)).alias("has_report"))


def markdown(table: DataFrame, order: list[str]) -> DataFrame:
    """(line) of a markdown table, header first; NULL is an em dash. For tables that a page can hold."""
    bar = lambda parts: F.concat(F.lit("| "), F.concat_ws(" | ", *parts), F.lit(" |"))
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("—")) for c in table.columns]
    lines = table.orderBy(*order).select(bar(cells).alias("line"), F.row_number().over(Window.orderBy(*order)).alias("i"))
    body = lines.agg(F.array_sort(F.collect_list(F.struct("i", "line"))).alias("b"))
    head = [F.lit("| " + " | ".join(table.columns) + " |"), F.lit("|" + "---|" * len(table.columns))]
    return body.select(F.explode(F.concat(F.array(*head), F.transform("b", lambda r: r["line"]))).alias("line"))


def ratings_table(rated: DataFrame) -> DataFrame:
    """Printed ratings: largest absolute score first, then ticker."""
    place = F.row_number().over(Window.partitionBy("date").orderBy(F.desc(F.abs("score")), "ticker"))
    return rated.select("date", place.alias("place"), "ticker", "rating", signed("score").alias("score"), signed_percent("weight_coverage", 0).alias("coverage"), F.coalesce(F.nullif("missing", F.lit("")), F.lit("—")).alias("missing"))



def capped_messages(rows: DataFrame, key: str, message: str, order: str, most: int = 3) -> DataFrame:
    """(key, message): the first few messages in order, and how many more there are."""
    ranked = rows.select(key, message, F.row_number().over(Window.partitionBy(key).orderBy(order)).alias("r"))
    got = ranked.groupBy(key).agg(F.array_sort(F.collect_list(F.when(F.col("r") <= most, F.struct("r", message)))).alias("m"), F.count("*").alias("n"))
    more = F.when(F.col("n") > most, F.concat(F.lit(", "), F.col("n") - most, F.lit(" more"))).otherwise("")
    return got.select(key, F.concat(F.array_join(F.transform("m", lambda x: x[message]), ", "), more).alias("message"))


def shadow_table(track: DataFrame) -> DataFrame:
    """(date, portfolio, benchmark, excess)."""
    return track.withColumn("excess", F.col("portfolio") - F.col("benchmark"))


def ic_table(ic: DataFrame, period: str = "yyyy") -> DataFrame:
    """(year, n, mean_ic, sd_ic) of daily coefficients."""
    return ic.groupBy(F.date_format("date", period).alias("year")).agg(F.count("*").alias("n"), F.avg("ic").alias("mean_ic"), F.stddev_samp("ic").alias("sd_ic"))


def calibration_table(rated: DataFrame) -> DataFrame:
    """(rating, n, mean_abs, coverage)."""
    return rated.groupBy("rating").agg(F.count("*").alias("n"), F.avg(F.abs("score")).alias("mean_abs"), F.avg("weight_coverage").alias("coverage"))


def bakeoff_table(compliance: DataFrame, latency: DataFrame) -> DataFrame:
    """(model, calls, ratio, latency_s)."""
    return compliance.select("model", "calls", "ratio").join(latency.select("model", "latency_s"), "model")


def news_table(rollup: DataFrame) -> DataFrame:
    """rollup (ticker, n, headline) with its place: most articles first, then ticker."""
    return placed(rollup, "place", F.desc("n"), "ticker")
