"""Checks of tables as rows (name, passed, detail). A failed check is a row, never an exception."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from tidemark.functions.columns import safe_ratio

CHECK = "name string, passed boolean, detail string"


def row(df: DataFrame, name: str, passed: Column, detail: Column) -> DataFrame:
    """One check from an aggregate of one row; a condition that is unknown hasn't passed."""
    return df.select(F.lit(name).alias("name"), F.coalesce(passed, F.lit(False)).alias("passed"), detail.cast("string").alias("detail"))


def report(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def summary(checks: DataFrame) -> DataFrame:
    """(ok, n, failures, summary); no check at all isn't ok."""
    bad = F.array_sort(F.collect_list(F.when(~F.col("passed"), F.concat_ws(": ", "name", "detail"))))
    got = checks.agg(F.count("*").alias("n"), bad.alias("failures"))
    text = F.when(F.col("n") == 0, "no checks ran").when(F.size("failures") == 0, F.concat(F.col("n"), F.lit(" checks passed")))
    return got.select(((F.col("n") > 0) & (F.size("failures") == 0)).alias("ok"), "n", F.array_join("failures", "; ").alias("failures"), F.coalesce(text, F.concat(F.size("failures"), F.lit(" of "), "n", F.lit(" checks failed"))).alias("summary"))


def schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Missing, additional and differently typed columns; nullability is not compared."""
    have, want = dict(df.dtypes), {f.name: f.dataType.simpleString() for f in expected}
    wrong = [f"missing {c}" for c in sorted(want.keys() - have.keys())] + [f"extra {c}" for c in sorted(have.keys() - want.keys())]
    wrong += [f"{c} is {have[c]}, not {want[c]}" for c in want if c in have and have[c] != want[c]]
    return df.sparkSession.createDataFrame([("schema", not wrong, "; ".join(wrong))], CHECK)


def missing_ratio(df: DataFrame, limits: dict[str, float]) -> DataFrame:
    """A check per column: its share of nulls is within the limit. A table without rows fails."""
    got = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in limits])
    one = lambda c, m: F.struct(F.lit(f"missing_ratio.{c}").alias("name"), F.coalesce(F.col(c) <= m, F.lit(False)).alias("passed"), F.coalesce(F.round(c, 6).cast("string"), F.lit("no rows")).alias("detail"))
    return got.select(F.explode(F.array(*[one(c, m) for c, m in limits.items()])).alias("r")).select("r.*")


def settled_rows(df: DataFrame, sessions: int, date: str = "date") -> DataFrame:
    """df without its last distinct dates, whose data may still come."""
    late = df.select(date).distinct().orderBy(F.desc(date)).limit(sessions)
    return df.join(F.broadcast(late), date, "left_anti")


def continuity(df: DataFrame, calendar: DataFrame, key: str = "ticker", date: str = "date") -> DataFrame:
    """(key, missing, off_session, duplicates, passed) per key, between its own first and last date."""
    held = df.groupBy(key, date).agg(F.count("*").alias("n"))
    days = F.broadcast(calendar.select(F.col("session_date").alias(date), F.lit(1).alias("_open")))
    got = held.join(days, date, "left").groupBy(key).agg(
        F.min(date).alias("a"), F.max(date).alias("b"), F.count("_open").alias("on"), F.count_if(F.col("_open").isNull()).alias("off_session"), F.count_if(F.col("n") > 1).alias("duplicates")
    )
    numbered = calendar.select("session_date", F.row_number().over(Window.orderBy("session_date")).alias("i"))
    # Expected sessions between two dates are the difference of their places, so keys are never crossed with days.
    first = numbered.select(F.col("session_date").alias("a"), F.col("i").alias("ia"))
    last = numbered.select(F.col("session_date").alias("b"), F.col("i").alias("ib"))
    counted = got.join(F.broadcast(first), "a", "left").join(F.broadcast(last), "b", "left")
    lost = F.col("ib") - F.col("ia") + 1 - F.col("on")
    return counted.select(key, lost.alias("missing"), "off_session", "duplicates", F.coalesce((lost == 0) & (F.col("off_session") == 0) & (F.col("duplicates") == 0), F.lit(False)).alias("passed"))


def known_value(df: DataFrame, name: str, where: Column, value: str, expected: float, tolerance: float = 0.0) -> DataFrame:
    """Exactly one row is selected and its value is within the tolerance; null fails."""
    got = df.where(where).agg(F.count("*").alias("n"), F.max(F.col(value)).alias("v"))
    return row(got, name, (F.col("n") == 1) & (F.abs(F.col("v") - expected) <= tolerance), F.concat_ws(" ", F.concat(F.lit("rows="), "n"), F.concat(F.lit("value="), F.round("v", 6))))


def identity(df: DataFrame, parts: Sequence[str], name: str = "flow_identity") -> DataFrame:
    """The columns sum to 0 on every row, nulls counting as 0; how many don't and the worst."""
    off = reduce(Column.__add__, [F.coalesce(F.col(c), F.lit(0)) for c in parts])
    got = df.agg(F.count_if(F.abs(off) > 1e-6).alias("n"), F.max(F.abs(off)).alias("worst"))
    return row(got, name, F.col("n") == 0, F.concat(F.lit("rows="), "n", F.lit(" worst="), F.round(F.coalesce("worst", F.lit(0.0)).cast("double"), 4)))


def implied_close(df: DataFrame, where: Column, expected: float, tolerance: float = 1.0) -> DataFrame:
    """Market value over shares is near a pinned close; no such row passes."""
    got = df.where(where).agg(F.max(safe_ratio("market_cap", "shares_outstanding")).alias("v"), F.count("*").alias("n"))
    return row(got, "implied_close", (F.col("n") == 0) | (F.abs(F.col("v") - expected) <= tolerance), F.coalesce(F.round("v", 4).cast("string"), F.lit("no row")))


def not_empty(df: DataFrame, expected: int) -> DataFrame:
    got = df.agg(F.count("*").alias("n"))
    return row(got, "not_empty", (F.col("n") > 0) | F.lit(expected == 0), F.concat(F.lit("rows="), "n"))


def coverage(df: DataFrame, calendar: DataFrame, key: str = "series", date: str = "date", least: float = 0.95, stale: int = 10) -> DataFrame:
    """(key, ratio, stale_sessions, weekend_rows, duplicates, passed): how fully a series covers the sessions up to its last value."""
    numbered = calendar.select(F.col("session_date").alias(date), F.row_number().over(Window.orderBy("session_date")).alias("i"))
    last = calendar.count()
    got = df.groupBy(key, date).agg(F.count("*").alias("n")).join(F.broadcast(numbered), date, "left").groupBy(key).agg(
        F.count("i").alias("held"), F.min("i").alias("a"), F.max("i").alias("b"), F.count_if(F.dayofweek(date).isin(1, 7)).alias("weekend_rows"), F.count_if(F.col("n") > 1).alias("duplicates")
    )
    ratio, behind = safe_ratio("held", F.col("b") - F.col("a") + 1), F.lit(last) - F.col("b")
    ok = (ratio >= least) & (behind <= stale) & (F.col("weekend_rows") == 0) & (F.col("duplicates") == 0)
    return got.select(key, ratio.alias("ratio"), behind.alias("stale_sessions"), "weekend_rows", "duplicates", F.coalesce(ok, F.lit(False)).alias("passed"))


def event_gaps(events: DataFrame, key: str = "event", date: str = "date", most: int = 45) -> DataFrame:
    """(key, n, max_gap, duplicates, weekend, passed): consecutive dates of an event lie no further apart."""
    gap = F.datediff(date, F.lag(date).over(Window.partitionBy(key).orderBy(date)))
    got = events.select(key, date, gap.alias("gap")).groupBy(key).agg(F.count("*").alias("n"), F.max("gap").alias("max_gap"), F.count_if(F.col("gap") == 0).alias("duplicates"), F.count_if(F.dayofweek(date).isin(1, 7)).alias("weekend"))
    return got.withColumn("passed", (F.coalesce("max_gap", F.lit(0)) <= most) & (F.col("duplicates") == 0) & (F.col("weekend") == 0))


def structural(articles: DataFrame, now: str, old_days: int = 30, ahead_hours: int = 6) -> DataFrame:
    """(feed, n, too_old, in_future, foreign_host, duplicates): counts of articles that can't be right."""
    at = F.lit(now).cast("timestamp")
    same = F.count("*").over(Window.partitionBy("article_id")) if "article_id" in articles.columns else F.lit(1)
    marked = articles.select(
        "feed", (F.col("published_at") < at - F.expr(f"interval {old_days} days")).alias("old"), (F.col("published_at") > at + F.expr(f"interval {ahead_hours} hours")).alias("ahead"),
        (~F.coalesce(F.contains(F.parse_url("link", F.lit("HOST")), "domain"), F.lit(False))).alias("foreign"), (same > 1).alias("twice"),
    )
    return marked.groupBy("feed").agg(F.count("*").alias("n"), F.count_if("old").alias("too_old"), F.count_if("ahead").alias("in_future"), F.count_if("foreign").alias("foreign_host"), F.count_if("twice").alias("duplicates"))


def collection_gap(ledger: DataFrame, now: str, most_hours: float = 2.0) -> DataFrame:
    """The last run is no longer ago than so many hours; no run yet passes."""
    hours = (F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp(F.max("run_at"))) / 3600.0
    got = ledger.agg(hours.alias("h"))
    return row(got, "collection_gap", F.col("h").isNull() | (F.col("h") <= most_hours), F.coalesce(F.round("h", 3).cast("string"), F.lit("no run")))


def feed_continuity(buffer: DataFrame, stored: DataFrame, feeds: DataFrame, now: str, silent_hours: float = 24.0) -> DataFrame:
    """(feed, lost_hours, silent_hours, state) for each feed.

    lost: what the feed still offers begins after the newest article stored; silent: it gave nothing and
    its newest article is older than the limit; unanswered: it gave nothing so far; new: nothing stored.
    """
    oldest = buffer.groupBy("feed").agg(F.min("published_at").alias("oldest"))
    newest = stored.groupBy("feed").agg(F.max("published_at").alias("newest"))
    hours = lambda a, b: (F.unix_timestamp(a) - F.unix_timestamp(b)) / 3600.0
    got = feeds.select("feed").distinct().join(oldest, "feed", "left").join(newest, "feed", "left")
    got = got.select("feed", "oldest", "newest", F.greatest(hours(F.col("oldest"), F.col("newest")), F.lit(0.0)).alias("lost_hours"), hours(F.lit(now).cast("timestamp"), F.col("newest")).alias("silent_hours"))
    state = (
        F.when(F.col("newest").isNull(), "new").when(F.col("oldest").isNull() & (F.col("silent_hours") > silent_hours), "silent")
        .when(F.col("oldest").isNull(), "unanswered").when(F.col("lost_hours") > 0, "lost").otherwise("ok")
    )
    return got.select("feed", "lost_hours", "silent_hours", state.alias("state"))


def completeness(asked: DataFrame, got: DataFrame, key: str) -> DataFrame:
    """Keys that were asked for and aren't in the result."""
    return asked.select(key).distinct().join(got.select(key), key, "left_anti")


def duplicate_claims(df: DataFrame, value: str, owner: str) -> DataFrame:
    """(value, owners) for values that more than one owner claims."""
    return df.groupBy(value).agg(F.array_join(F.array_sort(F.collect_set(F.col(owner).cast("string"))), ",").alias("owners"), F.countDistinct(owner).alias("_n")).where("_n > 1").drop("_n")


def watchlist(entries: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """(market, ticker, fault) of entries (market, ticker, name): missing fields, markets and tickers of another form, repeats within a market."""
    form = F.lit(False)
    for market, pattern in patterns.items():
        form = form | ((F.col("market") == market) & F.rlike("ticker", F.lit(pattern)))
    bare = lambda c: F.coalesce(F.trim(F.col(c).cast("string")) == "", F.lit(True))
    marked = entries.select("market", "ticker", F.array_compact(F.array(
        F.when(bare("ticker"), "no ticker"), F.when(bare("name"), "no name"), F.when(~bare("ticker") & ~F.coalesce(form, F.lit(False)), "ticker's form"),
    )).alias("faults"))
    twice = entries.groupBy("market", "ticker").agg(F.count("*").alias("n")).where("n > 1 AND ticker IS NOT NULL").select("market", "ticker", F.lit("listed twice").alias("fault"))
    return marked.select("market", "ticker", F.explode("faults").alias("fault")).distinct().unionByName(twice)


def feeds(entries: DataFrame) -> DataFrame:
    """(name, fault) of feeds (name, outlet, section, url, domain, enabled): missing fields, repeated names, shared URLs, other schemes, none enabled."""
    need = ("name", "outlet", "section", "url", "domain")
    lost = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in need]))
    own = entries.select("name", F.array_compact(F.array(
        F.when(F.size(lost) > 0, F.concat(F.lit("missing "), F.array_join(lost, ","))), F.when(~F.rlike("url", F.lit("^https?://")), "not http(s)"),
    )).alias("f")).select("name", F.explode("f").alias("fault"))
    twice = entries.where("name IS NOT NULL").groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select("name", F.lit("repeated name").alias("fault"))
    shared = entries.where("url IS NOT NULL").groupBy("url").agg(F.count("*").alias("n"), F.min("name").alias("name")).where("n > 1").select("name", F.lit("shared url").alias("fault"))
    off = entries.agg(F.count_if(F.coalesce("enabled", F.lit(True))).alias("n")).where("n = 0").select(F.lit(None).cast("string").alias("name"), F.lit("none enabled").alias("fault"))
    return own.unionByName(twice).unionByName(shared).unionByName(off)


def rating_config(weights: DataFrame, cuts: DataFrame, floor: float) -> DataFrame:
    """Checks of a rating's parameters: weights (feature, weight string, active boolean), cuts (cut, threshold) of strong, moderate and weak."""
    number = F.try_cast("weight", "double") if hasattr(F, "try_cast") else F.expr("try_cast(weight AS double)")
    bad = weights.agg(F.array_join(F.array_sort(F.collect_set(F.when(number.isNull() | F.isnan(number), F.col("feature")))), ",").alias("v"))
    both = weights.groupBy("feature").agg(F.countDistinct("active").alias("n")).agg(F.array_join(F.array_sort(F.collect_set(F.when(F.col("n") > 1, F.col("feature")))), ",").alias("v"))
    of = lambda name: F.max(F.when(F.col("cut") == name, F.col("threshold")))
    laid = cuts.agg(of("strong").alias("s"), of("moderate").alias("m"), of("weak").alias("w"))
    order = (F.col("s") > F.col("m")) & (F.col("m") > F.col("w")) & (F.col("w") > 0)
    limit = cuts.agg(F.lit(float(floor)).alias("v"))
    return report(
        row(bad, "numeric_weights", F.col("v") == "", F.col("v")), row(both, "active_or_deferred", F.col("v") == "", F.col("v")),
        row(laid, "ordered_cuts", order, F.concat_ws(" > ", "s", "m", "w")), row(limit, "floor", F.col("v").between(0, 1), F.col("v")),
    )


def known_date(df: DataFrame, name: str, where: Column, date: str, expected: str) -> DataFrame:
    """Exactly one row is selected and its date is the expected one."""
    got = df.where(where).agg(F.count("*").alias("n"), F.max(F.col(date).cast("date")).alias("v"))
    return row(got, name, (F.col("n") == 1) & (F.col("v") == F.lit(expected).cast("date")), F.concat_ws(" ", F.concat(F.lit("rows="), "n"), F.concat(F.lit("value="), F.col("v").cast("string"))))


def unmapped(entries: DataFrame, mapping: DataFrame, key: str) -> DataFrame:
    """Rows of entries whose key the mapping doesn't have."""
    return entries.join(mapping.select(key).distinct(), key, "left_anti")


def _per_key(verdicts: DataFrame, name: str, key: str, detail: Column) -> DataFrame:
    return verdicts.select(F.concat(F.lit(f"{name}["), F.col(key).cast("string"), F.lit("]")).alias("name"), "passed", detail.alias("detail"))


def price_suite(df: DataFrame, expected: T.StructType, calendar: DataFrame, limits: dict[str, float], known: DataFrame | None = None) -> DataFrame:
    """Prices of stocks or indices: schema, missing values, rows, each ticker's sessions, and a known value's check if one is handed in."""
    gaps = _per_key(continuity(df, calendar), "continuity", "ticker", F.format_string("missing=%d off=%d twice=%d", "missing", "off_session", "duplicates"))
    checks = [schema(df, expected), missing_ratio(df, limits), not_empty(df, calendar.count()), gaps]
    return report(*checks, *([known] if known is not None else []))


def flow_suite(df: DataFrame, expected: T.StructType, calendar: DataFrame, limits: dict[str, float], late: dict[str, float], parts: Sequence[str], lag: int, known: DataFrame | None = None) -> DataFrame:
    """Investor flows: as prices, and the flows' identity; columns in ``late`` are judged without the last ``lag`` sessions."""
    settled = settled_rows(df, lag)
    short = missing_ratio(settled, late).withColumn("name", F.concat(F.lit("settled."), "name"))
    none = settled.agg(F.count("*").alias("_n"))
    short = short.join(F.broadcast(none), F.lit(True)).select("name", (F.col("passed") | (F.col("_n") == 0)).alias("passed"), "detail")
    return report(price_suite(df, expected, calendar, limits, known), short, identity(df, parts))


def macro_suite(df: DataFrame, expected: T.StructType, calendar: DataFrame, limits: dict[str, float], known: DataFrame | None = None) -> DataFrame:
    """Series: schema, missing values, coverage of each series, a known value."""
    covered = _per_key(coverage(df, calendar), "coverage", "series", F.format_string("ratio=%.4f stale=%d", "ratio", F.col("stale_sessions").cast("long")))
    return report(schema(df, expected), missing_ratio(df, limits), covered, *([known] if known is not None else []))


def calendar_suite(df: DataFrame, expected: T.StructType, limits: dict[str, float], *known: DataFrame) -> DataFrame:
    """Events: schema, missing values, gaps of each event, known dates."""
    gaps = _per_key(event_gaps(df), "event_continuity", "event", F.format_string("gap=%d", F.col("max_gap").cast("long")))
    return report(schema(df, expected), missing_ratio(df, limits), gaps, *known)


def news_suite(df: DataFrame, expected: T.StructType, limits: dict[str, float], ledger: DataFrame, buffer: DataFrame, stored: DataFrame, feeds: DataFrame, now: str) -> DataFrame:
    """Articles: schema, missing values (none without rows), the last run, lost hours of each feed, and what can't be right."""
    n = df.agg(F.count("*").alias("_n"))
    full = missing_ratio(df, limits).join(F.broadcast(n), F.lit(True)).select("name", (F.col("passed") | (F.col("_n") == 0)).alias("passed"), "detail")
    lost = feed_continuity(buffer, stored, feeds, now).withColumn("passed", ~F.col("state").isin("lost", "silent"))
    odd = structural(df, now).withColumn("passed", F.col("too_old") + F.col("in_future") + F.col("foreign_host") + F.col("duplicates") == 0)
    return report(
        schema(df, expected), full, collection_gap(ledger, now), _per_key(lost, "feed_continuity", "feed", F.col("state")),
        _per_key(odd, "structural", "feed", F.format_string("old=%d ahead=%d foreign=%d twice=%d", "too_old", "in_future", "foreign_host", "duplicates")),
    )


def suites(**checks: DataFrame) -> DataFrame:
    """(collector, name, passed, detail) of each collector's checks."""
    return reduce(DataFrame.unionByName, [c.select(F.lit(name).alias("collector"), "name", "passed", "detail") for name, c in checks.items()])
