"""Checks, versions and set operations over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import quality, sessions
from tidemark.operators.storage import shared_folder
from tidemark.plans.names import query, r
from tidemark.plans.panels import articles, panel, series, sql, table
from tidemark.sources import versioned

_P, _PS, _S, _A = sql("panel"), sql("panel", "sessions"), sql("series"), sql("articles")
_NOW = "2024-01-20 00:00:00"


def _calendar(s, d):
    return sessions.sessions_of(panel(s, d).select("date"))


@query("check_schema", "SELECT 'schema' AS name, FALSE AS passed, 'missing halted; extra known_at_utc; volume is double, not bigint' AS detail FROM (SELECT count(*) FROM lineitem)")
def _(s, d):
    want = T.StructType.fromDDL("date date, ticker bigint, close double, volume bigint, halted boolean")
    return quality.schema(panel(s, d).select("date", "ticker", "close", "volume", "known_at_utc"), want)


@query("check_missing_ratio", f"""{_P}, m AS (SELECT avg(CASE WHEN short_balance = 0 THEN 1.0 ELSE 0.0 END) AS short_balance, avg(CASE WHEN close IS NULL THEN 1.0 ELSE 0.0 END) AS close FROM panel)
SELECT 'missing_ratio.short_balance' AS name, short_balance <= 0.05 AS passed, NULL AS detail FROM m UNION ALL SELECT 'missing_ratio.close', close <= 0.05, NULL FROM m""")
def _(s, d):
    p = panel(s, d).withColumn("short_balance", F.nullif("short_balance", F.lit(0.0)))
    return quality.missing_ratio(p, {"short_balance": 0.05, "close": 0.05}).withColumn("detail", F.lit(None).cast("string"))


@query("check_trading_day_continuity", f"""{_PS}, n AS (SELECT session_date, row_number() OVER (ORDER BY session_date) AS i FROM sessions),
t AS (SELECT ticker, min(date) AS a, max(date) AS b, count(DISTINCT date) AS c FROM panel GROUP BY ticker)
SELECT ticker, y.i - x.i + 1 - c AS missing, CAST(0 AS BIGINT) AS off_session, CAST(0 AS BIGINT) AS duplicates, y.i - x.i + 1 - c = 0 AS passed FROM t JOIN n x ON x.session_date = a JOIN n y ON y.session_date = b""")
def _(s, d):
    return quality.continuity(panel(s, d), _calendar(s, d))


@query("check_known_value", "SELECT 'nation_7' AS name, count(*) = 1 AND max(n_regionkey) = 3 AS passed, 'rows=' || count(*) || ' value=' || max(n_regionkey) AS detail FROM nation WHERE n_nationkey = 7")
def _(s, d):
    return quality.known_value(table(s, d, "nation"), "nation_7", F.col("n_nationkey") == 7, "n_regionkey", 3)


@query("check_flow_identity", f"{_P} SELECT 'flow_identity' AS name, count(*) FILTER (WHERE abs(foreign_net + inst_net + retail_net) > 1e-6) = 0 AS passed, CAST(count(*) FILTER (WHERE abs(foreign_net + inst_net + retail_net) > 1e-6) AS BIGINT) AS bad FROM panel")
def _(s, d):
    got = quality.identity(panel(s, d), ["foreign_net", "inst_net", "retail_net", "other_net"])
    return got.select("name", "passed", F.regexp_extract("detail", "rows=(\\d+)", 1).cast("bigint").alias("bad"))


@query("check_implied_close", f"{_P} SELECT 'implied_close' AS name, count(*) = 0 OR abs(max(trading_value / nullif(volume, 0)) - 1500) <= 400 AS passed, count(*) > 0 AS found FROM panel WHERE ticker = 1 AND date = DATE '1996-03-13'")
def _(s, d):
    p = panel(s, d).withColumn("market_cap", F.col("trading_value"))
    got = quality.implied_close(p, (F.col("ticker") == 1) & (F.col("date") == F.lit("1996-03-13").cast("date")), 1500.0, 400.0)
    return got.select("name", "passed", (F.col("detail") != "no row").alias("found"))


@query("settled_rows", f"{_P} SELECT date, count(*) AS n FROM panel WHERE date NOT IN (SELECT DISTINCT date FROM panel ORDER BY date DESC LIMIT 5) GROUP BY date")
def _(s, d):
    return quality.settled_rows(panel(s, d), 5).groupBy("date").agg(F.count("*").alias("n"))


@query("settled_missing_ratio", f"{_P} SELECT 'missing_ratio.short_balance' AS name, avg(CASE WHEN short_balance = 0 THEN 1.0 ELSE 0.0 END) <= 0.5 AS passed FROM panel WHERE date NOT IN (SELECT DISTINCT date FROM panel ORDER BY date DESC LIMIT 5)")
def _(s, d):
    p = quality.settled_rows(panel(s, d), 5).withColumn("short_balance", F.nullif("short_balance", F.lit(0.0)))
    return quality.missing_ratio(p, {"short_balance": 0.5}).drop("detail")


@query("check_not_empty", f"{_P} SELECT 'not_empty' AS name, count(*) > 0 AS passed, 'rows=' || count(*) AS detail FROM panel")
def _(s, d):
    return quality.not_empty(panel(s, d), 1)


@query("check_series_coverage", f"""{_S}, days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS session_date FROM orders), n AS (SELECT session_date, row_number() OVER (ORDER BY session_date) AS i FROM days), m AS (SELECT max(i) AS last FROM n),
g AS (SELECT series, count(*) AS held, min(i) AS a, max(i) AS b, count(*) FILTER (WHERE dayofweek(date) IN (0, 6)) AS weekend_rows FROM series JOIN n ON n.session_date = date GROUP BY series)
SELECT series, {r('held::DOUBLE / (b - a + 1)', 'ratio')}, last - b AS stale_sessions, weekend_rows, CAST(0 AS BIGINT) AS duplicates, held::DOUBLE / (b - a + 1) >= 0.95 AND last - b <= 10 AND weekend_rows = 0 AS passed FROM g, m""")
def _(s, d):
    cal = sessions.sessions_of(table(s, d, "orders").select(F.to_date("o_orderdate").alias("date")))
    return quality.coverage(series(s, d), cal)


@query("check_event_continuity", """WITH g AS (SELECT DISTINCT event_type AS event, CAST(ts AS DATE) AS date FROM events), l AS (SELECT event, date, date_diff('day', lag(date) OVER (PARTITION BY event ORDER BY date), date) AS gap FROM g)
SELECT event, count(*) AS n, CAST(max(gap) AS INT) AS max_gap, count(*) FILTER (WHERE gap = 0) AS duplicates, count(*) FILTER (WHERE dayofweek(date) IN (0, 6)) AS weekend, coalesce(max(gap), 0) <= 45 AND count(*) FILTER (WHERE gap = 0) = 0 AND count(*) FILTER (WHERE dayofweek(date) IN (0, 6)) = 0 AS passed FROM l GROUP BY event""")
def _(s, d):
    e = table(s, d, "events").select(F.col("event_type").alias("event"), F.to_date("ts").alias("date")).distinct()
    return quality.event_gaps(e)


@query("gap_scan", """WITH g AS (SELECT DISTINCT o_orderpriority AS event, CAST(o_orderdate AS DATE) AS date FROM orders), l AS (SELECT event, date, date_diff('day', lag(date) OVER (PARTITION BY event ORDER BY date), date) AS gap FROM g)
SELECT event, count(*) AS n, CAST(max(gap) AS INT) AS max_gap FROM l GROUP BY event""")
def _(s, d):
    return quality.event_gaps(table(s, d, "orders").select(F.col("o_orderpriority").alias("event"), F.to_date("o_orderdate").alias("date")).distinct()).select("event", "n", "max_gap")


@query("check_structural_invariants", f"""{_A} SELECT feed, count(*) AS n, count(*) FILTER (WHERE published_at < TIMESTAMP '{_NOW}' - INTERVAL 30 DAY) AS too_old, count(*) FILTER (WHERE published_at > TIMESTAMP '{_NOW}' + INTERVAL 6 HOUR) AS in_future,
  count(*) FILTER (WHERE seq % 50 = 0) AS foreign_host, CAST(0 AS BIGINT) AS duplicates FROM articles GROUP BY feed""")
def _(s, d):
    a = articles(s, d).withColumn("domain", F.when(F.col("seq") % 50 == 0, "elsewhere.org").otherwise(F.col("domain")))
    return quality.structural(a, _NOW)


@query("check_collection_gap", f"{_A} SELECT 'collection_gap' AS name, date_diff('second', max(published_at), TIMESTAMP '2024-02-01 00:00:00') / 3600.0 <= 2 AS passed FROM articles")
def _(s, d):
    return quality.collection_gap(articles(s, d).select(F.col("published_at").alias("run_at")), "2024-02-01 00:00:00").drop("detail")


@query("check_feed_continuity", f"""{_A}, cut AS (SELECT min(published_at) + (max(published_at) - min(published_at)) / 2 AS mid FROM articles),
o AS (SELECT feed, min(published_at) AS oldest FROM articles, cut WHERE published_at > mid + INTERVAL 3 HOUR AND feed <> 'click' GROUP BY feed), n AS (SELECT feed, max(published_at) AS newest FROM articles, cut WHERE published_at <= mid GROUP BY feed)
SELECT f.feed, CASE WHEN oldest IS NULL THEN 'silent' WHEN oldest > newest THEN 'lost' ELSE 'ok' END AS state FROM (SELECT DISTINCT feed FROM articles) f LEFT JOIN o USING (feed) LEFT JOIN n USING (feed)""")
def _(s, d):
    a = articles(s, d)
    lo, hi = a.agg(F.min("published_at"), F.max("published_at")).first()
    cut = F.lit(lo + (hi - lo) / 2)
    later = a.where((F.col("published_at") > cut + F.expr("interval 3 hours")) & (F.col("feed") != "click"))
    return quality.feed_continuity(later, a.where(F.col("published_at") <= cut), a, str(hi)).select("feed", "state")


@query("check_fetch_completeness", "SELECT s_suppkey + 0 AS ticker FROM supplier WHERE s_suppkey NOT IN (SELECT l_suppkey FROM lineitem WHERE l_shipdate < TIMESTAMP '1992-03-01')")
def _(s, d):
    asked = table(s, d, "supplier").select(F.col("s_suppkey").alias("ticker"))
    return quality.completeness(asked, panel(s, d).where("date < '1992-03-01'"), "ticker")


@query("validation_report", f"""{_P}, c AS (SELECT 'not_empty' AS name, count(*) > 0 AS passed FROM panel UNION ALL SELECT 'missing_ratio.close', avg(CASE WHEN close IS NULL THEN 1.0 ELSE 0.0 END) <= 0.01 FROM panel UNION ALL SELECT 'nation_7', count(*) = 1 AND max(n_regionkey) = 99 FROM nation WHERE n_nationkey = 7)
SELECT bool_and(passed) AS ok, count(*) AS n, count(*) FILTER (WHERE NOT passed) || ' of ' || count(*) || ' checks failed' AS summary FROM c""")
def _(s, d):
    p = panel(s, d)
    checks = quality.report(quality.not_empty(p, 1), quality.missing_ratio(p, {"close": 0.01}), quality.known_value(table(s, d, "nation"), "nation_7", F.col("n_nationkey") == 7, "n_regionkey", 99))
    return quality.summary(checks).drop("failures")


_KINDS = "date date, ticker bigint, close double"
_SUITES = f"""{sql('panel', 'sessions', 'series', 'articles')}, n AS (SELECT session_date, row_number() OVER (ORDER BY session_date) AS i FROM sessions), t AS (SELECT ticker, min(date) AS a, max(date) AS b, count(DISTINCT date) AS c FROM panel GROUP BY ticker),
gaps AS (SELECT 'continuity[' || ticker || ']' AS name, y.i - x.i + 1 - c = 0 AS passed FROM t JOIN n x ON x.session_date = a JOIN n y ON y.session_date = b),
idx AS (SELECT count(DISTINCT date) = (SELECT count(*) FROM sessions) AS whole FROM panel),
ev AS (SELECT DISTINCT event_type AS event, CAST(ts AS DATE) AS date FROM events), evl AS (SELECT event, date, date_diff('day', lag(date) OVER (PARTITION BY event ORDER BY date), date) AS gap FROM ev),
oday AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders), oi AS (SELECT d, row_number() OVER (ORDER BY d) AS i FROM oday), cov AS (SELECT series, count(*) AS held, min(i) AS a, max(i) AS b, count(*) FILTER (WHERE dayofweek(date) IN (0, 6)) AS weekend FROM series JOIN oi ON oi.d = date GROUP BY series)"""


@query("validation_suite", f"""{_SUITES}
SELECT 'kr_price' AS collector, 'schema' AS name, TRUE AS passed UNION ALL SELECT 'kr_price', 'missing_ratio.close', avg(CASE WHEN close IS NULL THEN 1.0 ELSE 0.0 END) <= 0.0 FROM panel UNION ALL SELECT 'kr_price', 'not_empty', count(*) > 0 FROM panel UNION ALL SELECT 'kr_price', name, passed FROM gaps UNION ALL SELECT 'kr_price', 'known', count(*) = 1 AND abs(max(close) - 1500) <= 400 FROM panel WHERE ticker = 1 AND date = DATE '1996-03-13'
UNION ALL SELECT 'us_price', 'schema', FALSE UNION ALL SELECT 'us_price', 'missing_ratio.close', avg(CASE WHEN close IS NULL THEN 1.0 ELSE 0.0 END) <= 0.0 FROM panel UNION ALL SELECT 'us_price', 'not_empty', count(*) > 0 FROM panel UNION ALL SELECT 'us_price', name, passed FROM gaps
UNION ALL SELECT 'kr_flow', 'schema', TRUE UNION ALL SELECT 'kr_flow', 'missing_ratio.foreign_net', TRUE UNION ALL SELECT 'kr_flow', 'not_empty', count(*) > 0 FROM panel UNION ALL SELECT 'kr_flow', name, passed FROM gaps UNION ALL SELECT 'kr_flow', 'flow_identity', count(*) FILTER (WHERE abs(foreign_net + inst_net + retail_net) > 1e-6) = 0 FROM panel
UNION ALL SELECT 'kr_flow', 'settled.missing_ratio.short_balance', avg(CASE WHEN short_balance = 0 THEN 1.0 ELSE 0.0 END) <= 0.5 FROM panel WHERE date NOT IN (SELECT DISTINCT date FROM panel ORDER BY date DESC LIMIT 5)
UNION ALL SELECT 'kr_index', 'schema', TRUE UNION ALL SELECT 'kr_index', 'missing_ratio.close', TRUE UNION ALL SELECT 'kr_index', 'not_empty', whole FROM idx UNION ALL SELECT 'kr_index', 'continuity[0]', whole FROM idx
UNION ALL SELECT 'macro', 'schema', TRUE UNION ALL SELECT 'macro', 'missing_ratio.value', TRUE UNION ALL SELECT 'macro', 'coverage[' || series || ']', held::DOUBLE / (b - a + 1) >= 0.95 AND (SELECT max(i) FROM oi) - b <= 10 AND weekend = 0 FROM cov
UNION ALL SELECT 'calendar', 'schema', TRUE UNION ALL SELECT 'calendar', 'missing_ratio.date', TRUE UNION ALL SELECT 'calendar', 'event_continuity[' || event || ']', coalesce(max(gap), 0) <= 45 AND count(*) FILTER (WHERE gap = 0) = 0 AND count(*) FILTER (WHERE dayofweek(date) IN (0, 6)) = 0 FROM evl GROUP BY event
UNION ALL SELECT 'news', 'schema', TRUE UNION ALL SELECT 'news', 'missing_ratio.title', TRUE UNION ALL SELECT 'news', 'collection_gap', date_diff('second', max(published_at), TIMESTAMP '{_NOW}') / 3600.0 <= 2 FROM articles UNION ALL SELECT 'news', 'feed_continuity[' || feed || ']', TRUE FROM articles GROUP BY feed
UNION ALL SELECT 'news', 'structural[' || feed || ']', count(*) FILTER (WHERE published_at < TIMESTAMP '{_NOW}' - INTERVAL 30 DAY OR published_at > TIMESTAMP '{_NOW}' + INTERVAL 6 HOUR OR seq % 50 = 0) = 0 FROM articles GROUP BY feed""")
def _(s, d):
    p, o, e = panel(s, d), table(s, d, "orders"), table(s, d, "events")
    cal, kinds = _calendar(s, d), T.StructType.fromDDL(_KINDS)
    prices = p.select("date", "ticker", "close")
    known = quality.known_value(prices, "known", (F.col("ticker") == 1) & (F.col("date") == F.lit("1996-03-13").cast("date")), "close", 1500.0, 400.0)
    flow = p.select("date", "ticker", "foreign_net", "inst_net", "retail_net", "other_net", F.nullif("short_balance", F.lit(0.0)).alias("short_balance"))
    index = p.groupBy("date").agg(F.sum("trading_value").alias("close")).select("date", F.lit(0).cast("bigint").alias("ticker"), "close")
    a = articles(s, d).withColumn("domain", F.when(F.col("seq") % 50 == 0, "elsewhere.org").otherwise(F.col("domain")))
    days = sessions.sessions_of(o.select(F.to_date("o_orderdate").alias("date")))
    events = e.select(F.col("event_type").alias("event"), F.to_date("ts").alias("date")).distinct()
    return quality.suites(
        kr_price=quality.price_suite(prices, kinds, cal, {"close": 0.0}, known),
        us_price=quality.price_suite(prices.withColumn("volume", F.lit(1)), kinds, cal, {"close": 0.0}),
        kr_flow=quality.flow_suite(flow, flow.schema, cal, {"foreign_net": 0.0}, {"short_balance": 0.5}, ["foreign_net", "inst_net", "retail_net", "other_net"], 5),
        kr_index=quality.price_suite(index, index.schema, cal, {"close": 0.0}),
        macro=quality.macro_suite(series(s, d), series(s, d).schema, days, {"value": 0.0}),
        calendar=quality.calendar_suite(events, events.schema, {"date": 0.0}),
        news=quality.news_suite(a, a.schema, {"title": 0.0}, a.select(F.col("published_at").alias("run_at")), a, a, a, _NOW),
    ).drop("detail")


@query("alias_integrity", "SELECT p_name AS alias, string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) AS owners FROM part GROUP BY p_name HAVING count(DISTINCT p_brand) > 1")
def _(s, d):
    return quality.duplicate_claims(table(s, d, "part").select(F.col("p_name").alias("alias"), "p_brand"), "alias", "p_brand")


@query("watchlist_integrity", """WITH w AS (SELECT CASE c_nationkey % 3 WHEN 0 THEN 'KR' WHEN 1 THEN 'US' ELSE 'JP' END AS market, CASE WHEN c_custkey % 40 <> 0 THEN lpad(CAST(c_custkey % 1000 AS VARCHAR), 6, '0') END AS ticker, CASE WHEN c_custkey % 30 <> 0 THEN c_name ELSE ' ' END AS name FROM customer)
SELECT DISTINCT market, ticker, 'no ticker' AS fault FROM w WHERE ticker IS NULL UNION ALL SELECT DISTINCT market, ticker, 'no name' FROM w WHERE trim(name) = '' UNION ALL SELECT DISTINCT market, ticker, 'ticker''s form' FROM w WHERE ticker IS NOT NULL AND market <> 'KR'
UNION ALL SELECT market, ticker, 'listed twice' FROM w WHERE ticker IS NOT NULL GROUP BY ALL HAVING count(*) > 1""")
def _(s, d):
    k = F.col("c_custkey")
    market = F.element_at(F.array(F.lit("KR"), F.lit("US"), F.lit("JP")), (F.col("c_nationkey") % 3 + 1).cast("int"))
    entries = table(s, d, "customer").select(market.alias("market"), F.when(k % 40 != 0, F.lpad((k % 1000).cast("string"), 6, "0")).alias("ticker"), F.when(k % 30 != 0, F.col("c_name")).otherwise(" ").alias("name"))
    return quality.watchlist(entries, {"KR": "^[0-9]{6}$", "US": "^[A-Z.]{1,6}$"})


@query("sector_mapping_integrity", "SELECT n_nationkey FROM nation WHERE n_regionkey NOT IN (SELECT r_regionkey FROM region WHERE r_name <> 'ASIA')")
def _(s, d):
    kept = table(s, d, "region").where("r_name <> 'ASIA'").select(F.col("r_regionkey").alias("n_regionkey"))
    return quality.unmapped(table(s, d, "nation"), kept, "n_regionkey").select("n_nationkey")


@query("feed_config", """WITH f AS (SELECT CAST(page_id % 200 AS VARCHAR) AS name, CASE WHEN page_id % 9 <> 0 THEN 'o' END AS outlet, CASE WHEN page_id % 7 = 0 THEN 'ftp://' || url ELSE url END AS url, url AS domain FROM pages)
SELECT name, 'missing outlet' AS fault FROM f WHERE outlet IS NULL UNION ALL SELECT name, 'not http(s)' FROM f WHERE NOT regexp_matches(url, '^https?://') UNION ALL SELECT name, 'repeated name' FROM f GROUP BY name HAVING count(*) > 1 UNION ALL SELECT min(name), 'shared url' FROM f GROUP BY url HAVING count(*) > 1 UNION ALL SELECT NULL, 'none enabled' FROM (SELECT count(*) AS n FROM f) WHERE n > 0""")
def _(s, d):
    k = F.col("page_id")
    entries = table(s, d, "pages").select((k % 200).cast("string").alias("name"), F.when(k % 9 != 0, "o").alias("outlet"), F.lit("s").alias("section"), F.when(k % 7 == 0, F.concat(F.lit("ftp://"), "url")).otherwise(F.col("url")).alias("url"), F.col("url").alias("domain"), F.lit(False).alias("enabled"))
    return quality.feeds(entries)


@query("rating_config", """WITH w AS (SELECT p_brand AS feature, CASE WHEN p_partkey % 50 = 0 THEN 'heavy' ELSE CAST(p_size AS VARCHAR) END AS weight, p_partkey % 2 = 0 AS active FROM part), c AS (SELECT max(p_retailprice) AS s, avg(p_retailprice) AS m, min(p_retailprice) AS w FROM part)
SELECT 'numeric_weights' AS name, count(*) FILTER (WHERE weight = 'heavy') = 0 AS passed FROM w UNION ALL SELECT 'active_or_deferred', count(*) = 0 FROM (SELECT feature FROM w GROUP BY feature HAVING count(DISTINCT active) > 1) UNION ALL SELECT 'ordered_cuts', s > m AND m > w AND w > 0 FROM c UNION ALL SELECT 'floor', TRUE""")
def _(s, d):
    k, p = F.col("p_partkey"), table(s, d, "part")
    weights = p.select(F.col("p_brand").alias("feature"), F.when(k % 50 == 0, "heavy").otherwise(F.col("p_size").cast("string")).alias("weight"), (k % 2 == 0).alias("active"))
    laid = p.agg(F.max("p_retailprice").alias("strong"), F.avg("p_retailprice").alias("moderate"), F.min("p_retailprice").alias("weak"))
    return quality.rating_config(weights, laid.unpivot([], ["strong", "moderate", "weak"], "cut", "threshold"), 0.5).drop("detail")


_VERSIONS = f"""{_P}, v AS (SELECT date, ticker, close, 1 AS version FROM panel UNION ALL SELECT date, ticker, close * 2, 2 FROM panel WHERE day(date) = 3 AND ticker % 2 = 0 UNION ALL SELECT date, ticker, close * 3, 10 FROM panel WHERE day(date) = 3 AND ticker % 4 = 0)"""


def _versions(s, d):
    p = panel(s, d).select("date", "ticker", "close")
    third = p.where("day(date) = 3")
    return p.withColumn("version", F.lit(1)).unionByName(third.where("ticker % 2 = 0").withColumns({"close": F.col("close") * 2, "version": F.lit(2)})).unionByName(third.where("ticker % 4 = 0").withColumns({"close": F.col("close") * 3, "version": F.lit(10)}))


@query("load_versioned", f"{_VERSIONS} SELECT date, ticker, {r('arg_max(close, version)', 'close')} FROM v GROUP BY date, ticker")
def _(s, d):
    path = shared_folder(s)
    _versions(s, d).write.partitionBy("version").parquet(path)
    return versioned.load_versioned(s, path).select("date", "ticker", "close")


@query("latest_version_per_session", f"{_VERSIONS} SELECT date, ticker, {r('close')} FROM v WHERE (date, version) IN (SELECT (date, max(version)) FROM v GROUP BY date)")
def _(s, d):
    return versioned.latest_version_per_session(_versions(s, d)).select("date", "ticker", "close")


@query("latest_stored_version", f"{_VERSIONS} SELECT date, CAST(max(version) AS INT) AS version FROM v GROUP BY date")
def _(s, d):
    return versioned.latest_stored_version(_versions(s, d))


@query("diff_revision", f"""{_P}, f AS (SELECT date, ticker, CASE WHEN day(date) = 5 THEN close + 1 ELSE close END AS close FROM panel WHERE NOT (day(date) = 7 AND ticker % 3 = 0) AND year(date) < 1997),
st AS (SELECT date, ticker, close FROM panel WHERE year(date) > 1992),
j AS (SELECT coalesce(s.date, f.date) AS date, s.ticker AS a, f.ticker AS b, abs(s.close - f.close) > 1e-8 + 1e-5 * abs(f.close) AS moved FROM st s FULL JOIN f ON s.date = f.date AND s.ticker = f.ticker)
SELECT date, CASE WHEN count(a) = 0 THEN 'new' WHEN count(*) FILTER (WHERE b IS NULL) > 0 THEN 'shrunk' WHEN count(*) FILTER (WHERE a IS NULL) > 0 OR bool_or(moved) THEN 'revised' ELSE 'same' END AS state FROM j GROUP BY date HAVING count(b) > 0""")
def _(s, d):
    p = panel(s, d).select("date", "ticker", "close")
    fetched = p.where("NOT (day(date) = 7 AND ticker % 3 = 0) AND year(date) < 1997").withColumn("close", F.when(F.dayofmonth("date") == 5, F.col("close") + 1).otherwise(F.col("close")))
    return versioned.diff_revision(p.where("year(date) > 1992"), fetched, ["date", "ticker"])


@query("pending_sessions", f"{_PS} SELECT session_date FROM sessions WHERE session_date NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderpriority = '1-URGENT')")
def _(s, d):
    stored = table(s, d, "orders").where("o_orderpriority = '1-URGENT'").select(F.to_date("o_orderdate").alias("date"))
    return versioned.pending_sessions(_calendar(s, d), stored)


def _months(s, d):
    return panel(s, d).select(F.date_format("date", "yyyy-MM").alias("month"), "date", "ticker", "close")


@query("write_versioned", f"{_P} SELECT strftime(date, '%Y-%m') AS month, date, ticker, (round(CASE WHEN month(date) = 5 THEN close + 1 ELSE close END, 6) + 0.0) AS close FROM panel")
def _(s, d):
    """Twice into one table: the second time May is revised and the rest as it was."""
    path, p = shared_folder(s), _months(s, d)
    versioned.write_versioned(p, path, ["month", "date", "ticker"], "month")
    revised = p.withColumn("close", F.when(F.month("date") == 5, F.col("close") + 1).otherwise(F.col("close")))
    versioned.write_versioned(revised, path, ["month", "date", "ticker"], "month")
    return versioned.load_versioned(s, path, ["month", "date", "ticker"]).select(F.date_format("date", "yyyy-MM").alias("month"), "date", "ticker", "close")


@query("backfill_write", f"{_P} SELECT strftime(date, '%Y-%m') AS month, count(*) AS n FROM panel GROUP BY ALL")
def _(s, d):
    path, p = shared_folder(s), _months(s, d)
    versioned.backfill_write(p.where("year(date) <= 1994"), path, "month")
    versioned.backfill_write(p, path, "month")
    return s.read.parquet(path).groupBy(F.date_format("date", "yyyy-MM").alias("month")).agg(F.count("*").alias("n"))


_VENDORS = f"{_P}, a AS (SELECT date, ticker, close FROM panel WHERE day(date) % 3 <> 0), b AS (SELECT date, ticker, CASE WHEN ticker % 7 = 0 THEN close * 1.01 ELSE close END AS close FROM panel)"


def _vendors(s, d):
    p = panel(s, d).select("date", "ticker", "close")
    return p.where("day(date) % 3 <> 0"), p.withColumn("close", F.when(F.col("ticker") % 7 == 0, F.col("close") * 1.01).otherwise(F.col("close")))


@query("overlay_fill", f"{_VENDORS} SELECT date, ticker, {r('close')} FROM a UNION ALL SELECT date, ticker, round(close, 6) + 0.0 FROM b WHERE date NOT IN (SELECT date FROM a)")
def _(s, d):
    return versioned.overlay_fill(*_vendors(s, d))


@query("vendor_disagreement", f"{_VENDORS} SELECT date, ticker, {r('a.close', 'a')}, {r('b.close', 'b')}, {r('abs(b.close - a.close) / a.close', 'diff')} FROM a JOIN b USING (date, ticker) WHERE abs(b.close - a.close) / nullif(a.close, 0) > 0.001 OR nullif(a.close, 0) IS NULL")
def _(s, d):
    return versioned.vendor_disagreement(*_vendors(s, d))
