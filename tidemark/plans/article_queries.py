"""Article feeds and news tables over events, pages and documents."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemark.operators import asof, entity, labels, report, rolling, sessions
from tidemark.plans.names import query, r
from tidemark.plans.panel_queries import _FEATURES, _WEIGHTS, _weight_coverage
from tidemark.plans.panels import SQL, articles, attempts, panel, series, sql, table
from tidemark.sources import articles as feed
from tidemark.sources import vendors, versioned

_A, _P = sql("articles"), sql("panel")
_DAY = "2024-01-15"


@query("article_id", "SELECT page_id, substr(sha256(trim(CASE WHEN page_id % 3 = 0 THEN url ELSE CAST(page_id AS VARCHAR) END)), 1, 20) AS article_id FROM pages")
def _(s, d):
    p = table(s, d, "pages").withColumn("guid", F.when(F.col("page_id") % 3 == 0, "").otherwise(F.col("page_id").cast("string")))
    return p.select("page_id", feed.article_id(F.col("guid"), F.col("url")).alias("article_id"))


@query("parse_pubdate", f"{_A} SELECT article_id, date_trunc('second', published_at) AS at FROM articles")
def _(s, d):
    a = articles(s, d)
    # Every third date is written in Seoul's time, every fourth of the others in GMT.
    seoul = F.date_format(F.from_utc_timestamp("published_at", "Asia/Seoul"), "dd MMM yyyy HH:mm:ss")
    utc = F.date_format("published_at", "dd MMM yyyy HH:mm:ss")
    raw = F.when(F.col("seq") % 3 == 0, F.concat(F.lit("Mon, "), seoul, F.lit(" +0900"))).when(F.col("seq") % 3 == 1, F.concat(seoul, F.lit(" +09:00"))).when(F.col("seq") % 4 == 0, F.concat(utc, F.lit(" GMT"))).otherwise(seoul)
    zone = F.when((F.col("seq") % 3 == 2) & (F.col("seq") % 4 != 0), "Asia/Seoul")
    return a.select("article_id", feed.parse_pubdate(raw, zone).alias("at"))


@query("parse_rss_items", f"{_A} SELECT substr(sha256(link), 1, 20) AS article_id, feed, title, date_trunc('second', published_at) AS published_at FROM articles WHERE seq % 10 <> 0")
def _(s, d):
    a = articles(s, d)
    link = F.when(F.col("seq") % 10 == 0, "").otherwise(F.col("link"))
    item = F.concat(F.lit("<item><title>"), "title", F.lit("</title><link>"), link, F.lit("</link><pubDate>"), F.date_format("published_at", "dd MMM yyyy HH:mm:ss"), F.lit(" +0000</pubDate></item>"))
    polls = a.withColumn("item", item).groupBy("feed", (F.col("seq") % 100).alias("poll")).agg(F.concat(F.lit("<rss><channel>"), F.array_join(F.collect_list("item"), ""), F.lit("</channel></rss>")).alias("xml"))
    items, _ = feed.parse_rss_items(polls.select("feed", F.col("feed").alias("outlet"), F.lit(None).cast("string").alias("zone"), "xml", F.lit("2024-02-01").cast("timestamp").alias("collected_at_utc")))
    return items.select("article_id", "feed", "title", "published_at")


@query("seen_ids", f"{_A} SELECT DISTINCT article_id FROM articles WHERE CAST(published_at AS DATE) BETWEEN DATE '2024-01-14' AND DATE '{_DAY}'")
def _(s, d):
    return feed.seen_ids(articles(s, d), _DAY, at="published_at")


@query("newest_stored_per_feed", f"{_A} SELECT feed, max(published_at) AS newest FROM articles WHERE CAST(published_at AS DATE) BETWEEN DATE '2024-01-14' AND DATE '{_DAY}' GROUP BY feed")
def _(s, d):
    return feed.newest_per_feed(articles(s, d), _DAY, at="published_at")


@query("last_run_at", f"{_A} SELECT max(published_at) AS run_at FROM articles WHERE CAST(published_at AS DATE) BETWEEN DATE '2024-01-14' AND DATE '{_DAY}'")
def _(s, d):
    return feed.last_run_at(articles(s, d).select(F.col("published_at").alias("run_at")), _DAY)


@query("new_rows_only", f"{_A} SELECT article_id, feed FROM articles WHERE seq % 3 <> 0")
def _(s, d):
    a = articles(s, d)
    return feed.new_rows_only(a.unionByName(a.where("seq % 2 = 0")), a.where("seq % 3 = 0")).select("article_id", "feed")


@query("distinct_keep_first", f"{_A} SELECT ticker, arg_min(article_id, (published_at, seq)) AS article_id FROM articles GROUP BY ticker")
def _(s, d):
    return feed.keep_first(articles(s, d), ["ticker"], ["published_at", "seq"]).select("ticker", "article_id")


@query("distinct_keep_last", f"{_A} SELECT ticker, arg_max(article_id, (published_at, seq)) AS article_id FROM articles GROUP BY ticker")
def _(s, d):
    return feed.keep_first(articles(s, d), ["ticker"], ["published_at", "seq"], last=True).select("ticker", "article_id")


@query("buffer_oldest", f"{_A} SELECT feed, min(published_at) AS oldest FROM articles GROUP BY feed")
def _(s, d):
    return feed.buffer_oldest(articles(s, d))


@query("next_tradeable_open", f"""{_A}, days AS (SELECT DISTINCT CAST(ts AS DATE) AS session_date FROM events WHERE dayofweek(ts) NOT IN (0, 6)), opens AS (SELECT session_date + INTERVAL 9 HOUR AS open_utc FROM days)
SELECT article_id, open_utc AS known_at_utc FROM articles ASOF LEFT JOIN opens ON published_at <= open_utc""")
def _(s, d):
    a = articles(s, d)
    days = a.select(F.to_date("published_at").alias("date")).where(~F.dayofweek("date").isin(1, 7))
    return sessions.next_tradeable_open(a, sessions.sessions_of(days), "published_at").select("article_id", "known_at_utc")


@query("news_rollup", f"{_A} SELECT ticker, count(*) AS n, arg_min(title, (published_at, article_id)) AS headline FROM articles GROUP BY ticker")
def _(s, d):
    a = articles(s, d)
    return entity.news_rollup(a.select("article_id", "ticker"), a)


@query("sorted_news_counts", f"{_A} SELECT ticker, n, CAST(row_number() OVER (ORDER BY n DESC, ticker) AS INT) AS place FROM (SELECT ticker, count(*) AS n FROM articles GROUP BY ticker)")
def _(s, d):
    n = articles(s, d).groupBy("ticker").agg(F.count("*").alias("n"))
    return rolling.placed(n, "place", F.desc("n"), "ticker")


@query("news_score_rollup", f"{_A} SELECT CAST(published_at AS DATE) AS date, ticker, count(*) AS n, {r('sum(score * (seq % 10)) / nullif(sum(seq % 10), 0)', 'polarity')}, arg_max(title, (score, seq)) AS headline FROM articles GROUP BY ALL")
def _(s, d):
    a = articles(s, d).withColumns({"date": F.to_date("published_at"), "polarity": F.col("score"), "intensity": F.col("score"), "relevance": F.col("seq") % 10})
    return feed.news_score_rollup(a, "date", "ticker")


@query("news_volume_z", f"""{_A}, days AS (SELECT unnest(generate_series(DATE '2024-01-01', (SELECT CAST(max(ts) AS DATE) FROM events), INTERVAL 1 DAY))::DATE AS date), c AS (SELECT feed, CAST(published_at AS DATE) AS date, count(*) AS n FROM articles GROUP BY ALL),
f AS (SELECT t.feed, d.date, coalesce(n, 0)::DOUBLE AS n FROM (SELECT DISTINCT feed FROM articles) t CROSS JOIN days d LEFT JOIN c ON c.feed = t.feed AND c.date = d.date)
SELECT feed, date, {r('CASE WHEN count(n) OVER w = 10 AND stddev_samp(n) OVER w > 0 THEN (n - avg(n) OVER w) / stddev_samp(n) OVER w END', 'z')} FROM f WINDOW w AS (PARTITION BY feed ORDER BY date ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)""")
def _(s, d):
    a = articles(s, d)
    last = a.agg(F.to_date(F.max("published_at")).alias("b"))
    days = last.select(F.explode(F.sequence(F.lit("2024-01-01").cast("date"), "b")).alias("date"))  # a calendar, bounded by its years
    grid = a.select("feed").distinct().crossJoin(F.broadcast(days))
    n = a.groupBy("feed", F.to_date("published_at").alias("date")).agg(F.count("*").cast("double").alias("n"))
    full = grid.join(n, ["feed", "date"], "left").fillna({"n": 0.0})
    return full.select("feed", "date", rolling.rolling_z("n", rolling.by("feed"), 10).alias("z"))


@query("calendar_today_tomorrow", "SELECT CASE WHEN CAST(o_orderdate AS DATE) = DATE '1995-06-01' THEN 'today' ELSE 'tomorrow' END AS \"when\", o_orderkey AS event, CAST(o_orderdate AS DATE) AS date FROM orders WHERE CAST(o_orderdate AS DATE) IN (DATE '1995-06-01', DATE '1995-06-02')")
def _(s, d):
    return report.calendar_table(table(s, d, "orders").select(F.col("o_orderkey").alias("event"), F.to_date("o_orderdate").alias("date")), "1995-06-01")


@query("newest_dates", f"{_P} SELECT 'panel' AS source, max(date) AS newest, count(*) AS rows FROM panel UNION ALL SELECT 'events', CAST(max(ts) AS DATE), count(*) FROM events")
def _(s, d):
    return report.newest_dates(("panel", panel(s, d), "date"), ("events", table(s, d, "events"), "ts"))


_HEADER = f"""{_FEATURES}, {_WEIGHTS}, {SQL['series']}, {SQL['articles']}, {SQL['attempts']}, m AS (SELECT series, value, lag(value) OVER (PARTITION BY series ORDER BY date) AS before, row_number() OVER (PARTITION BY series ORDER BY date DESC) AS k FROM series),
fails AS (SELECT failure AS kind, count(*) AS n FROM attempts WHERE failure IS NOT NULL GROUP BY 1), o AS (SELECT feed, CAST(floor((floor(epoch(max(published_at))) - floor(epoch(min(published_at)))) / 3600) AS BIGINT) AS h FROM articles GROUP BY feed),
apart AS (SELECT ticker, count(*) AS n FROM panel WHERE abs(close - open) / close > 0.35 GROUP BY ticker)"""


@query("header_facts", f"""{_HEADER} SELECT 'info' AS severity, 'market' AS key, string_agg(series || ' ' || printf('%.2f', value) || ' (' || printf('%+.2f%%', 100 * (value / before - 1)) || ')', ' | ' ORDER BY series) AS text FROM m WHERE k = 1
UNION ALL SELECT 'info', 'data', 'events ' || (SELECT max(CAST(ts AS DATE)) FROM events) || ', panel ' || (SELECT max(date) FROM panel)
UNION ALL SELECT 'warning', 'failures', string_agg(CASE WHEN n > 1 THEN kind || '×' || n ELSE kind END, ', ' ORDER BY kind) FROM fails
UNION ALL SELECT 'warning', 'lost news', string_agg(feed || ' ' || h || '.0 h', ', ' ORDER BY feed) FROM o WHERE h > 0
UNION ALL SELECT 'warning', 'vendors disagree', string_agg(ticker || ' on ' || n || ' days', ', ' ORDER BY ticker) FROM apart HAVING count(*) > 0
UNION ALL SELECT CASE WHEN missing = '' THEN 'info' ELSE 'warning' END, 'coverage', printf('%.2f/%.2f (%.0f%%)', present, weight, 100 * present / weight) || CASE WHEN missing = '' THEN '' ELSE ' without ' || missing END FROM coverage WHERE kind = 'active'
UNION ALL SELECT 'info', 'ambiguous', printf('%.1f%% of ', 100.0::DOUBLE * count(*) FILTER (WHERE seq % 11 = 0) / count(*)) || count(*) || ' articles' FROM articles""")
def _(s, d):
    a, p = articles(s, d), panel(s, d)
    fails = attempts(s, d).where("failure IS NOT NULL").groupBy(F.col("failure").alias("kind")).agg(F.count("*").alias("n"))
    lost = F.floor((F.unix_timestamp(F.max("published_at")) - F.unix_timestamp(F.min("published_at"))) / 3600).cast("double")
    gaps = a.groupBy("feed").agg(lost.alias("lost_hours"))
    apart = versioned.vendor_disagreement(p, p.withColumn("close", F.col("open")), most=0.35).groupBy("ticker").agg(F.count("*").alias("n"))
    status = a.agg(F.count("*").alias("articles"), F.count_if(F.col("seq") % 11 == 0).alias("ambiguous"))
    dates = report.newest_dates(("panel", p, "date"), ("events", table(s, d, "events"), "ts"))
    return report.header_facts(dates, report.market_line(series(s, d)), fails, gaps, apart, _weight_coverage(s, d), status)


@query("render_markdown", """WITH t AS (SELECT r_regionkey, r_name, count(n_nationkey) AS nations FROM region LEFT JOIN nation ON n_regionkey = r_regionkey GROUP BY ALL)
SELECT '| r_regionkey | r_name | nations |' AS line UNION ALL SELECT '|---|---|---|' UNION ALL SELECT '| ' || r_regionkey || ' | ' || r_name || ' | ' || nations || ' |' FROM t""")
def _(s, d):
    t = table(s, d, "region").join(table(s, d, "nation"), F.col("r_regionkey") == F.col("n_regionkey"), "left").groupBy("r_regionkey", "r_name").agg(F.count("n_nationkey").alias("nations"))
    return report.markdown(t, ["r_regionkey"])


@query("normalize_macro", f"""{sql('series')}, days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS session_date FROM orders WHERE dayofweek(o_orderdate) NOT IN (0, 6)),
good AS (SELECT date, series, value FROM series WHERE day(date) % 7 <> 0)
SELECT date, series, {r('value')}, session_date + INTERVAL 9 HOUR AS known_at_utc FROM (SELECT *, CAST(date + 1 AS DATE) AS after FROM good) g ASOF LEFT JOIN days ON g.after <= days.session_date""")
def _(s, d):
    m = series(s, d)
    raw = m.withColumn("value", F.when(F.dayofmonth("date") % 7 == 0, F.lit(".")).otherwise(F.col("value").cast("string")))
    cal = sessions.sessions_of(m.select("date").where(~F.dayofweek("date").isin(1, 7)))
    return vendors.normalize_macro(raw, cal)


_FLOW = f"""{_P}, f AS (SELECT * FROM panel WHERE ticker % 5 <> 0), sb AS (SELECT ticker, date, short_balance FROM panel WHERE day(date) % 2 = 0)
SELECT panel.date, panel.ticker, CASE WHEN panel.ticker % 10 = 0 AND f.ticker IS NULL THEN CAST(0 AS BIGINT) ELSE CAST(trunc(f.foreign_net) AS BIGINT) END AS foreign_net, {r('sb.short_balance', 'short_balance')}, panel.date + INTERVAL 930 MINUTE AS known_at_utc
FROM panel LEFT JOIN f USING (date, ticker) LEFT JOIN sb USING (date, ticker)"""


@query("normalize_kr_flow", _FLOW)
def _(s, d):
    p = panel(s, d)
    keys = ["ticker", "date"]
    cap = p.select(*keys, F.when(F.col("ticker") % 10 == 0, 0.0).otherwise(F.col("volume")).alias("volume"), F.col("trading_value").alias("market_cap"))
    flow = p.where("ticker % 5 <> 0").select(*keys, F.when(F.col("foreign_net") >= 0, F.floor("foreign_net")).otherwise(F.ceil("foreign_net")).alias("foreign_net"))
    short = p.where("day(date) % 2 = 0").select(*keys, "short_balance")
    return vendors.normalize_flow(flow, cap, short, p.select(*keys, "pbr"), sessions.sessions_of(p)).select("date", "ticker", "foreign_net", "short_balance", "known_at_utc")


@query("normalize_us_two_pass", "SELECT CAST((l_shipdate AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS DATE) AS date, l_orderkey AS ticker, count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS close FROM lineitem GROUP BY ALL")
def _(s, d):
    bars = table(s, d, "lineitem").select(F.col("l_orderkey").alias("symbol"), F.col("l_shipdate").alias("t"), F.col("l_linenumber").alias("c")).withColumn("k", F.monotonically_increasing_id())
    raw = bars.groupBy("symbol", "t").agg(F.sum("c").alias("c"), F.count("*").alias("v")).withColumns({"o": F.col("c"), "h": F.col("c"), "l": F.col("c")})
    got, _ = vendors.normalize_two_pass(raw, raw.select("symbol", "t", "c"))
    return got.groupBy("date", "ticker").agg(F.sum("volume").alias("n"), F.sum("close").alias("close"))


@query("normalize_kr_price", f"{_P} SELECT date, ticker, CAST(trunc(open) AS BIGINT) AS open, CAST(trunc(close) AS BIGINT) AS close, CAST(volume AS BIGINT) AS volume, date + INTERVAL 930 MINUTE AS known_at_utc FROM panel")
def _(s, d):
    p = panel(s, d)
    names = {"date": "date", "ticker": "ticker", "open": "open", "close": "close", "volume": "volume"}
    return vendors.normalize_price(p, names, sessions.sessions_of(p)).select("date", "ticker", "open", "close", "volume", "known_at_utc")


@query("latest_wins", f"{_A} SELECT ticker, arg_max(article_id, (published_at, seq)) AS article_id, min(seq) AS first_at FROM articles GROUP BY ticker")
def _(s, d):
    w = articles(s, d)
    return labels.latest_wins(w.withColumn("first_seq", F.min("seq").over(Window.partitionBy("ticker"))).withColumn("at", F.struct("published_at", "seq")), ["ticker"], "at").select("ticker", "article_id", F.col("first_seq").alias("first_at"))


@query("asof_prior", f"{_A} SELECT o_orderkey, arg_max(event_id, (ts, event_id)) AS event_id FROM (SELECT o_orderkey, o_custkey % 150 AS u, TIMESTAMP '2024-01-16' AS moment FROM orders) o JOIN events ON user_id = u AND ts <= moment GROUP BY o_orderkey")
def _(s, d):
    o = table(s, d, "orders").select(F.col("o_orderkey"), (F.col("o_custkey") % 150).alias("u"), F.lit("2024-01-16").cast("timestamp").alias("at"))
    e = table(s, d, "events").groupBy(F.col("user_id").alias("u"), "ts").agg(F.max("event_id").alias("event_id"))
    return asof.asof_prior(o, e, ["u"], "at", "ts", ["event_id"]).where("event_id IS NOT NULL").select("o_orderkey", "event_id")
