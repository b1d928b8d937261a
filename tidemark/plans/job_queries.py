"""Jobs, logs, conflicts, set operations, report tables and streams over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import conflicts, entity, evaluation, features, labels, quality, rating, report, sessions, sets, similarity
from tidemark.operators.storage import shared_folder, written
from tidemark.plans.names import query, r
from tidemark.plans.panel_queries import _BASKET, _RATED, _SCORES, _RANKED, _forward, _held, _pairs, _rated, _track
from tidemark.plans.panels import articles, attempts, panel, sql, table, titles
from tidemark.plans.text_queries import _E, _PAIRS, _articles, _entries
from tidemark.sources import articles as feed
from tidemark.sources import jobs, vendors, versioned
from tidemark.streaming import articles as streams

_P, _PS, _A, _T = sql("panel"), sql("panel", "sessions"), sql("articles"), sql("attempts")


@query("write_ratings_archive", f"{_RATED} SELECT strftime(date, '%Y-%m') AS month, count(*) AS n, {r('avg(score)', 'score')} FROM rated GROUP BY 1")
def _(s, d):
    path = shared_folder(s)
    made = rating.refuse_empty(written(_rated(s, d).drop("terms").withColumn("month", F.date_format("date", "yyyy-MM"))))
    versioned.write_versioned(made, path, ["month", "date", "ticker"], "month")
    back = versioned.latest_version_per_session(s.read.parquet(path).withColumn("month", F.date_format("date", "yyyy-MM")), "month")
    return back.groupBy("month").agg(F.count("*").alias("n"), F.avg("score").alias("score"))


def _stored_news(s, d):
    root = shared_folder(s)
    a = articles(s, d).select("article_id", "feed", "title", "link", "published_at")
    feed.write_news_run(a.where("published_at < '2024-01-15'"), root, "2024-01-15 00:00:00")
    feed.write_news_run(a.where("published_at >= '2024-01-15'"), root, "2024-02-15 00:00:00")
    feed.write_news_run(a.limit(0), root, "2024-02-16 00:00:00")
    return root


@query("scan_news_jsonl", f"{_A} SELECT feed, count(*) AS n, count(DISTINCT article_id) AS ids FROM articles GROUP BY feed")
def _(s, d):
    return feed.scan_news(s, f"{_stored_news(s, d)}/articles").groupBy("feed").agg(F.count("*").alias("n"), F.countDistinct("article_id").alias("ids"))


@query("write_news_run", f"{_A} SELECT TIMESTAMP '2024-01-15' AS run_at, count(*) FILTER (WHERE published_at < TIMESTAMP '2024-01-15') AS rows FROM articles UNION ALL SELECT TIMESTAMP '2024-02-15', count(*) FILTER (WHERE published_at >= TIMESTAMP '2024-01-15') FROM articles UNION ALL SELECT TIMESTAMP '2024-02-16', 0 FROM articles HAVING count(*) > 0")
def _(s, d):
    return s.read.parquet(f"{_stored_news(s, d)}/ledger")


@query("normalize_kr_index", f"{_P}, i AS (SELECT date, sector, sum(CAST(trading_value AS DECIMAL(18,2)))::DOUBLE AS level FROM panel GROUP BY ALL) SELECT date, sector AS ticker, CAST(trunc(level) AS BIGINT) AS index_level, date + INTERVAL 930 MINUTE AS known_at_utc FROM i")
def _(s, d):
    p = panel(s, d)
    index = p.groupBy("date", "sector").agg(F.sum(F.col("trading_value").cast("decimal(18,2)")).cast("double").alias("level"))
    return vendors.normalize_price(index, {"date": "date", "sector": "ticker", "level": "index_level"}, sessions.sessions_of(p), {"index_level": "bigint"})


@query("normalize_us_single", f"{_P} SELECT date, ticker, {r('open')}, {r('close')}, CAST(volume AS BIGINT) AS volume, {r('close', 'adj_close')}, date + INTERVAL 930 MINUTE AS known_at_utc FROM panel")
def _(s, d):
    p = panel(s, d).withColumn("adjClose", F.col("close"))
    names = {"date": "date", "ticker": "ticker", "open": "open", "close": "close", "volume": "volume", "adjClose": "adj_close"}
    return vendors.normalize_price(p, names, sessions.sessions_of(p), {"open": "double", "close": "double", "volume": "bigint", "adj_close": "double"})


@query("normalize_calendar", """WITH o AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS a, o_orderpriority = '1-URGENT' AS sep, o_orderkey % 10 = 0 AS vote FROM orders)
SELECT 'fomc' AS event, CASE WHEN vote THEN a ELSE a + 1 END AS date, a AS date_start, sep AND NOT vote AS has_sep, CASE WHEN vote THEN 'FOMC notation vote (' || strftime(a, '%m/%d') || ')' ELSE 'FOMC 회의 (' || strftime(a, '%m/%d') || '~' || strftime(a + 1, '%m/%d') || ')' || CASE WHEN sep THEN ' (경제전망요약)' ELSE '' END END AS label FROM (SELECT DISTINCT a, sep AND NOT vote AS sep, vote FROM o)
UNION ALL SELECT CASE WHEN event_type = 'click' THEN 'cpi' ELSE event_type END, CAST(ts AS DATE), CAST(ts AS DATE), FALSE, CASE WHEN event_type = 'click' THEN 'CPI 발표' ELSE '고용지표 발표' END FROM events WHERE event_id % 13 <> 0""")
def _(s, d):
    k = F.col("o_orderkey") % 10 == 0
    o = table(s, d, "orders").select(F.to_date("o_orderdate").alias("a"), ((F.col("o_orderpriority") == "1-URGENT") & ~k).alias("sep"), k.alias("vote")).distinct()
    b = F.date_add("a", 1)
    month = F.when(F.col("vote") | (F.month("a") == F.month(b)), F.date_format("a", "MMMM")).otherwise(F.concat(F.date_format("a", "MMM"), F.lit("/"), F.date_format(b, "MMM")))
    text = F.when(F.col("vote"), F.concat(F.dayofmonth("a"), F.lit(" (notation vote)"))).otherwise(F.concat(F.dayofmonth("a"), F.lit("-"), F.dayofmonth(b), F.when(F.col("sep"), "*").otherwise("")))
    cells = o.select(F.year("a").alias("year"), month.alias("month_text"), text.alias("date_text"))
    # Every thirteenth release has a date that can't be read.
    day = F.when(F.col("event_id") % 13 == 0, "soon").otherwise(F.date_format("ts", "yyyy-MM-dd"))
    releases = table(s, d, "events").select(F.when(F.col("event_type") == "click", "cpi").otherwise(F.col("event_type")).alias("event"), day.alias("date"))
    return vendors.normalize_calendar(releases, cells)


@query("run_status", f"{_A}, st AS (SELECT feed || '[' || (seq % 7) || ']' AS name, seq % 11 <> 0 AS ok, published_at AS moment FROM articles), newest AS (SELECT max(moment) AS m FROM st), fresh AS (SELECT * FROM st, newest WHERE moment > m - INTERVAL 20 HOUR AND NOT ok) SELECT split_part(name, '[', 1) AS kind, count(*) AS n FROM fresh GROUP BY 1")
def _(s, d):
    st = articles(s, d).select(F.concat("feed", F.lit("["), F.col("seq") % 7, F.lit("]")).alias("name"), (F.col("seq") % 11 != 0).alias("ok"), F.col("published_at").alias("at"))
    return jobs.read_status(st, 20)


@query("jsonl_round_trip", f"{_T} SELECT model, count(*) AS n, {r('max(polarity)', 'polarity')} FROM attempts GROUP BY model")
def _(s, d):
    path = shared_folder(s)
    a = attempts(s, d).select("model", "example", "repeat", "polarity")
    jobs.append_jsonl(a.where("repeat = 0"), path)
    jobs.append_jsonl(a.where("repeat > 0"), path)
    return jobs.read_jsonl(s, path, a.schema).groupBy("model").agg(F.count("*").alias("n"), F.max("polarity").alias("polarity"))


@query("load_dimension", "SELECT p_brand AS ticker, string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS aliases FROM part GROUP BY p_brand")
def _(s, d):
    dim = jobs.dimension(table(s, d, "part").select(F.col("p_brand").alias("ticker"), F.col("p_type").alias("alias")), "ticker", "alias", "aliases")
    return dim.withColumn("aliases", F.array_join("aliases", ","))


@query("backfill_job", f"{_P} SELECT strftime(date, '%Y-%m') AS month, count(*) AS n, round(sum(CAST(close AS DECIMAL(18,4)))::DOUBLE, 6) + 0.0 AS close FROM panel GROUP BY 1")
def _(s, d):
    """Months stand for sessions, so that the folder holds one partition for each."""
    path, p = shared_folder(s), written(panel(s, d).select(F.trunc("date", "month").alias("date"), F.col("date").alias("day"), "ticker", "close"))
    calendar = sessions.sessions_of(p)
    first, last = p.agg(F.min("date"), F.max("date")).first()
    middle = first + (last - first) / 2

    def fetch(start, end):
        return p.where(F.col("date").between(F.lit(start), F.lit(end))).withColumnRenamed("date", "session")

    def until_middle(start, end):
        if start > middle:
            raise jobs.Refused("no session")
        return fetch(start, end)

    # The first run is refused half way; the second goes on from the sessions that it left.
    run = lambda source: jobs.backfill_job(s, path, calendar, source, 800, lambda df: df.withColumnRenamed("session", "date"), lambda df: quality.not_empty(df, 1))
    assert run(until_middle).where("state LIKE 'stopped%'").count() == 1
    run(fetch)
    return versioned.stored(s, path).groupBy(F.date_format("date", "yyyy-MM").alias("month")).agg(F.count("*").alias("n"), F.sum(F.col("close").cast("decimal(18,4)")).cast("double").alias("close"))


@query("collect_job", f"{_P} SELECT 'panel' AS source, TRUE AS ok, count(*) AS rows, count(DISTINCT strftime(date, '%Y-%m')) AS new, CAST(0 AS BIGINT) AS revised, CAST(0 AS BIGINT) AS failed FROM panel UNION ALL SELECT 'broken', FALSE, NULL, NULL, NULL, NULL FROM (SELECT count(*) FROM nation) UNION ALL SELECT 'orders', TRUE, count(*), CAST(0 AS BIGINT), count(DISTINCT strftime(o_orderdate, '%Y-%m')) FILTER (WHERE o_orderkey % 50 = 0), CAST(1 AS BIGINT) FROM orders")
def _(s, d):
    def broken():
        raise ValueError("refused")

    root, keys = shared_folder(s), ["month", "ticker", "date"]
    p = panel(s, d).select(F.date_format("date", "yyyy-MM").alias("month"), "date", "ticker", "close")
    o = table(s, d, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.to_date("o_orderdate").alias("date"), F.col("o_orderkey").alias("ticker"), F.col("o_totalprice").alias("close"))
    jobs.collect(s, {"orders": lambda: o}, root, keys, "month")
    changed = o.withColumn("close", F.when(F.col("ticker") % 50 == 0, F.col("close") + 1000).otherwise(F.col("close")))
    failing = {"orders": lambda df: quality.identity(df, ["close"])}
    return jobs.collect(s, {"panel": lambda: p, "broken": broken, "orders": lambda: changed}, root, keys, "month", failing).drop("detail")


@query("write_candidates", f"{_A}, k AS (SELECT ticker, article_id, title, link, row_number() OVER (PARTITION BY ticker ORDER BY md5(concat_ws('|', article_id, CAST(ticker AS VARCHAR), '3')), article_id) AS k, count(*) OVER (PARTITION BY ticker) AS n FROM articles), c AS (SELECT * FROM k ORDER BY k, n DESC, ticker LIMIT 200) SELECT article_id, c.ticker, coalesce(s_name, '') AS name, title, link FROM c LEFT JOIN supplier ON s_suppkey = c.ticker")
def _(s, d):
    a, names, path = articles(s, d), table(s, d, "supplier").select(F.col("s_suppkey").alias("ticker"), F.col("s_name").alias("name")), shared_folder(s)
    jobs.write_candidates(labels.stratified_round_robin(a.select("ticker", "article_id"), 200, 3), a.select("article_id", "title", "link"), names, path)
    return jobs.read_jsonl(s, path, T.StructType.fromDDL("article_id string, ticker bigint, name string, title string, link string"))


@query("scan_flags", f"{_P} SELECT date, ticker, concat_ws(',', CASE WHEN foreign_net / trading_value > 0.5 THEN 'inflow' END, CASE WHEN foreign_net / trading_value < -0.5 THEN 'outflow' END, CASE WHEN inst_net / trading_value > 0.5 THEN 'volatility' END) AS flags FROM panel")
def _(s, d):
    f = report.scan_flags(F.col("foreign_net") / F.col("trading_value"), F.col("inst_net") / F.col("trading_value"), 0.5)
    return panel(s, d).select("date", "ticker", F.array_join(f, ",").alias("flags"))


@query("spine_left_join", f"{_P} SELECT p.date, p.ticker, {r('f.foreign_net', 'foreign_net')}, {r('h.short_balance', 'short_balance')} FROM panel p LEFT JOIN (SELECT * FROM panel WHERE foreign_net > 0) f USING (date, ticker) LEFT JOIN (SELECT * FROM panel WHERE short_balance > 0) h USING (date, ticker)")
def _(s, d):
    p, keys = panel(s, d), ["date", "ticker"]
    return sets.spine_left_join(p.select(*keys), keys, p.where("foreign_net > 0").select(*keys, "foreign_net"), p.where("short_balance > 0").select(*keys, "short_balance"))


@query("entity_candidate_join", f"{_E} SELECT article_id, ticker FROM j")
def _(s, d):
    return entity.touching(_articles(s, d), _entries(s, d), codes=False).select("article_id", "ticker")


@query("same_event_pairs", f"{_PAIRS.replace('jaccard >= 0.5', 'jaccard >= 0.35')} SELECT ticker, a, b, {r('jaccard')} FROM pairs")
def _(s, d):
    return similarity.same_event_pairs(titles(s, d), least=0.35)


@query("label_text_join", "SELECT l.doc_id, quality, toxic, n_chars FROM labels l JOIN documents USING (doc_id)")
def _(s, d):
    return labels.with_texts(table(s, d, "labels"), table(s, d, "documents").select("doc_id", "n_chars"), "doc_id")


@query("remaining_candidates", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def _(s, d):
    return labels.resume(table(s, d, "documents").select("doc_id"), table(s, d, "labels"), ["doc_id"])


@query("curve_intersection", f"{_BASKET} SELECT date, {r('c.ret', 'p')}, {r('bench.ret', 'b')} FROM carried c JOIN bench USING (date)")
def _(s, d):
    f = _forward(s, d)
    return evaluation.shared_sessions(evaluation.carried_returns(_held(s, d), f), evaluation.benchmark_returns(f, 1))


@query("basket_members", f"{_BASKET} SELECT p.date, p.ticker, {r('close')} FROM panel p JOIN held h ON h.date = p.date AND h.ticker = p.ticker")
def _(s, d):
    return evaluation.members(panel(s, d), _held(s, d)).select("date", "ticker", "close")


@query("gate_report_coverage", f"{_PS} SELECT session_date, count(o_orderkey) > 0 AS has_report FROM sessions LEFT JOIN orders ON CAST(o_orderdate AS DATE) = session_date GROUP BY session_date")
def _(s, d):
    return report.gate_report_coverage(sessions.sessions_of(panel(s, d)), table(s, d, "orders"), "o_orderdate")


@query("revision_change", f"{_P} SELECT a.date, a.ticker, {r('a.close / nullif(b.close, 0) - 1', 'change')} FROM panel a ASOF LEFT JOIN panel b ON a.ticker = b.ticker AND b.date <= a.date - INTERVAL 28 DAY")
def _(s, d):
    return features.revision_change(panel(s, d), 28, "close")


@query("news_polarity", f"{_A}, g AS (SELECT CAST(published_at AS DATE) AS date, feed, ticker, sum(score * (seq % 10)) / nullif(sum(seq % 10), 0) AS x, count(*)::DOUBLE AS y FROM articles GROUP BY ALL), pairs AS (SELECT date, x, y FROM g WHERE x IS NOT NULL), ranked AS (SELECT date, rank() OVER (PARTITION BY date ORDER BY x) + (count(*) OVER (PARTITION BY date, x) - 1) / 2.0::DOUBLE AS rx, rank() OVER (PARTITION BY date ORDER BY y) + (count(*) OVER (PARTITION BY date, y) - 1) / 2.0::DOUBLE AS ry FROM pairs) SELECT date, count(*) AS n, {r('corr(rx, ry)', 'ic')} FROM ranked GROUP BY date HAVING count(DISTINCT rx) > 1 AND count(DISTINCT ry) > 1")
def _(s, d):
    w = F.col("seq") % 10
    g = articles(s, d).groupBy(F.to_date("published_at").alias("date"), "feed", "ticker").agg(F.try_divide(F.sum(F.col("score") * w), F.sum(w).cast("double")).alias("x"), F.count("*").cast("double").alias("y"))
    return evaluation.daily_ic(g, "x", "y")


@query("capped_messages", f"{_A}, k AS (SELECT feed, title, row_number() OVER (PARTITION BY feed ORDER BY seq) AS k, count(*) OVER (PARTITION BY feed) AS n FROM articles) SELECT feed, string_agg(title, ', ' ORDER BY k) FILTER (WHERE k <= 3) || CASE WHEN max(n) > 3 THEN ', ' || (max(n) - 3) || ' more' ELSE '' END AS message FROM k GROUP BY feed")
def _(s, d):
    return report.capped_messages(articles(s, d), "feed", "title", "seq", 3)


@query("paired_tail", f"{_SCORES}, k AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS k FROM pairs) SELECT date, ticker, {r('score')}, {r('excess')} FROM k WHERE k <= 60")
def _(s, d):
    return evaluation.paired_tail(_pairs(s, d), 60)


@query("union_all", f"{_P} SELECT 'panel' AS source, date, {r('close', 'value')} FROM panel UNION ALL SELECT 'orders', CAST(o_orderdate AS DATE), round(o_totalprice, 6) + 0.0 FROM orders")
def _(s, d):
    return sets.stacked({"panel": panel(s, d).select("date", F.col("close").alias("value")), "orders": table(s, d, "orders").select(F.to_date("o_orderdate").alias("date"), F.col("o_totalprice").alias("value"))})


@query("set_difference", f"{_PS}, o AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders) SELECT session_date AS day, 'missing' AS kind FROM sessions WHERE session_date NOT IN (SELECT day FROM o) UNION ALL SELECT day, 'extra' FROM o WHERE day NOT IN (SELECT session_date FROM sessions)")
def _(s, d):
    want = sessions.sessions_of(panel(s, d)).select(F.col("session_date").alias("day"))
    return sets.set_difference(want, table(s, d, "orders").select(F.to_date("o_orderdate").alias("day")))


@query("set_intersection", f"{_PS} SELECT DISTINCT session_date AS day FROM sessions WHERE session_date IN (SELECT CAST(o_orderdate AS DATE) FROM orders)")
def _(s, d):
    return sets.set_intersection(sessions.sessions_of(panel(s, d)).select(F.col("session_date").alias("day")), table(s, d, "orders").select(F.to_date("o_orderdate").alias("day")))


@query("key_set_compare", f"{_P}, o AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date, o_custkey AS ticker FROM orders), j AS (SELECT coalesce(p.date, o.date) AS date, p.ticker AS a, o.ticker AS b FROM (SELECT date, ticker FROM panel) p FULL JOIN o USING (date, ticker)) SELECT date, count(*) FILTER (WHERE b IS NULL) AS lost, count(*) FILTER (WHERE a IS NULL) AS gained FROM j GROUP BY date")
def _(s, d):
    after = table(s, d, "orders").select(F.to_date("o_orderdate").alias("date"), F.col("o_custkey").alias("ticker"))
    return sets.key_set_compare(panel(s, d), after, ["date", "ticker"], "date")


_LINES = """WITH lines AS (SELECT doc_id, CAST(unnest(range(0, len(string_split(text, chr(10))))) AS INT) AS line, unnest(string_split(text, chr(10))) AS said_text FROM documents),
mentions AS (SELECT doc_id, line, 'Licensed' AS ticker FROM lines WHERE contains(replace(said_text, 'Licensed under CC', chr(1)), 'Licensed') UNION SELECT doc_id, line, 'Released' FROM lines WHERE contains(said_text, 'Released') OR contains(said_text, 'This work')),
said AS (SELECT doc_id, line, w AS said FROM lines, (VALUES ('License'), ('GNU')) v(w) WHERE contains(said_text, w))"""


def _lines(s, d):
    return table(s, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "said_text"))


def _mentions(s, d):
    entries = [("Licensed", "Licensed", ["Licensed"], ["Licensed under CC"]), ("Released", None, ["This work"], None)]
    return entity.mentions(_lines(s, d), s.createDataFrame(entries, "ticker string, canonical string, aliases array<string>, exclude array<string>"))


def _said(s, d):
    return entity.claimed_labels(_lines(s, d), ["License", "GNU"])


def _verdicts(s, d):
    docs = table(s, d, "documents").select("doc_id", "text")
    ratings = s.createDataFrame([("Licensed", "License"), ("Released", "GNU")], "ticker string, rating string")
    return entity.commentary_consistency(docs, ratings, _mentions(s, d), _said(s, d))


@query("mention_extraction", f"{_LINES} SELECT doc_id, line, ticker FROM mentions")
def _(s, d):
    return _mentions(s, d)


@query("label_extraction", f"{_LINES} SELECT doc_id, line, said FROM said")
def _(s, d):
    return _said(s, d)


_VERDICTS = f"""{_LINES}, para AS (SELECT *, sum(CASE WHEN trim(said_text) = '' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line) AS para FROM lines),
named AS (SELECT doc_id, line, count(DISTINCT ticker) AS n, min(ticker) AS ticker FROM mentions GROUP BY ALL),
carried AS (SELECT p.doc_id, p.line, last_value(n IGNORE NULLS) OVER w AS n, last_value(ticker IGNORE NULLS) OVER w AS ticker FROM para p LEFT JOIN named USING (doc_id, line) WINDOW w AS (PARTITION BY p.doc_id, para ORDER BY p.line)),
verdicts AS (SELECT c.doc_id, c.line, CASE WHEN n = 1 THEN ticker END AS ticker, said, CASE WHEN n = 1 THEN CASE ticker WHEN 'Licensed' THEN 'License' ELSE 'GNU' END END AS rating FROM carried c JOIN said USING (doc_id, line) WHERE n IS NOT NULL)"""
_VERDICT = "CASE WHEN ticker IS NULL THEN 'ambiguous' WHEN said = rating THEN 'agrees' ELSE 'contradicts' END"


@query("commentary_consistency", f"{_VERDICTS} SELECT doc_id, line, ticker, said, rating, {_VERDICT} AS verdict FROM verdicts")
def _(s, d):
    return _verdicts(s, d)


@query("consistency_report", f"{_VERDICTS} SELECT doc_id, count(*) FILTER (WHERE {_VERDICT} <> 'ambiguous') AS checked, count(*) FILTER (WHERE {_VERDICT} = 'contradicts') AS contradictions, count(*) FILTER (WHERE {_VERDICT} = 'ambiguous') AS ambiguous, count(*) FILTER (WHERE {_VERDICT} = 'contradicts') = 0 AS ok FROM verdicts GROUP BY doc_id")
def _(s, d):
    return conflicts.consistency_report(_verdicts(s, d))


_LABELLED = f"""{_PAIRS}, base AS (SELECT t.article_id, ticker, title, quality, toxic FROM titles t JOIN labels ON doc_id = article_id),
labelled AS (SELECT article_id, ticker, title, CASE WHEN toxic = 1 THEN 'irrelevant' WHEN quality = 1 THEN 'positive' ELSE 'negative' END AS bucket, CASE WHEN article_id % 3 = 0 THEN '한국증권' ELSE 'a company' END AS name, CASE WHEN article_id % 2 = 0 THEN '목표가 상향' ELSE '' END AS description FROM base
UNION ALL SELECT article_id, 'other', title, CASE WHEN article_id % 2 = 0 THEN 'positive' ELSE 'negative' END, 'another', '' FROM base WHERE article_id % 5 = 0)"""


def _labelled(s, d):
    """Labelled titles: a bucket from the labels, brokers and their views by id, and a second entity for every fifth article."""
    i = F.col("article_id")
    base = titles(s, d).join(table(s, d, "labels").withColumnRenamed("doc_id", "article_id"), "article_id")
    own = base.select("article_id", "ticker", "title", F.when(F.col("toxic") == 1, "irrelevant").when(F.col("quality") == 1, "positive").otherwise("negative").alias("bucket"), F.when(i % 3 == 0, "한국증권").otherwise("a company").alias("name"), F.when(i % 2 == 0, "목표가 상향").otherwise("").alias("description"))
    other = base.where(i % 5 == 0).select("article_id", F.lit("other").alias("ticker"), "title", F.when(i % 2 == 0, "positive").otherwise("negative").alias("bucket"), F.lit("another").alias("name"), F.lit("").alias("description"))
    return own.unionByName(other)


@query("label_conflict_flags", f"""{_LABELLED}, f AS (SELECT p.ticker, p.a, p.b FROM pairs p JOIN labelled x ON x.article_id = a AND x.ticker = p.ticker JOIN labelled y ON y.article_id = p.b AND y.ticker = p.ticker WHERE x.bucket <> y.bucket)
SELECT a AS article_id, ticker, 'contradiction' AS flag FROM f UNION SELECT b, ticker, 'contradiction' FROM f
UNION SELECT article_id, ticker, 'shared_sign' FROM labelled WHERE article_id IN (SELECT article_id FROM labelled GROUP BY article_id HAVING count(*) > 1 AND min(bucket) = max(bucket) AND min(bucket) <> 'irrelevant')
UNION SELECT article_id, ticker, 'author_mention' FROM labelled WHERE bucket <> 'irrelevant' AND contains(name, '증권') AND contains(description, '목표가')""")
def _(s, d):
    members = written(similarity.titled(titles(s, d)))
    return conflicts.label_conflicts(_labelled(s, d), similarity.alike_classes(members), members)


_WORDS = ("외국인 순매수", "기관 수급에 급등", "외인 매물에 급락", "공급 계약에 급등", "plain")
_RANGED = f"""{_A}, rows AS (SELECT article_id, ticker, CASE seq % 4 WHEN 0 THEN 'positive' WHEN 1 THEN 'negative' WHEN 2 THEN 'irrelevant' ELSE 'mixed' END AS bucket, CASE WHEN seq % 6 = 0 THEN '한국증권' ELSE 'a company' END AS name, CASE seq % 5 {' '.join(f"WHEN {i} THEN '{w}'" for i, w in enumerate(_WORDS))} END AS title,
CASE WHEN seq % 7 = 0 THEN '투자의견' ELSE '' END AS description, CASE WHEN seq % 17 <> 0 THEN (seq % 11) / 10.0::DOUBLE END AS relevance, CASE WHEN seq % 19 <> 0 THEN (seq % 21) / 10.0::DOUBLE - 1 END AS polarity, (seq % 13) / 12.0::DOUBLE AS intensity FROM articles)"""


@query("score_conflicts", f"""{_RANGED}, x AS (SELECT *, contains(name, '증권') AND contains(description, '투자의견') AS author,
regexp_matches(title, '초고수|차익실현|차익 실현|수급|매수세|매도세|공매도|패시브|지수 편입|거래대금|순매수|순매도') AS structure, regexp_matches(title, '폭락|급등|급락|반등') AND regexp_matches(title, '외인|외국인|기관|수급') AS price FROM rows)
SELECT article_id, ticker, 'polarity' AS dimension, 'sign against bucket' AS flag FROM x WHERE (bucket = 'positive' AND polarity <= 0) OR (bucket = 'negative' AND polarity >= 0)
UNION ALL SELECT article_id, ticker, 'polarity', 'polar though irrelevant' FROM x WHERE bucket = 'irrelevant' AND abs(polarity) >= 0.4
UNION ALL SELECT article_id, ticker, 'polarity', 'polar though an author' FROM x WHERE author AND abs(polarity) >= 0.2
UNION ALL SELECT article_id, ticker, 'relevance', CASE WHEN bucket = 'irrelevant' THEN 'relevant though irrelevant' WHEN structure THEN 'market structure' ELSE 'price move' END FROM x WHERE relevance >= 0.5 AND (bucket = 'irrelevant' OR structure OR price)
UNION ALL SELECT article_id, ticker, unnest(['relevance', 'intensity']), 'detached' FROM x WHERE relevance <= 0.3 AND intensity >= 0.7""")
def _(s, d):
    k, a = F.col("seq"), articles(s, d)
    rows = a.select(
        "article_id", "ticker", F.element_at(F.array(*map(F.lit, ("positive", "negative", "irrelevant", "mixed"))), (k % 4 + 1).cast("int")).alias("bucket"), F.when(k % 6 == 0, "한국증권").otherwise("a company").alias("name"),
        F.element_at(F.array(*map(F.lit, _WORDS)), (k % 5 + 1).cast("int")).alias("title"), F.when(k % 7 == 0, "투자의견").otherwise("").alias("description"),
        F.when(k % 17 != 0, (k % 11) / 10.0).alias("relevance"), F.when(k % 19 != 0, (k % 21) / 10.0 - 1).alias("polarity"), ((k % 13) / 12.0).alias("intensity"),
    )
    return conflicts.score_conflicts(rows)


@query("score_divergence", f"""{_T}, t AS (SELECT article_id, ticker, list_distinct(regexp_extract_all(title, '[가-힣A-Za-z0-9]+')) AS t, (length % 10) / 9.0::DOUBLE AS relevance, (length % 7) / 6.0::DOUBLE AS polarity FROM titles),
p AS (SELECT a.ticker, a.article_id AS a, b.article_id AS b, a.relevance AS ra, b.relevance AS rb, a.polarity AS pa, b.polarity AS pb FROM t a JOIN t b ON a.ticker = b.ticker AND a.article_id <> b.article_id WHERE len(a.t) > 0 AND len(b.t) > 0 AND len(list_intersect(a.t, b.t))::DOUBLE / least(len(a.t), len(b.t)) >= 0.35)
SELECT a AS article_id, ticker, 'relevance' AS dimension, b AS against, {r('abs(ra - rb)', 'gap')} FROM p WHERE abs(ra - rb) >= 0.4 UNION ALL SELECT a, ticker, 'polarity', b, {r('abs(pa - pb)', 'gap')} FROM p WHERE abs(pa - pb) >= 0.4""".replace(_T, sql("titles")))
def _(s, d):
    t = titles(s, d).withColumns({"relevance": (F.col("length") % 10) / 9.0, "polarity": (F.col("length") % 7) / 6.0})
    dims = ["relevance", "polarity"]
    return conflicts.divergence(similarity.same_event_pairs(t, least=conflicts.DIVERGENCE_SIMILARITY, overlap=True, carry=dims), dims)


@query("live_examples", f"""{_A}, f AS (SELECT article_id, arg_min(title, published_at) AS title FROM articles WHERE CAST(published_at AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' GROUP BY article_id), p AS (SELECT DISTINCT article_id, ticker FROM articles JOIN f USING (article_id) WHERE feed <> 'view'),
k AS (SELECT article_id, ticker, row_number() OVER (PARTITION BY ticker ORDER BY md5(concat_ws('|', article_id, CAST(ticker AS VARCHAR), '11')), article_id) AS k, count(*) OVER (PARTITION BY ticker) AS n FROM p), c AS (SELECT * FROM k ORDER BY k, n DESC, ticker LIMIT 300)
SELECT article_id, c.ticker, coalesce(s_name, '') AS name, title FROM c JOIN f USING (article_id) LEFT JOIN supplier ON s_suppkey = c.ticker""")
def _(s, d):
    a = articles(s, d).withColumns({"day": F.to_date("published_at"), "description": F.lit("")})
    copies = a.unionByName(a.where("seq % 4 = 0").withColumns({"published_at": F.col("published_at") + F.expr("interval 1 hour"), "title": F.lit("a later copy")}))
    resolved = a.select("article_id", "ticker", F.when(F.col("feed") == "view", "ambiguous").otherwise("matched").alias("status"))
    names = table(s, d, "supplier").select(F.col("s_suppkey").alias("ticker"), F.col("s_name").alias("name"))
    return labels.live_examples(copies, resolved, names, "2024-01-05", "2024-01-20").drop("description")


@query("check_known_date", "SELECT 'order_1' AS name, count(*) = 1 AND max(CAST(o_orderdate AS DATE)) = DATE '1996-01-02' AS passed, 'rows=' || count(*) || ' value=' || coalesce(CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR), '') AS detail FROM orders WHERE o_orderkey = 1")
def _(s, d):
    first = table(s, d, "orders").select(F.col("o_orderkey"), F.to_date("o_orderdate").alias("date"))
    return quality.known_date(first, "order_1", F.col("o_orderkey") == 1, "date", "1996-01-02")


@query("news_table", f"{_A} SELECT ticker, n, headline, CAST(row_number() OVER (ORDER BY n DESC, ticker) AS INT) AS place FROM (SELECT ticker, count(*) AS n, arg_min(title, (published_at, article_id)) AS headline FROM articles GROUP BY ticker)")
def _(s, d):
    a = articles(s, d)
    return report.news_table(entity.news_rollup(a.select("article_id", "ticker"), a))


@query("calendar_table", "SELECT CASE WHEN CAST(ts AS DATE) = DATE '2024-01-15' THEN 'today' ELSE 'tomorrow' END AS \"when\", event_id AS event, CAST(ts AS DATE) AS date FROM events WHERE CAST(ts AS DATE) IN (DATE '2024-01-15', DATE '2024-01-16')")
def _(s, d):
    return report.calendar_table(table(s, d, "events").select(F.col("event_id").alias("event"), F.to_date("ts").alias("date")), "2024-01-15")


@query("shadow_table", f"{_BASKET} SELECT date, {r('portfolio')}, {r('benchmark')}, {r('portfolio - benchmark', 'excess')} FROM track")
def _(s, d):
    return report.shadow_table(_track(s, d))


@query("ic_table", f"{_RANKED} SELECT strftime(date, '%Y') AS year, count(*) AS n, {r('avg(ic)', 'mean_ic')}, {r('stddev_samp(ic)', 'sd_ic')} FROM ic GROUP BY 1")
def _(s, d):
    return report.ic_table(evaluation.daily_ic(_pairs(s, d)))


@query("calibration_table", f"{_RATED} SELECT rating, count(*) AS n, {r('avg(abs(score))', 'mean_abs')}, {r('avg(coverage)', 'coverage')} FROM rated GROUP BY rating")
def _(s, d):
    return report.calibration_table(_rated(s, d))


@query("bakeoff_table", f"{_T} SELECT model, count(*) AS calls, {r('(count(*) FILTER (WHERE ok))::DOUBLE / nullif(count(*) FILTER (WHERE ok OR failure <> $$transport$$), 0)', 'ratio')}, {r('avg(latency_s)', 'latency_s')} FROM attempts GROUP BY model")
def _(s, d):
    a = attempts(s, d)
    return report.bakeoff_table(labels.compliance(a), labels.mean_latency(a))


def _dropped(s, d):
    """The events as JSON lines in shared storage, twice, as overlapping polls would leave them."""
    path = shared_folder(s)
    a = articles(s, d).select("article_id", "feed", "title", "link", "published_at")
    a.write.json(f"{path}/in/a")
    a.where("seq % 2 = 0").write.json(f"{path}/in/b")
    return path


def _finished(writer):
    writer.trigger(availableNow=True).start().awaitTermination()


@query("stream_new_articles", f"{_A} SELECT article_id, feed FROM articles")
def _(s, d):
    path = _dropped(s, d)
    new = streams.new_articles(streams.stream_articles(s, f"{path}/in"), "60 days").select("article_id", "feed")
    _finished(new.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/cp"))
    return s.read.parquet(f"{path}/out")


@query("stream_entity_counts", f"""{_A}, said AS (SELECT article_id, published_at, title || ' ' || a.n_name AS title, b.n_name AS description FROM articles LEFT JOIN nation a ON a.n_nationkey = seq % 25 LEFT JOIN nation b ON b.n_nationkey = ticker % 25)
SELECT CAST(published_at AS DATE) AS day, n_nationkey AS ticker, count(*) AS n FROM said JOIN nation ON contains(coalesce(title, ''), n_name) OR contains(coalesce(description, ''), n_name) GROUP BY ALL""")
def _(s, d):
    path, nation = shared_folder(s), table(s, d, "nation").select("n_nationkey", "n_name")
    one, other = (nation.select(F.col("n_nationkey").alias(f"{k}_key"), F.col("n_name").alias(f"{k}_name")) for k in ("one", "other"))
    said = articles(s, d).join(F.broadcast(one), F.col("seq") % 25 == F.col("one_key"), "left").join(F.broadcast(other), F.col("ticker") % 25 == F.col("other_key"), "left")
    said = said.select("seq", "article_id", "published_at", F.concat("title", F.lit(" "), "one_name").alias("title"), F.col("other_name").alias("description"))
    said.write.json(f"{path}/in/a")
    said.where("seq % 2 = 0").write.json(f"{path}/in/b")  # polled again
    none = F.lit(None).cast("array<string>")
    entries = nation.select(F.col("n_nationkey").alias("ticker"), F.array("n_name").alias("aliases"), none.alias("exclude"), none.alias("ambiguous_parents"))
    counts = streams.entity_counts(streams.stream_articles(s, f"{path}/in"), entries, "60 days")
    batch = lambda df, i: df.write.mode("overwrite").parquet(f"{path}/out/batch={i}")
    _finished(counts.writeStream.outputMode("update").foreachBatch(batch).option("checkpointLocation", f"{path}/cp"))
    return s.read.parquet(f"{path}/out").groupBy("day", "ticker").agg(F.max_by("n", "batch").alias("n"))


@query("stream_quality", f"{_A} SELECT feed, count(*) + count(*) FILTER (WHERE seq % 2 = 0) AS n, CAST(0 AS BIGINT) AS foreign_host FROM articles GROUP BY feed")
def _(s, d):
    path = _dropped(s, d)
    read = streams.stream_articles(s, f"{path}/in").withColumn("domain", F.concat("feed", F.lit(".example.com")))
    _finished(streams.quality_counters(read, f"{path}/out", "2024-01-20 00:00:00").option("checkpointLocation", f"{path}/cp"))
    return s.read.parquet(f"{path}/out").groupBy("feed").agg(F.sum("n").alias("n"), F.sum("foreign_host").alias("foreign_host"))


_HALF = "(SELECT CAST(min(published_at) AS DATE) + CAST(date_diff('day', min(published_at), max(published_at)) // 2 AS INT) FROM articles)"


@query("stream_feed_progress", f"""{_A}, polled AS (SELECT feed, date_trunc('millisecond', published_at) AS moment, published_at >= {_HALF} AS later FROM articles WHERE feed <> 'error' OR published_at < {_HALF}),
polls AS (SELECT feed, max(moment) FILTER (WHERE NOT later) AS before, min(moment) FILTER (WHERE later) AS oldest, max(moment) AS newest FROM polled GROUP BY feed)
SELECT feed, newest, {r("coalesce(epoch_us(oldest) - epoch_us(before), 0) / 3.6e9", "lost_hours")}, newest < (SELECT max(newest) FROM polls) - INTERVAL 24 HOUR AS silent FROM polls""")
def _(s, d):
    """Two polls, the second without one feed, which falls silent."""
    path, key = shared_folder(s), "spark.sql.streaming.stateStore.providerClass"
    a = articles(s, d).select("article_id", "feed", "published_at")
    low, high = F.to_date(F.min("published_at")), F.to_date(F.max("published_at"))
    half = F.lit(a.agg(F.date_add(low, F.floor(F.datediff(high, low) / 2).cast("int")).cast("string")).first()[0]).cast("timestamp")
    before = s.conf.get(key, None)
    s.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        for poll in (a.where(F.col("published_at") < half), a.where((F.col("published_at") >= half) & (F.col("feed") != "error"))):
            poll.write.mode("append").json(f"{path}/in")
            got = streams.feed_progress(streams.stream_articles(s, f"{path}/in", 1_000_000), late="60 days")
            batch = lambda df, i: df.write.mode("overwrite").parquet(f"{path}/out/batch={i}")
            _finished(got.writeStream.outputMode("update").foreachBatch(batch).option("checkpointLocation", f"{path}/cp"))
    finally:
        s.conf.set(key, before) if before else s.conf.unset(key)
    said = s.read.parquet(f"{path}/out")
    return said.groupBy("feed").agg(F.max("newest").alias("newest"), F.max("lost_hours").alias("lost_hours"), F.max_by("silent", F.struct("newest", "silent")).alias("silent"))


