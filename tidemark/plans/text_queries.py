"""Entities, duplicates and topicality over documents, benchmark items and vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import entity, labels, similarity
from tidemark.plans.names import query, r
from tidemark.plans.panels import sql, table, titles
from tidemark.sources import articles as feed

_T = sql("titles")
_E = """WITH entries AS (SELECT item_id AS ticker, substr(text, 1, 40) AS alias, CASE WHEN item_id % 4 = 0 THEN substr(text, 1, 60) END AS exclude, substr(text, 1, 12) AS parent FROM benchmark),
j AS (SELECT d.doc_id AS article_id, e.*, CASE WHEN exclude IS NULL THEN ' ' || d.text ELSE replace(' ' || d.text, exclude, chr(1)) END AS masked FROM documents d JOIN entries e ON contains(d.text, e.parent)),
resolved AS (SELECT article_id, ticker, CASE WHEN contains(masked, alias) THEN 'matched' ELSE 'ambiguous' END AS status, CASE WHEN contains(masked, alias) THEN alias ELSE parent END AS matched_form, CASE WHEN contains(masked, alias) THEN 'alias' ELSE 'parent' END AS match_type FROM j WHERE contains(masked, parent)),
status AS (SELECT doc_id AS article_id, CASE WHEN count(*) FILTER (WHERE status = 'matched') > 0 THEN 'matched' WHEN count(status) > 0 THEN 'ambiguous' ELSE 'unmatched' END AS status, count(*) FILTER (WHERE status = 'matched') AS n FROM documents LEFT JOIN resolved ON article_id = doc_id GROUP BY doc_id)"""


def _entries(s, d):
    t = F.col("text")
    return table(s, d, "benchmark").select(F.col("item_id").alias("ticker"), F.array(F.substring(t, 1, 40)).alias("aliases"), F.when(F.col("item_id") % 4 == 0, F.array(F.substring(t, 1, 60))).alias("exclude"), F.array(F.substring(t, 1, 12)).alias("ambiguous_parents"))


def _articles(s, d):
    return table(s, d, "documents").select(F.col("doc_id").alias("article_id"), F.lit("").alias("title"), F.col("text").alias("description"))


def _resolved(s, d):
    return entity.resolve_entities(_articles(s, d), _entries(s, d), codes=False)


def _status(s, d):
    return entity.article_status(_articles(s, d), _resolved(s, d))


@query("resolve_entities", f"{_E} SELECT article_id, ticker, status, matched_form, match_type FROM resolved")
def _(s, d):
    return _resolved(s, d)


@query("matched_pairs", f"{_E} SELECT DISTINCT article_id, ticker FROM resolved WHERE status = 'matched'")
def _(s, d):
    return _resolved(s, d).where("status = 'matched'").select("article_id", "ticker").distinct()


@query("article_status", f"{_E} SELECT article_id, status, n FROM status")
def _(s, d):
    return _status(s, d)


@query("resolution_report", f"{_E} SELECT count(*) AS articles, count(*) FILTER (WHERE status = 'matched') AS matched, count(*) FILTER (WHERE status = 'ambiguous') AS ambiguous, count(*) FILTER (WHERE status = 'unmatched') AS unmatched, count(*) FILTER (WHERE n > 1) AS multi, {r('(count(*) FILTER (WHERE status = $$ambiguous$$))::DOUBLE / count(*)', 'ambiguous_ratio')}, (count(*) FILTER (WHERE status = 'ambiguous'))::DOUBLE / count(*) <= 0.3 AS within FROM status")
def _(s, d):
    return entity.resolution_report(_status(s, d))


@query("per_ticker_counts", f"{_E} SELECT ticker, count(*) AS n FROM resolved WHERE status = 'matched' GROUP BY ticker")
def _(s, d):
    return entity.counts_by(_resolved(s, d), "ticker")


@query("per_form_counts", f"{_E} SELECT ticker, matched_form, count(*) AS n FROM resolved WHERE status = 'matched' GROUP BY ALL")
def _(s, d):
    return entity.counts_by(_resolved(s, d), "ticker", "matched_form")


@query("dead_aliases", f"{_E} SELECT DISTINCT ticker, alias FROM entries e WHERE NOT EXISTS (SELECT 1 FROM resolved r WHERE r.ticker = e.ticker AND r.matched_form = e.alias AND match_type = 'alias')")
def _(s, d):
    return entity.dead_aliases(_entries(s, d), _resolved(s, d))


@query("coverage_gaps", f"{_E}, watch AS (SELECT DISTINCT ticker FROM entries UNION SELECT 100000 + n_nationkey FROM nation) SELECT ticker, 'no entry' AS reason FROM watch WHERE ticker NOT IN (SELECT ticker FROM entries) UNION ALL SELECT ticker, 'no match' FROM watch WHERE ticker IN (SELECT ticker FROM entries) AND ticker NOT IN (SELECT ticker FROM resolved WHERE status = 'matched')")
def _(s, d):
    watch = table(s, d, "benchmark").select(F.col("item_id").alias("ticker")).union(table(s, d, "nation").select((F.col("n_nationkey") + 100000).cast("bigint")))
    return entity.coverage_gaps(watch, _entries(s, d), _resolved(s, d))


@query("alias_audit", f"{_E}, t AS (SELECT ticker, article_id, row_number() OVER (PARTITION BY ticker ORDER BY article_id) AS k, source FROM (SELECT DISTINCT ticker, article_id FROM resolved WHERE status = 'matched') JOIN documents ON doc_id = article_id) SELECT ticker, count(*) AS articles, string_agg(source, ' | ' ORDER BY k) FILTER (WHERE k <= 3) AS samples FROM t GROUP BY ticker")
def _(s, d):
    return entity.alias_audit(_resolved(s, d), table(s, d, "documents").select(F.col("doc_id").alias("article_id"), F.col("source").alias("title")))


@query("group_prefix", "WITH n AS (SELECT DISTINCT p_type AS name FROM part WHERE length(p_type) > 2), x AS (SELECT name, unnest(range(2, length(name))) AS k FROM n), c AS (SELECT substr(name, 1, k) AS prefix FROM x GROUP BY 1 HAVING count(*) >= 3) SELECT name, arg_min(substr(name, 1, k), k) AS prefix FROM x JOIN c ON c.prefix = substr(name, 1, k) GROUP BY name")
def _(s, d):
    return entity.group_prefixes(table(s, d, "part").select(F.col("p_type").alias("name")))


@query("exclude_candidates", "WITH n AS (SELECT DISTINCT c_name AS name FROM customer UNION SELECT DISTINCT substr(c_name, 1, 12) FROM customer UNION SELECT DISTINCT substr(c_name, 10) FROM customer) SELECT a.name, b.name AS longer FROM n a JOIN n b ON contains(b.name, a.name) AND a.name <> b.name")
def _(s, d):
    c = table(s, d, "customer").select(F.col("c_name").alias("name"))
    return entity.exclude_candidates(c.union(c.select(F.substring("name", 1, 12))).union(c.select(F.substring("name", 10, 1000))))


@query("name_lookup", "WITH q AS (SELECT DISTINCT p_brand AS query FROM part UNION SELECT n_name FROM nation UNION SELECT 'AN'), l AS (SELECT n_name AS name FROM nation), c AS (SELECT query, count(name) AS n, max(CASE WHEN name = query THEN name END) AS exact, min(name) AS single FROM q LEFT JOIN l ON contains(name, query) GROUP BY query) SELECT query, n, CASE WHEN exact IS NOT NULL THEN 'exact' WHEN n = 0 THEN 'not found' WHEN n > 1 THEN 'ambiguous' ELSE 'found' END AS state, coalesce(exact, CASE WHEN n = 1 THEN single END) AS found FROM c")
def _(s, d):
    q = table(s, d, "part").select(F.col("p_brand").alias("query")).union(table(s, d, "nation").select("n_name")).union(table(s, d, "nation").select(F.lit("AN")))
    return entity.name_lookup(q, table(s, d, "nation").select(F.col("n_name").alias("name")))


_TOK = r"list_distinct(regexp_extract_all(title, '[가-힣A-Za-z0-9]+'))"
_PAIRS = f"""{_T}, t AS (SELECT article_id, ticker, length, {_TOK} AS t FROM titles), p AS (SELECT a.ticker, a.article_id AS a, b.article_id AS b, len(list_intersect(a.t, b.t))::DOUBLE / len(list_distinct(list_concat(a.t, b.t))) AS jaccard FROM t a JOIN t b ON a.ticker = b.ticker AND a.article_id < b.article_id WHERE len(a.t) > 0 AND len(b.t) > 0), pairs AS (SELECT * FROM p WHERE jaccard >= 0.5)"""


@query("title_jaccard_same_event", f"{_PAIRS} SELECT ticker, a, b, {r('jaccard')} FROM pairs")
def _(s, d):
    return similarity.same_event_pairs(titles(s, d))


_V = """WITH v AS (SELECT vec_id AS article_id, label AS ticker, embedding::DOUBLE[] AS v FROM embeddings), pairs AS (SELECT * FROM (SELECT a.ticker, a.article_id AS a, b.article_id AS b, list_dot_product(a.v, b.v) AS cosine FROM v a JOIN v b ON a.ticker = b.ticker AND a.article_id < b.article_id) WHERE cosine >= 0.30),
reach AS (SELECT article_id AS x, article_id AS y FROM v UNION SELECT reach.x, l.b FROM reach JOIN (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs) l ON l.a = reach.y), comp AS (SELECT x AS article_id, min(y) AS cluster FROM reach GROUP BY x),
c AS (SELECT ticker, article_id, cluster, article_id = max(article_id) OVER (PARTITION BY ticker, cluster) AS kept FROM comp JOIN v USING (article_id))""".replace("WITH v", "WITH RECURSIVE v")


def _vectors(s, d):
    return table(s, d, "embeddings").select(F.col("vec_id").alias("article_id"), F.col("label").alias("ticker"), F.col("embedding").alias("vector"), F.lit(64).alias("length"))


def _clusters(s, d):
    v = _vectors(s, d)
    return similarity.cluster_duplicates(v, similarity.similarity_pairs(v, 0.30))


@query("similarity_pairs", f"{_V} SELECT ticker, a, b, {r('cosine')} FROM pairs")
def _(s, d):
    return similarity.similarity_pairs(_vectors(s, d), 0.30)


@query("cluster_duplicates", f"{_V} SELECT ticker, article_id, cluster, kept FROM c")
def _(s, d):
    return _clusters(s, d)


@query("dedup_report", f"{_V}, g AS (SELECT ticker, cluster, count(*) AS n, count(*) FILTER (WHERE kept) AS k FROM c GROUP BY ALL) SELECT ticker, CAST(sum(n) AS BIGINT) AS articles, CAST(sum(k) AS BIGINT) AS kept, CAST(sum(n) - sum(k) AS BIGINT) AS dropped, count(*) FILTER (WHERE n > 1) AS clusters FROM g GROUP BY ticker")
def _(s, d):
    return similarity.dedup_report(_clusters(s, d))


@query("topicality_filter", f"""{_V}, prof AS (SELECT ticker, v AS p FROM v WHERE article_id IN (SELECT min(article_id) FROM v GROUP BY ticker)) SELECT article_id, v.ticker, {r('list_dot_product(v, p)', 'cosine')} FROM v JOIN prof ON prof.ticker = v.ticker WHERE list_dot_product(v, p) >= 0.1""")
def _(s, d):
    v = _vectors(s, d)
    profiles = v.groupBy("ticker").agg(F.min_by("vector", "article_id").alias("vector"))
    return similarity.topicality(v, profiles, 0.1).select("article_id", "ticker", "cosine")


@query("topicality_report", f"""{_V}, prof AS (SELECT ticker, v AS p FROM v WHERE article_id IN (SELECT min(article_id) FROM v GROUP BY ticker)) SELECT v.ticker, count(*) AS pairs, count(*) FILTER (WHERE list_dot_product(v, p) >= 0.1) AS kept, count(*) FILTER (WHERE list_dot_product(v, p) < 0.1) AS dropped FROM v JOIN prof ON prof.ticker = v.ticker GROUP BY v.ticker""")
def _(s, d):
    v = _vectors(s, d)
    kept = similarity.topicality(v, v.groupBy("ticker").agg(F.min_by("vector", "article_id").alias("vector")), 0.1)
    return similarity.topicality_report(v, kept)


@query("dedup_calibration", f"{_V} SELECT a % 2 = b % 2 AS is_duplicate, count(*) AS n, {r('min(cosine)', 'least')}, {r('avg(cosine)', 'mean')}, {r('max(cosine)', 'most')} FROM pairs GROUP BY ALL")
def _(s, d):
    pairs = similarity.similarity_pairs(_vectors(s, d), 0.30)
    return similarity.dedup_calibration(pairs, pairs.where("a % 2 = b % 2").select("a", "b"))


@query("build_profiles", "SELECT s_suppkey + 0 AS ticker, s_name || ' (' || s_suppkey || ')' || coalesce(', ' || n_name, '') AS sentence FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey")
def _(s, d):
    e = table(s, d, "supplier").join(table(s, d, "nation"), F.col("n_nationkey") == F.col("s_nationkey"), "left")
    return similarity.profiles(e.select(F.col("s_suppkey").alias("ticker"), F.col("s_name").alias("name"), F.col("n_name").alias("sector")))


@query("embed_texts")
def _(s, d):
    return similarity.embed_texts(titles(s, d).select("article_id", "title"), text="title", size=32).select("article_id", "vector")


@query("article_text", "SELECT doc_id, trim(source || ' ' || lang) AS text FROM documents")
def _(s, d):
    return table(s, d, "documents").select("doc_id", feed.article_text(F.col("source"), F.col("lang")).alias("text"))


@query("clip_text", "SELECT doc_id, substr(text, 1, 400) AS clipped FROM documents")
def _(s, d):
    return table(s, d, "documents").select("doc_id", feed.clip_text(F.col("text")).alias("clipped"))


@query("first_n_per_bucket_skip_same_event")
def _(s, d):
    t = titles(s, d)
    rows = t.select(F.col("ticker").alias("bucket"), F.col("article_id").alias("seq"), "article_id", similarity.tokens("title").alias("tokens"))
    return labels.first_n_per_bucket(rows)
