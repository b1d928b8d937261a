"""Attempts of models, label logs and raters over events and labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import labels, rolling
from tidemark.plans.names import query, r
from tidemark.plans.panels import articles, attempts, sql, table
from tidemark.sources import articles as feed

_T, _A = sql("attempts"), sql("articles")
_DIMS = ("relevance", "polarity")
_LONG = f"{_T}, long AS (SELECT model, example, repeat, ok, 'relevance' AS dimension, relevance AS value FROM attempts UNION ALL SELECT model, example, repeat, ok, 'polarity', polarity FROM attempts), first AS (SELECT * FROM long WHERE ok AND repeat = 0)"


def _corr(pairs: str, groups: str) -> str:
    """Guarded rank correlation in DuckDB of a relation (groups, x, y)."""
    return f"""ranked AS (SELECT {groups}, rank() OVER (PARTITION BY {groups} ORDER BY x) + (count(*) OVER (PARTITION BY {groups}, x) - 1) / 2.0::DOUBLE AS rx, rank() OVER (PARTITION BY {groups} ORDER BY y) + (count(*) OVER (PARTITION BY {groups}, y) - 1) / 2.0::DOUBLE AS ry FROM {pairs}),
corrs AS (SELECT {groups}, count(*) AS n, CASE WHEN count(DISTINCT rx) > 1 AND count(DISTINCT ry) > 1 THEN corr(rx, ry) END AS corr FROM ranked GROUP BY {groups})"""


@query("self_consistency", f"{_LONG}, e AS (SELECT model, dimension, example, stddev_samp(value) AS sd, count(*) AS n FROM long WHERE ok AND value IS NOT NULL GROUP BY ALL HAVING count(*) > 1) SELECT model, dimension, {r('avg(sd)', 'sd')} FROM e GROUP BY ALL")
def _(s, d):
    return labels.self_consistency(attempts(s, d), ["example"], _DIMS)


@query("schema_compliance", f"{_T} SELECT model, count(*) AS calls, count(*) FILTER (WHERE ok OR failure <> 'transport') AS answered, count(*) FILTER (WHERE ok) AS ok, count(*) FILTER (WHERE failure = 'transport') AS transport, {r('(count(*) FILTER (WHERE ok))::DOUBLE / nullif(count(*) FILTER (WHERE ok OR failure <> $$transport$$), 0)', 'ratio')} FROM attempts GROUP BY model")
def _(s, d):
    return labels.compliance(attempts(s, d))


@query("transport_failures", f"{_T} SELECT model, count(*) FILTER (WHERE failure = 'transport') AS transport FROM attempts GROUP BY model")
def _(s, d):
    return labels.compliance(attempts(s, d)).select("model", "transport")


@query("answered", f"{_T} SELECT model, example, repeat, ok OR coalesce(failure, '') <> 'transport' AS answered FROM attempts")
def _(s, d):
    return attempts(s, d).select("model", "example", "repeat", labels.answered().alias("answered"))


@query("cost_per_valid_signal", f"{_T} SELECT model, {r('sum(CAST(cost_usd AS DECIMAL(18,4)))::DOUBLE / nullif(count(DISTINCT CASE WHEN ok AND relevance > 0.5 THEN example END), 0)', 'cost')} FROM attempts GROUP BY model")
def _(s, d):
    return labels.cost_per_signal(attempts(s, d).withColumn("cost_usd", F.col("cost_usd").cast("decimal(18,4)")))


@query("mean_latency", f"{_T} SELECT model, {r('avg(latency_s)', 'latency_s')}, count(*) AS calls, string_agg(DISTINCT CAST(example % 3 AS VARCHAR), ',' ORDER BY CAST(example % 3 AS VARCHAR)) AS temperatures FROM attempts GROUP BY model")
def _(s, d):
    return labels.mean_latency(attempts(s, d).withColumn("temperature", (F.col("example") % 3).cast("string")))


_INTER = f"{_LONG}, pairs AS (SELECT a.model AS model_a, b.model AS model_b, a.dimension, a.value AS x, b.value AS y FROM first a JOIN first b USING (example, dimension) WHERE a.model < b.model AND a.value IS NOT NULL AND b.value IS NOT NULL), {_corr('pairs', 'model_a, model_b, dimension')}"


@query("inter_model", f"{_INTER} SELECT model_a, model_b, dimension, n, {r('corr')} FROM corrs")
def _(s, d):
    return labels.inter_model(attempts(s, d), ["example"], _DIMS)


@query("gate_verdict", f"{_INTER} SELECT bool_and(coalesce(corr > -0.2, FALSE)) AS passed, count(*) AS pairs, count(*) FILTER (WHERE NOT coalesce(corr > -0.2, FALSE)) AS below FROM corrs")
def _(s, d):
    return labels.gate_verdict(labels.inter_model(attempts(s, d), ["example"], _DIMS), -0.2)


_BARS = {"relevance": 0.0, "polarity": 0.01}


@query("model_bars", f"""{_LONG}, pairs AS (SELECT a.model, a.dimension, a.value AS x, b.value AS y FROM first a JOIN long b ON b.model = 'click' AND b.repeat = 1 AND b.example = a.example AND b.dimension = a.dimension WHERE a.value IS NOT NULL AND b.value IS NOT NULL), {_corr('pairs', 'model, dimension')},
e AS (SELECT model, dimension, example, stddev_samp(value) AS sd FROM long WHERE ok AND value IS NOT NULL GROUP BY ALL HAVING count(*) > 1), sds AS (SELECT model, avg(sd) AS sd FROM e WHERE dimension = 'polarity' GROUP BY model),
comp AS (SELECT model, (count(*) FILTER (WHERE ok))::DOUBLE / nullif(count(*) FILTER (WHERE ok OR failure <> 'transport'), 0) AS ratio FROM attempts GROUP BY model),
j AS (SELECT comp.model, ratio, sd, r.corr AS rc, p.corr AS pc FROM comp LEFT JOIN sds USING (model) LEFT JOIN corrs r ON r.model = comp.model AND r.dimension = 'relevance' LEFT JOIN corrs p ON p.model = comp.model AND p.dimension = 'polarity'),
t AS (SELECT model, concat_ws('; ', CASE WHEN NOT coalesce(rc > 0.0, FALSE) THEN 'relevance correlation ' || coalesce(printf('%.2f', rc), '—') || ' <= 0.0' END, CASE WHEN NOT coalesce(pc > 0.01, FALSE) THEN 'polarity correlation ' || coalesce(printf('%.2f', pc), '—') || ' <= 0.01' END,
CASE WHEN NOT coalesce(sd < 0.05, FALSE) THEN 'polarity deviation ' || coalesce(printf('%.3f', sd), '—') || ' >= 0.05' END, CASE WHEN ratio IS NULL THEN 'compliance unmeasured' WHEN ratio <= 0.95 THEN 'compliance ' || printf('%.3f', ratio) || ' <= 0.95' END) AS reasons FROM j)
SELECT model, reasons = '' AS passed, reasons FROM t""")
def _(s, d):
    a = attempts(s, d)
    correlation = labels.rater_correlation(labels.first_pass(a), a.where("model = 'click' AND repeat = 1"), ["example"], _DIMS, "model")
    return labels.model_bars(correlation, labels.self_consistency(a, ["example"], _DIMS), labels.compliance(a), _BARS, ("polarity", 0.05), 0.95)


@query("rater_correlation", f"{_LONG}, pairs AS (SELECT a.model, a.dimension, a.value AS x, b.value AS y FROM first a JOIN long b ON b.model = 'click' AND b.repeat = 1 AND b.example = a.example AND b.dimension = a.dimension WHERE a.value IS NOT NULL AND b.value IS NOT NULL), {_corr('pairs', 'model, dimension')} SELECT model, dimension, n, {r('corr')} FROM corrs")
def _(s, d):
    a = attempts(s, d)
    return labels.rater_correlation(labels.first_pass(a), a.where("model = 'click' AND repeat = 1"), ["example"], _DIMS, "model")


@query("shared_examples", f"{_T} SELECT a.model AS model_a, b.model AS model_b, count(DISTINCT a.example) AS n FROM attempts a JOIN attempts b USING (example) WHERE a.ok AND b.ok AND a.repeat = 0 AND b.repeat = 0 AND a.model < b.model GROUP BY ALL")
def _(s, d):
    return labels.shared_examples(attempts(s, d))


@query("noise_floor", f"{_LONG} SELECT a.dimension, count(*) AS n, {r('avg(abs(a.value - b.value))', 'mean_gap')}, {r('max(abs(a.value - b.value))', 'max_gap')} FROM long a JOIN long b USING (model, example, dimension) WHERE a.repeat = 0 AND b.repeat = 1 GROUP BY a.dimension")
def _(s, d):
    a = attempts(s, d)
    return labels.noise_floor(a.where("repeat = 0"), a.where("repeat = 1"), ["model", "example"], _DIMS)


@query("latest_run_per_model", f"{_T} SELECT model, example, repeat FROM attempts WHERE (model, CAST(run_at AS DATE)) IN (SELECT (model, max(CAST(run_at AS DATE))) FROM attempts GROUP BY model)")
def _(s, d):
    return labels.latest_run_per_model(attempts(s, d)).select("model", "example", "repeat")


@query("resume_anti_join", f"{_T} SELECT model, example, repeat FROM attempts WHERE NOT ok")
def _(s, d):
    a = attempts(s, d)
    return labels.resume(a.select("model", "example", "repeat"), a.where("ok"), ["model", "example", "repeat"])


@query("spearman", f"{_A}, pairs AS (SELECT feed, score AS x, CAST(ticker AS DOUBLE) AS y FROM articles), {_corr('pairs', 'feed')} SELECT feed, n, {r('corr')} FROM corrs")
def _(s, d):
    return rolling.spearman(articles(s, d), "score", "ticker", "feed")


@query("average_rank", f"{_A} SELECT article_id, {r('rank() OVER (PARTITION BY feed ORDER BY ticker) + (count(*) OVER (PARTITION BY feed, ticker) - 1) / 2.0::DOUBLE', 'rank')} FROM articles")
def _(s, d):
    return articles(s, d).select("article_id", rolling.average_rank("ticker", "feed").alias("rank"))


def _log(s, d):
    e = table(s, d, "events")
    return e.select(F.col("user_id").alias("example"), F.element_at(F.array(F.lit("relevance"), F.lit("polarity")), (F.col("event_id") % 2 + 1).cast("int")).alias("dimension"), "value", F.col("event_id").alias("seq"))


_LOG = "WITH log AS (SELECT user_id AS example, CASE WHEN event_id % 2 = 0 THEN 'relevance' ELSE 'polarity' END AS dimension, value, event_id AS seq FROM events)"


@query("collate_scores", f"{_LOG} SELECT example, {r('arg_max(value, seq) FILTER (WHERE dimension = $$relevance$$)', 'relevance')}, {r('arg_max(value, seq) FILTER (WHERE dimension = $$polarity$$)', 'polarity')} FROM log GROUP BY example HAVING count(DISTINCT dimension) = 2")
def _(s, d):
    return labels.collate_scores(_log(s, d), ["example"], _DIMS)


@query("finalise_labels", f"{_LOG} SELECT c_custkey AS example, c_mktsegment AS bucket, {r('arg_max(value, seq) FILTER (WHERE dimension = $$relevance$$)', 'relevance')}, {r('arg_max(value, seq) FILTER (WHERE dimension = $$polarity$$)', 'polarity')} FROM log JOIN customer ON c_custkey = example GROUP BY ALL HAVING count(DISTINCT dimension) = 2")
def _(s, d):
    selection = table(s, d, "customer").select(F.col("c_custkey").alias("example"), F.col("c_mktsegment").alias("bucket"))
    return labels.finalise_labels(labels.collate_scores(_log(s, d), ["example"], _DIMS), selection, ["example"])


@query("redo_influence", f"{_LOG}, m AS (SELECT example, value <> lag(value) OVER (PARTITION BY example, dimension ORDER BY seq) AS changed FROM log), e AS (SELECT example, coalesce(bool_or(changed), FALSE) AS c FROM m GROUP BY example) SELECT count(*) AS examples, count(*) FILTER (WHERE c) AS redone FROM e")
def _(s, d):
    return labels.redo_influence(_log(s, d), ["example"])


@query("auc", "WITH q AS (SELECT n_chars AS score, toxic AS label FROM labels JOIN documents USING (doc_id)), k AS (SELECT *, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS k FROM q) SELECT count(*) FILTER (WHERE label = 1) AS n_pos, count(*) FILTER (WHERE label <> 1) AS n_neg, " + r("(sum(k) FILTER (WHERE label = 1) - count(*) FILTER (WHERE label = 1) * (count(*) FILTER (WHERE label = 1) + 1) / 2.0::DOUBLE) / (count(*) FILTER (WHERE label = 1) * count(*) FILTER (WHERE label <> 1))", "auc") + " FROM k")
def _(s, d):
    rows = table(s, d, "labels").join(table(s, d, "documents").select("doc_id", "n_chars"), "doc_id")
    return labels.auc(rows, "n_chars", "toxic")


@query("best_threshold", "WITH q AS (SELECT n_chars AS score, toxic AS label FROM labels JOIN documents USING (doc_id)), g AS (SELECT score, count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label <> 1) AS q FROM q GROUP BY score), k AS (SELECT score, (sum(p) OVER (ORDER BY score ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE / sum(p) OVER () AS recall, coalesce(sum(q) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE / sum(q) OVER () AS specificity FROM g) SELECT score AS threshold, " + f"{r('recall + specificity - 1', 'youden')}, {r('recall')}, {r('specificity')} FROM k ORDER BY recall + specificity - 1 DESC, score LIMIT 1")
def _(s, d):
    rows = table(s, d, "labels").join(table(s, d, "documents").select("doc_id", "n_chars"), "doc_id")
    return labels.best_threshold(rows, "n_chars", "toxic")


@query("label_set_checks", "SELECT CASE quality WHEN 1 THEN 'good' ELSE 'bad' END AS bucket, count(*) AS n, count(*) - count(DISTINCT doc_id) AS duplicates, " + r("avg(toxic)", "toxic_share") + " FROM labels GROUP BY quality")
def _(s, d):
    bucket = F.when(F.col("quality") == 1, "good").otherwise("bad")
    return labels.label_set_checks(table(s, d, "labels").withColumn("bucket", bucket))


@query("review_influence", "SELECT count(*) AS n, " + r("(count(*) FILTER (WHERE toxic = 1 AND quality = 1))::DOUBLE / count(*)", "share") + ", (count(*) FILTER (WHERE toxic = 1 AND quality = 1))::DOUBLE / count(*) <= 0.15 AS within FROM labels")
def _(s, d):
    return labels.review_influence(table(s, d, "labels"), (F.col("toxic") == 1) & (F.col("quality") == 1))


@query("out_of_range", f"{_T} SELECT model, example, repeat, concat_ws(',', CASE WHEN NOT coalesce(relevance BETWEEN 0 AND 0.8, FALSE) THEN 'relevance' END, CASE WHEN NOT coalesce(polarity BETWEEN -1 AND 1, FALSE) THEN 'polarity' END) AS wrong FROM attempts")
def _(s, d):
    m = F.create_map(F.lit("relevance"), "relevance", F.lit("polarity"), "polarity")
    return attempts(s, d).select("model", "example", "repeat", F.array_join(labels.out_of_range(m, {"relevance": (0.0, 0.8), "polarity": (-1.0, 1.0)}), ",").alias("wrong"))


@query("unwrap_envelope", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def _(s, d):
    wrapped = table(s, d, "events").select("event_id", F.when(F.col("event_id") % 2 == 0, F.concat(F.lit('{"result": '), "props", F.lit("}"))).otherwise(F.col("props")).alias("j"))
    return wrapped.select("event_id", F.get_json_object(labels.unwrap(F.col("j"), ["k"]), "$.k").cast("bigint").alias("k"))


_SEEDED = lambda seed, *keys: f"md5(concat_ws('|', {', '.join(f'CAST({k} AS VARCHAR)' for k in keys)}, '{seed}'))"


@query("stratified_round_robin", f"{_A}, k AS (SELECT ticker, article_id, row_number() OVER (PARTITION BY ticker ORDER BY {_SEEDED(7, 'article_id', 'ticker')}, article_id) AS k, count(*) OVER (PARTITION BY ticker) AS n FROM articles) SELECT ticker, article_id, CAST(k AS INT) AS round FROM k ORDER BY k, n DESC, ticker LIMIT 300")
def _(s, d):
    return labels.stratified_round_robin(articles(s, d).select("ticker", "article_id"), 300, 7)


@query("seeded_recheck_sample", f"SELECT doc_id, quality, toxic FROM labels ORDER BY {_SEEDED(7, 'doc_id')}, doc_id LIMIT 100")
def _(s, d):
    return labels.seeded_sample(table(s, d, "labels"), 100, 7, "doc_id")


def _rule(model: str, text: str) -> dict[str, float] | None:
    if not text:
        return None
    return {"length": float(len(text)) * (2 if model == "long" else 1), "lines": float(text.count("\n") + 1)}


@query("score_batch", """WITH calls AS (SELECT doc_id, model, CAST(repeat AS INT) AS repeat, text FROM documents, (VALUES ('long'), ('short')) m(model), range(2) t(repeat)
WHERE NOT (model = 'short' AND repeat = 0 AND doc_id IN (SELECT doc_id FROM labels WHERE toxic = 0))), x AS (SELECT *, length(text) * CASE WHEN model = 'long' THEN 2.0::DOUBLE ELSE 1.0 END AS length FROM calls)
SELECT doc_id, model, repeat, CASE WHEN length <= 5000 AND length > 0 THEN (round(length, 6) + 0.0) END AS length, CASE WHEN length <= 5000 AND length > 0 THEN (length(text) - length(replace(text, chr(10), '')) + 1)::DOUBLE END AS lines, CASE WHEN coalesce(length, 0) = 0 OR length > 5000 THEN 'schema' END AS failure, CASE WHEN length > 5000 THEN 'length' END AS detail FROM x""")
def _(s, d):
    # A log of an earlier run: answers, and transport failures that are asked again.
    log = table(s, d, "labels").select("doc_id", F.lit("short").alias("model"), F.lit(0).alias("repeat"), F.when(F.col("toxic") == 1, "transport").alias("failure")).distinct()
    docs = table(s, d, "documents").select("doc_id", "text")
    got = labels.scoring_run(docs, ["short", "long"], 2, _rule, {"length": (0.0, 5000.0), "lines": (1.0, 1e9)}, ["doc_id"], log)
    return got.select("doc_id", "model", "repeat", F.col("scores")["length"].alias("length"), F.col("scores")["lines"].alias("lines"), "failure", "detail")


@query("gate_run_counts", f"{_A}, days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders UNION SELECT DISTINCT CAST(ts AS DATE) FROM events) SELECT day AS session_date, count(article_id) AS runs FROM days LEFT JOIN articles ON CAST(published_at AS DATE) = day GROUP BY day")
def _(s, d):
    days = table(s, d, "orders").select(F.to_date("o_orderdate").alias("session_date")).union(table(s, d, "events").select(F.to_date("ts")))
    return feed.runs_per_session(days, articles(s, d), "published_at")


_REPORTS = """WITH reports AS (SELECT CAST(o_orderdate AS DATE) AS date, CASE o_orderkey % 3 WHEN 0 THEN 'single' WHEN 1 THEN 'morning' ELSE 'evening' END AS run, strftime(o_orderdate, '%Y-%m-%d') || CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN '-morning' ELSE '-evening' END || '.md' AS name,
CASE WHEN o_orderkey % 11 <> 0 THEN o_orderkey % 1000 / 1000.0::DOUBLE END AS ambiguous_pct, CASE WHEN o_orderkey % 11 <> 0 THEN o_custkey END AS articles,
CASE o_orderkey % 5 WHEN 0 THEN 'kr_flow/schema×2' WHEN 1 THEN 'kr_news/structural_invariants' WHEN 2 THEN 'kr/investor_flow (KeyError)' WHEN 3 THEN 'us_price/not_empty' ELSE 'kr_flow/flow_identity' END AS item, o_orderkey % 5 = 0 AS vendor_disagreement, CASE WHEN o_orderkey % 7 = 0 THEN 'a feed ' || o_custkey || ' h' END AS news_gap FROM orders)"""


def _reports(s, d):
    """Report files made of the orders: names by date and run, header lines, failures, a disagreement, a gap."""
    k = F.col("o_orderkey")
    name = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.element_at(F.array(F.lit(""), F.lit("-morning"), F.lit("-evening")), (k % 3 + 1).cast("int")), F.lit(".md"))
    item = F.element_at(F.array(*[F.lit(x) for x in ("kr_flow/schema×2", "kr_news/structural_invariants", "kr/investor_flow (KeyError)", "us_price/not_empty", "kr_flow/flow_identity")]), (k % 5 + 1).cast("int"))
    lines = F.concat_ws(
        "\n", F.lit("# head"), F.when(k % 11 != 0, F.concat(F.lit("ℹ 엔티티 모호 비율: "), (k % 1000 / 10.0).cast("decimal(10,1)"), F.lit("% (기사 "), F.format_number("o_custkey", 0), F.lit("건)"))),
        F.concat(F.lit("⚠ 수집 실패: "), item, F.lit(", us_price/coverage×3")), F.when(k % 5 == 0, F.lit("⚠ 미국 시세 벤더 불일치: A")), F.when(k % 7 == 0, F.concat(F.lit("⚠ 뉴스 유실: a feed "), "o_custkey", F.lit(" h"))), F.lit("end"),
    )
    return feed.parse_report_headers(table(s, d, "orders").select(name.alias("name"), lines.alias("text")))


@query("parse_report_headers", f"{_REPORTS} SELECT name, date, run, {r('ambiguous_pct')}, articles, item || ',us_price/coverage×3' AS failures, vendor_disagreement, news_gap FROM reports")
def _(s, d):
    return _reports(s, d).withColumn("failures", F.array_join("failures", ","))


@query("gate_consistency_counts", f"{_REPORTS}, f AS (SELECT CASE item WHEN 'kr_flow/schema×2' THEN 'confirmed' WHEN 'kr_flow/flow_identity' THEN 'confirmed' WHEN 'kr_news/structural_invariants' THEN 'ambiguous' WHEN 'us_price/not_empty' THEN 'excluded' ELSE 'unparsed' END AS classification, CASE item WHEN 'kr_flow/schema×2' THEN 2 ELSE 1 END AS c FROM reports UNION ALL SELECT 'ambiguous', 3 FROM reports) SELECT classification, count(*) AS n, CAST(sum(c) AS BIGINT) AS failures FROM f GROUP BY 1")
def _(s, d):
    return feed.failure_items(_reports(s, d)).groupBy("classification").agg(F.count("*").alias("n"), F.sum("count").alias("failures"))


@query("gate_ambiguous_means", f"{_REPORTS} SELECT {r('avg(ambiguous_pct)', 'simple')}, {r('sum(ambiguous_pct * articles) / sum(articles)', 'weighted')}, {r('avg(ambiguous_pct) FILTER (WHERE run <> $$morning$$)', 'evening')}, count(ambiguous_pct) AS n FROM reports")
def _(s, d):
    return feed.ambiguous_means(_reports(s, d))


@query("reports_for_session", f"{_REPORTS}, u AS (SELECT DISTINCT date, run, name FROM reports) SELECT date, run, name FROM u WHERE run <> 'single' OR date NOT IN (SELECT date FROM u WHERE run <> 'single')")
def _(s, d):
    return feed.reports_for_session(_reports(s, d).select("date", "run", "name").distinct())
