"""Edges of the panel operators on tiny frames."""

import random
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import columns
from tidemark.operators import asof, entity, evaluation, features, labels, quality, rating, rolling, sessions, similarity
from tidemark.sources import articles, versioned

D = dt.date


def panel(spark, rows):
    return spark.createDataFrame([(D(2024, 1, 1) + dt.timedelta(days=i), t, v) for t, vs in rows.items() for i, v in enumerate(vs)], "date date, ticker string, x double")


def values(df, column, ticker="a"):
    return [r[column] for r in df.where(F.col("ticker") == ticker).orderBy("date").collect()]


def test_z_ends_before_the_row_and_needs_a_full_varying_window(spark):
    df = panel(spark, {"a": [1.0, 2.0, 3.0, 100.0], "b": [5.0, 5.0, 5.0, 9.0], "c": [1.0, None, 2.0, 3.0]})
    got = df.withColumn("z", rolling.rolling_z("x", rolling.by(), 3))
    assert values(got, "z") == [None, None, None, pytest.approx(98.0)]
    assert values(got, "z", "b") == [None] * 4 and values(got, "z", "c") == [None] * 4


@pytest.mark.parametrize("size", [1, 2, 5, 60])
def test_wide_scores_are_those_of_sliding_frames(spark, size):
    draw = random.Random(size)
    near = lambda n: [None if draw.random() < 0.01 else draw.choice([0.1, 0.1, 0.3, draw.random()]) for _ in range(n)]
    rows = {"a": near(700), "b": [0.1] * 90 + [0.7] + [0.1] * 90, "c": [1e12] + near(300), "d": near(3), "e": [float("nan")] + near(150), "f": [float("inf")] + near(150), None: near(80)}
    df = panel(spark, rows).repartition(3)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        both = rolling.with_rolling_z(df.withColumn("z", rolling.rolling_z("x", rolling.by(), size)), {"got": "x"}, size).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert len(both) == sum(map(len, rows.values())) and (size == 1 or any(r.z is not None for r in both))
    off = [r for r in both if (r.z is None) != (r.got is None) or r.z is not None and r.got != pytest.approx(r.z, rel=1e-6, abs=1e-6, nan_ok=True)]
    assert not off


def test_wide_windows_of_features_are_no_sliding_frames(spark):
    cols = ", ".join(f"{c} double" for c in ("open", "close", "foreign_net", "inst_net", "trading_value", "short_balance", "shares_outstanding", "pbr"))
    p = spark.createDataFrame([], f"date date, ticker string, sector string, {cols}")
    for made in (features.panel_features(p), features.volatility_z(p)):
        assert "-252" not in made._jdf.queryExecution().analyzed().toString()


def test_what_is_counted_is_made_once(spark):
    from tidemark.plans.panel_queries import rating as levels

    made = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    rows = spark.range(1000).select(F.lit("HOLD").alias("rating"), (F.col("id") % 70 / 20).alias("score")).mapInArrow(seen, "rating string, score double")
    got = {r.rating: (r.published, r.current) for r in evaluation.bucket_counts(rows, levels.bucket(F.col("score")), levels.LEVELS).collect()}
    assert made.value == 1000 and got["HOLD"][0] == 1000 and sum(c for _, c in got.values()) == 1000 and got["STRONG_SELL"] == (0, 0)
    assert evaluation.score_percentiles(rows).count() == 5 and made.value == 2000


def test_percentile_counts_the_row_itself(spark):
    df = panel(spark, {"a": [1.0, 2.0, 3.0, 4.0], "b": [4.0, 3.0, 2.0, 1.0], "c": [1.0, 1.0, None, 1.0]})
    got = rolling.with_rolling_percentile(df, "x", "p", 3)
    assert values(got, "p") == [None, None, 1.0, 1.0] and values(got, "p", "b") == [None, None, 0.0, 0.0]
    assert values(got, "p", "c") == [None] * 4
    one = rolling.with_rolling_percentile(df, "x", "p", 1)
    assert values(one, "p") == [None] * 4 and one.columns == [*df.columns, "p"]


def test_percentile_over_batches_is_brute_force(spark):
    import random

    draw = random.Random(4)
    rows = {t: [draw.choice([None, *range(6)]) if draw.random() < 0.02 else float(draw.randrange(9)) for _ in range(n)] for t, n in (("a", 300), ("b", 7), ("c", 120))}
    df = panel(spark, {t: [None if v is None else float(v) for v in vs] for t, vs in rows.items()})
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "11")
    try:
        got = rolling.with_rolling_percentile(df, "x", "p", 8).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for t, vs in rows.items():
        want = [None if i < 7 or None in vs[i - 7 : i + 1] else (sum(v <= vs[i] for v in vs[i - 7 : i + 1]) - 1) / 7 for i in range(len(vs))]
        assert [r.p for r in sorted((r for r in got if r.ticker == t), key=lambda r: r.date)] == [None if w is None else pytest.approx(w) for w in want]


@pytest.mark.parametrize("n", [0, 1, 7, 400])
def test_places_and_percentiles_over_ranges(spark, n):
    import numpy as np

    df = spark.createDataFrame([(i * 37 % 101, i) for i in range(n)], "v int, i int").repartition(5)
    got = sorted((r.place, r.v, r.i) for r in rolling.placed(df, "place", F.desc("v"), "i").collect())
    assert got == [(k + 1, v, i) for k, (v, i) in enumerate(sorted(((r.v, r.i) for r in df.collect()), key=lambda x: (-x[0], x[1])))]
    at = {r.p: r.value for r in evaluation.score_percentiles(df.withColumn("score", F.col("v") - 50.0)).collect()}
    assert at == {p: pytest.approx(np.quantile([abs(i * 37 % 101 - 50.0) for i in range(n)], p)) if n else None for p in (0.5, 0.75, 0.9, 0.95, 0.99)}


def test_sums_come_before_the_ratio_and_zero_is_no_denominator(spark):
    df = panel(spark, {"a": [1.0, 3.0], "b": [0.0, 0.0]}).withColumn("y", F.when(F.col("ticker") == "b", 0.0).otherwise(F.col("x") * 2))
    got = df.withColumn("r", rolling.rolling_sum_ratio("x", "y", rolling.by(), 2))
    assert values(got, "r") == [None, 0.5] and values(got, "r", "b") == [None, None]


def test_what_is_missing_prints_as_a_dash(spark):
    df = spark.createDataFrame([(0.0123,), (None,)], "x double")
    got = [tuple(r) for r in df.select(columns.signed_percent("x"), columns.shown("x"), columns.signed("x")).collect()]
    assert got == [("+1.23%", "0.01", "+0.01"), ("—", "—", "—")]


def test_lag_and_change_stay_within_a_key(spark):
    df = panel(spark, {"a": [1.0, 2.0, None, 4.0], "b": [8.0, 4.0, 2.0, 0.0]})
    got = rolling.pct_change(df, "x", 1, rolling.by(), "c")
    assert values(got, "c") == [None, 1.0, 0.0, 1.0] and values(got, "c", "b") == [None, -0.5, -0.5, -1.0]
    lagged = df.withColumn("one", F.lit(1.0)).withColumn("r", rolling.lagged_ratio("x", "one", rolling.by(), 1))
    assert values(lagged, "r", "b") == [None, 8.0, 4.0, 2.0]


def test_correlation_of_a_constant_side_is_unknown(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0), ("a", 2.0, 3.0), ("b", 1.0, 5.0), ("b", 1.0, 6.0), ("c", 1.0, 1.0), ("d", None, 1.0)], "g string, x double, y double")
    got = {r.g: (r.n, r["corr"]) for r in rolling.spearman(df, "x", "y", "g").collect()}
    assert got == {"a": (2, pytest.approx(1.0)), "b": (2, None), "c": (1, None)}
    constant = spark.createDataFrame([(0.1, float(i)) for i in range(7)], "x double, y double")
    assert rolling.correlation(constant, "x", "y").first()["corr"] is None


def test_group_of_one_is_null_in_features_and_the_universe_in_evaluation(spark):
    df = panel(spark, {"a": [1.0, 2.0], "b": [1.0, 4.0], "c": [1.0, 3.0]}).withColumn("sector", F.when(F.col("ticker") == "c", "s2").otherwise("s1"))
    got = features.rel_strength(df, 1, "x")
    assert values(got, "rel_strength", "a")[1] == pytest.approx(-1.0) and values(got, "rel_strength", "c") == [None, None]
    ev = features.excess_return(df, "x")
    assert values(ev, "excess", "c")[1] == pytest.approx(0.0) and values(ev, "excess", "a")[1] == pytest.approx(-1.0)
    half = features.excess_return(df.withColumn("x", F.when(F.col("ticker") != "b", F.col("x"))), "x")
    assert values(half, "excess", "a")[1] == 0.0  # the member without a value still makes a group of two


def test_asof_joins_are_strict_or_not_as_they_say(spark):
    left = spark.createDataFrame([("k", 1), ("k", 2), ("k", 5), ("z", 1)], "k string, at int")
    right = spark.createDataFrame([("k", 2, "two"), ("k", 4, "four")], "k string, d int, v string")
    run = lambda f: [r.v for r in f(left, right, ["k"], "at", "d", ["v"]).orderBy("k", "at").collect()]
    assert run(asof.asof_prior_strict) == [None, None, "four", None]
    assert run(asof.asof_prior) == [None, "two", "four", None]
    assert run(asof.asof_next) == ["two", "two", None, None]


def test_forward_return_never_skips_a_session(spark):
    p = spark.createDataFrame([(D(2024, 1, d), t, 10.0, 11.0) for t, ds in {"a": (1, 2, 3), "b": (1, 3)}.items() for d in ds], "date date, ticker string, open double, close double")
    got = {(r.date.day, r.ticker): r.forward for r in evaluation.forward_return(p, sessions.sessions_of(p)).collect()}
    assert got[(1, "a")] == pytest.approx(0.1) and got[(1, "b")] is None and got[(3, "a")] is None


def test_baskets_are_carried_and_nothing_comes_before_the_first(spark):
    f = spark.createDataFrame([(D(2024, 1, d), t, float(d)) for d in range(1, 6) for t in "ab"], "date date, ticker string, forward double")
    held = spark.createDataFrame([(D(2024, 1, 2), "a"), (D(2024, 1, 4), "b"), (D(2024, 1, 4), "a")], "date date, ticker string")
    assert [(r.date.day, r.n) for r in evaluation.carried_returns(held, f).orderBy("date").collect()] == [(2, 1), (3, 1), (4, 2), (5, 2)]


def test_bootstrap_is_repeatable_and_undefined_for_one_date(spark):
    ic = spark.createDataFrame([(D(2024, 1, 1 + i), 0.1 * (i % 4) - 0.1) for i in range(20)], "date date, ic double")
    a, b = (evaluation.bootstrap_ci(ic.repartition(n), 200).first() for n in (1, 5))
    assert a == b and a.low < a.high and a.draws == 200
    assert evaluation.bootstrap_ci(ic.limit(1)).first().low is None


def rated(spark, zs, **options):
    names = list(rating.WEIGHTS)
    schema = "date date, ticker string, " + ", ".join(f"{n}_z double" for n in names)
    return rating.rate(spark.createDataFrame([(D(2024, 1, 1), str(i), *[z.get(n) for n in names]) for i, z in enumerate(zs)], schema), **options).orderBy("ticker").collect()


def test_rating_renormalises_over_what_is_there(spark):
    w = {"foreign_flow_5d": 0.5, "inst_flow_5d": 0.5}
    names = {"weights": w}
    got = rated(spark, [{"foreign_flow_5d": 2.0, "inst_flow_5d": 2.0}, {"foreign_flow_5d": 2.0}, {}, {"foreign_flow_5d": -0.8}], **names)
    assert [(r.rating, r.score, r.weight_coverage, r.low_confidence) for r in got] == [("STRONG_BUY", 2.0, 1.0, False), ("STRONG_BUY", 2.0, 0.5, False), ("HOLD", 0.0, 0.0, True), ("WEAK_SELL", -0.8, 0.5, False)]
    assert got[2].missing == "foreign_flow_5d,inst_flow_5d"
    with pytest.raises(ValueError):
        rating.bucket(F.lit(1.0), {"strong": 1.0, "moderate": 1.0, "weak": 0.4})


@pytest.mark.parametrize(("score", "level"), [(2.0, "STRONG_BUY"), (1.0, "BUY"), (0.4, "WEAK_BUY"), (0.39, "HOLD"), (-0.39, "HOLD"), (-0.4, "WEAK_SELL"), (-1.0, "SELL"), (-2.0, "STRONG_SELL"), (None, "HOLD")])
def test_levels_hold_their_outer_edge(spark, score, level):
    assert spark.range(1).select(rating.bucket(F.lit(score).cast("double")).alias("l")).first().l == level


def test_rationale_keeps_the_weights_order_on_ties(spark):
    names = list(rating.WEIGHTS)
    df = spark.createDataFrame([(D(2024, 1, 1), "t", *[1.0 / rating.WEIGHTS[n] for n in names])], "date date, ticker string, " + ", ".join(f"{n}_z double" for n in names))
    top = rating.rationale(rating.rate(df), 2).first()
    assert [t.feature for t in top.top] == names[:2] and top.residual == pytest.approx(3.0) and top.subtotal == pytest.approx(5.0)


def test_entities(spark):
    e = spark.createDataFrame([("005930", ["Samsung Electronics", "Samsung"], ["Samsung Life"], ["Sams"]), ("000660", ["Hynix"], None, None)], "ticker string, aliases array<string>, exclude array<string>, ambiguous_parents array<string>")
    texts = ["Samsung Life up", "Samsung Life and Samsung", "x 005930 y", "x1005930", "Samsun", "nothing", "Hynix, Samsung"]
    a = spark.createDataFrame([(str(i), t, None) for i, t in enumerate(texts)], "article_id string, title string, description string")
    got = {(r.article_id, r.ticker): (r.status, r.matched_form, r.match_type) for r in entity.resolve_entities(a, e).collect()}
    assert got == {
        ("1", "005930"): ("matched", "Samsung", "alias"), ("2", "005930"): ("matched", "005930", "code"), ("4", "005930"): ("ambiguous", "Sams", "parent"),
        ("6", "005930"): ("matched", "Samsung", "alias"), ("6", "000660"): ("matched", "Hynix", "alias"),
    }
    report = entity.resolution_report(entity.article_status(a, entity.resolve_entities(a, e))).first()
    assert (report.articles, report.matched, report.ambiguous, report.unmatched, report.multi) == (7, 3, 1, 3, 1)


def test_commentary_carries_its_subject_and_contests_it(spark):
    docs = spark.createDataFrame([(1, "A is up\nBUY it\n\nBUY nothing\nA and B\nSELL them")], "doc_id long, text string")
    mentions = spark.createDataFrame([(1, 0, "A"), (1, 4, "A"), (1, 4, "B")], "doc_id long, line int, ticker string")
    said = spark.createDataFrame([(1, 1, "BUY"), (1, 3, "BUY"), (1, 5, "SELL")], "doc_id long, line int, said string")
    got = entity.commentary_consistency(docs, spark.createDataFrame([("A", "HOLD")], "ticker string, rating string"), mentions, said).orderBy("line").collect()
    assert [(r.line, r.ticker, r.verdict) for r in got] == [(1, "A", "contradicts"), (5, None, "ambiguous")]
    lines = spark.createDataFrame([("a STRONG BUY here",), ("BUY",), ("none",)], "text string")
    assert [r.said for r in entity.label_extraction(lines, ["BUY", "STRONG BUY"]).collect()] == [["STRONG BUY"], ["BUY"], []]


def test_clusters_are_transitive_inclusive_and_keep_the_longest(spark):
    items = spark.createDataFrame([("k", i, n) for i, n in enumerate([5, 9, 9, 1])], "ticker string, article_id long, length int")
    pairs = spark.createDataFrame([("k", 0, 1, 0.85), ("k", 1, 2, 0.9)], "ticker string, a long, b long, cosine double")
    got = {r.article_id: (r.cluster, r.kept) for r in similarity.cluster_duplicates(items, pairs).collect()}
    assert got == {0: (0, False), 1: (0, False), 2: (0, True), 3: (3, True)}
    v = spark.createDataFrame([("k", 0, [1.0, 0.0]), ("k", 1, [0.6, 0.8]), ("j", 2, [1.0, 0.0])], "ticker string, article_id long, vector array<double>")
    assert [(r.a, r.b) for r in similarity.similarity_pairs(v, 0.6).collect()] == [(0, 1)]


def test_pairs_over_several_blocks_are_all_found(spark, monkeypatch):
    monkeypatch.setattr(similarity, "BLOCK", 4)
    v = spark.createDataFrame([("k", i, [1.0, 0.0]) for i in range(13)], "ticker string, article_id long, vector array<double>")
    got = [(r.a, r.b) for r in similarity.similarity_pairs(v, 0.9).collect()]
    assert sorted(got) == [(a, b) for a in range(13) for b in range(a + 1, 13)]


def test_embedding_is_of_unit_length_or_zero(spark):
    t = spark.createDataFrame([("a b a",), ("",), (None,)], "text string")
    for embed in (None, lambda xs: [[float(len(x)), 0.0] for x in xs]):
        norms = [round(sum(x * x for x in r.vector), 9) for r in similarity.embed_texts(t, embed, size=16).collect()]
        assert norms == [1.0, 0.0, 0.0]


def test_checks_are_rows(spark):
    df = spark.createDataFrame([(1, None), (2, 3.0)], "id int, v double")
    got = {r.name: r.passed for r in quality.report(quality.missing_ratio(df, {"v": 0.4, "id": 0.0}), quality.not_empty(df.limit(0), 2), quality.known_value(df, "k", F.col("id") == 1, "v", 3.0)).collect()}
    assert got == {"missing_ratio.v": False, "missing_ratio.id": True, "not_empty": False, "k": False}
    assert quality.missing_ratio(df.limit(0), {"v": 1.0}).first().passed is False
    none = quality.summary(quality.not_empty(df, 1).limit(0)).first()
    assert none.ok is False and none.summary == "no checks ran"
    weights = spark.createDataFrame([("a", "1.0", True), ("a", "2.0", False), ("b", "much", True)], "feature string, weight string, active boolean")
    cuts = lambda *v: spark.createDataFrame(list(zip(("strong", "moderate", "weak"), v, strict=True)), "cut string, threshold double")
    got = {r.name: (r.passed, r.detail) for r in quality.rating_config(weights, cuts(1.0, 2.0, 0.5), 2.0).collect()}
    assert got == {"numeric_weights": (False, "b"), "active_or_deferred": (False, "a"), "ordered_cuts": (False, "1.0 > 2.0 > 0.5"), "floor": (False, "2.0")}
    assert all(r.passed for r in quality.rating_config(weights.where("weight = '1.0'"), cuts(2.0, 1.0, 0.4), 0.5).collect())


def test_versions(spark, tmp_path):
    path = str(tmp_path / "v")
    df = lambda rows: spark.createDataFrame([(D(2024, 1, d), t, x) for d, t, x in rows], "date date, ticker string, x double")
    assert versioned.load_versioned(spark, path).collect() == []
    first = [(1, "a", 1.0), (1, "b", 2.0), (2, "a", 3.0)]
    assert versioned.write_versioned(df(first), path) == {"new": 2}
    assert versioned.write_versioned(df(first), path) == {"same": 2}
    assert versioned.write_versioned(df([(1, "a", 1.0)]), path) == {"shrunk": 1}
    assert versioned.write_versioned(df([(1, "a", 1.5), (1, "b", 2.0)]), path) == {"revised": 1}
    assert versioned.write_versioned(df([(1, "a", 1.5), (1, "b", 2.0), (1, "c", 0.0)]), path) == {"revised": 1}
    got = {(str(r.date), r.ticker): r.x for r in versioned.load_versioned(spark, path).collect()}
    assert got == {("2024-01-01", "a"): 1.5, ("2024-01-01", "b"): 2.0, ("2024-01-01", "c"): 0.0, ("2024-01-02", "a"): 3.0}
    with pytest.raises(KeyError):
        versioned.load_versioned(spark, path, ("date", "nothing"))
    assert versioned.backfill_write(df([(1, "a", 9.0), (3, "a", 4.0)]), path) == 1


def test_pubdates_and_runs(spark, tmp_path):
    raw = ["Mon, 05 Aug 2024 09:00:00 +0900", "Tue, 6 Aug 2024 09:00:00 +09:00", "05 Aug 2024 09:00:00 GMT", "05 Aug 2024 09:00:00", "2024-08-05 09:00:00", "rubbish", None]
    df = spark.createDataFrame([(r,) for r in raw], "raw string")
    got = [str(r[0]) if r[0] else None for r in df.select(articles.parse_pubdate(F.col("raw"), F.lit("Asia/Seoul"))).collect()]
    assert got[:1] + got[2:] == ["2024-08-05 00:00:00", "2024-08-05 09:00:00", "2024-08-05 00:00:00", "2024-08-05 00:00:00", None, None]
    assert [r[0] is None for r in df.select(articles.parse_pubdate(F.col("raw"))).collect()][3:5] == [True, True]
    news = spark.createDataFrame([("i1", "f", None)], "article_id string, feed string, published_at timestamp")
    articles.write_news_run(news, str(tmp_path), "2024-08-05 10:00:00")
    articles.write_news_run(news.limit(0), str(tmp_path), "2024-08-05 12:00:00")
    assert articles.scan_news(spark, f"{tmp_path}/articles").count() == 1
    assert [r.rows for r in spark.read.parquet(f"{tmp_path}/ledger").orderBy("run_at").collect()] == [1, 0]


def test_report_headers(spark):
    text = "head\nℹ 엔티티 모호 비율: 8.8% (기사 12,432건)\n⚠ 수집 실패: kr_flow/schema×2, kr/flow (KeyError)\n⚠ 수집 실패: a/coverage\n⚠ 뉴스 유실: one feed\n"
    rows = [("2026-08-12-evening.md", text), ("2026-08-12.md", "plain"), ("2026-08-13.md", "⚠ 미국 시세 벤더 불일치: A"), ("notes.md", text)]
    got = articles.parse_report_headers(spark.createDataFrame(rows, "name string, text string"))
    said = {r.name: (str(r.date), r.run, r.ambiguous_pct, r.articles, r.vendor_disagreement, r.news_gap) for r in got.collect()}
    assert said == {
        "2026-08-12-evening.md": ("2026-08-12", "evening", pytest.approx(0.088), 12432, False, "one feed"),
        "2026-08-12.md": ("2026-08-12", "single", None, None, False, None), "2026-08-13.md": ("2026-08-13", "single", None, None, True, None),
    }
    items = [(r.raw, r["count"], r.classification) for r in articles.failure_items(got).orderBy("raw").collect()]
    assert items == [("a/coverage", 1, "ambiguous"), ("kr/flow (KeyError)", 1, "unparsed"), ("kr_flow/schema×2", 2, "confirmed")]
    assert sorted(r.name for r in articles.reports_for_session(got).collect()) == ["2026-08-12-evening.md", "2026-08-13.md"]
    m = articles.ambiguous_means(got).first()
    assert (m.simple, m.weighted, m.evening, m.n) == (pytest.approx(0.088), pytest.approx(0.088), pytest.approx(0.088), 1)
    assert articles.ambiguous_means(got.limit(0)).first().simple is None


def test_greedy_selection_and_scorer(spark):
    rows = spark.createDataFrame([("b", i, i, t.split()) for i, t in enumerate(["x y", "x y z", "p q", "r s"])], "bucket string, seq long, article_id long, tokens array<string>")
    assert [r.article_id for r in labels.first_n_per_bucket(rows, 2).orderBy("place").collect()] == [0, 2]

    def scorer(text):
        if text == "bad":
            raise ValueError
        return {"a": 1.0} if text else {}

    got = labels.score_batch(spark.createDataFrame([("ok",), ("bad",), (None,)], "text string"), scorer, ["a"]).collect()
    assert [r.failure for r in got] == [None, "ValueError", "schema"]


def test_round_robin_takes_from_every_group_first(spark):
    pairs = spark.createDataFrame([(t, f"{t}{i}") for t, n in (("a", 50), ("b", 3), ("c", 1)) for i in range(n)], "ticker string, article_id string")
    got = labels.stratified_round_robin(pairs, 6, 1).collect()
    assert {t: sum(r.ticker == t for r in got) for t in "abc"} == {"a": 3, "b": 2, "c": 1}


def test_as_of_is_strict_and_needs_a_zone(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 9),), (dt.datetime(2024, 1, 1, 10),)], "known_at_utc timestamp")
    assert sessions.visible_as_of(df, "2024-01-01 10:00:00").count() == 1 and sessions.visible_as_of(df, None).count() == 2
    with pytest.raises(ValueError):
        sessions.visible_as_of(df, dt.datetime(2024, 1, 1))


def test_exclude_candidates_hold_the_name_anywhere(spark):
    rng = random.Random(4)
    names = {"".join(rng.choice("abé") for _ in range(rng.randrange(1, 8))) for _ in range(150)} | {"bank", "newbank", "bankcorp", "x"}
    got = entity.exclude_candidates(spark.createDataFrame([(n,) for n in [*names, "bank", "", None]], "name string"))
    assert sorted(map(tuple, got.collect())) == sorted((a, b) for a in names for b in names if a != b and a in b)
    assert {r.longer for r in got.where("name = 'bank'").collect()} == {"newbank", "bankcorp"}
