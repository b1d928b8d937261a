"""Rules, runs, jobs and checks on tiny frames."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import conflicts, entity, labels, quality, rating, report, sessions, sets, similarity
from tidemark.operators.storage import discard, shared_folder, written
from tidemark.sources import jobs, vendors, versioned

D = dt.date
ROW = "article_id string, ticker string, bucket string, name string, title string, description string, relevance double, polarity double, intensity double"


def test_label_conflicts(spark):
    rows = [
        ("1", "A", "positive", "A", "t", ""), ("2", "A", "negative", "A", "t", ""), ("3", "A", "negative", "A", "t", ""), ("3", "B", "negative", "B", "t", ""),
        ("4", "A", "irrelevant", "A", "t", ""), ("4", "B", "irrelevant", "B", "t", ""), ("5", "C", "positive", "한국증권", "t", "목표가 상향"), ("6", "C", "irrelevant", "한국증권", "t", "목표가 상향"),
        ("7", "C", "positive", "한국증권", "한국증권 실적", "목표가 상향"),
    ]
    pairs = spark.createDataFrame([("A", "1", "2"), ("A", "2", "3")], "ticker string, a string, b string")
    got = conflicts.label_conflicts(spark.createDataFrame(rows, "article_id string, ticker string, bucket string, name string, title string, description string"), pairs)
    assert sorted((r.article_id, r.ticker, r.flag) for r in got.collect()) == [
        ("1", "A", "contradiction"), ("2", "A", "contradiction"), ("3", "A", "shared_sign"), ("3", "B", "shared_sign"), ("5", "C", "author_mention"),
    ]


def test_score_conflicts(spark):
    rows = [
        ("1", "A", "positive", "A", "t", "", 0.9, 0.0, 0.1), ("2", "A", "irrelevant", "A", "t", "", 0.5, 0.4, 0.1), ("3", "A", "negative", "A", "외국인 순매수", "", 0.5, -1.0, 0.1),
        ("4", "A", "negative", "A", "외국인 매물에 급락", "", 0.6, -1.0, 0.1), ("5", "A", "negative", "A", "공급 계약에 급등", "", 0.6, -1.0, 0.1), ("6", "A", "negative", "A", "t", "", 0.3, -1.0, 0.7),
        ("7", "C", "positive", "한국증권", "t", "투자의견", 0.4, 0.2, 0.0), ("8", "A", "positive", "A", None, None, None, None, None),
    ]
    got = sorted((r.article_id, r.dimension, r.flag) for r in conflicts.score_conflicts(spark.createDataFrame(rows, ROW)).collect())
    assert got == [
        ("1", "polarity", "sign against bucket"), ("2", "polarity", "polar though irrelevant"), ("2", "relevance", "relevant though irrelevant"), ("3", "relevance", "market structure"),
        ("4", "relevance", "price move"), ("6", "intensity", "detached"), ("6", "relevance", "detached"), ("7", "polarity", "polar though an author"),
    ]


def test_mentions_by_code_canonical_and_alias_after_masking(spark):
    entries = spark.createDataFrame([("005930", "Samsung", ["SEC"], ["Samsung Life"]), ("000660", None, None, None)], "ticker string, canonical string, aliases array<string>, exclude array<string>")
    texts = ["Samsung Life", "Samsung Life, Samsung", "code 005930!", "SEC and 000660", "", None]
    lines = spark.createDataFrame([(1, i, t) for i, t in enumerate(texts)], "doc_id long, line int, said_text string")
    assert sorted((r.line, r.ticker) for r in entity.mentions(lines, entries).collect()) == [(1, "005930"), (2, "005930"), (3, "000660"), (3, "005930")]


def test_entities_over_several_blocks_and_odd_forms(spark, monkeypatch):
    draw = random.Random(2)
    word = lambda: "".join(draw.choice("abc ") for _ in range(draw.randint(1, 4)))
    rows = [(f"{i:06d}", [word(), ""], [word()] if i % 3 else None, [word()]) for i in range(30)]
    entries = spark.createDataFrame(rows, "ticker string, aliases array<string>, exclude array<string>, ambiguous_parents array<string>")
    texts = [(str(i), " ".join(word() for _ in range(4)), None if i % 5 else f"x{draw.randrange(30):06d} ") for i in range(60)]
    articles = spark.createDataFrame(texts, "article_id string, title string, description string")
    want = set()
    for i, title, description in texts:
        text = f"{title} {description or ''}"
        for t, aliases, exclude, parents in rows:
            masked = text
            for e in exclude or []:
                masked = masked.replace(e, "\0")
            if aliases[0] in masked:
                want.add((i, t, "alias"))
            elif parents[0] in masked:
                want.add((i, t, "parent"))
    for size in (1 << 20, 20):
        monkeypatch.setattr(entity, "BLOCK_CHARS", size)
        assert {(r.article_id, r.ticker, r.match_type) for r in entity.resolve_entities(articles, entries, codes=False).collect()} == want
    assert entity.resolve_entities(articles, entries.limit(0)).collect() == []
    names = spark.createDataFrame([("Alpha",), ("Alpha Beta",), ("Gamma",)], "name string")
    asked = spark.createDataFrame([("Alpha",), ("Beta",), ("a",), ("zzz",)], "query string")
    assert {r.query: (r.n, r.state, r.found) for r in entity.name_lookup(asked, names).collect()} == {"Alpha": (2, "exact", "Alpha"), "Beta": (1, "found", "Alpha Beta"), "a": (3, "ambiguous", None), "zzz": (0, "not found", None)}


@pytest.mark.parametrize(("least", "overlap"), [(0.5, False), (0.35, True), (1.0, False)])
def test_title_pairs_are_brute_force(spark, least, overlap):
    draw = random.Random(3)
    rows = [(draw.choice("kj"), i, " ".join(draw.choice("abcdefgh") for _ in range(draw.randint(0, 7)))) for i in range(80)]
    got = {(r.ticker, r.a, r.b): r[3] for r in similarity.same_event_pairs(spark.createDataFrame(rows, "ticker string, article_id long, title string"), least=least, overlap=overlap).collect()}
    want = {}
    for t, i, x in rows:
        for u, j, y in rows:
            a, b = set(x.split()), set(y.split())
            if t == u and i < j and a and b and (s := len(a & b) / (min(len(a), len(b)) if overlap else len(a | b))) >= least:
                want[t, i, j] = pytest.approx(s)
    assert got == want


def test_scoring_runs_go_on_where_they_stopped(spark):
    def scorer(model, text):
        if text == "down":
            raise ConnectionError
        if text == "odd":
            raise KeyError
        return {"p": 5.0 if text == "wild" else 0.5} if text else None

    items = spark.createDataFrame([(1, "fine"), (2, "down"), (3, "odd"), (4, "wild"), (5, None)], "id long, text string")
    first = written(labels.scoring_run(items, ["m", "n"], 2, scorer, {"p": (0.0, 1.0)}, ["id"]))
    assert first.count() == 20
    said = {(r.id, r.failure, r.detail) for r in first.collect()}
    assert said == {(1, None, None), (2, "transport", None), (3, "KeyError", None), (4, "schema", "p"), (5, "schema", None)}
    assert {r.scores["p"] for r in first.where("id = 1").collect()} == {0.5} and first.where("id = 4 AND scores IS NOT NULL").count() == 0
    again = labels.scoring_run(items, ["m", "n"], 2, scorer, {"p": (0.0, 1.0)}, ["id"], first)
    assert {r.id for r in again.collect()} == {2} and again.count() == 4


def test_model_bars_name_their_reasons(spark):
    c = spark.createDataFrame([("a", "p", 0.9), ("b", "p", 0.5), ("c", "p", None)], "model string, dimension string, corr double")
    sd = spark.createDataFrame([("a", "p", 0.01), ("b", "p", 0.3)], "model string, dimension string, sd double")
    ratio = spark.createDataFrame([("a", 0.99), ("b", 0.9), ("c", None)], "model string, ratio double")
    got = {r.model: (r.passed, r.reasons) for r in labels.model_bars(c, sd, ratio, {"p": 0.5}, ("p", 0.15), 0.95).collect()}
    assert got["a"] == (True, "") and got["b"] == (False, "p correlation 0.50 <= 0.5; p deviation 0.300 >= 0.15; compliance 0.900 <= 0.95")
    assert got["c"] == (False, "p correlation — <= 0.5; p deviation — >= 0.15; compliance unmeasured")
    passed = labels.gate_verdict(c).first()
    assert (passed.passed, passed.pairs, passed.below) == (False, 3, 2)


def test_thresholds_and_ranks(spark):
    draw = random.Random(5)
    rows = [(draw.randrange(12), draw.randrange(2)) for _ in range(200)] + [(None, 1)]
    df = spark.createDataFrame(rows, "score int, label int")
    known = [r for r in rows if r[0] is not None]
    p, q = [s for s, x in known if x], [s for s, x in known if not x]
    assert labels.auc(df).first().auc == pytest.approx(sum((a > b) + (a == b) / 2 for a in p for b in q) / len(p) / len(q))
    best = max(((sum(a >= t for a in p) / len(p) + sum(b < t for b in q) / len(q) - 1), -t) for t in {s for s, _ in known})
    got = labels.best_threshold(df).first()
    assert (got.youden, got.threshold) == (pytest.approx(best[0]), -best[1])
    assert labels.best_threshold(df.where("label = 1")).collect() == [] and labels.auc(df.where("label = 1")).first().auc is None


def test_greedy_selection_is_brute_force(spark):
    draw = random.Random(6)
    rows = [(draw.choice("uv"), i, 100 + i, [draw.choice("abcdef") for _ in range(draw.randint(0, 4))]) for i in range(120)]
    df = spark.createDataFrame(rows, "bucket string, seq long, article_id long, tokens array<string>").repartition(6)
    want = []
    for bucket in "uv":
        held = []
        for b, _, i, t in rows:
            s = set(t)
            if b == bucket and len(held) < 9 and not any(s and h and len(s & h) / len(s | h) >= 0.5 for h in held):
                held.append(s)
                want.append((bucket, i, len(held)))
    assert sorted((r.bucket, r.article_id, r.place) for r in labels.first_n_per_bucket(df, 9).collect()) == sorted(want)


def test_live_examples(spark):
    rows = [("1", D(2024, 1, 1), "first", "", 1), ("1", D(2024, 1, 2), "copy", "", 2), ("2", D(2024, 1, 9), "late", "", 3), ("3", D(2024, 1, 1), "vague", "", 4)]
    a = spark.createDataFrame(rows, "article_id string, day date, title string, description string, published_at int")
    r = spark.createDataFrame([("1", "A", "matched"), ("1", "B", "matched"), ("2", "A", "matched"), ("3", "A", "ambiguous")], "article_id string, ticker string, status string")
    got = labels.live_examples(a, r, spark.createDataFrame([("A", "Alpha")], "ticker string, name string"), "2024-01-01", "2024-01-05")
    assert sorted((x.article_id, x.ticker, x.name, x.title) for x in got.collect()) == [("1", "A", "Alpha", "first"), ("1", "B", "", "first")]


def test_backfill_goes_on_after_a_refusal(spark, tmp_path):
    days = [D(2024, 1, 1) + dt.timedelta(days=i) for i in range(10)]
    table = spark.createDataFrame([(d, "a", 1.0) for d in days], "date date, ticker string, x double")
    calendar, path = sessions.sessions_of(table), str(tmp_path / "b")

    def fetch(start, end, closed=D(2024, 1, 7)):
        if start >= closed:
            raise jobs.Refused("closed")
        return table.where(F.col("date").between(F.lit(start), F.lit(end)))

    bad = lambda df: quality.not_empty(df.limit(0), 1)
    got = [(r.rows, r.written, r.failed, r.state) for r in jobs.backfill_job(spark, path, calendar, fetch, 3, checks=bad).collect()]
    assert got == [(3, 3, 1, "done"), (3, 3, 1, "done"), (0, 0, 0, "stopped: closed")]
    again = jobs.backfill_job(spark, path, calendar, lambda a, b: fetch(a, b, D(2025, 1, 1)), 3).collect()
    assert [(str(r.start), r.written) for r in again] == [("2024-01-07", 3), ("2024-01-10", 1)]
    assert jobs.backfill_job(spark, path, calendar, fetch, 3).collect() == [] and versioned.load_versioned(spark, path).count() == 10


def test_collection_counts_and_goes_on(spark, tmp_path):
    df = lambda x: spark.createDataFrame([(D(2024, 1, 1), "a", 1.0), (D(2024, 1, 2), "a", x)], "date date, ticker string, x double")
    run = lambda x: {r.source: (r.ok, r.rows, r.new, r.revised) for r in jobs.collect(spark, {"bad": lambda: 1 / 0, "p": lambda: df(x)}, str(tmp_path)).collect()}
    assert run(1.0) == {"bad": (False, None, None, None), "p": (True, 2, 2, 0)}
    assert run(2.0)["p"] == (True, 2, 0, 1) and run(2.0)["p"] == (True, 2, 0, 0)


def test_calendar_cells(spark):
    cells = [(2024, "January", "30-31*"), (2024, "Apr/May", "30-1"), (2024, "Dec/Jan", "31-1"), (2024, "May", "22 (notation vote)"), (2024, "June", "soon")]
    got = vendors.normalize_calendar(spark.createDataFrame([("cpi", "2024-02-13"), ("jobs", "2024-02-02"), ("jobs", "x")], "event string, date string"), spark.createDataFrame(cells, "year int, month_text string, date_text string"))
    assert sorted((str(r.date_start), str(r.date), r.event, r.label, r.has_sep) for r in got.collect()) == [
        ("2024-01-30", "2024-01-31", "fomc", "FOMC 회의 (01/30~01/31) (경제전망요약)", True), ("2024-02-02", "2024-02-02", "jobs", "고용지표 발표", False), ("2024-02-13", "2024-02-13", "cpi", "CPI 발표", False),
        ("2024-04-30", "2024-05-01", "fomc", "FOMC 회의 (04/30~05/01)", False), ("2024-05-22", "2024-05-22", "fomc", "FOMC notation vote (05/22)", False), ("2024-12-31", "2025-01-01", "fomc", "FOMC 회의 (12/31~01/01)", False),
    ]


def test_watchlists_and_feeds(spark):
    w = spark.createDataFrame([("KR", "005930", "S"), ("KR", "005930", "S"), ("US", "AAPL", "A"), ("US", "005930", " "), (None, None, "x")], "market string, ticker string, name string")
    got = sorted((r.market or "", r.ticker or "", r.fault) for r in quality.watchlist(w, {"KR": "^[0-9]{6}$", "US": "^[A-Z.]{1,6}$"}).collect())
    assert got == [("", "", "no ticker"), ("KR", "005930", "listed twice"), ("US", "005930", "no name"), ("US", "005930", "ticker's form")]
    f = spark.createDataFrame([("a", "o", "s", "http://x", "x", True), ("a", "o", "s", "ftp://y", "y", True), ("b", None, "s", "http://x", "x", None)], "name string, outlet string, section string, url string, domain string, enabled boolean")
    assert sorted((r.name, r.fault) for r in quality.feeds(f).collect()) == [("a", "not http(s)"), ("a", "repeated name"), ("a", "shared url"), ("b", "missing outlet")]
    assert [r.fault for r in quality.feeds(f.where("url = 'ftp://y'").withColumn("enabled", F.lit(False))).collect()] == ["not http(s)", "none enabled"]


def test_suites(spark):
    days = [D(2024, 1, i) for i in (1, 2, 3, 4)]
    p = spark.createDataFrame([(d, t, 1.0) for d in days for t in "ab" if (d.day, t) != (2, "b")], "date date, ticker string, close double")
    cal = sessions.sessions_of(p)
    got = {r.name: r.passed for r in quality.price_suite(p, p.schema, cal, {"close": 0.0}).collect()}
    assert got == {"schema": True, "missing_ratio.close": True, "not_empty": True, "continuity[a]": True, "continuity[b]": False}
    none = {r.name: r.passed for r in quality.price_suite(p.limit(0), p.schema, cal, {"close": 0.0}).collect()}
    assert none == {"schema": True, "missing_ratio.close": False, "not_empty": False}
    flow = p.withColumns({"x": F.lit(1.0), "y": F.lit(-1.0), "short": F.when(F.col("date") < "2024-01-03", 1.0)})
    late = {r.name: r.passed for r in quality.flow_suite(flow, flow.schema, cal, {"x": 0.0}, {"short": 0.0}, ["x", "y"], 2).collect()}
    assert late["settled.missing_ratio.short"] and late["flow_identity"]
    young = {r.name: r.passed for r in quality.flow_suite(flow.where("date > '2024-01-02'"), flow.schema, cal, {"x": 0.0}, {"short": 0.0}, ["x", "y"], 2).collect()}
    assert young["settled.missing_ratio.short"]  # no session is old enough to judge
    both = quality.suites(a=quality.not_empty(p, 1), b=quality.not_empty(p.limit(0), 1)).collect()
    assert {(r.collector, r.passed) for r in both} == {("a", True), ("b", False)}
    known = quality.known_date(p, "k", F.col("ticker") == "a", "date", "2024-01-01").first()
    assert known.passed is False and known.detail.startswith("rows=4")


def test_weight_coverage_and_header(spark):
    w = spark.createDataFrame([("a", 0.5, True), ("b", -0.25, True), ("c", 0.35, False)], "feature string, weight double, active boolean")
    got = {r.kind: (r.weight, r.present, r.missing) for r in rating.weight_coverage(w, spark.createDataFrame([("a",)], "feature string")).collect()}
    assert got == {"active": (0.75, 0.5, "b"), "deferred": (0.35, 0.0, "c")}
    frame = lambda schema, *rows: spark.createDataFrame(list(rows), schema)
    facts = report.header_facts(
        frame("source string, newest date, rows long", ("p", D(2024, 1, 2), 3), ("q", None, 0)), frame("series string, last double, change double", ("S", 1.5, 0.01)), frame("kind string, n long", ("x/y", 2), ("a/b", 1)),
        frame("feed string, lost_hours double", ("f", 0.0)), frame("ticker string, n long"), frame("kind string, weight double, present double, missing string", ("active", 1.0, 1.0, "")), frame("articles long, ambiguous long", (10, 4)),
    )
    assert sorted((r.key, r.severity, r.text) for r in facts.collect()) == [
        ("ambiguous", "warning", "40.0% of 10 articles"), ("coverage", "info", "1.00/1.00 (100%)"), ("data", "info", "p 2024-01-02"), ("failures", "warning", "a/b, x/y×2"), ("market", "info", "S 1.50 (+1.00%)"),
    ]
    flags = spark.range(1).select(report.more_flags(F.lit(True), F.lit(-0.031), F.lit(-0.8), F.lit(2.0)).alias("f")).first().f
    assert flags == ["filing", "earnings_revision", "valuation_band"]


def test_sets_and_topicality_report(spark):
    a, b = spark.createDataFrame([(1,), (1,), (2,)], "k int"), spark.createDataFrame([(2,), (3,), (3,)], "k int")
    assert sorted((r.k, r.kind) for r in sets.set_difference(a, b).collect()) == [(1, "missing"), (3, "extra")]
    assert [r.k for r in sets.set_intersection(a, b).collect()] == [2]
    both = sets.key_set_compare(a.withColumn("g", F.lit("x")), b.withColumn("g", F.lit("x")), ["g", "k"], "g").first()
    assert (both.lost, both.gained) == (1, 1)
    items = spark.createDataFrame([("t", 1), ("t", 2), ("u", 3)], "ticker string, article_id int")
    assert {r.ticker: (r.pairs, r.kept, r.dropped) for r in similarity.topicality_report(items, items.where("article_id = 1")).collect()} == {"t": (2, 1, 1), "u": (1, 0, 1)}


def test_storage_keeps_to_its_own(spark, tmp_path):
    kept, gone = written(spark.range(3)), written(spark.range(4))
    own = str(tmp_path / "own")
    spark.range(2).write.parquet(own)
    discard(gone)
    discard(spark.read.parquet(own))
    assert kept.count() == 3 and spark.read.parquet(own).count() == 2
    with pytest.raises(Exception):  # noqa: B017  its files aren't there any more
        gone.count()
    assert shared_folder(spark) != shared_folder(spark)


def _titles(spark, n=90):
    draw = random.Random(8)
    made = [" ".join(draw.sample("abcdefgh", draw.randint(0, 5))) for _ in range(n // 3)]
    return spark.createDataFrame([(draw.choice(["k", "l", None]), i % 80, draw.choice(made) if i % 9 else None, float(i)) for i in range(n)], "ticker string, article_id long, title string, v double")


@pytest.mark.parametrize("least, overlap", [(0.35, False), (0.5, False), (0.35, True), (1.0, True)])
def test_title_pairs_of_blocks_and_chunks_are_all_pairs(spark, monkeypatch, least, overlap):
    monkeypatch.setattr(similarity, "TITLES", 4)
    monkeypatch.setattr(similarity, "MEMBERS", 2)
    t = _titles(spark)
    got = similarity.same_event_pairs(t, least=least, overlap=overlap, carry=["v"])
    assert not any(line.strip().startswith("Join") and "w#" in line for line in got._jdf.queryExecution().analyzed().toString().splitlines())
    rows, want = [(r.ticker, r.article_id, set((r.title or "").split()), r.v) for r in t.collect()], []
    for p in rows:
        for q in rows:
            if p[0] and p[0] == q[0] and p[1] < q[1] and p[2] and q[2]:
                shared = len(p[2] & q[2])
                s = shared / (min(len(p[2]), len(q[2])) if overlap else len(p[2] | q[2]))
                want += [(p[0], p[1], q[1], s, p[3], q[3])] if s >= least else []
    assert len(want) > 20 and sorted(map(tuple, got.collect())) == sorted(want)


def test_contradictions_of_classes_are_those_of_pairs(spark):
    t = _titles(spark)
    rows = t.where("ticker IS NOT NULL").select("article_id", "ticker", F.element_at(F.array(F.lit("positive"), F.lit("negative"), F.lit(None)), (F.col("v") % 7 % 3 + 1).cast("int")).alias("bucket"), F.lit("n").alias("name"), "title", F.lit("").alias("description"))
    members = similarity.titled(t)
    flags = lambda got: sorted(map(tuple, got.collect()))
    want = flags(conflicts.label_conflicts(rows, similarity.same_event_pairs(t)))
    assert any(f == "contradiction" for *_, f in want) and flags(conflicts.label_conflicts(rows, similarity.alike_classes(members), members)) == want
