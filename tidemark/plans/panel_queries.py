"""Rolling features, ratings and evaluation over the daily panel."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemark.functions.columns import group_or_own, safe_ratio, signed, signed_percent
from tidemark.operators import asof, evaluation, features, rating, report, rolling, sessions
from tidemark.plans.names import query, r
from tidemark.plans.panels import panel, series, sql

#: A year of sessions and the percentile's window, as the driver's panel has about 500 sessions a ticker.
YEAR, VALUATION = 252, 120

_P = sql("panel")
_PS = sql("panel", "sessions")
_W = "PARTITION BY ticker ORDER BY date"
_FILL = f"fill AS (SELECT *, last_value(close IGNORE NULLS) OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS f FROM panel)"


def _z(x: str, n: int = YEAR) -> str:
    w = f"OVER ({_W} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    return f"CASE WHEN count({x}) {w} = {n} AND stddev_samp({x}) {w} > 0 THEN ({x} - avg({x}) {w}) / stddev_samp({x}) {w} END"


def _sum_ratio(a: str, b: str, n: int = 5) -> str:
    w = f"OVER ({_W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({a}) {w} = {n} AND count({b}) {w} = {n} THEN sum({a}) {w} / nullif(sum({b}) {w}, 0) END"


def _change(n: int) -> str:
    return f"f / nullif(lag(f, {n}) OVER ({_W}), 0) - 1"


_CHANGES = {n: f"moved{n} AS (SELECT *, {_change(n)} AS ret{n} FROM fill)" for n in (1, 20, 120)}
_STRENGTH = lambda n: f"rel{n} AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY date, sector) > 1 THEN ret{n} - avg(ret{n}) OVER (PARTITION BY date, sector) END AS strength FROM moved{n})"
_BAND = f"""CASE WHEN count(close) OVER ({_W} ROWS BETWEEN {VALUATION - 1} PRECEDING AND CURRENT ROW) = {VALUATION} THEN
  (0.5 - (len(list_filter(list(close) OVER ({_W} ROWS BETWEEN {VALUATION - 1} PRECEDING AND CURRENT ROW), lambda v: v <= close)) - 1) / CAST({VALUATION - 1} AS DOUBLE)) * 2 END"""
_FEATURES = f"""{_P}, {_FILL}, {_CHANGES[20]}, {_STRENGTH(20)}, feats AS (
  SELECT *, {_sum_ratio('foreign_net', 'trading_value')} AS foreign_flow_5d, {_sum_ratio('inst_net', 'trading_value')} AS inst_flow_5d,
    lag(short_balance / nullif(volume, 0), 3) OVER ({_W}) AS short_ratio, {_BAND} AS valuation_band, strength AS rel_strength_20d
  FROM rel20
), scored AS (
  SELECT *, {_z('foreign_flow_5d')} AS foreign_flow_5d_z, {_z('inst_flow_5d')} AS inst_flow_5d_z, {_z('short_ratio')} AS short_ratio_z,
    {_z('rel_strength_20d')} AS rel_strength_20d_z, valuation_band AS valuation_band_z FROM feats
)"""
_TERM = lambda f, w: f"coalesce({f}_z * {w}, 0)"
_RATED = f"""{_FEATURES}, cov AS (
  SELECT *, ({' + '.join(_TERM(f, w) for f, w in rating.WEIGHTS.items())}) AS raw,
    ({' + '.join(f'CASE WHEN {f}_z IS NULL THEN 0.0 ELSE {abs(w)} END' for f, w in rating.WEIGHTS.items())})::DOUBLE / 0.75 AS coverage,
    concat_ws(',', {', '.join(f"CASE WHEN {f}_z IS NULL THEN '{f}' END" for f in rating.WEIGHTS)}) AS missing FROM scored
), levels AS (
  SELECT *, CASE WHEN coverage > 0 THEN raw / coverage ELSE 0 END AS score FROM cov
), rated AS (
  SELECT *, coverage < 0.5 - 1e-9 AS low_confidence, CASE WHEN coverage < 0.5 - 1e-9 THEN 'HOLD' WHEN score >= 2 THEN 'STRONG_BUY' WHEN score >= 1 THEN 'BUY' WHEN score >= 0.4 THEN 'WEAK_BUY'
    WHEN score <= -2 THEN 'STRONG_SELL' WHEN score <= -1 THEN 'SELL' WHEN score <= -0.4 THEN 'WEAK_SELL' ELSE 'HOLD' END AS rating FROM levels
)"""
_FORWARD = f"""{_PS}, forward AS (
  SELECT a.date, a.ticker, a.sector, b.close / nullif(b.open, 0) - 1 AS forward FROM panel a LEFT JOIN sessions s ON s.session_date = a.date LEFT JOIN panel b ON b.date = s.next_date AND b.ticker = a.ticker
), excess AS (
  SELECT *, forward - CASE WHEN count(*) OVER (PARTITION BY date, sector) > 1 THEN avg(forward) OVER (PARTITION BY date, sector) ELSE avg(forward) OVER (PARTITION BY date) END AS excess FROM forward
)"""
_SCORES = f"""{_FORWARD}, scores AS (SELECT date, ticker, {_sum_ratio('foreign_net', 'trading_value')} AS score FROM panel),
pairs AS (SELECT s.date, s.ticker, s.score, e.excess FROM scores s JOIN excess e USING (date, ticker) WHERE s.score IS NOT NULL AND e.excess IS NOT NULL)"""
_RANKED = f"""{_SCORES}, ranked AS (
  SELECT date, rank() OVER (PARTITION BY date ORDER BY score) + (count(*) OVER (PARTITION BY date, score) - 1) / 2.0::DOUBLE AS x,
    rank() OVER (PARTITION BY date ORDER BY excess) + (count(*) OVER (PARTITION BY date, excess) - 1) / 2.0::DOUBLE AS y FROM pairs
), ic AS (SELECT date, count(*) AS n, corr(x, y) AS ic FROM ranked GROUP BY date HAVING count(DISTINCT x) > 1 AND count(DISTINCT y) > 1)"""
_BASKET = f"""{_SCORES}, held AS (
  SELECT date, ticker FROM (SELECT date, ticker, row_number() OVER (PARTITION BY date ORDER BY score DESC, ticker) AS k, count(*) OVER (PARTITION BY date) AS n FROM scores WHERE score IS NOT NULL)
  WHERE k <= greatest(1, ceil(n * 0.2)) AND day(date) % 5 = 0
), days AS (SELECT DISTINCT date FROM forward), decided AS (SELECT DISTINCT date AS decided FROM held),
basket AS (SELECT days.date, max(decided) AS decided FROM days JOIN decided ON decided <= days.date GROUP BY days.date),
carried AS (SELECT b.date, avg(f.forward) AS ret, count(*) AS n FROM basket b JOIN held h ON h.date = b.decided JOIN forward f ON f.date = b.date AND f.ticker = h.ticker WHERE f.forward IS NOT NULL GROUP BY b.date),
bench AS (SELECT date, forward AS ret FROM forward WHERE ticker = 1 AND forward IS NOT NULL),
track AS (SELECT date, product(1 + c.ret) OVER (ORDER BY date) - 1 AS portfolio, product(1 + bench.ret) OVER (ORDER BY date) - 1 AS benchmark FROM carried c JOIN bench USING (date))"""


def _panel(s, d):
    return panel(s, d).withColumn("sector", group_or_own("sector", "ticker"))


def _calendar(s, d):
    return sessions.sessions_of(panel(s, d).select("date"))


def _scored(s, d):
    return features.panel_features(panel(s, d), YEAR, VALUATION, keep=("date", "ticker"))


def _rated(s, d):
    return rating.rate(_scored(s, d))


def _scores(s, d):
    return panel(s, d).select("date", "ticker", rolling.rolling_sum_ratio("foreign_net", "trading_value", rolling.by()).alias("score"))


def _excess(s, d):
    p = panel(s, d)
    return features.excess_return(evaluation.forward_return(p, _calendar(s, d)).join(p.select("date", "ticker", "sector"), ["date", "ticker"]))


def _pairs(s, d):
    return evaluation.paired(_scores(s, d), _excess(s, d))


def _held(s, d):
    """Baskets that are decided anew on some days only, so that there is something to carry forward between them."""
    return evaluation.top_fraction(_scores(s, d)).where(F.dayofmonth("date") % 5 == 0)


def _forward(s, d):
    return evaluation.forward_return(panel(s, d), _calendar(s, d))


def _track(s, d):
    f = _forward(s, d)
    return evaluation.curve(evaluation.carried_returns(_held(s, d), f), evaluation.benchmark_returns(f, 1))


def _columns(name: str, column, expression: str, source: str = "panel"):
    """A query of one computed column per panel row."""

    @query(name, f"{_P} SELECT date, ticker, {r(expression, 'value')} FROM {source}")
    def run(s, d):
        return panel(s, d).select("date", "ticker", column().alias("value"))


_w = rolling.by
_columns("rolling_sum_ratio", lambda: rolling.rolling_sum_ratio("foreign_net", "trading_value", _w()), _sum_ratio("foreign_net", "trading_value"))
_columns("flow_persistence_60d", lambda: rolling.rolling_sum_ratio("foreign_net", "trading_value", _w(), 60), _sum_ratio("foreign_net", "trading_value", 60))
@query("rolling_z", f"{_P} SELECT date, ticker, {r(_z('close'), 'value')} FROM panel")
def _(s, d):
    return rolling.with_rolling_z(panel(s, d).select("date", "ticker", "close"), {"value": "close"}, YEAR).drop("close")


_columns("by_ticker", lambda: rolling.rolling_z("trading_value", _w(), 20), _z("trading_value", 20))
@query("rolling_percentile", f"{_P} SELECT date, ticker, {r(f'0.5 - ({_BAND}) / 2', 'value')} FROM panel")
def _(s, d):
    return rolling.with_rolling_percentile(panel(s, d), "close", "value", VALUATION).select("date", "ticker", "value")


@query("valuation_band", f"{_P} SELECT date, ticker, {r(_BAND, 'value')} FROM panel")
def _(s, d):
    return rolling.with_rolling_percentile(panel(s, d), "close", "p", VALUATION).select("date", "ticker", rolling.band(F.col("p")).alias("value"))


_columns("lagged_ratio", lambda: rolling.lagged_ratio("short_balance", "volume", _w()), f"lag(short_balance / nullif(volume, 0), 3) OVER ({_W})")
_columns("safe_ratio", lambda: safe_ratio("short_balance", "trading_value"), "short_balance / nullif(trading_value, 0)")


def _moved(name: str, n: int):
    @query(name, f"{_P}, {_FILL}, {_CHANGES[n]} SELECT date, ticker, {r(f'ret{n}', 'ret')} FROM moved{n}")
    def run(s, d):
        return rolling.pct_change(panel(s, d), "close", n, _w(), "ret").select("date", "ticker", "ret")


_moved("pct_change", 20)


def _strength(name: str, n: int):
    @query(name, f"{_P}, {_FILL}, {_CHANGES[n]}, {_STRENGTH(n)} SELECT date, ticker, {r('strength', 'rel_strength')} FROM rel{n}")
    def run(s, d):
        return features.rel_strength(_panel(s, d), n).select("date", "ticker", "rel_strength")


_strength("rel_strength", 20)
_strength("rel_strength_120d", 120)


@query("group_mean_if_peers", f"{_P}, {_FILL}, {_CHANGES[20]} SELECT date, ticker, {r('CASE WHEN count(*) OVER (PARTITION BY date, sector) > 1 THEN avg(ret20) OVER (PARTITION BY date, sector) END', 'mean')} FROM moved20")
def _(s, d):
    moved = rolling.pct_change(_panel(s, d), "close", 20, _w(), "ret")
    return features.group_mean_if_peers(moved, "ret", "sector").select("date", "ticker", "mean")


@query("volatility_z", f"""{_P}, {_FILL}, {_CHANGES[1]}, vol AS (SELECT date, ticker, CASE WHEN count(ret1) OVER ({_W} ROWS 19 PRECEDING) = 20 THEN stddev_samp(ret1) OVER ({_W} ROWS 19 PRECEDING) END AS vol FROM moved1)
SELECT date, ticker, {r(_z('vol'), 'volatility_z')} FROM vol""")
def _(s, d):
    return features.volatility_z(panel(s, d), YEAR)


@query("rv_20d", f"""{_P}, l AS (SELECT date, ticker, CASE WHEN close / nullif(lag(close) OVER ({_W}), 0) > 0 THEN ln(close / lag(close) OVER ({_W})) END AS l FROM panel)
SELECT date, ticker, {r(f'CASE WHEN count(l) OVER ({_W} ROWS 19 PRECEDING) = 20 THEN stddev_samp(l) OVER ({_W} ROWS 19 PRECEDING) * sqrt(252) END', 'rv')} FROM l""")
def _(s, d):
    return features.realised_volatility(panel(s, d))


@query("feature_attach", f"{_FEATURES} SELECT date, ticker, {', '.join(r(c) for f in features.FEATURES for c in (f, f + '_z'))} FROM scored")
def _(s, d):
    return _scored(s, d).select("date", "ticker", *[c for f in features.FEATURES for c in (f, f"{f}_z")])


@query("z_scores_for", f"{_FEATURES} SELECT ticker, {', '.join(r(f + '_z', f) for f in features.FEATURES)} FROM scored WHERE date = (SELECT max(date) FROM panel)")
def _(s, d):
    scored = _scored(s, d)
    last = panel(s, d).agg(F.max("date").alias("date"))
    keys = panel(s, d).select("date", "ticker").join(F.broadcast(last), "date", "left_semi")
    return features.z_scores_for(scored.join(F.broadcast(last), "date", "left_semi"), keys).select("ticker", *[F.col("z")[f].alias(f) for f in features.FEATURES])


@query("sector_map", "SELECT s_suppkey AS ticker, CASE WHEN s_nationkey % 5 = 0 THEN '__no_sector__:' || s_suppkey ELSE CAST(s_nationkey AS VARCHAR) END AS sector FROM supplier")
def _(s, d):
    t = s.read.parquet(f"{d}/supplier.parquet").select(F.col("s_suppkey").alias("ticker"), F.when(F.col("s_nationkey") % 5 != 0, F.col("s_nationkey").cast("string")).alias("sector"))
    return t.select("ticker", group_or_own("sector", "ticker").alias("sector"))


@query("rate", f"{_RATED} SELECT date, ticker, rating, {r('score')}, {r('coverage', 'weight_coverage')}, missing, low_confidence FROM rated")
def _(s, d):
    return _rated(s, d).drop("terms")


@query("bucket", f"{_RATED} SELECT rating, low_confidence, count(*) AS n FROM rated GROUP BY rating, low_confidence")
def _(s, d):
    return _rated(s, d).groupBy("rating", "low_confidence").agg(F.count("*").alias("n"))


@query("coverage_floor", f"{_RATED} SELECT date, ticker, {r('coverage', 'weight_coverage')} FROM rated WHERE low_confidence")
def _(s, d):
    return _rated(s, d).where("low_confidence").select("date", "ticker", "weight_coverage")


@query("decompose", f"{_RATED} " + " UNION ALL ".join(f"SELECT date, ticker, '{f}' AS feature, {r(f + '_z', 'z')}, CAST({w} AS DOUBLE) AS weight, {r(f'{f}_z * {w}', 'value')}, {r(f'{f}_z * {w} / coverage', 'in_score')} FROM rated WHERE {f}_z IS NOT NULL" for f, w in rating.WEIGHTS.items()))
def _(s, d):
    return rating.decompose(_rated(s, d)).drop("score", "weight_coverage")


@query("rationale_topk", f"""{_RATED}, long AS ({' UNION ALL '.join(f"SELECT date, ticker, {i} AS place, '{f}' AS feature, {f}_z * {w} AS value FROM rated WHERE {f}_z IS NOT NULL" for i, (f, w) in enumerate(rating.WEIGHTS.items()))}),
k AS (SELECT *, row_number() OVER (PARTITION BY date, ticker ORDER BY abs(value) DESC, place) AS k FROM long)
SELECT date, ticker, string_agg(feature, ',' ORDER BY k) FILTER (WHERE k <= 4) AS top, {r('coalesce(sum(value) FILTER (WHERE k > 4), 0)', 'residual')} FROM k GROUP BY date, ticker""")
def _(s, d):
    top = rating.rationale(_rated(s, d).where("weight_coverage > 0"))
    return top.select("date", "ticker", F.array_join(F.transform("top", lambda t: t["feature"]), ",").alias("top"), "residual")


@query("rate_all", f"""{_RATED} SELECT s_suppkey + 0 AS ticker, coalesce(rating, 'HOLD') AS rating, (round(coalesce(score, 0), 6) + 0.0) AS score, (round(coalesce(coverage, 0), 6) + 0.0) AS weight_coverage
FROM supplier LEFT JOIN (SELECT * FROM rated WHERE date = DATE '1997-06-02') t ON t.ticker = s_suppkey""")
def _(s, d):
    watch = s.read.parquet(f"{d}/supplier.parquet").select(F.col("s_suppkey").alias("ticker"))
    return rating.rate_all(watch, _scored(s, d), F.lit("1997-06-02").cast("date")).select("ticker", "rating", "score", "weight_coverage")


_WEIGHTS = f"""w AS ({' UNION ALL '.join([f"SELECT 'active' AS kind, '{f}' AS feature, {abs(w)}::DOUBLE AS weight, (SELECT count({f}_z) > 0 FROM scored) AS made" for f, w in rating.WEIGHTS.items()] + [f"SELECT 'deferred', '{f}', {abs(w)}::DOUBLE, FALSE" for f, w in rating.DEFERRED.items()])}),
coverage AS (SELECT kind, sum(weight) AS weight, coalesce(sum(weight) FILTER (WHERE made), 0) AS present, coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (WHERE NOT made), '') AS missing FROM w GROUP BY kind)"""


def _weight_coverage(s, d):
    weights = [(f, float(w), True) for f, w in rating.WEIGHTS.items()] + [(f, float(w), False) for f, w in rating.DEFERRED.items()]
    return rating.weight_coverage(s.createDataFrame(weights, "feature string, weight double, active boolean"), rating.produced(_scored(s, d), rating.WEIGHTS))


@query("weight_coverage", f"{_FEATURES}, {_WEIGHTS} SELECT kind, {r('weight')}, {r('present')}, missing FROM coverage")
def _(s, d):
    return _weight_coverage(s, d)


@query("news_flags", f"""{_P}, f AS (SELECT p.date, p.ticker, {_BAND} AS band, {_z('volume', 20)} AS news FROM panel p), v AS (SELECT a.date, a.ticker, a.close / nullif(b.close, 0) - 1 AS change FROM panel a ASOF LEFT JOIN panel b ON a.ticker = b.ticker AND b.date <= a.date - INTERVAL 28 DAY),
filed AS (SELECT DISTINCT CAST(o_orderdate AS DATE) + 1 AS date, o_custkey AS ticker FROM orders)
SELECT f.date, f.ticker, concat_ws(',', CASE WHEN x.ticker IS NOT NULL THEN 'filing' END, CASE WHEN abs(change) > 0.03 THEN 'earnings_revision' END, CASE WHEN abs(band) >= 0.8 THEN 'valuation_band' END, CASE WHEN news > 2 THEN 'news_spike' END) AS flags FROM f JOIN v USING (date, ticker) LEFT JOIN filed x ON x.date = f.date AND x.ticker = f.ticker""")
def _(s, d):
    p, keys = panel(s, d), ["date", "ticker"]
    base = rolling.with_rolling_percentile(p, "close", "p", VALUATION).select(*keys, rolling.band(F.col("p")).alias("band"), rolling.rolling_z("volume", rolling.by(), 20).alias("news"))
    filed = s.read.parquet(f"{d}/orders.parquet").select(F.date_add(F.to_date("o_orderdate"), 1).alias("date"), F.col("o_custkey").alias("ticker"), F.lit(True).alias("filed")).distinct()
    got = base.join(features.revision_change(p, 28, "close"), keys).join(filed, keys, "left")
    return got.select(*keys, F.array_join(report.more_flags(F.col("filed"), F.col("change"), F.col("band"), F.col("news")), ",").alias("flags"))


@query("all_zero_coverage_guard", f"{_RATED} SELECT date, max(coverage) > 0 AS worth_storing FROM rated GROUP BY date")
def _(s, d):
    return _rated(s, d).groupBy("date").agg((F.max("weight_coverage") > 0).alias("worth_storing"))


@query("rating_order", f"{_RATED} SELECT date, ticker, CAST(row_number() OVER (PARTITION BY date ORDER BY abs(round(score, 9)) DESC, ticker) AS INT) AS place FROM rated")
def _(s, d):
    w = Window.partitionBy("date").orderBy(F.desc(F.abs(F.round("score", 9))), "ticker")
    return _rated(s, d).select("date", "ticker", F.row_number().over(w).alias("place"))


@query("ratings_table")
def _(s, d):
    return report.ratings_table(_rated(s, d))


@query("score_percentiles", f"""{_RATED}, q AS (SELECT quantile_cont(abs(score), [0.5, 0.75, 0.9, 0.95, 0.99]) AS v FROM rated)
SELECT unnest([0.5, 0.75, 0.9, 0.95, 0.99])::DOUBLE AS p, (round(unnest(v), 6) + 0.0) AS value FROM q""")
def _(s, d):
    return evaluation.score_percentiles(_rated(s, d))


@query("cut_point_table", f"{_RATED} SELECT c.cut, c.threshold::DOUBLE AS threshold, {r('avg(CASE WHEN abs(score) >= c.threshold THEN 1.0 ELSE 0.0 END)', 'share')} FROM rated, (VALUES ('strong', 2.0), ('moderate', 1.0), ('weak', 0.4)) c(cut, threshold) GROUP BY c.cut, c.threshold")
def _(s, d):
    return evaluation.cut_point_table(_rated(s, d), rating.CUTS)


@query("bucket_counts", f"""{_RATED}, now AS (SELECT rating, CASE WHEN low_confidence THEN 'HOLD' WHEN score >= 1 THEN 'STRONG_BUY' WHEN score >= 0.5 THEN 'BUY' WHEN score >= 0.2 THEN 'WEAK_BUY' WHEN score <= -1 THEN 'STRONG_SELL' WHEN score <= -0.5 THEN 'SELL' WHEN score <= -0.2 THEN 'WEAK_SELL' ELSE 'HOLD' END AS again FROM rated)
SELECT l.rating, (SELECT count(*) FROM now WHERE now.rating = l.rating) AS published, (SELECT count(*) FROM now WHERE again = l.rating) AS current
FROM (VALUES ('STRONG_BUY'), ('BUY'), ('WEAK_BUY'), ('HOLD'), ('WEAK_SELL'), ('SELL'), ('STRONG_SELL')) l(rating)""")
def _(s, d):
    again = F.when(F.col("low_confidence"), "HOLD").otherwise(rating.bucket(F.col("score"), {"strong": 1.0, "moderate": 0.5, "weak": 0.2}))
    return evaluation.bucket_counts(_rated(s, d), again, rating.LEVELS)


@query("weight_influence", f"""{_FEATURES}, long AS ({' UNION ALL '.join(f"SELECT '{f}' AS feature, {w}::DOUBLE AS weight, {f}_z AS z FROM scored" for f, w in rating.WEIGHTS.items())}),
g AS (SELECT feature, weight, count(z) AS n, avg(abs(z)) AS m FROM long GROUP BY feature, weight)
SELECT feature, {r('abs(weight) / 0.75', 'designed')}, n, {r('m', 'mean_abs_z')}, {r('m * abs(weight)', 'mean_abs_contribution')},
  {r('m * abs(weight) / sum(m * abs(weight)) OVER ()', 'realised')}, {r('m * abs(weight) / sum(m * abs(weight)) OVER () - abs(weight) / 0.75', 'delta')} FROM g""")
def _(s, d):
    return evaluation.weight_influence(_scored(s, d), rating.WEIGHTS)


@query("forward_return", f"{_FORWARD} SELECT date, ticker, {r('forward')} FROM forward")
def _(s, d):
    return _forward(s, d)


@query("excess_return", f"{_FORWARD} SELECT date, ticker, {r('excess')} FROM excess")
def _(s, d):
    return _excess(s, d).select("date", "ticker", "excess")


@query("paired", f"{_SCORES} SELECT date, ticker, {r('score')}, {r('excess')} FROM pairs WHERE date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'")
def _(s, d):
    return evaluation.paired(_scores(s, d), _excess(s, d), start="1996-01-01", end="1996-12-31")


@query("daily_ic", f"{_RANKED} SELECT date, n, {r('ic')} FROM ic")
def _(s, d):
    return evaluation.daily_ic(_pairs(s, d))


@query("icir", f"{_RANKED} SELECT count(*) AS n, {r('avg(ic)', 'mean_ic')}, {r('stddev_samp(ic)', 'sd_ic')}, {r('avg(ic) / stddev_samp(ic)', 'icir')} FROM ic")
def _(s, d):
    return evaluation.icir(evaluation.daily_ic(_pairs(s, d)))


@query("bootstrap_ci")
def _(s, d):
    return evaluation.bootstrap_ci(evaluation.daily_ic(_pairs(s, d)))


@query("quantile_spread", f"""{_SCORES}, k AS (SELECT date, excess, count(*) OVER (PARTITION BY date) AS n, greatest(1, ceil(count(*) OVER (PARTITION BY date) * 0.2)) AS k,
  row_number() OVER (PARTITION BY date ORDER BY score DESC, ticker) AS t, row_number() OVER (PARTITION BY date ORDER BY score, ticker) AS b FROM pairs)
SELECT date, max(n) AS n, {r('avg(excess) FILTER (WHERE t <= k) - avg(excess) FILTER (WHERE b <= k)', 'spread')} FROM k WHERE n >= 2 * k GROUP BY date""")
def _(s, d):
    return evaluation.quantile_spread(_pairs(s, d))


@query("top_fraction_per_group", f"{_SCORES} SELECT date, ticker FROM (SELECT date, ticker, row_number() OVER (PARTITION BY date ORDER BY score DESC, ticker) AS k, count(*) OVER (PARTITION BY date) AS n FROM scores WHERE score IS NOT NULL) WHERE k <= greatest(1, ceil(n * 0.2))")
def _(s, d):
    return evaluation.top_fraction(_scores(s, d))


@query("carry_forward_basket", f"{_BASKET} SELECT date, {r('ret')}, n FROM carried")
def _(s, d):
    return evaluation.carried_returns(_held(s, d), _forward(s, d))


@query("benchmark_returns", f"{_BASKET} SELECT date, {r('ret')} FROM bench")
def _(s, d):
    return evaluation.benchmark_returns(_forward(s, d), 1)


@query("benchmark_curve", f"{_BASKET} SELECT date, {r('portfolio')}, {r('benchmark')} FROM track")
def _(s, d):
    return _track(s, d)


@query("cumulative_return", f"{_P}, {_FILL}, {_CHANGES[1]} SELECT date, ticker, {r('product(1 + ret1) OVER (PARTITION BY ticker ORDER BY date) - 1', 'cumulative')} FROM moved1 WHERE ret1 IS NOT NULL")
def _(s, d):
    moved = rolling.pct_change(panel(s, d), "close", 1, rolling.by(), "ret").where("ret IS NOT NULL")
    return moved.select("date", "ticker", rolling.cumulative_return("ret", rolling.by()).alias("cumulative"))


@query("shadow_summary", f"{_BASKET} SELECT {r('arg_max(portfolio, date)', 'portfolio')}, {r('arg_max(benchmark, date)', 'benchmark')}, {r('arg_max(portfolio, date) - arg_max(benchmark, date)', 'excess')}, count(*) AS sessions FROM track")
def _(s, d):
    return evaluation.shadow_summary(_track(s, d))


@query("net_of_cost_curve", f"""{_BASKET}, sets AS (SELECT date, list(ticker) AS now, lag(list(ticker)) OVER (ORDER BY date) AS before FROM held GROUP BY date),
turn AS (SELECT date, CASE WHEN before IS NULL THEN 1.0::DOUBLE ELSE len(list_filter(now, lambda x: NOT list_contains(before, x)))::DOUBLE / len(now) END AS turnover FROM sets)
SELECT c.date, {r('coalesce(turnover, 0.0::DOUBLE)', 'turnover')}, {r('ret - coalesce(turnover, 0) * 0.003', 'ret')} FROM carried c LEFT JOIN turn USING (date)""")
def _(s, d):
    return evaluation.net_of_cost(_held(s, d), evaluation.carried_returns(_held(s, d), _forward(s, d)), 0.003)


@query("visible_as_of", f"{_P} SELECT date, ticker, {r('close')} FROM panel WHERE known_at_utc < TIMESTAMP '1995-03-01 06:30:00'")
def _(s, d):
    return sessions.visible_as_of(panel(s, d), "1995-03-01 06:30:00").select("date", "ticker", "close")


@query("in_window", f"{_P} SELECT date, ticker FROM panel WHERE date BETWEEN DATE '1996-01-01' AND DATE '1996-03-31'")
def _(s, d):
    return panel(s, d).where("date BETWEEN '1996-01-01' AND '1996-03-31'").select("date", "ticker")


@query("next_session", f"{_PS} SELECT session_date, previous_date, next_date FROM sessions")
def _(s, d):
    return sessions.with_neighbours(_calendar(s, d)).select("session_date", "previous_date", "next_date")


@query("last_closed_session", f"{_PS} SELECT max(session_date) AS session_date FROM sessions WHERE close_utc <= TIMESTAMP '1996-05-05 12:00:00'")
def _(s, d):
    return sessions.last_closed_session(_calendar(s, d), "1996-05-05 12:00:00")


@query("trading_days", f"{_PS} SELECT session_date FROM sessions WHERE session_date BETWEEN DATE '1995-01-01' AND DATE '1995-06-30' AND day(session_date) <> 1")
def _(s, d):
    c = _calendar(s, d)
    return sessions.trading_days(c, "1995-01-01", "1995-06-30", c.where(F.dayofmonth("session_date") == 1).select("session_date")).select("session_date")


@query("is_trading_day", f"{_PS} SELECT o_orderkey, CAST(o_orderdate AS DATE) IN (SELECT session_date FROM sessions) AS is_session FROM orders")
def _(s, d):
    o = s.read.parquet(f"{d}/orders.parquet").select("o_orderkey", F.to_date("o_orderdate").alias("date"))
    return sessions.is_trading_day(o, _calendar(s, d)).select("o_orderkey", "is_session")


@query("session_stamp", f"{_PS} SELECT o_orderkey, close_utc AS known_at_utc FROM orders LEFT JOIN sessions ON session_date = CAST(o_orderdate AS DATE)")
def _(s, d):
    o = s.read.parquet(f"{d}/orders.parquet").select("o_orderkey", F.to_date("o_orderdate").alias("date"))
    return sessions.session_stamp(o, _calendar(s, d)).select("o_orderkey", "known_at_utc")


@query("calendar_shift_join", f"{_PS} SELECT a.date, a.ticker, {r('b.close', 'next_close')} FROM panel a LEFT JOIN sessions ON session_date = a.date LEFT JOIN panel b ON b.date = next_date AND b.ticker = a.ticker")
def _(s, d):
    p, steps = panel(s, d), sessions.with_neighbours(_calendar(s, d)).select(F.col("session_date").alias("date"), "next_date")
    return p.select("date", "ticker").join(F.broadcast(steps), "date", "left").join(p.select(F.col("date").alias("next_date"), "ticker", F.col("close").alias("next_close")), ["next_date", "ticker"], "left").select("date", "ticker", "next_close")


@query("options_expiration", f"""{_PS}, m AS (SELECT DISTINCT CAST(date_trunc('month', session_date) AS DATE) AS month FROM sessions),
f AS (SELECT month, CAST(month + to_days(CAST((5 - dayofweek(month) + 7) % 7 + 14 AS INT)) AS DATE) AS friday FROM m)
SELECT month, friday, (SELECT max(session_date) FROM sessions WHERE session_date <= friday) AS expires FROM f""")
def _(s, d):
    return sessions.options_expiration(_calendar(s, d))


@query("date_chunks", "SELECT CAST(a AS DATE) AS start, CAST(least(a + INTERVAL 29 DAY, (SELECT max(o_orderdate) FROM orders)) AS DATE) AS \"end\" FROM (SELECT unnest(generate_series((SELECT CAST(min(o_orderdate) AS DATE) FROM orders), (SELECT CAST(max(o_orderdate) AS DATE) FROM orders), INTERVAL 30 DAY)) AS a)")
def _(s, d):
    lo, hi = s.read.parquet(f"{d}/orders.parquet").agg(F.to_date(F.min("o_orderdate")), F.to_date(F.max("o_orderdate"))).first()
    return sessions.date_chunks(s, str(lo), str(hi), 30)


_SERIES = sql("series")
_ASOF = f"""{_SERIES}, l AS (SELECT date, value AS y FROM series WHERE series = '1-URGENT' AND date % 2 = 0), q AS (SELECT date, value AS x FROM series WHERE series = '5-LOW')"""
_ASOF = _ASOF.replace("date % 2 = 0", "day(date) % 2 = 0")


@query("asof_prior_strict", f"{_ASOF} SELECT l.date, {r('y')}, {r('x')} FROM l ASOF LEFT JOIN q ON l.date > q.date")
def _(s, d):
    m = series(s, d).withColumn("all", F.lit(0))
    left = m.where("series = '1-URGENT' AND day(date) % 2 = 0").select("all", "date", F.col("value").alias("y"))
    right = m.where("series = '5-LOW'").select("all", F.col("date").alias("d"), F.col("value").alias("x"))
    return asof.asof_prior_strict(left, right, ["all"], "date", "d", ["x"]).select("date", "y", "x")


@query("change_over", f"""{_SERIES}, k AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY date DESC) AS k FROM series)
SELECT series, {r('max(value) FILTER (WHERE k = 1)', 'last')}, {r('max(value) FILTER (WHERE k = 1) - max(value) FILTER (WHERE k = 121)', 'change')} FROM k GROUP BY series""")
def _(s, d):
    return rolling.change_over(series(s, d), "series", "date", "value", 120)


@query("regime_table", f"""{_SERIES}, k AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY date DESC) AS k FROM series)
SELECT series, {r('max(value) FILTER (WHERE k = 1)', 'last')}, {r('max(value) FILTER (WHERE k = 1) - max(value) FILTER (WHERE k = 61)', 'change')} FROM k GROUP BY series""")
def _(s, d):
    return report.regime(series(s, d), 60)


@query("series_at", f"{_SERIES} SELECT date, {r('value')} FROM series WHERE series = '2-HIGH'")
def _(s, d):
    return series(s, d).where("series = '2-HIGH'").select("date", "value")


_LEGS = f"""{_SERIES}, rets AS (SELECT date, series, value / nullif(lag(value) OVER (PARTITION BY series ORDER BY date), 0) - 1 AS ret FROM series),
map AS (SELECT * FROM (VALUES ('1-URGENT', '5-LOW'), ('1-URGENT', '2-HIGH'), ('3-MEDIUM', '2-HIGH')) m(us, sector)),
pairs AS (SELECT us, sector, y.date, y.ret AS y, x.ret AS x FROM (SELECT map.us, map.sector, rets.date, ret FROM rets JOIN map ON map.sector = rets.series WHERE ret IS NOT NULL) y ASOF JOIN (SELECT series, date, ret FROM rets WHERE ret IS NOT NULL) x ON x.series = y.us AND y.date > x.date),
k AS (SELECT *, row_number() OVER (PARTITION BY us, sector ORDER BY date DESC) AS k FROM pairs),
c AS (SELECT us, sector, count(*) AS n, CASE WHEN count(*) >= 30 THEN corr(x, y) END AS corr FROM k WHERE k <= 60 GROUP BY us, sector)"""


def _legs(s, d):
    w = Window.partitionBy("series").orderBy("date")
    rets = series(s, d).select("date", "series", (safe_ratio("value", F.lag("value").over(w)) - 1).alias("ret"))
    mapping = s.createDataFrame([("1-URGENT", "5-LOW"), ("1-URGENT", "2-HIGH"), ("3-MEDIUM", "2-HIGH")], "us string, sector string")
    return rets.withColumnRenamed("series", "sector"), rets.withColumnRenamed("series", "us"), mapping


@query("transmission_table", f"{_LEGS} SELECT us, sector, n, {r('corr')}, CASE WHEN corr IS NULL THEN 'insufficient' WHEN corr >= 0.3 THEN 'valid' WHEN corr >= 0.1 THEN 'weak' ELSE 'broken' END AS reading FROM c")
def _(s, d):
    return report.transmission(*_legs(s, d))


@query("rolling_tail_corr", f"{_LEGS} SELECT us, sector, n, {r('corr')} FROM c")
def _(s, d):
    return report.transmission(*_legs(s, d)).drop("reading")


@query("us_kr_beta_60d", f"""{_LEGS}, b AS (SELECT *, count(*) OVER w AS n60, covar_samp(x, y) OVER w AS cv, var_samp(x) OVER w AS vx FROM pairs WINDOW w AS (PARTITION BY us, sector ORDER BY date ROWS 59 PRECEDING))
SELECT us, sector, date, {r('CASE WHEN n60 = 60 THEN cv / nullif(vx, 0) END', 'beta')} FROM b""")
def _(s, d):
    kr, us, mapping = _legs(s, d)
    left = kr.where("ret IS NOT NULL").join(F.broadcast(mapping), "sector").select("us", "sector", "date", F.col("ret").alias("y"))
    right = us.where("ret IS NOT NULL").join(F.broadcast(mapping), "us").select("us", "sector", F.col("date").alias("d"), F.col("ret").alias("x"))
    pairs = asof.asof_prior_strict(left, right, ["us", "sector"], "date", "d", ["x"]).where("x IS NOT NULL")
    return pairs.select("us", "sector", "date", rolling.rolling_beta("x", "y", Window.partitionBy("us", "sector").orderBy("date"), 60).alias("beta"))


@query("index_returns", f"{_P}, {_FILL} SELECT ticker, date, {r(_change(1), 'ret_1')}, {r(_change(20), 'ret_20')} FROM fill")
def _(s, d):
    return report.index_returns(panel(s, d))


@query("format_pct", f"{_P} SELECT date, ticker, coalesce(printf('%+.2f%%', round(inst_net / nullif(trading_value, 0), 2) + 0.0), '—') AS shown FROM panel")
def _(s, d):
    return panel(s, d).select("date", "ticker", signed_percent(F.round(safe_ratio("inst_net", "trading_value"), 2) / 100).alias("shown"))


@query("format_z", f"{_P} SELECT date, ticker, coalesce(printf('%+.1f', round(inst_net / nullif(trading_value, 0), 1) + 0.0), '—') AS shown FROM panel")
def _(s, d):
    return panel(s, d).select("date", "ticker", signed(F.round(safe_ratio("inst_net", "trading_value"), 1), 1).alias("shown"))


@query("scan_table", f"""{_FEATURES}, v1 AS (SELECT *, {_change(1)} AS ret1 FROM (SELECT *, last_value(close IGNORE NULLS) OVER ({_W}) AS f FROM panel)),
v2 AS (SELECT date, ticker, CASE WHEN count(ret1) OVER ({_W} ROWS 19 PRECEDING) = 20 THEN stddev_samp(ret1) OVER ({_W} ROWS 19 PRECEDING) END AS vol FROM v1),
v3 AS (SELECT date, ticker, {_z('vol')} AS vol_z FROM v2),
news AS (SELECT CAST(o_orderdate AS DATE) AS date, o_custkey % 100 + 1 AS ticker, count(*) AS n FROM orders GROUP BY ALL),
j AS (SELECT s.date, s.ticker, foreign_flow_5d_z AS flow_z, vol_z, n AS articles FROM scored s LEFT JOIN v3 USING (date, ticker) LEFT JOIN news USING (date, ticker))
SELECT date, ticker, {r('flow_z')}, {r('vol_z')}, articles, concat_ws(',', CASE WHEN flow_z > 1.5 THEN 'inflow' END, CASE WHEN flow_z < -1.5 THEN 'outflow' END, CASE WHEN vol_z > 1.5 THEN 'volatility' END) AS flags
FROM j WHERE flow_z IS NOT NULL OR vol_z IS NOT NULL OR articles IS NOT NULL""")
def _(s, d):
    news = s.read.parquet(f"{d}/orders.parquet").groupBy(F.to_date("o_orderdate").alias("date"), (F.col("o_custkey") % 100 + 1).alias("ticker")).agg(F.count("*").alias("n"))
    return report.scan(features.scan_scores(panel(s, d), YEAR), news)
