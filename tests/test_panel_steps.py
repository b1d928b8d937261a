"""The steps that all queries on features and ratings share: shuffles, exact sums, group means, terms."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tidemark.operators import features, rating, rolling
from tidemark.plans import panels, registry

SF = "/root/testdata/sf0.001"


def shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.mark.parametrize(("name", "most"), [("rate", 1), ("feature_attach", 1), ("rating_order", 2), ("scan_table", 5)])
def test_a_panel_is_shuffled_by_ticker_once(spark, name, most):
    assert shuffles(registry.queries()[name](spark, SF)) <= most


def test_hundredths_round_as_decimals_do(spark):
    xs = [0.0, -0.0, 0.1, 1.005, -1.005, 2.675, 0.015, -0.005, 1e-9, 123456.78, 90071992547409.93, 1e13, 1e13 + 0.01, 999999999999999.9, -4503599627370.49, None]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select("x", panels.hundredths("x").alias("got"), (F.col("x").cast("decimal(18,2)") * 100).cast("long").alias("want")).collect()
    assert [r.got for r in got] == [r.want for r in got] and got[3].got == 101


def test_group_means_hold_rows_without_a_date(spark):
    day = [None, *[dt.date(2024, 1, 1) + dt.timedelta(i) for i in range(3)]]
    rows = [(d, t, s, float(1 + i * k), 1.0) for k, (t, s) in enumerate((("a", "s"), ("b", "s"), ("c", None)), 1) for i, d in enumerate(day)]
    p = spark.createDataFrame(rows, "date date, ticker string, sector string, close double, one double")
    p = p.withColumns({c: F.col("one") for c in ("foreign_net", "inst_net", "trading_value", "short_balance", "shares_outstanding", "pbr")})
    for frame in (p, p.withColumn("date", F.col("date") + 0)):
        got = features.panel_features(frame, 2, 2, strength_days=1)
        want = {(r.date, r.ticker): r.rel_strength for r in features.rel_strength(frame.withColumn("sector", features.group_or_own("sector", "ticker")), 1).collect()}
        assert {(r.date, r.ticker): r.rel_strength_20d for r in got.collect()} == {k: None if v is None else pytest.approx(v) for k, v in want.items()}
        assert sum(v is not None for v in want.values()) == 6


def test_scan_scores_are_those_of_the_two_passes(spark):
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(i), t, math.sin(i * k) + 2, math.cos(i * k), 3.0 + i % 4) for k, t in ((1, "a"), (3, "b")) for i in range(60)]
    p = spark.createDataFrame(rows, "date date, ticker string, close double, foreign_net double, trading_value double")
    flow = rolling.with_rolling_z(p.withColumn("v", rolling.rolling_sum_ratio("foreign_net", "trading_value", rolling.by(), 5)), {"z": "v"}, 12)
    want = {(r.date, r.ticker): (r.z, r.volatility_z) for r in flow.join(features.volatility_z(p, 12, 6), ["date", "ticker"]).collect()}
    got = {(r.date, r.ticker): (r.foreign_flow_5d_z, r.volatility_z) for r in features.scan_scores(p, 12, 5, 6).collect()}
    assert got == want and any(z is not None and v is not None for z, v in got.values())


def test_terms_and_score_agree_where_scores_are_missing_or_no_number(spark):
    names = list(rating.WEIGHTS)
    zs = [[2.0, None, -0.0, 1.0, None], [None] * 5, [float("nan"), 1.0, 1.0, 1.0, 1.0], [-1.0, -2.0, 3.0, 4.0, 5.0]]
    df = spark.createDataFrame([(dt.date(2024, 1, 1), str(i), *z) for i, z in enumerate(zs)], "date date, ticker string, " + ", ".join(f"{n}_z double" for n in names))
    got = rating.rationale(rating.rate(df), 2).orderBy("ticker").collect()
    for r in got:
        total = sum(t.value for t in r.terms)
        assert math.isnan(r.score) if math.isnan(total) else r.score == pytest.approx(total / r.weight_coverage if r.terms else 0.0)
        assert r.missing == ",".join(n for n in names if n not in {t.feature for t in r.terms})
    assert [t.feature for t in got[2].top][0] == names[0] and [t.feature for t in got[3].top] == ["rel_strength_20d", "short_ratio"]
