"""Wide windows: one call a batch, whatever keys are in it, and the values that each window alone gives."""

import datetime as dt
import math
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import rolling


def rows_seen(x, missing, place, size):
    return np.full(len(x), float(len(x))), np.zeros(len(x), bool)


def frame(spark, keys, n):
    value = lambda k, i: None if (k, i) == (1, n // 2) else 0.5 if k == 2 else 1e9 if (k, i) == (3, 4) else round(math.sin(i * (k + 2)), 1) + 1e6
    return spark.createDataFrame([(dt.date(2024, 1, 1) + dt.timedelta(i), k, value(k or 0, i)) for k in (None, *range(keys - 1)) for i in range(n)], "date date, ticker int, x double").coalesce(1)


def test_a_batch_of_many_keys_is_one_call(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), k, 1.0) for k in range(500)], "date date, ticker int, x double")
    got = rolling.with_rolling(df, {"seen": (rows_seen, "x", 3)}).groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.max("seen").alias("seen"))
    assert all(r.n == r.seen for r in got.collect())


@pytest.mark.parametrize("batch", [1, 7, 10_000])
def test_windows_keep_to_their_key_across_batches(spark, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        df, size = frame(spark, 5, 24), 6
        got = rolling.with_rolling(df, {"p": (rolling.shares, "x", size), "z": (rolling.scores, "x", size)}).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == 120 and sum(r.z is not None for r in got) > 50
    for key in {r.ticker for r in got}:
        rows = sorted((r for r in got if r.ticker == key), key=lambda r: r.date)
        for i, r in enumerate(rows):
            here, before = [q.x for q in rows[max(0, i + 1 - size) : i + 1]], [q.x for q in rows[max(0, i - size) : i]]
            whole = len(here) == size and None not in here
            assert r.p == (pytest.approx((sum(v <= r.x for v in here) - 1) / (size - 1)) if whole else None)
            varies = len(before) == size and None not in [*before, r.x] and len(set(before)) > 1
            assert r.z == (pytest.approx((r.x - statistics.fmean(before)) / statistics.stdev(before), rel=1e-6, abs=1e-6) if varies else None)


def test_an_outlier_that_has_left_leaves_nothing_behind():
    x = np.array([1.0, 2.0, 4.0, 1e15, *(float(i % 3) for i in range(40))])
    mean, squares = rolling.moments(x, 11)
    for i in range(4, len(x) - 10):
        assert mean[i] == pytest.approx(statistics.fmean(x[i : i + 11]), rel=1e-14) and squares[i] == pytest.approx(10 * statistics.variance(x[i : i + 11]), rel=1e-13)


def test_counted_and_ranked_shares_are_the_same(monkeypatch):
    draw = np.random.default_rng(3)
    x = np.round(draw.random(900) * 40)
    x[[100, 500]] = np.nan, np.inf
    place = np.concatenate([np.arange(n) for n in (300, 10, 590)])
    for size in (1, 2, 40, 255, 256, 300):
        monkeypatch.setattr(rolling, "COUNTED", 1024)
        value, missing = rolling.shares(x, np.isnan(x), place, size)
        monkeypatch.setattr(rolling, "COUNTED", 0)
        ranked, lost = rolling.shares(x, np.isnan(x), place, size)
        assert (missing == lost).all() and (value[~missing] == ranked[~lost]).all() and missing.all() == (size == 1)
