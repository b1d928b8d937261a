"""What each query on scores and ratings sends through shuffles: lines by ticker once, then only what it makes of them."""

import re

import pytest

from tidemark.plans import job_queries, registry

SF = "/root/testdata/sf0.001"

#: Query and the keys by which it may shuffle further: places within a date, and aggregates of a few rows.
FURTHER = [
    ("ratings_table", {"date"}),
    ("bucket", {"rating"}),
    ("feature_attach", set()),
    ("coverage_floor", set()),
    ("weight_coverage", {"feature", "_groupingexpression"}),
    ("rating_order", {"date"}),
    ("weight_influence", {"feature"}),
    ("calibration_table", {"rating"}),
    ("cut_point_table", set()),
]


def keys(df):
    """First key of each hash exchange in the plan."""
    return re.findall(r"Exchange hashpartitioning\((\w+)#", df._jdf.queryExecution().executedPlan().toString())


@pytest.mark.parametrize(("name", "further"), FURTHER)
def test_lines_are_dealt_by_ticker_once(spark, name, further):
    got = keys(registry.queries()[name](spark, SF))
    assert got.count("ticker") == 1 and set(got) - {"ticker"} <= further


def test_the_archive_writes_ratings_of_lines_dealt_once(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(job_queries, "written", lambda df: seen.append(keys(df)) or df)
    monkeypatch.setattr(job_queries.rating, "refuse_empty", lambda df: df)
    monkeypatch.setattr(job_queries.versioned, "write_versioned", lambda df, path, *_: df.limit(1).selectExpr("date", "ticker", "score", "month", "1 AS version").write.parquet(path))
    registry.queries()["write_ratings_archive"](spark, SF)
    assert seen == [["ticker"]]
