"""Pairs of titles: what leaves the tasks that compare blocks, and how many blocks there are."""

import random
import re

import pytest

from tidemark.operators import conflicts, similarity
from tidemark.plans import registry


def _titles(spark, n):
    draw = random.Random(8)
    made = [" ".join(draw.sample("abcdefgh", draw.randint(0, 5))) for _ in range(n // 3)]
    return spark.createDataFrame([(draw.choice(["k", "l", None]), i % (n - 10), draw.choice(made) if i % 9 else None, float(i)) for i in range(n)], "ticker string, article_id long, title string, v double")


@pytest.mark.parametrize("name", ["score_divergence", "same_event_pairs", "title_jaccard_same_event"])
def test_pairs_are_made_where_their_blocks_are_compared(spark, name):
    plan = registry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    above, _, below = plan.partition("FlatMapGroupsInArrow")
    assert below and not re.search("Exchange|Join|Sort", above)


def test_blocks_of_titles_grow_before_there_are_more(spark, monkeypatch):
    monkeypatch.setattr(similarity, "TITLES", 1)
    monkeypatch.setattr(similarity, "BLOCKS", 3)
    monkeypatch.setattr(similarity, "GROWN", 10)
    rows = [(n, 1, 1, 1) for n in (1, 2, 3, 30, 31) for _ in range(n)]
    blocks = similarity._blocks(spark.createDataFrame(rows, "ticker int, chunks int, tokens int, articles int"), "ticker")
    assert {r.ticker: r.n for r in blocks.collect()} == {1: 1, 2: 2, 3: 3, 30: 3, 31: 4}
    t = _titles(spark, 300)
    want = similarity.same_event_pairs(t, least=0.35, carry=["v"]).collect()
    monkeypatch.setattr(similarity, "MEMBERS", 2)
    monkeypatch.setattr(similarity, "PAIRS", 5)
    got = similarity.same_event_pairs(t, least=0.35, carry=["v"])
    assert len(want) > 1000 and sorted(map(tuple, got.collect())) == sorted(map(tuple, want))


def test_divergence_takes_no_slow_way_over_its_array(spark):
    pairs = spark.createDataFrame([("k", 1, 2, 0.0, 0.4, 0.0, 0.3), ("k", 3, 4, None, 0.9, 0.9, 0.1)], "ticker string, a long, b long, x_a double, x_b double, y_a double, y_b double")
    got = conflicts.divergence(pairs, ["x", "y"])
    assert sorted(map(tuple, got.collect())) == [(1, "k", "x", 2, 0.4), (2, "k", "x", 1, 0.4), (3, "k", "y", 4, 0.8), (4, "k", "y", 3, 0.8)]
    assert "lambda" not in got._jdf.queryExecution().executedPlan().toString()  # one is interpreted row by row
