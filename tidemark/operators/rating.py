"""Composite scores from whatever standard scores are present, and their seven levels."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Weights, cut points and floor of the composite.
WEIGHTS = {"foreign_flow_5d": 0.30, "inst_flow_5d": 0.15, "rel_strength_20d": 0.15, "short_ratio": -0.10, "valuation_band": 0.05}
DEFERRED = {"news_polarity": 0.20, "rev_4w": 0.15}
CUTS = {"strong": 2.0, "moderate": 1.0, "weak": 0.4}
FLOOR = 0.5
LEVELS = ("STRONG_BUY", "BUY", "WEAK_BUY", "HOLD", "WEAK_SELL", "SELL", "STRONG_SELL")
TERMS = 4


def bucket(score: Column, cuts: Mapping[str, float] = CUTS) -> Column:
    """One of LEVELS; the outer edge belongs to the stronger level, inside the weak cut is HOLD."""
    if not cuts["strong"] > cuts["moderate"] > cuts["weak"] > 0:
        raise ValueError("cuts must fall from strong to weak and stay above 0")
    up, down = LEVELS[:3], LEVELS[:3:-1]
    side = F.when(F.lit(False), F.lit(""))
    for name, cut in zip(up, (cuts["strong"], cuts["moderate"], cuts["weak"]), strict=True):
        side = side.when(score >= cut, name)
    for name, cut in zip(down, (cuts["strong"], cuts["moderate"], cuts["weak"]), strict=True):
        side = side.when(score <= -cut, name)
    return F.when(score.isNull(), "HOLD").otherwise(side.otherwise("HOLD"))


def contributions(weights: Mapping[str, float] = WEIGHTS) -> Column:
    """Array of (place, feature, z, weight, value) of the scores that are present, in the weights' order."""
    terms = [
        F.when(F.col(f"{f}_z").isNotNull(), F.struct(F.lit(i).alias("place"), F.lit(f).alias("feature"), F.col(f"{f}_z").alias("z"), F.lit(w).alias("weight"), (F.col(f"{f}_z") * w).alias("value")))
        for i, (f, w) in enumerate(weights.items())
    ]
    return F.array_compact(F.array(*terms))


def rate(features: DataFrame, weights: Mapping[str, float] = WEIGHTS, cuts: Mapping[str, float] = CUTS, floor: float = FLOOR) -> DataFrame:
    """(date, ticker, rating, score, weight_coverage, missing, low_confidence, terms) for each row.

    The weighted sum of the scores present over the share of absolute weight that they carry; nothing
    present is a HOLD of score 0 and coverage 0. Below the floor the rating is HOLD of low confidence.
    """
    whole = sum(abs(w) for w in weights.values())
    z = {f: F.col(f"{f}_z") for f in weights}
    carried = reduce(add, [F.when(z[f].isNull(), 0.0).otherwise(abs(w)) for f, w in weights.items()], F.lit(0.0))
    raw = reduce(add, [F.coalesce(z[f] * w, F.lit(0.0)) for f, w in weights.items()], F.lit(0.0))
    missing = F.concat_ws(",", *[F.when(z[f].isNull(), F.lit(f)) for f in weights])
    made = features.select("date", "ticker", contributions(weights).alias("terms"), missing.alias("missing"), (carried / whole).alias("weight_coverage"), raw.alias("_raw"))
    made = made.withColumn("score", F.coalesce(F.try_divide("_raw", "weight_coverage"), F.lit(0.0)))
    low = F.col("weight_coverage") < floor - 1e-9
    return made.select(
        "date", "ticker", F.when(low, "HOLD").otherwise(bucket(F.col("score"), cuts)).alias("rating"), "score", "weight_coverage",
        "missing", low.alias("low_confidence"), "terms",
    )


def rate_all(watchlist: DataFrame, features: DataFrame, date: Column, **options) -> DataFrame:
    """A rating of every entity of the watchlist on a date, those without features included."""
    day = features.where(F.col("date") == date).drop("date")
    return rate(watchlist.select("ticker").join(day, "ticker", "left").withColumn("date", date), **options)


def rationale(rated: DataFrame, terms: int = TERMS) -> DataFrame:
    """rated with its largest contributions (ties keep the weights' order) and the sum of the others."""
    sized = F.transform("terms", lambda t: F.struct(F.abs(t["value"]).alias("size"), (-t["place"]).alias("turn"), t.alias("term")))
    ranked = rated.withColumn("_ranked", F.sort_array(sized, asc=False))
    total = lambda c, value: F.aggregate(c, F.lit(0.0), lambda s, t: s + value(t))
    return ranked.withColumns({
        "top": F.transform(F.slice("_ranked", 1, terms), lambda r: r["term"]),
        "residual": total(F.slice("_ranked", terms + 1, 1000), lambda r: r["term"]["value"]),
        "subtotal": total(F.col("terms"), lambda t: t["value"]),
    }).drop("_ranked")


def decompose(rated: DataFrame) -> DataFrame:
    """One row per contribution, with what it adds to the score after renormalising."""
    return rated.select("date", "ticker", "score", "weight_coverage", F.explode("terms").alias("t")).select(
        "date", "ticker", F.col("t.feature").alias("feature"), F.col("t.z").alias("z"), F.col("t.weight").alias("weight"), F.col("t.value").alias("value"),
        F.try_divide(F.col("t.value"), F.col("weight_coverage")).alias("in_score"),
    )


def refuse_empty(rated: DataFrame) -> DataFrame:
    """rated, or an error if no row has any coverage: such a table says nothing and isn't to be stored."""
    if not (rated.agg(F.max("weight_coverage")).first()[0] or 0) > 0:
        raise ValueError("no rating has any weight behind it")
    return rated


def weight_coverage(weights: DataFrame, produced: DataFrame) -> DataFrame:
    """(kind, weight, present, missing): absolute weight of active and of deferred features, and of those that are produced.

    weights (feature, weight, active), produced (feature); missing names the others, in order.
    """
    held = weights.join(produced.select("feature").distinct().withColumn("_is", F.lit(True)), "feature", "left")
    size = F.abs(F.col("weight").cast("double"))
    return held.groupBy(F.when(F.col("active"), "active").otherwise("deferred").alias("kind")).agg(
        F.sum(size).alias("weight"), F.coalesce(F.sum(F.when(F.col("_is"), size)), F.lit(0.0)).alias("present"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("_is").isNull(), F.col("feature")))), ",").alias("missing"),
    )


def produced(features: DataFrame, names: Mapping[str, float]) -> DataFrame:
    """(feature) of those that have a score on any row."""
    some = features.agg(*[F.count(f"{f}_z").alias(f) for f in names])
    return some.unpivot([], list(names), "feature", "n").where("n > 0").select("feature")
