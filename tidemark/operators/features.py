"""Features of a daily panel (date, ticker, ...), all knowable at their own row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemark.functions.columns import group_or_own, safe_ratio
from tidemark.operators.rolling import band, by, lagged_ratio, pct_change, rolling_spread, rolling_sum_ratio, scores, shares, with_rolling, with_rolling_z
from tidemark.operators.storage import written

FEATURES = ("foreign_flow_5d", "inst_flow_5d", "short_ratio", "valuation_band", "rel_strength_20d")


def group_mean(df: DataFrame, value: str, group: str, date: str = "date", key: str = "ticker") -> tuple[Column, Column]:
    """(mean over the date's group, whether the group has several members there, those without a value included)."""
    w = Window.partitionBy(date, group)
    return F.avg(value).over(w), F.min(key).over(w) < F.max(key).over(w)


def group_mean_if_peers(df: DataFrame, value: str, group: str, out: str = "mean") -> DataFrame:
    """df with the mean of the value over the date's group; NULL in a group of one."""
    mean, peers = group_mean(df, value, group)
    return df.withColumn(out, F.when(peers, mean))


def written_means(df: DataFrame, value: str, group: str, date: str = "date", key: str = "ticker") -> DataFrame:
    """(_date, _group, _mean) of each date's groups of several members, those without a value included; written, so that their size is known."""
    made = df.groupBy(F.col(date).alias("_date"), F.col(group).alias("_group")).agg(F.avg(value).alias("_mean"), (F.min(key) < F.max(key)).alias("_peers"))
    return written(made.where("_peers").drop("_peers"))


def rel_strength(df: DataFrame, n: int = 20, value: str = "close", group: str = "sector", out: str = "rel_strength") -> DataFrame:
    """Own change over n sessions less the group's mean; NULL in a group of one."""
    moved = group_mean_if_peers(pct_change(df, value, n, by(), "_ret"), "_ret", group, "_mean")
    return moved.withColumn(out, F.col("_ret") - F.col("_mean")).drop("_ret", "_mean")


def excess_return(df: DataFrame, value: str = "forward", group: str = "sector", out: str = "excess") -> DataFrame:
    """Value less its group's mean on the date; a group of one is measured against all of the date."""
    mean, peers = group_mean(df, value, group)
    everyone = F.avg(value).over(Window.partitionBy("date"))
    return df.withColumn(out, F.col(value) - F.when(peers, mean).otherwise(everyone))


def panel_features(panel: DataFrame, window: int = 252, valuation_window: int = 756, short_lag: int = 3, flow_days: int = 5, strength_days: int = 20, keep: Sequence[str] | None = None) -> DataFrame:
    """panel with the five features and their standard scores (``*_z``); the band is its own score.

    keep names the panel's columns that stay, all of them by default; others aren't carried through the shuffles.
    All windows share one shuffle and sort by ticker. The group means, a row a date and group, are made and written
    first; where Spark finds them small they are broadcast, else panel and means are shuffled by date and group.
    """
    w = by()
    made = panel.withColumn("sector", group_or_own("sector", "ticker"))
    means = written_means(pct_change(made.select("date", "ticker", "sector", "close"), "close", strength_days, w, "_ret"), "_ret", "sector")
    made = pct_change(made, "close", strength_days, w, "_ret").withColumns({
        "foreign_flow_5d": rolling_sum_ratio("foreign_net", "trading_value", w, flow_days),
        "inst_flow_5d": rolling_sum_ratio("inst_net", "trading_value", w, flow_days),
        "short_ratio": lagged_ratio("short_balance", "shares_outstanding", w, short_lag),
    })
    made = made.join(means, F.col("date").eqNullSafe(F.col("_date")) & F.col("sector").eqNullSafe(F.col("_group")), "left").withColumn("rel_strength_20d", F.col("_ret") - F.col("_mean"))
    made = made.select(*(panel.columns if keep is None else keep), F.col("pbr").alias("_pbr"), *[f for f in FEATURES if f != "valuation_band"])
    wide = {"_percentile": (shares, "_pbr", valuation_window)} | {f"{f}_z": (scores, f, window) for f in FEATURES if f != "valuation_band"}
    made = with_rolling(made, wide).withColumn("valuation_band", band(F.col("_percentile"))).drop("_percentile", "_pbr")
    return made.withColumn("valuation_band_z", F.col("valuation_band"))


def volatility_z(panel: DataFrame, window: int = 252, days: int = 20) -> DataFrame:
    """(date, ticker, volatility_z): deviation of daily returns over days rows, as a standard score."""
    moved = pct_change(panel, "close", 1, by(), "ret").withColumn("vol", rolling_spread("ret", by(), days))
    return with_rolling_z(moved.select("date", "ticker", "vol"), {"volatility_z": "vol"}, window).drop("vol")


def scan_scores(panel: DataFrame, window: int = 252, flow_days: int = 5, days: int = 20) -> DataFrame:
    """(date, ticker, foreign_flow_5d_z, volatility_z) in one pass over the panel."""
    moved = pct_change(panel, "close", 1, by(), "ret").withColumn("foreign_flow_5d", rolling_sum_ratio("foreign_net", "trading_value", by(), flow_days))
    moved = moved.withColumn("vol", rolling_spread("ret", by(), days)).select("date", "ticker", "foreign_flow_5d", "vol")
    return with_rolling_z(moved, {"foreign_flow_5d_z": "foreign_flow_5d", "volatility_z": "vol"}, window).drop("foreign_flow_5d", "vol")


def realised_volatility(panel: DataFrame, days: int = 20) -> DataFrame:
    """(date, ticker, rv): yearly deviation of log returns."""
    ratio = safe_ratio("close", F.lag("close").over(by()))
    logged = panel.withColumn("_log", F.when(ratio > 0, F.ln(ratio)))
    return logged.select("date", "ticker", (rolling_spread("_log", by(), days) * F.sqrt(F.lit(252.0))).alias("rv"))


def z_scores_for(features: DataFrame, keys: DataFrame, names: tuple[str, ...] = FEATURES) -> DataFrame:
    """keys (date, ticker) with a map of their scores, all NULL where there is no row."""
    found = keys.join(features.select("date", "ticker", *[f"{n}_z" for n in names]), ["date", "ticker"], "left")
    return found.select("date", "ticker", F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*[F.nanvl(f"{n}_z", F.lit(None).cast("double")) for n in names])).alias("z"))


def revision_change(df: DataFrame, days: int, value: str = "value") -> DataFrame:
    """(date, ticker, change) against the last row at least so many days before."""
    from tidemark.operators.asof import asof_prior

    left = df.select("ticker", F.date_sub("date", days).alias("_at"), "date", value)
    right = df.select("ticker", F.col("date").alias("_d"), F.col(value).alias("_then"))
    got = asof_prior(left, right, ["ticker"], "_at", "_d", ["_then"])
    return got.select("date", "ticker", (safe_ratio(value, "_then") - 1).alias("change"))
