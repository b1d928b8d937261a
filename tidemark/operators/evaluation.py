"""Does a score foresee returns? Correlations, spreads, baskets carried forward."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemark.functions.columns import safe_ratio
from tidemark.operators.asof import asof_prior
from tidemark.operators.rolling import by, cumulative_return, running_total, spearman
from tidemark.operators.sessions import with_neighbours


def forward_return(prices: DataFrame, calendar: DataFrame) -> DataFrame:
    """(date, ticker, forward): close over open of the calendar's next session, less 1.

    The next session of the calendar, not the ticker's next row: a ticker that didn't trade then has NULL.
    """
    steps = with_neighbours(calendar).select(F.col("session_date").alias("date"), "next_date")
    ahead = prices.select(F.col("date").alias("next_date"), "ticker", (safe_ratio("close", "open") - 1).alias("forward"))
    return prices.select("date", "ticker").join(F.broadcast(steps), "date", "left").join(ahead, ["next_date", "ticker"], "left").select("date", "ticker", "forward")


def paired(scores: DataFrame, returns: DataFrame, score: str = "score", value: str = "excess", start=None, end=None) -> DataFrame:
    """(date, ticker, score, value) where both are there, within dates."""
    both = scores.select("date", "ticker", score).join(returns.select("date", "ticker", value), ["date", "ticker"]).dropna(subset=[score, value])
    if start is not None:
        both = both.where(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return both


def paired_tail(pairs: DataFrame, n: int) -> DataFrame:
    """The last n pairs of each ticker."""
    place = F.row_number().over(Window.partitionBy("ticker").orderBy(F.desc("date")))
    return pairs.withColumn("_k", place).where(F.col("_k") <= n).drop("_k")


def shared_sessions(returns: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(date, p, b): both returns of the sessions that both have."""
    return returns.select("date", F.col("ret").alias("p")).join(benchmark.select("date", F.col("ret").alias("b")), "date")


def members(prices: DataFrame, held: DataFrame) -> DataFrame:
    """Rows of prices of what was held on their date."""
    return prices.join(held, ["date", "ticker"], "left_semi")


def daily_ic(pairs: DataFrame, score: str = "score", value: str = "excess") -> DataFrame:
    """(date, n, ic): rank correlation per date; dates where it is undefined are dropped."""
    return spearman(pairs, score, value, "date").where("corr IS NOT NULL").select("date", "n", F.col("corr").alias("ic"))


def icir(ic: DataFrame) -> DataFrame:
    """(n, mean_ic, sd_ic, icir); the last two NULL for fewer than two dates."""
    m, s = F.avg("ic"), F.stddev_samp("ic")
    return ic.agg(F.count("ic").alias("n"), m.alias("mean_ic"), s.alias("sd_ic"), F.when(s > 0, F.try_divide(m, s)).alias("icir"))


def bootstrap_ci(ic: DataFrame, draws: int = 10_000, seed: int = 7) -> DataFrame:
    """(low, high, draws): 2.5 and 97.5 percent points of the ratio over resamples with replacement.

    Slot and draw hash to the row that is drawn, so the result doesn't depend on partitions. A resample
    without spread is left out. One row a date goes in; draws * dates rows are joined on the row's place.
    """
    placed = ic.select((F.row_number().over(Window.orderBy("date")) - 1).alias("place"), "ic")
    n = ic.count()
    spark = ic.sparkSession
    if n < 2:
        return spark.createDataFrame([(None, None, 0)], "low double, high double, draws long")
    slots = spark.range(draws * n).select((F.col("id") / n).cast("long").alias("draw"), F.pmod(F.xxhash64(F.col("id"), F.lit(seed)), F.lit(n)).alias("place"))
    drawn = slots.join(placed, "place").groupBy("draw").agg(F.avg("ic").alias("m"), F.stddev_samp("ic").alias("s")).where("s > 0")
    ratio = F.col("m") / F.col("s")
    return drawn.agg(F.percentile(ratio, 0.025).alias("low"), F.percentile(ratio, 0.975).alias("high"), F.count("*").alias("draws"))


def bucket_size(n: Column, share: float) -> Column:
    return F.greatest(F.lit(1), F.ceil(n * share)).cast("long")


def quantile_spread(pairs: DataFrame, share: float = 0.2, score: str = "score", value: str = "excess") -> DataFrame:
    """(date, n, spread): mean value of the top share less the bottom share; dates too thin for both are left out. Ties fall by ticker."""
    day = Window.partitionBy("date")
    ranked = pairs.select(
        "date", value, F.count("*").over(day).alias("n"),
        F.row_number().over(day.orderBy(F.desc(score), "ticker")).alias("top"), F.row_number().over(day.orderBy(score, "ticker")).alias("bottom"),
    ).withColumn("k", bucket_size(F.col("n"), share)).where("n >= 2 * k")
    mean = lambda c: F.avg(F.when(F.col(c) <= F.col("k"), F.col(value)))
    return ranked.groupBy("date").agg(F.max("n").alias("n"), (mean("top") - mean("bottom")).alias("spread"))


def top_fraction(ratings: DataFrame, share: float = 0.2, score: str = "score") -> DataFrame:
    """(date, ticker) of each date's top share, one at least; ties fall by ticker."""
    day = Window.partitionBy("date")
    ranked = ratings.where(F.col(score).isNotNull()).select("date", "ticker", F.row_number().over(day.orderBy(F.desc(score), "ticker")).alias("r"), F.count("*").over(day).alias("n"))
    return ranked.where(F.col("r") <= bucket_size(F.col("n"), share)).select("date", "ticker")


def carried_returns(held: DataFrame, forward: DataFrame) -> DataFrame:
    """(date, ret, n): equal-weight return of the basket last decided on or before each session.

    Nothing before the first decision. A session on which no member has a return is left out.
    """
    days = forward.select("date").distinct().withColumn("_all", F.lit(0))
    decided = held.select(F.lit(0).alias("_all"), F.col("date").alias("decided")).distinct()
    basket = asof_prior(days, decided, ["_all"], "date", "decided", ["decided"]).where("decided IS NOT NULL").select("date", "decided")
    members = basket.join(held.select(F.col("date").alias("decided"), "ticker"), "decided")
    return members.join(forward.dropna(subset=["forward"]), ["date", "ticker"]).groupBy("date").agg(F.avg("forward").alias("ret"), F.count("*").alias("n"))


def benchmark_returns(forward: DataFrame, ticker) -> DataFrame:
    """(date, ret) of one entity, nulls dropped."""
    return forward.where((F.col("ticker") == ticker) & F.col("forward").isNotNull()).select("date", F.col("forward").alias("ret"))


def curve(returns: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(date, portfolio, benchmark): both compounded over the sessions that both have."""
    both = shared_sessions(returns, benchmark)
    w = Window.orderBy("date")  # a row a session
    return both.select("date", cumulative_return("p", w).alias("portfolio"), cumulative_return("b", w).alias("benchmark"))


def shadow_summary(track: DataFrame) -> DataFrame:
    """(portfolio, benchmark, excess, sessions) at the end of a curve."""
    p, b = F.max_by("portfolio", "date"), F.max_by("benchmark", "date")
    return track.agg(p.alias("portfolio"), b.alias("benchmark"), (p - b).alias("excess"), F.count("*").alias("sessions"))


def net_of_cost(held: DataFrame, returns: DataFrame, cost: float) -> DataFrame:
    """(date, turnover, ret): returns less cost times the share of the basket that is new on each decision."""
    days = held.groupBy("date").agg(F.collect_set("ticker").alias("now")).withColumn("before", F.lag("now").over(Window.orderBy("date")))
    turnover = F.when(F.col("before").isNull(), 1.0).otherwise(F.size(F.array_except("now", "before")) / F.size("now"))
    moved = returns.join(days.select("date", turnover.alias("turnover")), "date", "left").fillna({"turnover": 0.0})
    return moved.select("date", "turnover", (F.col("ret") - F.col("turnover") * cost).alias("ret"))


def score_percentiles(scores: DataFrame, score: str = "score", points: Sequence[float] = (0.5, 0.75, 0.9, 0.95, 0.99)) -> DataFrame:
    """(p, value) of absolute scores, linear between rows.

    Distinct values are counted and laid out in ranges; only the two values beside each point are looked at.
    """
    known = scores.select(F.abs(score).alias("v")).where("v IS NOT NULL").groupBy("v").agg(F.count("*").alias("n"))
    laid = running_total(known, "n", "before", "v")
    total = laid.agg(F.sum("n")).first()[0] or 0  # of what is written, so that the scores are made once
    place = [(float(p), (total - 1) * float(p)) for p in points]
    lower = lambda at: F.max(F.when(F.col("before") <= F.floor(F.lit(at)), F.col("v")))
    upper = lambda at: F.max(F.when(F.col("before") <= F.ceil(F.lit(at)), F.col("v")))
    value = lambda at: lower(at) + (upper(at) - lower(at)) * (F.lit(at) - F.floor(F.lit(at)))
    got = laid.agg(F.array(*[F.struct(F.lit(p).alias("p"), value(at).alias("value")) for p, at in place]).alias("r"))
    return got.select(F.explode("r").alias("r")).select("r.*")


def cut_point_table(scores: DataFrame, cuts: dict[str, float], score: str = "score") -> DataFrame:
    """(cut, threshold, share): share of rows whose absolute score reaches each threshold."""
    return scores.agg(*[F.avg((F.abs(score) >= c).cast("double")).alias(k) for k, c in cuts.items()]).select(
        F.explode(F.array(*[F.struct(F.lit(k).alias("cut"), F.lit(float(c)).alias("threshold"), F.col(k).alias("share")) for k, c in cuts.items()])).alias("r")
    ).select("r.*")


def bucket_counts(ratings: DataFrame, rebucketed: Column, levels: Sequence[str]) -> DataFrame:
    """(rating, published, current) for every level, counts of labels as stored and as the current cuts give."""
    both = ratings.groupBy("rating", rebucketed.alias("again")).agg(F.count("*").alias("n"))
    none, n = F.lit(0).cast("long"), F.col("n")
    sides = F.array(*[F.struct(F.col(c).alias("rating"), p.alias("published"), q.alias("current")) for c, p, q in (("rating", n, none), ("again", none, n))])
    counts = both.select(F.explode(sides).alias("s")).select("s.*").groupBy("rating").agg(F.sum("published").alias("published"), F.sum("current").alias("current"))
    dim = ratings.sparkSession.createDataFrame([(x,) for x in levels], "rating string")
    return dim.join(counts, "rating", "left").fillna(0, ["published", "current"])


def weight_influence(features: DataFrame, weights: dict[str, float]) -> DataFrame:
    """(feature, designed, n, mean_abs_z, mean_abs_contribution, realised, delta): what each weight does, NULL without data."""
    long = features.select(F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"{f}_z").alias("z")) for f in weights])).alias("r")).select("r.*").where("z IS NOT NULL")
    whole = sum(abs(w) for w in weights.values())
    dim = features.sparkSession.createDataFrame([(f, float(w), abs(w) / whole) for f, w in weights.items()], "feature string, weight double, designed double")
    got = dim.join(long.groupBy("feature").agg(F.count("*").alias("n"), F.avg(F.abs("z")).alias("mean_abs_z")), "feature", "left")
    got = got.withColumn("mean_abs_contribution", F.col("mean_abs_z") * F.abs("weight"))
    realised = F.try_divide(F.col("mean_abs_contribution"), F.sum("mean_abs_contribution").over(Window.partitionBy(F.lit(1))))
    return got.withColumn("realised", realised).select("feature", "designed", F.coalesce("n", F.lit(0)).alias("n"), "mean_abs_z", "mean_abs_contribution", "realised", (F.col("realised") - F.col("designed")).alias("delta"))


def regime_change(prices: DataFrame, key: str, value: str, n: int) -> DataFrame:
    """(key, date, change) against n rows before."""
    w = by(key)
    return prices.select(key, "date", (safe_ratio(value, F.lag(value, n).over(w)) - 1).alias("change"))
