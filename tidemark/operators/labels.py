"""Label logs, raters and models: who agrees with whom, and how much noise there is."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemark.functions.columns import shown
from tidemark.operators.rolling import running_total, spearman
from tidemark.operators.storage import written


def latest_wins(log: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Last record of each key, with the place of its first one as ``first_at``."""
    w = Window.partitionBy(*keys)
    ranked = log.withColumn("first_at", F.min(order).over(w)).withColumn("_r", F.row_number().over(w.orderBy(F.desc(order))))
    return ranked.where("_r = 1").drop("_r")


def collate_scores(log: DataFrame, keys: Sequence[str], dims: Sequence[str], dimension: str = "dimension", value: str = "value", order: str = "seq") -> DataFrame:
    """One row per key from a log of one dimension a record; the last value counts, incomplete keys are left out."""
    return log.groupBy(*keys).agg(*[F.max_by(F.when(F.col(dimension) == d, F.col(value)), F.when(F.col(dimension) == d, F.col(order))).alias(d) for d in dims]).dropna(subset=list(dims))


def finalise_labels(rows: DataFrame, selection: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Complete rows of the current selection, with its bucket rather than the log's."""
    return rows.drop("bucket").join(selection.select(*keys, "bucket"), list(keys))


def seeded(seed: int, *keys: str):
    """A stated random order of keys: the MD5 of their texts and the seed, joined by bars."""
    return F.md5(F.encode(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))), "UTF-8"))


def stratified_round_robin(pairs: DataFrame, size: int, seed: int, group: str = "ticker", item: str = "article_id") -> DataFrame:
    """size rows dealt one a round from each group, larger groups first; within a group in a seeded order."""
    place = F.row_number().over(Window.partitionBy(group).orderBy(seeded(seed, item, group), item))
    ranked = pairs.select(group, item, place.alias("round"), F.count("*").over(Window.partitionBy(group)).alias("n"))
    return ranked.orderBy("round", F.desc("n"), group).limit(size).drop("n")


def seeded_sample(rows: DataFrame, size: int, seed: int, *keys: str) -> DataFrame:
    """size rows in a seeded order."""
    return rows.orderBy(seeded(seed, *keys), *keys).limit(size)


def first_n_per_bucket(rows: DataFrame, n: int = 25, least: float = 0.5) -> DataFrame:
    """(bucket, article_id, place): in order, each bucket takes up to n rows that are no same event as one it holds.

    rows (bucket, seq, article_id, tokens). Of rows of a bucket with equal tokens only the first can be
    taken (rows without tokens are like no other), so these are found first. A bucket's rows then stream in
    order through one task, which holds the n that it has taken.
    """
    alike = F.when(F.size("tokens") > 0, F.array_sort("tokens"))
    keyed = rows.select("bucket", "seq", "article_id", "tokens", F.coalesce(F.sha2(F.to_json(F.struct(alike)), 256), F.lit("")).alias("_set"), alike.isNull().alias("_bare"))
    first = keyed.where("NOT _bare").groupBy("bucket", "_set").agg(F.min(F.struct("seq", "article_id", "tokens")).alias("r")).select("bucket", "r.*")
    stream = first.unionByName(keyed.where("_bare").select(*first.columns)).repartition("bucket").sortWithinPartitions("bucket", "seq")

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bucket, held = None, []
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                if r.bucket != bucket:
                    bucket, held = r.bucket, []
                if len(held) < n:
                    t = set(() if r.tokens is None else r.tokens)
                    if not any(t and s and len(t & s) / len(t | s) >= least for s in held):
                        held.append(t)
                        out.append((bucket, r.article_id, len(held)))
            yield pd.DataFrame(out, columns=["bucket", "article_id", "place"])

    return stream.mapInPandas(walk, "bucket string, article_id long, place int")


def label_set_checks(labels: DataFrame, bucket: str = "bucket", item: str = "doc_id", share: str = "toxic") -> DataFrame:
    """(bucket, n, duplicates, share): rows of each bucket, those whose item repeats there, and the mean of a marked column."""
    return labels.groupBy(bucket).agg(F.count("*").alias("n"), (F.count("*") - F.countDistinct(item)).alias("duplicates"), F.avg(share).alias(f"{share}_share"))


def review_influence(reviewed: DataFrame, changed, most: float = 0.15) -> DataFrame:
    """(n, share, within): the share of labels that a review has changed, and whether it stays within the limit."""
    share = F.try_divide(F.count_if(changed).cast("double"), F.count("*"))
    return reviewed.agg(F.count("*").alias("n"), share.alias("share"), (share <= most).alias("within"))


def with_texts(labels: DataFrame, texts: DataFrame, key: str) -> DataFrame:
    """Labels with the fields of the text that they are of; labels without one are left out."""
    return labels.join(texts, key)


def long_scores(rows: DataFrame, keys: Sequence[str], dims: Sequence[str]) -> DataFrame:
    return rows.unpivot(list(keys), list(dims), "dimension", "value")


def rater_correlation(a: DataFrame, b: DataFrame, keys: Sequence[str], dims: Sequence[str], *groups: str) -> DataFrame:
    """(groups, dimension, n, corr): rank correlation of two raters over the examples that both have."""
    left = long_scores(a, [*groups, *keys], dims).withColumnRenamed("value", "x")
    right = long_scores(b, list(keys), dims).withColumnRenamed("value", "y")
    return spearman(left.join(right, [*keys, "dimension"]), "x", "y", *groups, "dimension")


def first_pass(attempts: DataFrame) -> DataFrame:
    return attempts.where("repeat = 0 AND ok")


def inter_model(attempts: DataFrame, keys: Sequence[str], dims: Sequence[str]) -> DataFrame:
    """(model_a, model_b, dimension, n, corr) of each pair of models on their first passes."""
    long = long_scores(first_pass(attempts), ["model", *keys], dims)
    a = long.select(F.col("model").alias("model_a"), *keys, "dimension", F.col("value").alias("x"))
    b = long.select(F.col("model").alias("model_b"), *keys, "dimension", F.col("value").alias("y"))
    return spearman(a.join(b, [*keys, "dimension"]).where("model_a < model_b"), "x", "y", "model_a", "model_b", "dimension")


def self_consistency(attempts: DataFrame, keys: Sequence[str], dims: Sequence[str]) -> DataFrame:
    """(model, dimension, sd): mean over examples of the deviation between repeats, two at least."""
    long = long_scores(attempts.where("ok"), ["model", *keys], dims).where("value IS NOT NULL")
    each = long.groupBy("model", "dimension", *keys).agg(F.stddev_samp("value").alias("sd"), F.count("*").alias("n")).where("n > 1")
    return each.groupBy("model", "dimension").agg(F.avg("sd").alias("sd"))


def compliance(attempts: DataFrame) -> DataFrame:
    """(model, calls, answered, ok, transport, ratio): transport failures are no answers; none answered gives NULL."""
    answered = F.count_if(F.col("ok") | (F.coalesce("failure", F.lit("")) != "transport"))
    good = F.count_if("ok")
    return attempts.groupBy("model").agg(F.count("*").alias("calls"), answered.alias("answered"), good.alias("ok"), F.count_if(F.col("failure") == "transport").alias("transport"), F.try_divide(good.cast("double"), answered).alias("ratio"))


def cost_per_signal(attempts: DataFrame, example: str = "example") -> DataFrame:
    """(model, cost): total cost by distinct examples found relevant; NULL if an ok call has no price or none is relevant."""
    valid = F.countDistinct(F.when(F.col("ok") & (F.col("relevance") > 0.5), F.col(example)))
    unpriced = F.bool_or(F.col("ok") & F.col("cost_usd").isNull())
    return attempts.groupBy("model").agg(F.when(~unpriced & (valid > 0), F.try_divide(F.sum("cost_usd"), valid.cast("double"))).alias("cost"))


def mean_latency(attempts: DataFrame) -> DataFrame:
    """(model, latency_s, calls, temperatures): the distinct temperatures that calls were made with, in order."""
    temperatures = F.array_join(F.array_sort(F.collect_set("temperature")), ",") if "temperature" in attempts.columns else F.lit("")
    return attempts.groupBy("model").agg(F.avg("latency_s").alias("latency_s"), F.count("*").alias("calls"), temperatures.alias("temperatures"))


def gate_verdict(correlations: DataFrame, bar: float = 0.5) -> DataFrame:
    """(passed, pairs, below): every pair is above the bar, an undefined one isn't."""
    ok = F.coalesce(F.col("corr") > bar, F.lit(False))
    return correlations.agg(F.bool_and(ok).alias("passed"), F.count("*").alias("pairs"), F.count_if(~ok).alias("below"))


def model_bars(correlation: DataFrame, consistency: DataFrame, compliance: DataFrame, bars: Mapping[str, float], sigma: tuple[str, float], least_compliance: float) -> DataFrame:
    """(model, passed, reasons): what keeps a model from being chosen, before cost may decide.

    A dimension's correlation must exceed its bar, the deviation of one dimension must stay below sigma's,
    compliance must exceed its bar; what wasn't measured doesn't pass.
    """
    name, most = sigma
    c = correlation.groupBy("model").agg(F.map_from_entries(F.collect_list(F.struct("dimension", "corr"))).alias("c"))
    got = compliance.select("model", "ratio").join(c, "model", "left").join(consistency.where(F.col("dimension") == name).select("model", "sd"), "model", "left")
    low = lambda d, bar: F.when(~F.coalesce(F.col("c")[d] > bar, F.lit(False)), F.concat(F.lit(f"{d} correlation "), shown(F.col("c")[d], 2), F.lit(f" <= {bar}")))
    loose = F.when(~F.coalesce(F.col("sd") < most, F.lit(False)), F.concat(F.lit(f"{name} deviation "), shown("sd", 3), F.lit(f" >= {most}")))
    unmet = F.when(F.col("ratio").isNull(), "compliance unmeasured").when(F.col("ratio") <= least_compliance, F.concat(F.lit("compliance "), shown("ratio", 3), F.lit(f" <= {least_compliance}")))
    reasons = F.array_compact(F.array(*[low(d, bar) for d, bar in bars.items()], loose, unmet))
    return got.select("model", (F.size(reasons) == 0).alias("passed"), F.array_join(reasons, "; ").alias("reasons"))


def shared_examples(attempts: DataFrame, example: str = "example") -> DataFrame:
    """(model_a, model_b, n): examples that both of two models answered on their first pass."""
    f = first_pass(attempts).select("model", example).distinct()
    a, b = f.withColumnRenamed("model", "model_a"), f.withColumnRenamed("model", "model_b")
    return a.join(b, example).where("model_a < model_b").groupBy("model_a", "model_b").agg(F.count("*").alias("n"))


def answered(ok="ok", failure="failure"):
    """Whether a call reached its model: transport failures are no answers."""
    return F.col(ok) | (F.coalesce(F.col(failure), F.lit("")) != "transport")


def latest_run_per_model(attempts: DataFrame, at: str = "run_at") -> DataFrame:
    """Attempts of each model's last day of runs."""
    days = attempts.withColumn("_day", F.to_date(at))
    last = days.groupBy("model").agg(F.max("_day").alias("_day"))
    return days.join(last, ["model", "_day"], "left_semi").drop("_day")


def noise_floor(first: DataFrame, second: DataFrame, keys: Sequence[str], dims: Sequence[str]) -> DataFrame:
    """(dimension, n, mean_gap, max_gap) between two passes over the same examples."""
    a, b = long_scores(first, keys, dims).withColumnRenamed("value", "x"), long_scores(second, keys, dims).withColumnRenamed("value", "y")
    gap = F.abs(F.col("x") - F.col("y"))
    return a.join(b, [*keys, "dimension"]).groupBy("dimension").agg(F.count("*").alias("n"), F.avg(gap).alias("mean_gap"), F.max(gap).alias("max_gap"))


def redo_influence(log: DataFrame, keys: Sequence[str], dimension: str = "dimension", value: str = "value", order: str = "seq") -> DataFrame:
    """(examples, redone): examples with any score that was rewritten to another value."""
    before = F.lag(value).over(Window.partitionBy(*keys, dimension).orderBy(order))
    marked = log.select(*keys, (F.col(value) != before).alias("changed"))
    return marked.groupBy(*keys).agg(F.coalesce(F.bool_or("changed"), F.lit(False)).alias("c")).agg(F.count("*").alias("examples"), F.count_if("c").alias("redone"))


def _counted(rows: DataFrame, score: str, label: str) -> DataFrame:
    """(score, p, q): positives and negatives of each distinct score."""
    known = rows.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    return known.groupBy(F.col(score).alias("score")).agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) != 1).alias("q"))


def auc(rows: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """(n_pos, n_neg, auc) by rank sum, ties shared; NULL without both classes."""
    laid = running_total(_counted(rows, score, label), "q", "below", "score")
    got = laid.agg(F.sum("p").alias("n_pos"), F.sum("q").alias("n_neg"), F.sum(F.col("p") * (F.col("below") + F.col("q") / 2)).alias("w"))
    return got.select("n_pos", "n_neg", F.try_divide("w", (F.col("n_pos") * F.col("n_neg")).cast("double")).alias("auc"))


def best_threshold(rows: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """(threshold, youden, recall, specificity) of the score from which on calling a row positive serves best.

    Youden's J is recall + specificity - 1; of equal ones the least threshold. No row without both classes.
    """
    laid = written(running_total(running_total(_counted(rows, score, label), "q", "q_below", "score"), "p", "p_below", "score"))
    whole = laid.agg(F.sum("p").alias("np"), F.sum("q").alias("nq"))
    got = laid.join(F.broadcast(whole), F.lit(True)).where("np > 0 AND nq > 0")
    recall, specificity = (F.col("np") - F.col("p_below")) / F.col("np"), F.col("q_below") / F.col("nq")
    judged = got.select("score", recall.alias("recall"), specificity.alias("specificity")).withColumn("youden", F.col("recall") + F.col("specificity") - 1)
    best = judged.agg(F.max(F.struct("youden", (-F.col("score").cast("double")).alias("least"), "score", "recall", "specificity")).alias("b")).where("b IS NOT NULL")
    return best.select(F.col("b.score").alias("threshold"), "b.youden", "b.recall", "b.specificity")


def resume(todo: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What of todo has no answer yet."""
    return todo.join(done.select(*keys).distinct(), list(keys), "left_anti")


def out_of_range(scores, bounds: dict[str, tuple[float, float]]):
    """Names of the dimensions of a map column that are missing or outside their bounds."""
    bad = lambda d, lo, hi: F.when(~F.coalesce(F.try_element_at(scores, F.lit(d)).between(lo, hi), F.lit(False)), F.lit(d))
    return F.array_compact(F.array(*[bad(d, lo, hi) for d, (lo, hi) in bounds.items()]))


def unwrap(parsed, required: Sequence[str]):
    """A JSON object that lies alone inside another one, where it has all required names; otherwise the text as it is."""
    keys = F.json_object_keys(parsed)
    inner = F.get(F.map_values(F.from_json(parsed, "map<string,string>")), F.lit(0))
    whole = F.array_except(F.array(*map(F.lit, required)), F.json_object_keys(inner))
    return F.when((F.size(keys) == 1) & (F.size(whole) == 0), inner).otherwise(parsed)


def score_batch(items: DataFrame, scorer: Callable[..., dict[str, float] | None], dims: Sequence[str], text: str = "text", model: str | None = None) -> DataFrame:
    """items with ``scores`` (map) and ``failure`` (NULL, or why there are none), by any Python scorer on Arrow batches.

    scorer(text), or scorer(model, text) where a model column is named. A ConnectionError or TimeoutError is
    a transport failure, an answer without all dims a schema failure, any other error fails by its name.
    """
    schema = "scores map<string,double>, failure string"

    def one(*asked):
        try:
            got = scorer(*asked)
            return (got, None) if got and all(d in got for d in dims) else (None, "schema")
        except (ConnectionError, TimeoutError):
            return None, "transport"
        except Exception as e:  # a failure is a row of the result
            return None, type(e).__name__

    if model is None:

        @F.pandas_udf(schema)
        def run(batch: pd.Series) -> pd.DataFrame:
            return pd.DataFrame([one(t or "") for t in batch], columns=["scores", "failure"])

        scored = run(F.col(text))
    else:

        @F.pandas_udf(schema)
        def run_model(models: pd.Series, batch: pd.Series) -> pd.DataFrame:
            return pd.DataFrame([one(m, t or "") for m, t in zip(models, batch, strict=True)], columns=["scores", "failure"])

        scored = run_model(F.col(model), F.col(text))
    return items.withColumn("_r", scored).select("*", "_r.scores", "_r.failure").drop("_r")


def scoring_run(
    items: DataFrame, models: Sequence[str], repeats: int, scorer: Callable[[str, str], dict[str, float] | None], bounds: Mapping[str, tuple[float, float]], keys: Sequence[str], done: DataFrame | None = None, text: str = "text"
) -> DataFrame:
    """(keys, model, repeat, scores, failure, detail): every model's repeats on every item that have no answer yet.

    done (keys, model, repeat, failure) is the log of earlier runs; a transport failure there is asked again.
    Scores outside their bounds, or missing, are a schema failure, and detail names them.
    """
    calls = items.withColumn("model", F.explode(F.array(*map(F.lit, models)))).withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    if done is not None:
        calls = resume(calls, done.where("failure IS NULL OR failure <> 'transport'"), [*keys, "model", "repeat"])
    got = score_batch(calls, scorer, (), text, "model").withColumn("_wrong", F.when(F.col("scores").isNotNull(), out_of_range(F.col("scores"), dict(bounds))))
    bad = F.coalesce(F.size("_wrong") > 0, F.lit(False))
    return got.select(*keys, "model", "repeat", F.when(~bad, F.col("scores")).alias("scores"), F.when(bad, "schema").otherwise(F.col("failure")).alias("failure"), F.when(bad, F.array_join("_wrong", ",")).alias("detail"))


def live_examples(articles: DataFrame, resolved: DataFrame, names: DataFrame, start: str, end: str, size: int = 300, seed: int = 11) -> DataFrame:
    """(article_id, ticker, name, title, description) sampled from the window's articles, first copy of each id, that match an entity.

    articles (article_id, day, title, description, published_at), resolved (article_id, ticker, status), names (ticker, name).
    """
    inside = articles.where(F.col("day").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    first = inside.groupBy("article_id").agg(F.min_by(F.struct("title", "description"), F.struct("day", "published_at")).alias("a")).select("article_id", "a.*")
    pairs = resolved.where("status = 'matched'").select("article_id", "ticker").distinct().join(first.select("article_id"), "article_id")
    chosen = stratified_round_robin(pairs, size, seed).select("article_id", "ticker")
    return chosen.join(first, "article_id").join(names.select("ticker", "name"), "ticker", "left").select("article_id", "ticker", F.coalesce("name", F.lit("")).alias("name"), "title", "description")
