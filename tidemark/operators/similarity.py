"""Likeness within a key: title pairs, vector pairs, clusters of duplicates, topicality."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import dot
from tidemark.operators.graph import connected_components
from tidemark.operators.storage import written

#: Members of a key that one block holds; vector pairs are formed between blocks, never over a whole key at once.
BLOCK = 512
#: Chunks of titles, and tokens in them, that a block holds; articles of a class that a chunk holds.
TITLES, TOKENS, MEMBERS = 4096, 1 << 18, 256
#: Blocks of a key before they grow, as each goes to as many tasks, and times that they may grow before there are more.
BLOCKS, GROWN = 8, 16
#: Pairs that an Arrow batch holds, or those of two chunks.
PAIRS = 1 << 16
#: Fixed value: what the tokens of a title are made of.
TOKEN = "[가-힣A-Za-z0-9]+"


def tokens(text: str):
    """Distinct tokens of a text."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(TOKEN), 0))


def titled(articles: DataFrame, key: str = "ticker", text: str = "title", carry: Sequence[str] = ()) -> DataFrame:
    """(key, c, article_id, carry, t) of articles whose text has tokens; those of equal sets have one class c."""
    base = articles.where(F.col(key).isNotNull()).select(key, "article_id", *carry, F.array_sort(tokens(text)).alias("t")).where(F.size("t") > 0)
    return base.withColumn("c", F.unhex(F.md5(F.array_join("t", " "))))


def _blocks(classes: DataFrame, key: str) -> DataFrame:
    """(key, n): blocks of a key, of classes (key, chunks, tokens, articles). Past BLOCKS they grow first, so that what is sent grows with the titles."""
    wide = F.greatest(F.sum("chunks") / TITLES, F.sum(F.col("chunks") * F.col("tokens")) / TOKENS, F.sum("articles") / (TITLES * 8))
    return classes.groupBy(key).agg(F.ceil(F.greatest(F.least(wide, F.lit(BLOCKS)), wide / GROWN)).cast("int").alias("n"))


def _dealt(chunks: DataFrame, blocks: DataFrame, key: str, by: Sequence[str], carry: Sequence[str]) -> DataFrame:
    """(key, u, v, own, carry) of chunks, once for each pair of blocks (u, v) that its own one is of. The number of tasks is kept: they make more than they read."""
    own = chunks.join(F.broadcast(blocks), key).withColumn("own", F.pmod(F.xxhash64(*by), F.col("n")).cast("int"))
    pair = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda o: F.struct(F.least(o, "own").alias("u"), F.greatest(o, "own").alias("v")))
    parts = int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return own.withColumn("p", F.explode(pair)).select(key, "p.u", "p.v", "own", *carry).repartition(parts, key, "u", "v")


def _joined(column: pa.ChunkedArray) -> pa.Array:
    """A column in one piece."""
    return pa.concat_arrays(column.chunks)


def _alike(group: pa.Table, least: float, overlap: bool, itself: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places (x, y) of sets, one of block u and one of v, that reach the threshold, and their likeness, from the postings of v; some PAIRS a time."""
    own, u, v = group["own"].to_numpy(), group["u"][0].as_py(), group["v"][0].as_py()
    sets = pc.split_pattern(_joined(group["t"]), " ")
    sizes = pc.list_value_length(sets).to_numpy(zero_copy_only=False)
    word = sets.flatten().dictionary_encode().indices.to_numpy()
    begins = np.concatenate([[0], np.cumsum(sizes)])
    left, right = np.flatnonzero(own == u), np.flatnonzero(own == v)
    place = np.full(len(own), -1)
    place[right] = np.arange(len(right))
    of = np.repeat(place, sizes)
    held, at = word[of >= 0], of[of >= 0]
    posted = at[np.argsort(held, kind="stable")]
    starts = np.concatenate([[0], np.cumsum(np.bincount(held, minlength=int(word.max()) + 1))])
    xs, ys, likes, n, found = [], [], [], sizes[right], 0
    for i in left if len(right) else ():
        count = np.bincount(np.concatenate([posted[starts[w] : starts[w + 1]] for w in word[begins[i] : begins[i + 1]]]), minlength=len(right))
        like = count / (np.minimum(n, sizes[i]) if overlap else n + sizes[i] - count)
        hit = np.flatnonzero(like >= least)
        hit = hit[hit >= place[i] + (not itself)] if u == v else hit
        xs.append(np.full(len(hit), i))
        ys.append(right[hit])
        likes.append(like[hit])
        found += len(hit)
        if found >= PAIRS:
            yield np.concatenate(xs), np.concatenate(ys), np.concatenate(likes)
            xs, ys, likes, found = [], [], [], 0
    if found:
        yield np.concatenate(xs), np.concatenate(ys), np.concatenate(likes)


def alike_classes(members: DataFrame, key: str = "ticker", least: float = 0.5, overlap: bool = False) -> DataFrame:
    """(key, x, y, s), once each, of different classes of ``titled`` whose token sets reach the threshold.

    Classes of a key are dealt to blocks, and a task counts what two blocks share from the postings of one of
    them. Only what reaches the threshold leaves it, so candidates are never shuffled; sets are, once a block.
    """
    classes = members.groupBy(key, "c").agg(F.any_value(F.array_join("t", " ")).alias("t"), F.any_value(F.size("t")).alias("tokens"))
    blocks = _blocks(classes.select(key, F.lit(1).alias("chunks"), "tokens", F.lit(1).alias("articles")), key)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = pa.Table.from_batches(list(batches))
        name, c = _joined(group[key]), _joined(group["c"])
        for x, y, like in _alike(group, least, overlap, itself=False):
            yield pa.RecordBatch.from_arrays([name.take(pa.array(np.zeros(len(x), np.int64))), c.take(pa.array(x)), c.take(pa.array(y)), pa.array(like)], [key, "x", "y", "s"])

    schema = T.StructType([members.schema[key], T.StructField("x", T.BinaryType()), T.StructField("y", T.BinaryType()), T.StructField("s", T.DoubleType())])
    return _dealt(classes, blocks, key, ["c"], ["c", "t"]).groupBy(key, "u", "v").applyInArrow(compare, schema)


def same_event_pairs(articles: DataFrame, key: str = "ticker", text: str = "title", least: float = 0.5, overlap: bool = False, carry: Sequence[str] = ()) -> DataFrame:
    """(key, a, b, jaccard) of different articles of a key whose token sets reach the threshold.

    With overlap the shared tokens are measured against the smaller set, as ``overlap``. Columns to carry come
    with both sides, as ``_a`` and ``_b``. Articles of equal sets are held in bounded chunks, which are dealt to
    blocks; the task that compares two blocks makes their pairs, in bounded batches, so no pair is ever shuffled.
    """
    members = written(titled(articles, key, text, carry))  # read for classes and chunks: texts are split once
    classes = members.groupBy(key, "c").agg(F.count("*").alias("articles"), F.any_value(F.size("t")).alias("tokens")).withColumn("chunks", F.ceil(F.col("articles") / MEMBERS))
    many = classes.where("chunks > 1").select(key, "c", F.col("chunks").alias("_k"))  # at most one for so many articles as a chunk holds
    kept = members.select(key, "c", F.array_join("t", " ").alias("t"), F.struct("article_id", *carry).alias("i"))
    kept = kept.join(F.broadcast(many), [key, "c"], "left").withColumn("k", F.pmod(F.xxhash64("i.article_id"), F.coalesce("_k", F.lit(1))))
    chunks = kept.groupBy(key, "c", "k").agg(F.any_value("t").alias("t"), F.collect_list("i").alias("i"))
    item = members.select("article_id", *carry).schema

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = pa.Table.from_batches(list(batches))
        name, lists = _joined(group[key]), _joined(group["i"])
        parts, n = lists.flatten().flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        begins = np.cumsum(n) - n
        for xs, ys, likes in _alike(group, least, overlap, itself=True):
            sums = np.concatenate([[0], np.cumsum(n[xs] * n[ys])])
            cuts = np.unique(np.concatenate([np.searchsorted(sums, np.arange(0, sums[-1], PAIRS)), [len(xs)]]))
            for low, high in zip(cuts[:-1], cuts[1:], strict=True):
                x, y = xs[low:high], ys[low:high]
                made = n[x] * n[y]
                of = np.repeat(np.arange(len(x)), made)
                at = np.arange(len(of)) - np.repeat(sums[low:high] - sums[low], made)
                p, q = begins[x][of] + at // n[y][of], begins[y][of] + at % n[y][of]
                once = np.flatnonzero((x != y)[of] | (p < q))
                sides = [part.take(pa.array(side[once])) for side in (p, q) for part in parts]
                yield pa.RecordBatch.from_arrays([name.take(pa.array(np.zeros(len(once), np.int64))), pa.array(likes[low:high][of[once]]), *sides], names)

    schema = T.StructType([members.schema[key], T.StructField("s", T.DoubleType()), *[T.StructField(f"{side}_{f.name}", f.dataType) for side in "pq" for f in item]])
    names = schema.names
    found = _dealt(chunks, _blocks(classes, key), key, ["c", "k"], ["t", "i"]).groupBy(key, "u", "v").applyInArrow(pairs, schema).where("p_article_id <> q_article_id")
    first = F.col("p_article_id") < F.col("q_article_id")
    low, high = (lambda c, x=x, y=y: F.when(first, F.col(f"{x}_{c}")).otherwise(F.col(f"{y}_{c}")) for x, y in ("pq", "qp"))
    return found.select(
        key, low("article_id").alias("a"), high("article_id").alias("b"), F.col("s").alias("overlap" if overlap else "jaccard"),
        *[side(c).alias(f"{c}_{name}") for c in carry for side, name in ((low, "a"), (high, "b"))],
    )


def similarity_pairs(vectors: DataFrame, least: float, key: str = "ticker", item: str = "article_id", vector: str = "vector") -> DataFrame:
    """(key, a, b, cosine) of unit vectors of a key that reach the threshold, a before b.

    Members of a key are dealt to blocks by hash; one row pairs two blocks, and a task multiplies them.
    """
    blocks = vectors.groupBy(key).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("n"))
    own = vectors.select(F.col(key), F.col(item).alias("i"), F.col(vector).alias("v")).join(blocks, key).withColumn("own", F.pmod(F.xxhash64("i"), F.col("n")).cast("int"))
    pair = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda o: F.struct(F.least(o, "own").alias("x"), F.greatest(o, "own").alias("y")))
    dealt = own.withColumn("p", F.explode(pair)).select(key, "p.x", "p.y", "own", "i", "v")

    def multiply(group: pd.DataFrame) -> pd.DataFrame:
        import numpy as np

        x, y = group["x"].iloc[0], group["y"].iloc[0]
        left, right = group[group["own"] == x], group[group["own"] == y]
        out = {key: [], "a": [], "b": [], "cosine": []}
        if len(left) and len(right):
            c = np.stack(left["v"].to_list()).astype(float) @ np.stack(right["v"].to_list()).astype(float).T
            li, ri = left["i"].to_numpy(), right["i"].to_numpy()
            for r, s in zip(*np.nonzero(c >= least), strict=True):
                if li[r] < ri[s] or (x != y and li[r] != ri[s]):
                    out["a"].append(min(li[r], ri[s]))
                    out["b"].append(max(li[r], ri[s]))
                    out["cosine"].append(float(c[r, s]))
        out[key] = pd.Series([group[key].iloc[0]] * len(out["a"]), dtype=object)
        return pd.DataFrame(out)

    kinds = {f.name: f.dataType for f in vectors.schema}
    schema = T.StructType([T.StructField(key, kinds[key]), T.StructField("a", kinds[item]), T.StructField("b", kinds[item]), T.StructField("cosine", T.DoubleType())])
    return dealt.groupBy(key, "x", "y").applyInPandas(multiply, schema)


def cluster_duplicates(items: DataFrame, pairs: DataFrame, key: str = "ticker", item: str = "article_id", length: str = "length") -> DataFrame:
    """(key, item, cluster, kept): components of the pairs; of a cluster the longest stays, ties by greatest id.

    Ids must be longs and belong to one key.
    """
    comps = connected_components(pairs.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")))
    got = items.join(comps.withColumnRenamed("node", item), item, "left").withColumn("cluster", F.coalesce("component", F.col(item).cast("long")))
    best = got.groupBy(key, "cluster").agg(F.max_by(item, F.struct(length, item)).alias("best"))
    return got.join(best, [key, "cluster"]).select(key, item, "cluster", (F.col(item) == F.col("best")).alias("kept"))


def dedup_report(clustered: DataFrame, key: str = "ticker") -> DataFrame:
    """(key, articles, kept, dropped, clusters): clusters of more than one."""
    per = clustered.groupBy(key, "cluster").agg(F.count("*").alias("n"), F.count_if("kept").alias("k"))
    return per.groupBy(key).agg(F.sum("n").alias("articles"), F.sum("k").alias("kept"), (F.sum("n") - F.sum("k")).alias("dropped"), F.count_if(F.col("n") > 1).alias("clusters"))


def topicality(items: DataFrame, profiles: DataFrame, least: float, key: str = "ticker", vector: str = "vector") -> DataFrame:
    """items with their cosine to the key's profile, those below the threshold left out."""
    got = items.join(profiles.select(key, F.col(vector).alias("_profile")), key)
    return got.withColumn("cosine", dot(vector, "_profile")).where(F.col("cosine") >= least).drop("_profile")


def topicality_report(items: DataFrame, kept: DataFrame, key: str = "ticker") -> DataFrame:
    """(key, pairs, kept, dropped) of what a topicality filter was given and what it left."""
    left = kept.groupBy(key).agg(F.count("*").alias("kept"))
    got = items.groupBy(key).agg(F.count("*").alias("pairs")).join(left, key, "left").fillna({"kept": 0})
    return got.select(key, "pairs", "kept", (F.col("pairs") - F.col("kept")).alias("dropped"))


def without_profile(items: DataFrame, profiles: DataFrame, key: str = "ticker") -> DataFrame:
    """Keys of items that have no profile; such a table is in error."""
    return items.select(key).distinct().join(profiles.select(key), key, "left_anti")


def embed_texts(texts: DataFrame, embed: Callable[[list[str]], list[list[float]]] | None = None, text: str = "text", out: str = "vector", size: int = 256) -> DataFrame:
    """texts with a unit vector each; empty and null texts have a vector of zeros.

    embed maps a list of texts to vectors and runs on Arrow batches; without it, token counts hashed to
    size places and scaled to length 1, made of built-in functions.
    """
    if embed is None:
        place = F.transform(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(TOKEN), 0), lambda w: F.pmod(F.xxhash64(w), F.lit(size)))
        counted = texts.withColumn("_p", F.array_sort(place))
        raw = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.size(F.filter("_p", lambda p: p == i)).cast("double"))
        norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
        made = counted.withColumn("_v", raw).withColumn("_n", norm("_v"))
        return made.withColumn(out, F.transform("_v", lambda x: F.coalesce(F.try_divide(x, F.col("_n")), F.lit(0.0)))).drop("_p", "_v", "_n")

    @F.pandas_udf("array<double>")
    def run(batch: pd.Series) -> pd.Series:
        import numpy as np

        vectors = np.asarray(embed(batch.fillna("").tolist()), float).reshape(len(batch), -1)
        norms = np.linalg.norm(vectors, axis=1, keepdims=True)
        return pd.Series(list(np.divide(vectors, norms, out=np.zeros_like(vectors), where=norms > 0)))

    return texts.withColumn(out, run(F.col(text)))


def dedup_calibration(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """(is_duplicate, n, least, mean, most) of the similarity of known duplicates and of all other pairs."""
    marked = pairs.join(known.select("a", "b", F.lit(True).alias("k")), ["a", "b"], "left").withColumn("is_duplicate", F.coalesce("k", F.lit(False)))
    return marked.groupBy("is_duplicate").agg(F.count("*").alias("n"), F.min("cosine").alias("least"), F.avg("cosine").alias("mean"), F.max("cosine").alias("most"))


def profiles(entities: DataFrame) -> DataFrame:
    """(ticker, sentence): name (ticker), sector."""
    return entities.select("ticker", F.concat(F.col("name"), F.lit(" ("), F.col("ticker").cast("string"), F.lit(")"), F.coalesce(F.concat(F.lit(", "), "sector"), F.lit(""))).alias("sentence"))
