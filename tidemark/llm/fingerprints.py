"""Threshold-scaled sketches: of a text's shingle hashes, all that lie below a fixed fraction of the range.

Sketches of any two texts keep the same part of the hash range, so the union of two sketches is the
sketch of both texts, and containment can be estimated between texts of very unequal length. Everything
here is made of DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

#: Of the 2**64 hash values this share is kept.
FRACTION = 1 / 4
#: Words of a shingle.
WORDS = 5
_LEAST = -(1 << 63)


def words_of(text: Column) -> Column:
    """Lower-case words parted by ASCII white space; null and empty texts have none."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[ \\t-\\r]+"), lambda w: w != "")


def sketch_of_words(words: Column, k: int = WORDS, fraction: float = FRACTION) -> Column:
    """Sorted distinct hashes below the fraction; fewer than k words are one shingle."""
    last = F.greatest(F.size(words) - (k - 1), F.lit(1))
    hashed = F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice(words, i, k)))
    kept = F.filter(hashed, lambda h: h < F.lit(int(_LEAST + fraction * (1 << 64))))
    return F.when(F.size(words) > 0, F.array_sort(F.array_distinct(kept))).otherwise(F.array().cast("array<bigint>"))


def shared(left: Column, right: Column) -> Column:
    return F.size(F.array_intersect(left, right))


def jaccard(left: Column, right: Column) -> Column:
    """Estimated likeness, 0 to 1; two empty sketches have 0."""
    both = shared(left, right)
    return F.coalesce(F.try_divide(both.cast("double"), (F.size(left) + F.size(right) - both).cast("double")), F.lit(0.0))


def containment(part: Column, whole: Column) -> Column:
    """Estimated share of part's shingles that whole has as well; an empty sketch has 0."""
    return F.coalesce(F.try_divide(shared(part, whole).cast("double"), F.size(part).cast("double")), F.lit(0.0))


def merge(left: Column, right: Column) -> Column:
    """The sketch of both texts' shingles."""
    return F.array_sort(F.array_union(left, right))


def printed(sketch: Column) -> Column:
    """Hashes as 16 hexadecimal digits each, commas between; an empty sketch is an empty string."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), ",")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = WORDS, fraction: float = FRACTION) -> DataFrame:
    """(doc_id, sketch, fingerprint) for each row; null and empty texts have an empty sketch."""
    base = docs.select(F.col(f"`{id_col}`").alias("doc_id"), words_of(F.col(f"`{text_col}`")).alias("words"))
    return base.select("doc_id", sketch_of_words(F.col("words"), k, fraction).alias("sketch")).withColumn("fingerprint", printed(F.col("sketch")))


def with_neighbour(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> tuple[DataFrame, Window]:
    """docs as (part, spare, doc_id, text), and the window in which each row's successor by descending id comes next.

    Ids are cut into parts at approximate quantiles, so the order is global without one global sort task.
    The row that follows a part's last one is the first of the part below (of the first part, for the
    last): those few rows go to both parts, to the upper one as spares, which the caller drops.
    """
    spark = docs.sparkSession
    base = docs.select(
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(_LEAST)).alias("order_id"),
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    )
    parts = parts or max(8, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = base.agg(F.percentile_approx("order_id", [i / parts for i in range(1, parts)], 10_000).alias("q")).first().q
    bounds = sorted(set(found or []))
    # Two steps of about the square root of the bounds each; the number of parts is bounded, not the rows.
    step = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)] or [[_LEAST]]
    coarse = F.array(*[F.lit(g[0]).cast("long") for g in groups[1:]]).cast("array<bigint>")
    fine = F.array(*[F.array(*[F.lit(b).cast("long") for b in g]) for g in groups])
    group = F.size(F.filter(coarse, lambda b: b < F.col("order_id")))
    below = F.size(F.filter(F.get(fine, F.col("group")), lambda b: b < F.col("order_id")))
    parted = base.withColumn("group", group).withColumn("part", F.col("group") * (step + 1) + below).drop("group")
    heads = parted.groupBy("part").agg(F.max("order_id").alias("head"))  # a row for each part
    down = Window.orderBy(F.desc("part"))
    heads = heads.select("head", F.coalesce(F.lag("part").over(down), F.first("part").over(Window.orderBy("part"))).alias("above"))
    both = (
        parted.join(F.broadcast(heads), F.col("order_id") == F.col("head"), "left")
        .withColumn("copy", F.explode(F.when(F.col("head").isNull(), F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))))
        .select(F.when(F.col("copy") == 1, F.col("above")).otherwise(F.col("part")).alias("part"), F.col("copy").alias("spare"), "order_id", "doc_id", "text")
    )
    return both, Window.partitionBy("part").orderBy("spare", F.desc("order_id"), F.xxhash64("text"))


def neighbour_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = WORDS, fraction: float = FRACTION) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for each row.

    The edited text has its last third (floor of code points / 3) replaced by the first as many (or all)
    of the next document in descending id, after the last the first. near_* compare the text's sketch
    with the edited text's and the next document's; equal texts have 1. Null texts are empty, null ids
    come last, rows of the same id lie in the order of their texts' hashes. A single row follows itself.
    One shuffle moves the texts; no rows give no rows.
    """
    parted, order = with_neighbour(docs, id_col, text_col)
    third = F.floor(F.char_length("text") / 3).cast("int")
    sketch = lambda c: sketch_of_words(F.col(c), k, fraction)
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.char_length("text") - third), F.substring(F.col("next"), F.lit(1), third))
    made = (
        parted.withColumn("next", F.coalesce(F.lead("text").over(order), F.col("text")))
        .withColumn("edited", edited)
        .withColumn("words", words_of(F.col("text")))
        .withColumn("edited_words", words_of(F.col("edited")))
        .withColumn("sketch", sketch("words"))
        .withColumn("edited_sketch", sketch("edited_words"))
        .withColumn("next_sketch", F.lead("sketch").over(order))
        .where("spare = 0")
    )
    near = lambda other, text: F.when(F.col("text") == F.col(text), F.lit(1.0)).otherwise(jaccard(F.col("sketch"), F.col(other)))
    return made.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        printed(F.col("sketch")).alias("fingerprint"),
        printed(F.col("edited_sketch")).alias("edited_fingerprint"),
        near("edited_sketch", "edited").alias("near_edited"),
        near("next_sketch", "next").alias("near_next"),
    )
