"""A corpus pipeline of five stages; each reads what the one before it wrote.

Stages keep the columns of documents; further columns, whatever their names, are left out. Empty tables give
empty ones, and rows that repeat or have no id are judged each by its own text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe, decontamination, near_dedup, secrets, toxicity
from tidemark.llm.common import with_maybe, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _numbered(docs: DataFrame) -> DataFrame:
    """docs, written once with a number for each row: what is decided on a row holds for that row, whatever its id."""
    return written(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("_row")))


def _without(rows: DataFrame, dropped: DataFrame) -> DataFrame:
    """rows less the numbers in dropped. Texts stay where they are but for those that a map of fixed size can't rule out."""
    dropped = written(dropped.select("_row"))
    marked = with_maybe(rows, dropped, "_row")
    kept = marked.where("NOT _maybe").unionByName(marked.where("_maybe").join(dropped.hint("merge"), "_row", "left_anti"))
    return kept.select(*COLUMNS)


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go; it learns from the labels' training folds.

    Scoring needs no shuffle, and each row is dropped where it is read. Null and empty texts score 0 and stay.
    """
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.accepted(docs.select(*COLUMNS), model)


def near_duplicates_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, 0.8) the document with the smallest id stays, once.

    Rows without an id take part and come after those that have one. Texts without words are like no
    other; of those, rows of one id with equal texts stay once.
    """
    rows = _numbered(docs)
    blank = F.coalesce(F.col("text").rlike(r"^[\x20\x09-\x0D]*\z"), F.lit(True))
    again = blank & F.col("doc_id").isNotNull()
    groups = near_dedup.near_duplicates(rows, id_col="_row", k=5).select(F.col("doc_id").alias("_row"), "component_id")
    copy = F.concat_ws(":", F.lit("again"), "doc_id", F.sha2(F.encode("text", "UTF-8"), 256))
    own = rows.select("_row", "doc_id", F.when(again, copy).alias("copy")).join(groups, "_row")
    own = written(own.select("_row", "doc_id", F.coalesce("copy", F.concat_ws(":", F.lit("group"), "component_id")).alias("group")))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_row"))
    firsts = written(own.groupBy("group").agg(first.alias("first"), F.count("*").alias("n")).where("n > 1").select("group", F.col("first._row").alias("first")))
    return _without(rows, own.join(firsts, "group").where("_row <> first"))


def contaminated_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a ten-word window of a benchmark item go; null and empty texts hold none."""
    rows = _numbered(docs)
    index = written(decontamination.build_index(rows, row_col="_row"))
    found = decontamination.contaminated_rows(index, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where("size(hits) > 0")
    return _without(rows, found.select(F.col("row").alias("_row")))


def secrets_masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; what the scan finds in its text is masked, and n_chars follows the text."""
    masked = secrets.redact(docs, secrets.train(docs))
    return masked.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.char_length("text").cast("long"))).select(*COLUMNS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of every document; ids are decoded again, and NULL where that doesn't give the text."""
    import public_tokenizers

    return byte_bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, checked=True).select("doc_id", "n_tokens", "ids")


STAGES = [
    ("toxicity", toxic_out),
    ("near duplicates", near_duplicates_out),
    ("decontamination", contaminated_out),
    ("secrets", secrets_masked),
    ("byte-level BPE", encoded),
]

#: Trained models and a tokenizer aren't SQL's to say; tests hold every stage against plain code instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents, each written to shared storage and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs)
    return docs
