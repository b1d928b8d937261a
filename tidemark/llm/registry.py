"""Queries of the corpus operators by name, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import byte_bpe, decontamination, fingerprints, licenses, merkle, mixing, near_dedup, secrets, sharding, token_counts, toxicity, variants, warc
from tidemark.llm.oracle import SQL


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizers():
    import public_tokenizers

    return public_tokenizers


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = token_counts.unigram_pieces(_tokenizers().path("piece_bpe_32k.model"))
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), pieces)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    out = secrets.scan(docs, secrets.train(docs))
    return out.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(_table(spark, sf_dir, "documents"), shards=8)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.archived(_table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _tokenizers()
    return byte_bpe.digests(_table(spark, sf_dir, "documents"), t.path("byte_bpe_multi_50k.tiktoken"), t.PATTERN)


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.neighbour_fingerprints(_table(spark, sf_dir, "documents"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), k=2)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audited(merkle.tampered(_table(spark, sf_dir, "documents")))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.grouped(variants.count_words(_table(spark, sf_dir, "documents")))


def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


_QUERIES = (
    op1_token_counts, op2_secret_scan, op3_sharding, op4_warc, op5_byte_bpe,
    op6_fingerprints, op7_near_dedup, op8_decontamination, op9_license_scan, op10_toxicity,
    op11_merkle_manifest, op12_spelling_variants, op13_source_mix,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
