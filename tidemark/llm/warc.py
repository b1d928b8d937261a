"""WARC archives compressed with a dictionary.

An archive is a leading skippable frame that holds a Zstandard dictionary built from its own records,
then one frame for each record. A repeated payload is stored once; its other records revisit it.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_schema, pick, shared_folder, with_maybe, written

# Fixed values of the public formats.
SKIPPABLE = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass(frozen=True)
class Layout:
    """archive_bytes: plain bytes after which a task begins another archive; sample_bytes, piece_bytes: how
    much of its records, evenly spaced over all of it, and of each of them at most, the dictionary is built
    from; dictionary_bytes: the most that it may hold."""

    archive_bytes: int = 64 << 20
    sample_bytes: int = 2 << 20
    piece_bytes: int = 16 << 10
    dictionary_bytes: int = 64 << 10
    level: int = 3
    date: str = "2024-01-01T00:00:00Z"


def with_revisits(pages: DataFrame) -> DataFrame:
    """pages (page_id, url, html) with digest (SHA-1 in hexadecimal) and refers_to (null: the record is a response).

    Of equal payloads the largest page_id is the response and all others revisit it, null ids among them;
    where all ids are null there is none to refer to. The decision is made on ids and digests alone, and a
    row for each repeated payload is written. Payloads that a map of fixed size tells to be single stay
    where they are; the others meet that table, by one shuffle if it is too large for a broadcast.
    """
    digested = pages.withColumn("digest", F.sha1(F.encode(F.coalesce("html", F.lit("")), "UTF-8")))
    repeated = digested.groupBy("digest").agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1 AND last IS NOT NULL")
    repeated = written(repeated.drop("n"))
    marked = with_maybe(digested, repeated, "digest")
    single = marked.where("NOT _maybe").withColumn("last", F.lit(None).cast("long"))
    both = single.unionByName(marked.where("_maybe").join(repeated, "digest", "left"))
    return both.withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("last")), F.col("last"))).drop("last", "_maybe")


def write_archives(pages: DataFrame, folder: str, layout: Layout = Layout(), id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write an archive or more per task into folder, at once, and return the written table (path, records, bytes) of them.

    Names hold the task's attempt, and the table lists only what attempts that finished have written: a
    lost, repeated or speculative task may leave files behind, but none that the table knows. folder is
    taken on Spark's own default filesystem. Null html is an empty payload, null url an empty target;
    repeated rows of the responding id are all responses. No rows give no archive.
    """
    place = _qualified(pages.sparkSession, folder)
    rows = with_revisits(pick(pages, page_id=id_col, url=url_col, html=html_col))
    return written(rows.mapInArrow(lambda batches: _write(batches, place, layout), "path string, records long, bytes long"))


def _qualified(spark: SparkSession, folder: str) -> str:
    """The folder as a full URI, so that tasks mean the same place as Spark does; raises if they can't open it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    uri = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toUri().toString()
    uri = "file://" + uri.removeprefix("file:") if uri.startswith("file:/") and not uri.startswith("file://") else uri
    pa.fs.FileSystem.from_uri(uri)
    return uri


def _write(batches: Iterator[pa.RecordBatch], folder: str, layout: Layout) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    context, held, size, done = TaskContext.get(), [], 0, []

    def flush() -> None:
        nonlocal held, size
        done.append(_archive(held, f"{folder}/part-{context.partitionId():05d}-{context.taskAttemptId()}-{len(done):04d}.warc.zst", layout))
        held, size = [], 0

    for batch in batches:
        for row in batch.to_pylist():
            record = _record(row, layout.date)
            held.append(record)
            size += len(record)
            if size >= layout.archive_bytes:
                flush()
    if held:
        flush()
    yield pa.RecordBatch.from_pylist(done, schema=pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))


def _archive(records: list[bytes], path: str, layout: Layout) -> dict:
    import zstandard

    dictionary = _dictionary(records, layout)
    made = zstandard.ZstdCompressor(level=layout.level, dict_data=zstandard.ZstdCompressionDict(dictionary), write_checksum=True)
    store, place = pa.fs.FileSystem.from_uri(path)
    store.create_dir(place.rpartition("/")[0], recursive=True)
    size = 8 + len(dictionary)
    with store.open_output_stream(place, compression=None) as out:
        out.write(struct.pack("<II", SKIPPABLE, len(dictionary)) + dictionary)
        for record in records:
            frame = made.compress(record)
            out.write(frame)
            size += len(frame)
    return {"path": path, "records": len(records), "bytes": size}


def _dictionary(records: list[bytes], layout: Layout) -> bytes:
    """Built from the first piece of records that are evenly spaced over the archive.

    Where these are too few, or have too little in common, for the library to train on, their beginnings
    themselves are the dictionary's content.
    """
    import zstandard

    total = sum(min(len(r), layout.piece_bytes) for r in records)
    samples = [r[: layout.piece_bytes] for r in records[:: -(-total // layout.sample_bytes)]]
    most = max(256, min(layout.dictionary_bytes, total // 16))
    try:
        return zstandard.train_dictionary(most, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(r[: max(1, most // len(samples))] for r in samples)[:most]


def _record(row: dict, date: str) -> bytes:
    payload = (row["html"] or "").encode("utf-8")
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = [
        ("WARC-Type", "response" if row["refers_to"] is None else "revisit"),
        ("WARC-Record-ID", "<urn:page:none>" if row["page_id"] is None else f"<urn:page:{row['page_id']}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", row["url"] or "")),
        ("WARC-Payload-Digest", f"sha1:{base64.b32encode(bytes.fromhex(row['digest'])).decode()}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if row["refers_to"] is None:
        block += payload
    else:
        head += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<urn:page:{row['refers_to']}>")]
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*head, ("Content-Length", len(block))])
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


READ = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def archives_in(spark: SparkSession, folder: str) -> DataFrame:
    """(path) of the archives that a folder holds, for archives that have no table."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder).select("path")


def read_archives(archives: DataFrame, payloads: bool = True, parts: int | None = None) -> DataFrame:
    """A row for each record of the archives (path): what READ names; payload is null in revisits.

    Payloads of responses are digested anew and must agree with their headers. Tasks read archives as
    streams, so that memory holds a few records; ``parts`` tasks, by default one for each archive up to
    ten thousand.
    """
    fields = READ if payloads else READ.rpartition(",")[0]
    target = arrow_schema(archives.sparkSession, fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, place = pa.fs.FileSystem.from_uri(path)
                held, size = [], 0
                with store.open_input_stream(place, compression=None) as data:
                    for record in _parsed(data, payloads):
                        held.append(record)
                        size += len(record.get("payload") or b"")
                        if len(held) == 256 or size > 8 << 20:
                            yield pa.RecordBatch.from_pylist(held, schema=target)
                            held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=target)

    parts = parts or max(1, min(10_000, archives.count()))
    return archives.select("path").repartition(parts).mapInArrow(run, fields)


def _parsed(data, payloads: bool) -> Iterator[dict]:
    import zstandard

    magic, size = struct.unpack("<II", data.read(8))
    if magic != SKIPPABLE:
        raise ValueError("an archive must begin with its dictionary's frame")
    dictionary = zstandard.ZstdCompressionDict(data.read(size)) if size else None
    body = zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(data, read_across_frames=True)
    lines = io.BufferedReader(body, 1 << 16)
    while lines.readline():  # the version line
        head = dict(_headers(lines))
        block = io.BytesIO(lines.read(int(head["Content-Length"])))
        lines.read(4)
        block.readline()
        inner = dict(_headers(block))
        page, digest, refers = head["WARC-Record-ID"][10:-1], head["WARC-Payload-Digest"].removeprefix("sha1:"), head.get("WARC-Refers-To")
        out = {
            "page_id": None if page == "none" else int(page),
            "url": head["WARC-Target-URI"],
            "payload_bytes": int(inner["Content-Length"]),
            "payload_digest": digest,
            "record_type": head["WARC-Type"],
            "refers_to": int(refers[10:-1]) if refers else None,
        }
        if out["record_type"] == "response":
            payload = block.read()
            if len(payload) != out["payload_bytes"] or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                raise ValueError(f"the payload of page {page} isn't what its headers say")
            if payloads:
                out["payload"] = payload
        yield out


def _headers(lines) -> Iterator[tuple[str, str]]:
    while line := lines.readline().rstrip(b"\r\n"):
        key, _, value = line.decode().partition(": ")
        yield key, value


def archived(pages: DataFrame) -> DataFrame:
    """pages written to new archives in shared storage and read back, without payloads."""
    return read_archives(write_archives(pages, shared_folder(pages.sparkSession)), payloads=False)
