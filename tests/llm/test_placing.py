"""Sharding, archives and fingerprints on small tables, against plain Python."""

import base64
import hashlib
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import common, fingerprints, sharding, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, part string"


def docs(spark, texts, schema=DOCS):
    return spark.createDataFrame([(i, t, "en", "s", 0, "x", "y") for i, t in texts], schema)


def test_shards_are_even_whole_and_gapless(spark):
    texts = [(i, None if i == 3 else f"text {i % 40} " * (1 + i % 7)) for i in range(400)] + [(1000, ""), (1001, "x" * 5000)]
    rows = sharding.shard_by_bytes(docs(spark, texts), 8, group_share=0.2).collect()
    by_id = dict(texts)
    assert sorted(r.doc_id for r in rows) == sorted(by_id)
    total = sum(r["size"] for r in rows)
    for s in range(8):
        mine = [r for r in rows if r.shard == s]
        assert sorted(r.slot for r in mine) == list(range(len(mine)))
        assert abs(sum(r["size"] for r in mine) - total / 8) <= 0.4 * total / 8 + 5001
    for r in rows:
        data = (by_id[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "bytes", None)


def test_a_small_group_isnt_cut_and_a_large_one_is(spark):
    texts = [(i, f"own {i:04d} " * 3) for i in range(2000)] + [(5000 + i, "same words here " * 2) for i in range(4000)]
    rows = sharding.shard_by_bytes(docs(spark, texts), 8).collect()
    sizes = [sum(r["size"] for r in rows if r.shard == s) for s in range(8)]
    assert max(sizes) - min(sizes) <= 0.05 * max(sizes)
    assert len({r.shard for r in rows if r.doc_id >= 5000}) > 2


@pytest.mark.parametrize("share", [0.0, 0.2])
def test_shards_are_cut_as_plain_code_cuts_them(spark, share):
    texts = [(i, None if i % 50 == 3 else f"text {i * 7 % 60} " * (1 + i % 60 % 7)) for i in range(700)]
    got = {r.doc_id: (r.shard, r.slot) for r in sharding.shard_by_bytes(docs(spark, texts).repartition(7), 8, group_share=share).collect()}
    signed = lambda h: h - ((h >> 63) << 64)
    rows = sorted((signed(xxhash.xxh64_intdigest((t or "").encode(), 42)), zlib.crc32((t or "").encode()), i, len((t or "").encode()) + 1) for i, t in texts)
    begins, at = [], 0
    for r in rows:
        begins.append(at)
        at += r[3]
    cuts = []
    for k in range(1, 8):
        c = at * k // 8
        for digest in {r[0] for r in rows}:
            a = min(b for b, r in zip(begins, rows) if r[0] == digest)
            b = max(b + r[3] for b, r in zip(begins, rows) if r[0] == digest)
            if a < c < b:
                near = a if c - a <= b - c else b
                c = near if abs(near - c) <= share * at / 8 else c
                break
        cuts.append(c)
    want, slots = {}, [0] * 8
    for b, r in zip(begins, rows):
        shard = sum(b >= c for c in cuts)
        want[r[2]] = (shard, slots[shard])
        slots[shard] += 1
    assert got == want


def test_no_rows_have_no_shards(spark):
    assert sharding.shard_by_bytes(docs(spark, [])).collect() == []


@pytest.mark.parametrize("bits", [1 << 26, 1 << 16])
def test_maps_rule_out_no_partner(spark, monkeypatch, bits):
    monkeypatch.setattr(common, "FILTER_BITS", bits)
    df = spark.range(20_000).withColumn("t", F.when(F.col("id") % 7 != 0, F.concat(F.lit("t"), "id")))
    keys = df.where("id % 5 = 0 AND t IS NOT NULL")
    got = common.with_maybe(df, keys, "id", "t").select("id", "_maybe").collect()
    held = {r.id for r in keys.collect()}
    assert len(got) == 20_000 and all(r._maybe for r in got if r.id in held)
    assert sum(r._maybe for r in got if r.id not in held) <= (5 if bits > 1 << 20 else 2500)
    assert not any(r._maybe for r in common.with_maybe(df, keys.limit(0), "id", "t").collect())


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"http://h/{i}\r\nX: y", None if i % 10 == 0 else f"<p>{'word ' * (i % 13)}é</p>") for i in range(200)]
    return spark.createDataFrame(rows + [rows[7]], "page_id long, url string, html string")


def test_archives_return_what_was_written(spark, pages, tmp_path):
    table = warc.write_archives(pages, f"{tmp_path}/a", warc.Layout(archive_bytes=8000))
    made = table.collect()
    assert sum(m.records for m in made) == 201 and len(made) > 2
    left = tmp_path / "a" / "part-00000-999999-0000.warc.zst"  # as an attempt would leave it that was lost
    left.write_bytes(b"half")
    assert warc.archives_in(spark, f"{tmp_path}/a").count() == len(made) + 1
    html = {r.page_id: (r.html or "").encode() for r in pages.collect()}
    last = {}
    for i, h in html.items():
        last[h] = max(last.get(h, -1), i)
    read = warc.read_archives(table).collect()
    assert sorted(r.page_id for r in read) == sorted([*html, 7])
    for r in read:
        h = html[r.page_id]
        response = last[h] == r.page_id
        assert r.payload_digest == base64.b32encode(hashlib.sha1(h).digest()).decode() and r.payload_bytes == len(h)
        assert (r.record_type, r.refers_to) == (("response", None) if response else ("revisit", last[h]))
        assert (bytes(r.payload) if response else r.payload) == (h if response else None)
    import pathlib
    import struct

    left.unlink()
    for path in pathlib.Path(tmp_path, "a").glob("*.zst"):
        magic, size = struct.unpack("<II", path.read_bytes()[:8])
        assert magic == warc.SKIPPABLE and size > 0
    assert warc.read_archives(warc.archives_in(spark, f"{tmp_path}/a")).count() == 201


def test_a_dictionary_makes_records_smaller(spark):
    import zstandard

    records = [warc._record({"page_id": i, "url": f"http://h/{i}", "html": "<html><head><title>page</title></head><body>" + hashlib.md5(bytes([i])).hexdigest() * 20, "refers_to": None, "digest": "0d" * 20}, "d") for i in range(120)]
    d = warc._dictionary(records, warc.Layout())
    assert d
    with_it, without = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d)), zstandard.ZstdCompressor()
    assert sum(len(with_it.compress(r)) for r in records) < 0.8 * sum(len(without.compress(r)) for r in records)


def test_no_pages_and_null_ids(spark):
    schema = "page_id long, url string, html string"
    assert warc.archived(spark.createDataFrame([], schema)).collect() == []
    rows = [(None, None, "a"), (5, None, "a"), (3, None, "a"), (None, None, "b"), (None, None, "b"), (7, None, None), (8, None, ""), (8, None, "")]
    got = warc.archived(spark.createDataFrame(rows, schema)).collect()
    want = [(0, "response", 0), (0, "response", 0), (0, "revisit", 5), (3, "revisit", 5), (5, "response", 0), (7, "revisit", 8), (8, "response", 0), (8, "response", 0)]
    assert sorted((r.page_id or 0, r.record_type, r.refers_to or 0) for r in got) == want


@pytest.mark.parametrize("bodies", [["x"], ["x" * 50_000] + ["y"] * 3, [hashlib.sha512(bytes([i])).hexdigest() for i in range(40)], ["z" * (3 << 20)] + ["<p>page</p>" * 20] * 200])
def test_every_archive_has_a_dictionary(spark, tmp_path, bodies):
    import zstandard

    records = [warc._record({"page_id": i, "url": "", "html": h, "refers_to": None, "digest": hashlib.sha1(h.encode()).hexdigest()}, "d") for i, h in enumerate(bodies)]
    d = warc._dictionary(records, warc.Layout())
    assert 0 < len(d) <= warc.Layout.dictionary_bytes
    made = warc._archive(records, f"file://{tmp_path}/one.warc.zst", warc.Layout())
    got = warc.read_archives(spark.createDataFrame([(made["path"],)], "path string")).collect()
    assert [bytes(r.payload).decode() for r in sorted(got, key=lambda r: r.page_id)] == bodies


def _sketch(text, k=5, fraction=0.25):
    words = text.lower().split()
    out = set()
    for i in range(max(1, len(words) - k + 1)) if words else ():
        h = 42
        for w in words[i : i + k]:
            h = xxhash.xxh64_intdigest(w.encode(), h)
        h -= (h >> 63) << 64
        if h < -(1 << 63) + int(fraction * (1 << 64)):
            out.add(h)
    return out


def test_fingerprints_follow_their_definition(spark):
    texts = [(i, " ".join(f"w{(i * 7 + j * j) % 50}" for j in range(3 * i))) for i in range(60)] + [(99, None), (98, ""), (97, "Äö ß\ttab\nline " * 30), (96, "Äö ß\ttab\nline " * 30)]
    got = {r.doc_id: r for r in fingerprints.neighbour_fingerprints(docs(spark, texts)).collect()}
    order = sorted(((i, t or "") for i, t in texts), reverse=True)
    assert len(got) == len(texts)
    near = lambda a, b: 1.0 if a == b else (len(_sketch(a) & _sketch(b)) / len(u) if (u := _sketch(a) | _sketch(b)) else 0.0)
    for n, (i, t) in enumerate(order):
        nxt = order[(n + 1) % len(order)][1]
        third = len(t) // 3
        edited = t[: len(t) - third] + nxt[:third]
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == ",".join(f"{h & (2**64 - 1):016x}" for h in sorted(_sketch(t)))
        assert r.edited_fingerprint == ",".join(f"{h & (2**64 - 1):016x}" for h in sorted(_sketch(edited)))
        assert r.near_edited == pytest.approx(near(t, edited)) and r.near_next == pytest.approx(near(t, nxt))


def test_sketches_merge_and_tell_containment(spark):
    a, b = " ".join(f"a{i}" for i in range(2000)), " ".join(f"b{i}" for i in range(200))
    df = docs(spark, [(1, a), (2, b), (3, f"{a} {b}")])
    s = {r.doc_id: r.sketch for r in fingerprints.fingerprints(df).collect()}
    one = spark.createDataFrame([(s[1], s[2], s[3])], "a array<long>, b array<long>, c array<long>")
    r = one.select(fingerprints.containment(F.col("b"), F.col("c")).alias("x"), F.size(fingerprints.merge(F.col("a"), F.col("b"))).alias("n")).first()
    assert r.x == 1.0 and r.n == len(set(s[1]) | set(s[2]))


def test_few_rows_and_null_ids(spark):
    assert fingerprints.neighbour_fingerprints(docs(spark, [])).collect() == []
    one = fingerprints.neighbour_fingerprints(docs(spark, [(1, "a b c d e f")])).first()
    assert one.near_next == 1.0
    assert fingerprints.neighbour_fingerprints(docs(spark, [(None, "x"), (1, "y"), (1, "y")])).count() == 3
