"""Streams over a folder of poll drops, run until what is there is read."""

import json

from pyspark.sql import functions as F

from tidemark.streaming import articles


def drop(path, name, rows):
    path.mkdir(exist_ok=True, parents=True)
    (path / name).write_text("\n".join(json.dumps({"article_id": i, "feed": f, "published_at": at, "link": f"https://x.com/{i}"}) for i, f, at in rows))


def run(spark, df, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return spark.table(name).collect()


def test_articles_come_once(spark, tmp_path):
    drop(tmp_path / "in", "a.json", [("1", "f", "2024-01-01T10:00:00Z"), ("2", "f", "2024-01-01T11:00:00Z")])
    drop(tmp_path / "in", "b.json", [("2", "f", "2024-01-01T11:00:00Z"), ("3", "g", "2024-01-01T12:00:00Z")])
    got = run(spark, articles.new_articles(articles.stream_articles(spark, str(tmp_path / "in"), 1)), "once")
    assert sorted(r.article_id for r in got) == ["1", "2", "3"]


def titled(path, name, rows):
    path.mkdir(exist_ok=True, parents=True)
    (path / name).write_text("\n".join(json.dumps({"article_id": i, "published_at": at, "title": t, "description": d}) for i, at, t, d in rows))


def test_entities_are_resolved_and_counted_by_day(spark, tmp_path):
    entries = spark.createDataFrame(
        [("A", ["acme"], ["acme park"], None), ("B", ["bolt"], None, None), ("C", None, None, ["core"])], "ticker string, aliases array<string>, exclude array<string>, ambiguous_parents array<string>"
    )
    first = ("1", "2024-01-01T10:00:00Z", "acme and bolt", None)
    titled(tmp_path / "in", "a.json", [first, ("2", "2024-01-02T10:00:00Z", "a walk", "in acme park"), ("3", "2024-01-02T11:00:00Z", None, "core, bolt")])
    stream = articles.stream_articles(spark, str(tmp_path / "in"))

    def counts():
        batches = run_update(spark, articles.entity_counts(stream, entries), tmp_path, "counts")
        return sorted((str(r.day), r.ticker, r.n) for r in batches)

    assert counts() == [("2024-01-01", "A", 1), ("2024-01-01", "B", 1), ("2024-01-02", "B", 1)]
    titled(tmp_path / "in", "b.json", [first, ("4", "2024-01-09T10:00:00Z", "bolt", "bolt")])  # polled again: counts once
    assert counts() == [("2024-01-09", "B", 1)]
    titled(tmp_path / "in", "c.json", [("5", "2024-01-02T10:00:00Z", "bolt", None), ("6", "2024-01-09T11:00:00Z", "bolt", None)])  # 5 is late
    assert counts() == [("2024-01-09", "B", 2)]


def test_a_replayed_batch_leaves_the_same_counters(spark, tmp_path):
    drop(tmp_path / "in", "a.json", [("1", "f", "2020-01-01T10:00:00Z"), ("2", "f", "2024-01-01T11:00:00Z")])
    stream = articles.stream_articles(spark, str(tmp_path / "in")).withColumn("domain", F.lit("x.com"))

    def counters():
        q = articles.quality_counters(stream, str(tmp_path / "out"), "2024-01-01 12:00:00").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination(120)
        return [(r.epoch, r.n, r.too_old, r.in_future, r.foreign_host) for r in spark.read.parquet(str(tmp_path / "out")).orderBy("epoch").collect()]

    assert counters() == [(0, 2, 1, 0, 0)]
    for done in (tmp_path / "cp" / "commits").iterdir():  # as if the job was lost between writing and committing
        done.unlink()
    assert counters() == [(0, 2, 1, 0, 0)]
    drop(tmp_path / "in", "b.json", [("3", "f", "2024-01-01T11:30:00Z")])
    assert counters() == [(0, 2, 1, 0, 0), (1, 1, 0, 0, 0)]


def test_feed_progress_tells_lost_hours_and_silence(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")

    def progress(name, *rows):
        drop(tmp_path / "in", name, rows)
        got = run_update(spark, articles.feed_progress(articles.stream_articles(spark, str(tmp_path / "in"))), tmp_path, name)
        return sorted((r.feed, f"{r.newest:%d %H}", r.lost_hours, r.silent) for r in got)

    try:
        assert progress("a.json", ("1", "f", "2024-01-01T10:00:00Z"), ("2", "g", "2024-01-01T12:00:00Z")) == [("f", "01 10", 0.0, False), ("g", "01 12", 0.0, False)]
        assert progress("b.json", ("3", "f", "2024-01-01T13:00:00Z")) == [("f", "01 13", 3.0, False)]
        assert progress("c.json", ("4", "f", "2024-01-02T11:00:00Z"), ("5", "f", "2024-01-01T13:00:00Z")) == [("f", "02 11", 0.0, False)]
        assert progress("d.json", ("6", "f", "2024-01-02T13:00:00Z")) == [("f", "02 13", 2.0, False), ("g", "01 12", 0.0, True)]  # only f spoke
        assert progress("e.json", ("7", "g", "2024-01-02T14:00:00Z")) == [("g", "02 14", 26.0, False)]
        assert progress("f.json", ("8", "f", "2024-01-03T15:00:00Z")) == [("f", "03 15", 26.0, False), ("g", "02 14", 0.0, True)]
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def run_update(spark, df, tmp_path, name):
    held = []
    q = df.writeStream.foreachBatch(lambda b, _: held.extend(b.collect())).outputMode("update").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return held
