"""Article feeds: items of polled XML, JSON lines by day, a ledger of runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

NEWS = (
    "article_id string, feed string, outlet string, title string, link string, description string, "
    "published_at timestamp, collected_at_utc timestamp, known_at_utc timestamp"
)
LEDGER = "run_at timestamp, rows long"
_ITEMS = "channel struct<item: array<struct<title: string, link: string, guid: string, description: string, pubDate: string>>>"


def article_id(guid: Column, link: Column) -> Column:
    """First 20 hexadecimal digits of the SHA-256 of the trimmed guid, or of the link."""
    return F.substring(F.sha2(F.trim(F.coalesce(F.nullif(guid, F.lit("")), link)), 256), 1, 20)


def parse_pubdate(raw: Column, zone: Column | None = None) -> Column:
    """RFC-822 dates with +0900, +09:00 or GMT; without an offset only where a zone is declared, else NULL."""
    text = F.regexp_replace(F.trim(F.regexp_replace(raw, "^\\s*[A-Za-z]{3,9},\\s*", "")), "(GMT|UTC|Z)$", "+0000")
    text = F.when(F.rlike(text, F.lit("^\\d \\w")), F.concat(F.lit("0"), text)).otherwise(text)
    aware = F.coalesce(F.try_to_timestamp(text, F.lit("dd MMM yyyy HH:mm:ss Z")), F.try_to_timestamp(text, F.lit("dd MMM yyyy HH:mm:ss XXX")), F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")))
    if zone is None:
        return aware
    naive = F.coalesce(F.try_to_timestamp(text, F.lit("dd MMM yyyy HH:mm:ss")), F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")))
    return F.coalesce(aware, F.to_utc_timestamp(naive, F.coalesce(zone, F.lit("UTC"))))


def parse_rss_items(polls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(items, errors) from (feed, outlet, zone, xml, collected_at_utc).

    Items without a link or a readable date are dropped; a feed that has items but none readable is an error row.
    """
    parsed = polls.withColumn("item", F.explode(F.from_xml("xml", _ITEMS, {"mode": "PERMISSIVE"})["channel"]["item"]))
    rows = parsed.select(
        article_id(F.col("item.guid"), F.col("item.link")).alias("article_id"), "feed", "outlet", F.trim("item.title").alias("title"), F.trim("item.link").alias("link"),
        F.col("item.description").alias("description"), F.when(F.col("zone").isNotNull(), parse_pubdate(F.col("item.pubDate"), F.col("zone"))).otherwise(parse_pubdate(F.col("item.pubDate"))).alias("published_at"), "collected_at_utc",
    )
    good = rows.where("published_at IS NOT NULL AND coalesce(link, '') <> ''")
    errors = rows.groupBy("feed").agg(F.count("*").alias("items"), F.count_if((F.col("published_at").isNotNull()) & (F.coalesce("link", F.lit("")) != "")).alias("good")).where("good = 0").select("feed", F.concat(F.col("items"), F.lit(" items, none readable")).alias("detail"))
    return good, errors


def scan_news(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines, gzip or plain, of all day folders under path; blank lines are skipped."""
    return spark.read.schema(NEWS).option("recursiveFileLookup", "true").json(path).where("article_id IS NOT NULL")


def write_news_run(df: DataFrame, root: str, run_at: str) -> None:
    """Append a run's articles by day, and its ledger row even if it has none."""
    spark = df.sparkSession
    n = df.count()
    if n:
        df.withColumn("day", F.lit(run_at[:10])).write.partitionBy("day").mode("append").option("compression", "gzip").json(f"{root}/articles")
    spark.createDataFrame([(n,)], "rows long").select(F.lit(run_at).cast("timestamp").alias("run_at"), "rows").write.mode("append").parquet(f"{root}/ledger")


def seen_ids(articles: DataFrame, day: str, lookback: int = 1, at: str = "collected_at_utc") -> DataFrame:
    """Ids stored on a day or just before."""
    d = F.lit(day).cast("date")
    return articles.where(F.to_date(at).between(F.date_sub(d, lookback), d)).select("article_id").distinct()


def newest_per_feed(articles: DataFrame, day: str, lookback: int = 1, at: str = "collected_at_utc") -> DataFrame:
    d = F.lit(day).cast("date")
    return articles.where(F.to_date(at).between(F.date_sub(d, lookback), d)).groupBy("feed").agg(F.max("published_at").alias("newest"))


def last_run_at(ledger: DataFrame, day: str, lookback: int = 1) -> DataFrame:
    d = F.lit(day).cast("date")
    return ledger.where(F.to_date("run_at").between(F.date_sub(d, lookback), d)).agg(F.max("run_at").alias("run_at"))


def new_rows_only(fetched: DataFrame, stored: DataFrame, key: str = "article_id", order: str = "published_at") -> DataFrame:
    """First of each id that isn't stored."""
    first = fetched.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(order))).where("_r = 1").drop("_r")
    return first.join(stored.select(key), key, "left_anti")


def keep_first(df: DataFrame, keys: list[str], order: list[Column | str], last: bool = False) -> DataFrame:
    """First (or last) row of each key in a stated order."""
    by = [F.desc(o) if last else F.asc(o) for o in order]
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*by))).where("_r = 1").drop("_r")


#: The header lines of report files, and their names.
REPORT_NAME = r"^(\d{4}-\d{2}-\d{2})(?:-(morning|evening))?\.md$"
AMBIGUOUS_LINE = r"(?m)^ℹ 엔티티 모호 비율: ([\d.]+)% \(기사 ([\d,]+)건\)"
FAILURE_LINE = r"(?m)^⚠ 수집 실패: (.+)$"
VENDOR_LINE = r"(?m)^⚠ 미국 시세 벤더 불일치: (.+)$"
NEWS_GAP_LINE = r"(?m)^⚠ 뉴스 유실: (.+)$"
CHECK_ITEM = r"^([a-z_]+)/([a-zA-Z_]+)(?:×(\d+))?$"
CONFIRMED_CHECKS = ("schema", "flow_identity")
AMBIGUOUS_CHECKS = ("structural_invariants", "coverage")


def parse_report_headers(texts: DataFrame) -> DataFrame:
    """(name, date, run, ambiguous_pct, articles, failures, vendor_disagreement, news_gap) of report files (name, text).

    The share is of 1; failures are the parts of all failure lines, each as is. A file of another name is no
    report. run is morning, evening or single.
    """
    found = lambda pattern, i=1: F.nullif(F.regexp_extract("text", pattern, i), F.lit(""))
    run = F.regexp_extract("name", REPORT_NAME, 2)
    failed = F.flatten(F.transform(F.regexp_extract_all("text", F.lit(FAILURE_LINE), 1), lambda line: F.split(line, ", ")))
    return texts.where(F.rlike("name", F.lit(REPORT_NAME))).select(
        "name", F.regexp_extract("name", REPORT_NAME, 1).cast("date").alias("date"), F.when(run == "", "single").otherwise(run).alias("run"),
        (found(AMBIGUOUS_LINE).cast("double") / 100).alias("ambiguous_pct"), F.replace(found(AMBIGUOUS_LINE, 2), F.lit(",")).cast("long").alias("articles"),
        failed.alias("failures"), F.rlike("text", F.lit(VENDOR_LINE)).alias("vendor_disagreement"), found(NEWS_GAP_LINE).alias("news_gap"),
    )


def failure_items(reports: DataFrame) -> DataFrame:
    """(name, raw, collector, check, count, classification) of each failure that a report names.

    Parts that aren't a collector's check are unparsed; of checks, some are confirmed errors of the data,
    some can't be told from a header (ambiguous), and the others are excluded.
    """
    part = reports.select("name", F.explode("failures").alias("raw"))
    is_check = F.rlike("raw", F.lit(CHECK_ITEM))
    of = lambda i: F.when(is_check, F.regexp_extract("raw", CHECK_ITEM, i))
    got = part.select("name", "raw", of(1).alias("collector"), of(2).alias("check"), F.coalesce(F.nullif(of(3), F.lit("")).cast("long"), F.lit(1)).alias("count"))
    kind = F.when(F.col("check").isNull(), "unparsed").when(F.col("check").isin(*CONFIRMED_CHECKS), "confirmed").when(F.col("check").isin(*AMBIGUOUS_CHECKS), "ambiguous").otherwise("excluded")
    return got.withColumn("classification", kind)


def ambiguous_means(reports: DataFrame) -> DataFrame:
    """(simple, weighted, evening, n) of the ambiguous shares: of reports, of articles, of evening and single runs."""
    held, articles = reports.where("ambiguous_pct IS NOT NULL"), F.coalesce("articles", F.lit(0))
    return held.agg(
        F.avg("ambiguous_pct").alias("simple"), F.try_divide(F.sum(F.col("ambiguous_pct") * articles), F.sum(articles).cast("double")).alias("weighted"),
        F.avg(F.when(F.col("run").isin("evening", "single"), F.col("ambiguous_pct"))).alias("evening"), F.count("*").alias("n"),
    )


def reports_for_session(reports: DataFrame) -> DataFrame:
    """reports (date, run): each date's morning and evening ones, else its single one."""
    parted = F.max(F.col("run").isin("morning", "evening")).over(Window.partitionBy("date"))
    return reports.withColumn("_parted", parted).where((F.col("run") != "single") | ~F.col("_parted")).drop("_parted")


def runs_per_session(calendar: DataFrame, runs: DataFrame, at: str) -> DataFrame:
    """(session_date, runs) of each session of the calendar, 0 where nothing ran."""
    ran = runs.groupBy(F.to_date(at).alias("session_date")).agg(F.count("*").alias("runs"))
    return calendar.select("session_date").distinct().join(ran, "session_date", "left").fillna({"runs": 0})


def article_text(title: Column, description: Column) -> Column:
    """Title and description with a space between, trimmed; what is missing is empty."""
    return F.trim(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(description, F.lit(""))))


def clip_text(text: Column, most: int = 400) -> Column:
    return F.substring(text, 1, most)


def news_score_rollup(rows: DataFrame, *groups: str) -> DataFrame:
    """(groups, n, polarity, headline) of rows (polarity, relevance, intensity, title, seq).

    The mean polarity is weighted by relevance, NULL without any; the headline is of the most intense article.
    """
    weighted = F.try_divide(F.sum(F.col("polarity") * F.col("relevance")), F.sum("relevance").cast("double"))
    return rows.groupBy(*groups).agg(F.count("*").alias("n"), weighted.alias("polarity"), F.max_by("title", F.struct("intensity", "seq")).alias("headline"))


def buffer_oldest(buffer: DataFrame) -> DataFrame:
    """(feed, oldest) of what each feed still offers."""
    return buffer.groupBy("feed").agg(F.min("published_at").alias("oldest"))
