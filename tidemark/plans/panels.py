"""The driver's tables read as the library's: panels, calendars, series, articles, attempts, labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

#: DuckDB's form of the same tables, to stand before a query.
SQL = {
    "panel": """
panel AS (
  SELECT CAST(l_shipdate AS DATE) AS date, l_suppkey AS ticker, CAST(ANY_VALUE(s_nationkey) AS VARCHAR) AS sector,
    (MIN(l_extendedprice / l_quantity) + MAX(l_extendedprice / l_quantity)) / 2 AS open,
    CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS close,
    CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS volume,
    CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS trading_value,
    CAST(SUM(CASE l_returnflag WHEN 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) WHEN 'A' THEN -CAST(l_extendedprice AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END) AS DOUBLE) AS foreign_net,
    CAST(SUM(CASE l_returnflag WHEN 'A' THEN CAST(l_extendedprice AS DECIMAL(18,2)) WHEN 'N' THEN -CAST(l_extendedprice AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END) AS DOUBLE) AS inst_net,
    CAST(SUM(CASE l_returnflag WHEN 'N' THEN CAST(l_extendedprice AS DECIMAL(18,2)) WHEN 'R' THEN -CAST(l_extendedprice AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END) AS DOUBLE) AS retail_net,
    CAST(SUM(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END) AS DOUBLE) AS short_balance,
    CAST(l_shipdate AS DATE) + INTERVAL 390 MINUTE AS known_at_utc
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY CAST(l_shipdate AS DATE), l_suppkey
)""",
    "sessions": """
sessions AS (
  SELECT session_date, lead(session_date) OVER (ORDER BY session_date) AS next_date, lag(session_date) OVER (ORDER BY session_date) AS previous_date,
    session_date + INTERVAL 9 HOUR AS open_utc, session_date + INTERVAL 930 MINUTE AS close_utc
  FROM (SELECT DISTINCT date AS session_date FROM panel)
)""",
    "series": """
series AS (
  SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS series,
    CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS value
  FROM orders GROUP BY CAST(o_orderdate AS DATE), o_orderpriority
)""",
    "articles": """
articles AS (
  SELECT CAST(event_id AS VARCHAR) AS article_id, event_id AS seq, event_type AS feed, user_id AS ticker, ts AS published_at, value AS score,
    'https://' || event_type || '.example.com/' || event_id AS link, event_type || '.example.com' AS domain, 'headline ' || event_id AS title
  FROM events
)""",
    "attempts": """
attempts AS (
  SELECT event_type AS model, user_id AS example, CAST(row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts, event_id) - 1 AS INT) AS repeat,
    value AS polarity, CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100 AS relevance, event_id % 13 <> 0 AS ok,
    CASE WHEN event_id % 26 = 0 THEN 'transport' WHEN event_id % 13 = 0 THEN 'schema' END AS failure,
    CAST(CAST(value AS DECIMAL(18,4)) AS DOUBLE) AS cost_usd, CAST(event_id % 17 AS DOUBLE) AS latency_s, ts AS run_at
  FROM events
)""",
    "titles": """
titles AS (
  SELECT doc_id AS article_id, source AS ticker, split_part(text, chr(10), 1) AS title, length(text) AS length FROM documents
)""",
}


def sql(*names: str) -> str:
    return "WITH " + ",".join(SQL[n] for n in names)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hundredths(c: str) -> Column:
    """A double as whole hundredths, as decimals of two places round it; what is that already doesn't take the slow way over decimals."""
    x, n = F.col(c), F.rint(F.col(c) * 100)
    return F.when((F.abs(x) < 1e13) & (n / 100 == x), n.cast("long")).otherwise((x.cast("decimal(18,2)") * 100).cast("long"))


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily rows per supplier. Money is rounded to hundredths and summed as whole ones, so partitions don't change results.

    Lines are dealt by supplier before they are summed: a supplier's day has hardly more than one, and the windows
    over a supplier then need no further shuffle. Sums beyond a long's 9.2e18 hundredths a day are an error.
    """
    lines = table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("date"), F.col("l_suppkey").alias("ticker"), "l_extendedprice", "l_quantity", "l_returnflag").repartition("ticker")
    lines = lines.select("date", "ticker", (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit"), hundredths("l_extendedprice").alias("money"), hundredths("l_quantity").alias("qty"), F.col("l_returnflag").alias("flag"))
    total = lambda c: F.sum(c) / F.lit(100.0)
    net = lambda plus, minus: total(F.when(F.col("flag") == plus, F.col("money")).when(F.col("flag") == minus, -F.col("money")).otherwise(0))
    daily = lines.groupBy("date", "ticker").agg(
        ((F.min("unit") + F.max("unit")) / 2).alias("open"), (total("money") / total("qty")).alias("close"),
        total("qty").alias("volume"), total("money").alias("trading_value"),
        net("R", "A").alias("foreign_net"), net("A", "N").alias("inst_net"), net("N", "R").alias("retail_net"),
        total(F.when(F.col("flag") == "R", F.col("qty")).otherwise(0)).alias("short_balance"),
    )
    sectors = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("ticker"), F.col("s_nationkey").cast("string").alias("sector"))
    return daily.join(sectors, "ticker").withColumns({
        "shares_outstanding": F.col("volume"), "pbr": F.col("close"), "other_net": F.lit(0.0), "known_at_utc": F.col("date").cast("timestamp") + F.expr("interval 390 minutes"),
    })


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("date"), F.col("o_orderpriority").alias("series")).agg(
        (F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double") / F.count("*")).alias("value")
    )


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("article_id"), F.col("event_id").alias("seq"), F.col("event_type").alias("feed"), F.col("user_id").alias("ticker"), F.col("ts").alias("published_at"), F.col("value").alias("score"),
        F.concat(F.lit("https://"), "event_type", F.lit(".example.com/"), "event_id").alias("link"), F.concat("event_type", F.lit(".example.com")).alias("domain"), F.concat(F.lit("headline "), "event_id").alias("title"),
    )


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, i = table(spark, sf_dir, "events"), F.col("event_id")
    return e.select(
        F.col("event_type").alias("model"), F.col("user_id").alias("example"), (F.row_number().over(Window.partitionBy("event_type", "user_id").orderBy("ts", "event_id")) - 1).alias("repeat"),
        F.col("value").alias("polarity"), (F.get_json_object("props", "$.k").cast("double") / 100).alias("relevance"), (i % 13 != 0).alias("ok"),
        F.when(i % 26 == 0, "transport").when(i % 13 == 0, "schema").alias("failure"), F.col("value").cast("decimal(18,4)").cast("double").alias("cost_usd"), (i % 17).cast("double").alias("latency_s"), F.col("ts").alias("run_at"),
    )


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("article_id"), F.col("source").alias("ticker"), F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"), F.char_length("text").cast("long").alias("length"))
