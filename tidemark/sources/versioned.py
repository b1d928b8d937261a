"""Append-only tables with revisions: partitions date=.../version=..., nothing is ever overwritten."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from tidemark.operators.storage import discard, written


def _read(spark: SparkSession, path: str, schema: T.StructType | None) -> DataFrame | None:
    try:
        df = spark.read.parquet(path) if schema is None else spark.read.schema(schema).parquet(path)
        df.schema  # noqa: B018  a path that isn't there shows here
        return df
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """All rows and versions under path, or None if nothing was ever written there."""
    return _read(spark, path, None)


def newest_versions(df: DataFrame, keys: Sequence[str] = ("date", "ticker")) -> DataFrame:
    """Of each key the row of the highest version, without it."""
    ranked = df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(F.col("version").cast("int")))))
    return ranked.where("_r = 1").drop("_r", "version")


def load_versioned(spark: SparkSession, path: str, keys: Sequence[str] = ("date", "ticker"), schema: T.StructType | None = None) -> DataFrame:
    """Every version of every date, of each key the row of the highest version. No folder gives no rows; a key that isn't a column is an error."""
    df = _read(spark, path, schema)
    if df is None:
        return spark.createDataFrame([], schema or T.StructType())
    if lost := [k for k in keys if k not in df.columns]:
        raise KeyError(lost[0])
    return newest_versions(df, keys)


def latest_version_per_session(df: DataFrame, session: str = "date", version: str = "version") -> DataFrame:
    """Rows of each session's highest version alone; what older versions had besides is gone."""
    top = df.groupBy(session).agg(F.max(F.col(version).cast("int")).alias(version))
    return df.join(top, [session, version], "left_semi")


def latest_stored_version(df: DataFrame, session: str = "date") -> DataFrame:
    return df.groupBy(session).agg(F.max(F.col("version").cast("int")).alias("version"))


def diff_revision(stored: DataFrame, fetched: DataFrame, keys: Sequence[str], session: str = "date", rtol: float = 1e-5, atol: float = 1e-8) -> DataFrame:
    """(session, state) per fetched session: new, same, revised, or shrunk (it lacks stored keys, so it is no revision).

    Values are compared without regard to type, doubles within tolerances; another set of columns revises.
    """
    values = [c for c in fetched.columns if c not in keys]
    same_columns = set(stored.columns) == set(fetched.columns)
    number = ("double", "float", "bigint", "int", "smallint", "tinyint")
    kinds = dict(fetched.dtypes)

    def equal(c: str):
        a, b = F.col(f"_s_{c}"), F.col(f"_f_{c}")
        if kinds[c] in number:
            a, b = a.cast("double"), b.cast("double")
            return F.coalesce(F.abs(a - b) <= atol + rtol * F.abs(b), a.isNull() & b.isNull())
        return a.cast("string").eqNullSafe(b.cast("string"))

    common = [c for c in values if c in stored.columns]
    s = stored.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in common], F.lit(True).alias("_in_s"))
    f = fetched.select(*keys, *[F.col(c).alias(f"_f_{c}") for c in common], F.lit(True).alias("_in_f"))
    both = s.join(f, list(keys), "full_outer")
    alike = F.lit(True)
    for c in common:
        alike = alike & equal(c)
    got = both.groupBy(session).agg(
        F.bool_or("_in_s").alias("had"), F.bool_or("_in_f").alias("has"), F.bool_or(F.col("_in_f").isNull()).alias("lost"),
        F.bool_or(F.col("_in_s").isNull()).alias("more"), F.bool_or(F.col("_in_s").isNotNull() & F.col("_in_f").isNotNull() & ~alike).alias("moved"),
    ).where("has")
    state = F.when(F.col("had").isNull(), "new").when(F.col("lost"), "shrunk").when(F.col("more") | F.col("moved") | F.lit(not same_columns), "revised").otherwise("same")
    return got.select(session, state.alias("state"))


def write_versioned(df: DataFrame, path: str, keys: Sequence[str] = ("date", "ticker"), session: str = "date") -> dict[str, int]:
    """Write what is new as version 1 and what is revised as the next one; counts of sessions by state."""
    spark = df.sparkSession
    held = _read(spark, path, None)
    if held is None:
        plan = df.select(session).distinct().select(session, F.lit("new").alias("state"), F.lit(1).alias("version"))
    else:
        held = held.withColumn(session, F.col(session).cast(df.schema[session].dataType))
        states = diff_revision(load_versioned(spark, path, keys).withColumn(session, F.col(session).cast(df.schema[session].dataType)), df, keys, session)
        plan = states.join(latest_stored_version(held, session), session, "left").select(session, "state", (F.coalesce("version", F.lit(0)) + 1).alias("version"))
    plan = written(plan)  # a row a session; Spark checks its size before it broadcasts
    counts = {r.state: r.n for r in plan.groupBy("state").agg(F.count("*").alias("n")).collect()}
    todo = df.join(plan.where("state IN ('new', 'revised')").drop("state"), session)
    todo.repartition(session).write.partitionBy(session, "version").mode("append").parquet(path)
    discard(plan)
    return counts


def backfill_write(df: DataFrame, path: str, session: str = "date", revise: bool = False) -> int:
    """Write sessions that aren't stored, or all as their next version; how many were written."""
    held = _read(df.sparkSession, path, None)
    days = df.select(session).distinct()
    if held is None:
        plan = days.withColumn("version", F.lit(1))
    else:
        latest = latest_stored_version(held.withColumn(session, F.col(session).cast(df.schema[session].dataType)), session)
        plan = days.join(latest, session, "left").select(session, (F.coalesce("version", F.lit(0)) + 1).alias("version"))
        plan = plan if revise else plan.where("version = 1")
    plan = written(plan)
    n = plan.count()
    df.join(plan, session).repartition(session).write.partitionBy(session, "version").mode("append").parquet(path)
    return n


def pending_sessions(calendar: DataFrame, stored: DataFrame, session: str = "date") -> DataFrame:
    """Sessions of the calendar with nothing stored."""
    return calendar.select("session_date").join(stored.select(F.col(session).cast("date").alias("session_date")).distinct(), "session_date", "left_anti")


def overlay_fill(canonical: DataFrame, preview: DataFrame, date: str = "date") -> DataFrame:
    """canonical, and preview rows of dates that it has nothing of."""
    return canonical.unionByName(preview.join(canonical.select(date).distinct(), date, "left_anti"), allowMissingColumns=True)


def vendor_disagreement(a: DataFrame, b: DataFrame, value: str = "close", most: float = 0.001, keys: Sequence[str] = ("date", "ticker")) -> DataFrame:
    """(keys, a, b, diff) where two vendors differ by more than the share, or the share is undefined."""
    both = a.select(*keys, F.col(value).alias("a")).join(b.select(*keys, F.col(value).alias("b")), list(keys))
    diff = F.try_divide(F.abs(F.col("b") - F.col("a")), F.col("a"))
    return both.withColumn("diff", diff).where(F.col("diff").isNull() | (F.col("diff") > most))
