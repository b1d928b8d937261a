"""Shared storage for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder in the storage that the driver and all executors share.

    That is what ``spark.checkpoint.dir`` names. Where it is unset a local master takes a folder of its
    warehouse; on a cluster that could be a disk that only the driver sees, so it is an error.
    """
    return f"{_base(spark)}/{uuid.uuid4().hex}"


def _base(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
    return base.rstrip("/")


def written(df: DataFrame) -> DataFrame:
    """Write to shared storage and read again: lineage is cut, and a lost executor loses nothing."""
    spark, schema, path = df.sparkSession, df.schema, shared_folder(df.sparkSession)
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete what ``written`` wrote, when nothing will read it again; other tables are left alone."""
    spark = table.sparkSession
    path_of, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    base = path_of(_base(spark))
    base = base.getFileSystem(conf).makeQualified(base)
    for folder in {f.rpartition("/")[0] for f in table.inputFiles()}:
        path = path_of(folder)
        if path.getParent().toString() == base.toString():
            path.getFileSystem(conf).delete(path, True)
