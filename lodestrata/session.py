"""Session settings and plan helpers."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def session(app: str = "lodestrata", master: str | None = None) -> SparkSession:
    """A session with adaptive execution, UTC and Arrow; partition counts are left to adaptive execution and the cluster's own settings."""
    builder = SparkSession.builder.appName(app).config("spark.sql.adaptive.enabled", "true").config("spark.sql.session.timeZone", "UTC").config("spark.sql.execution.arrow.pyspark.enabled", "true")
    return (builder.master(master) if master else builder).getOrCreate()


def folder(spark: SparkSession) -> str:
    """The application's folder within the one that driver and executors share (spark.checkpoint.dir).

    Where the setting is missing, a local session gets a folder of its own; on a cluster that is an error.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if context.master.partition("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = _own_folder(context.applicationId)
    return f"{base.rstrip('/')}/staged-{context.applicationId}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet to the shared folder and read again.

    For frames that several readers need and that cost much to make: columns are pruned and filters pushed down for each reader, and a lost executor loses nothing.
    """
    path = f"{folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@cache
def _own_folder(application: str) -> str:
    return "file://" + tempfile.mkdtemp(prefix="lodestrata-")


def filter_above(df: DataFrame, condition: Column) -> DataFrame:
    """df where condition holds, with the filter kept above df's projections.

    A filter on a computed column is otherwise pushed below the projection and computes every step of that column anew at each use.
    """
    columns = df.columns
    return df.withColumn("_above", F.spark_partition_id()).where(condition & (F.col("_above") >= 0)).select(*columns)
