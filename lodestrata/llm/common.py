"""Helpers that several corpus operators share: staging in the shared folder, text defaults, connected components."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress
from functools import cache

import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The word separators of every operator here, as the inside of a character class (Java, Python and RE2 read it alike).
BLANKS = r"\x20\x09-\x0D"
#: Folders of the scopes that are open, outermost first.
_scopes: list[str] = []


def _remove(path) -> None:
    """Deletes a folder (a Hadoop path with its file system)."""
    where, system = path
    with suppress(Py4JError):  # at the end of the process the JVM may be gone already
        system.delete(where, True)


@cache
def _folder(application: str, base: str) -> str:
    """The application's own folder in the shared one; it goes when the driver's Python ends."""
    spark = SparkSession.active()
    folder = f"{base.rstrip('/')}/lodestrata-{application}"
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    atexit.register(_remove, (where, where.getFileSystem(spark._jsc.hadoopConfiguration())))
    return folder


@cache
def _own_dir(application: str) -> str:
    return "file://" + tempfile.mkdtemp(prefix="lodestrata-")


def shared_dir(spark: SparkSession) -> str:
    """The folder for staged tables, within the one that driver and executors share: spark.checkpoint.dir.

    Where that is unset, a local session (tests) gets a folder of its own; on a cluster it is an error, as no local folder would do.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and context.master.partition("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return _folder(context.applicationId, base or _own_dir(context.applicationId))


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it again: cuts the lineage, survives the loss of executors."""
    spark = df.sparkSession
    path = "/".join([shared_dir(spark), *_scopes, f"stage-{name}-{uuid.uuid4().hex}"])
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Tables staged in the body are deleted at its end; what is still needed must have been written elsewhere."""
    _scopes.append(f"scope-{uuid.uuid4().hex}")
    where = spark._jvm.org.apache.hadoop.fs.Path("/".join([shared_dir(spark), *_scopes]))
    try:
        yield
    finally:
        _scopes.pop()
        _remove((where, where.getFileSystem(spark._jsc.hadoopConfiguration())))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in parts of so many rows, so that few texts at a time are Python objects."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def connected_components(edges: DataFrame, rounds: int = 64) -> DataFrame:
    """(node, root) for every node of the undirected edges (a, b); root is the smallest node reachable.

    Alternating large-star and small-star contraction; each round is staged in the shared folder, and nothing but
    a count and a checksum comes to the driver. Self-loops and repeated edges are ignored; an empty frame gives an empty one.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    seen = None
    for i in range(rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.withColumnRenamed("m", "b"))
        edges = stage(small.distinct(), f"stars{i}")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
        if now == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        seen = now
    raise RuntimeError(f"no fixed point after {rounds} rounds")
