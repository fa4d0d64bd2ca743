"""Tables that are replayed by batch: delete a batch, merge rows by key, cascade, reset, audit, vacuum.

Parquet has no row-level merge. A table is a folder of parts, one per batch, and of numbered versions; a version is a small JSON file that names
the part of every batch. A change rewrites only the parts that it touches and then creates the next version's file, which fails if another
writer was faster: the change is then made again on what that writer left. Readers of an older version are not disturbed until `vacuum`
deletes its parts, and a failed write leaves the table as it was.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from .. import schemas
from ..session import stage
from .clean import keep_last

_PART = "_part"
_NO_BATCH = "__HIVE_DEFAULT_PARTITION__"


def without_batch(table: DataFrame, batch_id: str) -> DataFrame:
    return table.where(~F.col("batch_id").eqNullSafe(F.lit(batch_id)))


def merge(table: DataFrame, rows: DataFrame, key: str = "listing_url") -> DataFrame:
    """table with rows put in by key: a row with a known key replaces the old one, whatever its batch; rows without a key are added."""
    kept = table.join(rows.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti").select(*table.columns)
    return kept.unionByName(rows.select(*table.columns))


def last_of_each(rows: DataFrame, key: str = "listing_url", order: str | None = None) -> DataFrame:
    """One row per key: the last in the given order, in that of an ordinal column, or in the order of reading."""
    order = order or ("ordinal" if "ordinal" in rows.columns else None)
    if order:
        return keep_last(rows, key, order)
    return keep_last(rows.withColumn("_read", F.monotonically_increasing_id()), key, "_read").drop("_read")


def replay(table: DataFrame, rows: DataFrame, batch_id: str, key: str = "listing_url", order: str | None = None) -> DataFrame:
    """Delete the batch, then merge its rows; of rows with one key the last counts."""
    return merge(without_batch(table, batch_id), last_of_each(rows, key, order), key)


def numbered(rows: DataFrame, name: str, start: int, order: list[str]) -> DataFrame:
    """rows with name = start + 1, start + 2, ... in an order: ranks within ranges plus the ranges' first ranks, so no task holds them all.

    The ranges are written down once: made anew for each reader, they would be cut elsewhere (by other samples, and by adaptive execution, which joins small ranges by their bytes), and rows would lose their numbers or share them.
    """
    ranged = rows.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()).withColumn("_n", F.row_number().over(W.Window.partitionBy("_p").orderBy(*order)))
    ranged = stage(ranged, "ranges")
    before = ranged.groupBy("_p").agg(F.count("*").alias("_c"))
    before = before.withColumn("_before", F.coalesce(F.sum("_c").over(W.Window.orderBy("_p").rowsBetween(W.Window.unboundedPreceding, -1)), F.lit(0))).drop("_c")  # one row a partition
    return ranged.join(F.broadcast(before), "_p").select((F.lit(start) + F.col("_before") + F.col("_n")).cast("long").alias(name), *rows.columns)


class Conflict(Exception):
    """Another writer made the next version first."""


@dataclass(frozen=True)
class Version:
    """A state of a table: the folder of every batch's part, the rows' schema, the largest id given."""

    number: int
    parts: dict[str, str]
    schema: T.StructType
    last_id: int = 0

    def text(self) -> str:
        return json.dumps({"parts": self.parts, "schema": self.schema.jsonValue(), "last_id": self.last_id}) + "\n"


@dataclass
class Tables:
    """Named tables under one folder that driver and executors share.

    known: schemas of tables that may not exist yet. children: tables whose rows go when a batch of their parent is deleted, by key.
    ids: tables with an id column that a key keeps for as long as it is there.
    """

    spark: SparkSession
    root: str
    known: dict[str, T.StructType] = field(default_factory=dict)
    children: dict[str, list[str]] = field(default_factory=dict)
    ids: dict[str, str] = field(default_factory=dict)
    attempts: int = 5

    # --- files, in any file system that Spark writes

    def _path(self, *parts: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, *parts: str) -> list[str]:
        path, system = self._path(*parts)
        return [f.getPath().getName() for f in system.listStatus(path)] if system.exists(path) else []

    def _create(self, text: str, *parts: str) -> None:
        path, system = self._path(*parts)
        try:
            out = system.create(path, False)  # fails if it is there
        except Py4JJavaError as error:
            if "AlreadyExists" in str(error.java_exception):
                raise Conflict("/".join(parts)) from error
            raise
        out.write(bytearray(text.encode()))
        out.close()

    def _text(self, *parts: str) -> str:
        path, system = self._path(*parts)
        stream = system.open(path)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    # --- versions

    def versions(self, name: str) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self._names(name, "versions") if n.endswith(".json") and not n.startswith("."))

    def version(self, name: str, number: int | None = None) -> Version | None:
        """A version, the last one unless its number is given; None where there is no table."""
        for n in [number] if number is not None else reversed(self.versions(name)):
            text = self._text(name, "versions", f"{n:012d}.json")
            if text.endswith("\n"):  # else its writer is still at it
                data = json.loads(text)
                return Version(n, data["parts"], T.StructType.fromJson(data["schema"]), data["last_id"])
        return None

    def exists(self, name: str) -> bool:
        return self.version(name) is not None

    def _now(self, name: str, schema: T.StructType | None = None) -> Version:
        found = self.version(name)
        schema = self.known.get(name, schema)
        if found is None and schema is None:
            raise ValueError(f"no table {name}")
        if found is None and name in self.ids and self.ids[name] not in schema.names:
            schema = T.StructType([T.StructField(self.ids[name], T.LongType()), *schema])
        return found or Version(-1, {}, schema)

    def _rows(self, version: Version, batches: list[str] | None = None) -> DataFrame:
        paths = [p for b, p in version.parts.items() if batches is None or b in batches]
        return self.spark.read.schema(version.schema).parquet(*paths) if paths else self.spark.createDataFrame([], version.schema)

    def read(self, name: str, number: int | None = None) -> DataFrame:
        return self._rows(self._now(name) if number is None else self.version(name, number))

    def _commit(self, name: str, before: Version, rows: DataFrame, replaced: list[str] | None, last_id: int | None = None) -> Version:
        """The next version: rows instead of the parts of the replaced batches (None: of all)."""
        folder = f"{self.root}/{name}/data/{uuid.uuid4().hex}"
        rows.withColumn(_PART, F.col("batch_id") if "batch_id" in rows.columns else F.lit("all")).write.partitionBy(_PART).parquet(folder)
        made = {unquote(n.partition("=")[2]): f"{folder}/{n}" for n in self._names(name, "data", folder.rpartition("/")[2]) if n.startswith(f"{_PART}=")}
        kept = {b: p for b, p in before.parts.items() if replaced is not None and b not in replaced}
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])
        after = Version(before.number + 1, kept | made, schema, before.last_id if last_id is None else last_id)
        self._create(after.text(), name, "versions", f"{after.number:012d}.json")
        return after

    def _again(self, change: Callable[[], Version]) -> Version:
        for i in range(self.attempts):
            try:
                return change()
            except Conflict:
                if i == self.attempts - 1:
                    raise
        raise AssertionError("unreachable")

    # --- changes

    def write(self, name: str, rows: DataFrame) -> DataFrame:
        """The table with these rows and no others."""
        return self._rows(self._again(lambda: self._commit(name, self._now(name, rows.schema), rows, None)))

    def upsert(self, name: str, rows: DataFrame, key: str = "listing_url", order: str | None = None, batch_id: str | None = None) -> Version:
        """Puts rows in by key, the last of each key; with batch_id that batch's old rows are deleted first. Only parts with a deleted row or a known key are rewritten."""
        wanted = [f.name for f in self._now(name, rows.schema).schema if f.name != self.ids.get(name)]
        new = stage(last_of_each(rows, key, order).select(*(c for c in wanted if c in rows.columns)), "upsert")  # read several times below

        def change() -> Version:
            before = self._now(name, new.schema)
            table = self._rows(before)
            keys = new.select(key).where(F.col(key).isNotNull())
            touched = {r[0] for r in table.join(keys, key, "left_semi").select("batch_id").distinct().collect()}  # names of batches
            touched = {_NO_BATCH if b is None else b for b in touched | ({batch_id} if batch_id else set())}
            incoming = {_NO_BATCH if r[0] is None else r[0] for r in new.select("batch_id").distinct().collect()}
            parts = sorted((touched | incoming) & set(before.parts))
            old = self._rows(before, parts)
            old = without_batch(old, batch_id) if batch_id else old
            put, last = (self._with_ids(name, before, old, new, key) if name in self.ids else (new, None))
            return self._commit(name, before, merge(old, put, key), parts, last)

        return self._again(change)

    def _with_ids(self, name: str, before: Version, old: DataFrame, new: DataFrame, key: str) -> tuple[DataFrame, int]:
        """new with ids: a key that is still there keeps its own, others get the next ones."""
        column = self.ids[name]
        known = new.join(old.select(key, column).where(F.col(key).isNotNull()), key, "left")
        fresh = numbered(known.where(F.col(column).isNull()).drop(column), column, before.last_id, [key])
        last = before.last_id + known.where(F.col(column).isNull()).count()
        out = known.where(F.col(column).isNotNull()).unionByName(fresh)
        return out.select(column, *new.columns), last

    def replay(self, name: str, rows: DataFrame, batch_id: str, order: str | None = None, key: str = "listing_url") -> int:
        """Replays a batch: its old rows go, with their rows in the table's children; its new rows are merged by key. The number of rows of the batch that the table then has."""
        if self.exists(name):
            gone = self.read(name).where(F.col("batch_id") == batch_id).select(key)
            for child in self.children.get(name, []):
                self.delete_keys(child, gone, key)
        after = self.upsert(name, rows, key, order, batch_id)
        return self._rows(after, [batch_id]).count()

    def delete_keys(self, name: str, keys: DataFrame, key: str = "listing_url") -> None:
        """Deletes the rows with these keys; parts without any stay as they are."""
        if not self.exists(name):
            return

        def change() -> Version:
            before = self._now(name)
            hit = self._rows(before).join(keys.where(F.col(key).isNotNull()), key, "left_semi").select("batch_id").distinct().collect()  # names of batches
            parts = sorted(_NO_BATCH if r[0] is None else r[0] for r in hit)
            if not parts:
                return before
            return self._commit(name, before, self._rows(before, parts).join(keys, key, "left_anti").select(*before.schema.names), parts)

        self._again(change)

    def reset(self, names: list[str]) -> dict[str, int]:
        """Empties the tables and starts their ids anew; the rows that they had."""
        out = {}
        for name in names:
            if self.exists(name):
                df = self.read(name)
                out[name] = df.count()
                self._again(lambda name=name, df=df: self._commit(name, self._now(name), df.limit(0), None, 0))
            else:
                out[name] = 0
        return out

    def vacuum(self, name: str, keep: int = 1) -> int:
        """Deletes what only versions before the last `keep` name; the number of folders deleted. No writer may be at work on the table."""
        numbers = self.versions(name)
        live = {p.split("/data/")[1].split("/")[0] for n in numbers[-keep:] for p in self.version(name, n).parts.values()}
        dead = [d for d in self._names(name, "data") if d not in live]
        for parts in ([name, "versions", f"{n:012d}.json"] for n in numbers[:-keep]):
            path, system = self._path(*parts)
            system.delete(path, False)
        for d in dead:
            path, system = self._path(name, "data", d)
            system.delete(path, True)
        return len(dead)

    def audit(self, expected: dict[str, list[str]]) -> tuple[list[str], dict[str, list[str]], dict[str, int]]:
        """(tables missing, columns missing by table, row counts)."""
        missing = [n for n in expected if not self.exists(n)]
        there = {n: self.read(n) for n in expected if n not in missing}
        lacking = {n: sorted(set(expected[n]) - set(df.columns)) for n, df in there.items()}
        return missing, {n: c for n, c in lacking.items() if c}, {n: df.count() for n, df in there.items()}


def evolve(df: DataFrame, wanted: T.StructType, renamed: dict[str, str] | None = None) -> DataFrame:
    """An older table in today's columns: old names renamed, missing columns null, others dropped."""
    df = df.withColumnsRenamed({old: new for old, new in (renamed or {}).items() if old in df.columns and new not in df.columns})
    return df.select(*((F.col(f.name) if f.name in df.columns else F.lit(None)).try_cast(f.dataType).alias(f.name) for f in wanted))


def listing_tables(spark: SparkSession, root: str) -> Tables:
    """The tables of the listing engine: clean listings with ids and their features, which go with them; the fact with ids."""
    known = {"clean_listings": schemas.CORE_SCHEMA, "clean_listing_features": schemas.FEATURE_SCHEMA}
    return Tables(spark, root, known, {"clean_listings": ["clean_listing_features"]}, {"clean_listings": "listing_id", "fact_listing": "listing_fact_id"})


EXPECTED = {"clean_listings": list(schemas.CORE), "clean_listing_features": list(schemas.FEATURES), "fact_listing": list(schemas.FACT_COLUMNS), "ml_property_features": list(schemas.ML_COLUMNS)}
