"""Exact dedup (DataFrame functions only): group by a 128-bit content hash, compare the bytes inside the groups.

The grouping key is the hash together with the normalised bytes, so two texts fall into one class only if their bytes are equal;
partial aggregation folds copies before the shuffle, so that a group with a third of all rows arrives as one row per task. The
classes are joined back to the rows by hash; where one hash has several classes (a collision), by the bytes as well.

Defined cases: a null text counts as empty, and all blank texts are one class; of one class the row with the most code points in
its original text stays, then the smallest doc_id (a null doc_id counts as larger than any other); of repeated rows with the keeper's doc_id and length, or of the longest rows
of a class without ids, exactly one carries kept = true (the result has no column that tells them apart); an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

_TOP = 2**63 - 1
_SPAN = f"cast({2**64} as decimal(20,0))"


def normalised(text: Column) -> Column:
    """The text without blanks."""
    return F.translate(text, "\x20\x09\x0a\x0b\x0c\x0d", "")


def content_hash(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def classes(docs: DataFrame, hash_of=content_hash) -> DataFrame:
    """One row per distinct normalised text: h, body, group_size, most (code points), keep_id."""
    text = common.text_or_empty()
    body = normalised(text)
    # most code points first, then the smallest id, as one number: it has a fixed width, so that the aggregate stays a hash aggregate
    order = F.length(text).cast("decimal(11,0)") * F.expr(_SPAN) + (F.lit(_TOP).cast("decimal(20,0)") - F.coalesce(F.col("doc_id"), F.lit(_TOP)).cast("decimal(20,0)"))
    packed = docs.select(hash_of(body).alias("h"), body.alias("body"), order.cast("decimal(38,0)").alias("o"))
    out = packed.groupBy("h", "body").agg(F.count("*").alias("group_size"), F.max("o").alias("o"))
    return out.select("h", "body", "group_size", F.expr(f"cast(o div {_SPAN} as bigint)").alias("most"), F.expr(f"cast(cast({_TOP} as decimal(20,0)) - o % {_SPAN} as bigint)").alias("keep_id"))


def dedup(docs: DataFrame, hash_of=content_hash) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row."""
    text = common.text_or_empty()
    body = normalised(text)
    small = common.stage(classes(docs, hash_of).select("h", F.sha2(F.col("body").cast("binary"), 256).alias("text_sha256"), "group_size", "most", "keep_id"), "classes")
    rows = docs.select("doc_id", hash_of(body).alias("h"), F.length(text).cast("long").alias("points"), F.sha2(body.cast("binary"), 256).alias("text_sha256"))
    clash = small.groupBy("h").count().where("count > 1")
    if clash.limit(1).count():  # one hash, several texts: these rows are joined by their bytes
        whole = classes(docs, hash_of).join(clash.select("h"), "h", "left_semi")
        hit = docs.select("doc_id", hash_of(body).alias("h"), body.alias("body"), F.length(text).cast("long").alias("points")).join(whole, ["h", "body"])
        hit = hit.withColumn("text_sha256", F.sha2(F.col("body").cast("binary"), 256)).drop("body")
        rest = rows.join(clash, "h", "left_anti").join(small.drop("text_sha256"), "h")
        joined = rest.drop("count").unionByName(hit)
    else:
        joined = rows.join(small.drop("text_sha256"), "h")
    kept = F.coalesce(F.col("doc_id"), F.lit(_TOP)).eqNullSafe(F.col("keep_id")) & (F.col("points") == F.col("most"))
    out = joined.select("doc_id", F.when(F.col("keep_id") < _TOP, F.col("keep_id")).alias("keep_id"), "group_size", kept.alias("kept"), "text_sha256")
    out = common.stage(out.withColumn("row", F.monotonically_increasing_id()), "rows")
    # a class has one keeper: where several rows are alike, the one with the smallest number
    ties = out.where("kept").groupBy("text_sha256").agg(F.count("*").alias("n"), F.min("row").alias("one")).where("n > 1").select("text_sha256", "one")
    out = out.join(common.stage(ties, "ties"), "text_sha256", "left")
    return out.select("doc_id", "keep_id", "group_size", (F.col("kept") & (F.col("row") == F.coalesce("one", "row"))).alias("kept"), "text_sha256")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(common.read_documents(spark, sf_dir))


QUERIES = {"op5_exact_dedup": op5_exact_dedup}
ORACLES = {
    "op5_exact_dedup": r"""
        with n as (select doc_id, coalesce(text, '') as t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as body from documents)
        select doc_id, first_value(doc_id) over w as keep_id, count(*) over (partition by body) as group_size,
               doc_id = first_value(doc_id) over w as kept, sha256(body) as text_sha256
        from n window w as (partition by body order by length(t) desc, doc_id)"""
}
