"""Derives the language references of the quality rules, and the bound on the common words, from documents that are labelled as good.

`python -m lodestrata.llm.references <folder of tables>` prints both tables and the bound as they stand in `quality_rules`. Learnt from are labelled
rows with quality 1 whose crc32(doc_id as text) modulo 3 is not 1; each language's histogram adds up all of its documents. The bound is measured
against the tables in `quality_rules`, so after new tables the command runs again. Defined cases: null texts add nothing; documents without a
language are left out; ties among words go to the smaller word; without labels both tables are empty and the bound is None.
"""

from __future__ import annotations

import math
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from . import neighbours, quality_rules

COMMON = 18
#: Share of the good documents that pass the base rules which the bound lets pass.
PASSING = 0.998


def learnable(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents with a language that are labelled as good and may be learnt from."""
    good = labels.where("quality = 1").where(~neighbours.held_out(F.col("doc_id"))).select("doc_id").distinct()
    return docs.join(good, "doc_id", "left_semi").where("lang is not null")


def derive(docs: DataFrame, labels: DataFrame, common: int = COMMON) -> tuple[dict[str, tuple[float, ...]], dict[str, dict[str, int]]]:
    """Shares of character classes, and the common words with their shares in per mille, by language."""
    rows = quality_rules.measured(learnable(docs, labels))
    sums = rows.groupBy("_lang").agg(*(F.sum(c).alias(f"c{i}") for i, c in enumerate(quality_rules.class_counts())), F.sum("_n0").alias("n"), F.sum("_n_plain").alias("words"))
    classes, total = {}, {}
    for r in sums.orderBy("_lang").collect():  # one row a language
        classes[r._lang] = tuple(round(r[f"c{i}"] / r.n, 5) for i in range(7))
        total[r._lang] = r.words
    count = rows.select("_lang", F.explode("_plain").alias("word")).groupBy("_lang", "word").agg(F.count("*").alias("n"))
    rank = F.row_number().over(W.Window.partitionBy("_lang").orderBy(F.col("n").desc(), "word"))
    words: dict[str, dict[str, int]] = {k: {} for k in classes}
    for r in count.withColumn("rank", rank).where(F.col("rank") <= common).orderBy("_lang", "rank").collect():  # so many rows a language
        words[r._lang][r.word] = round(1000 * r.n / total[r._lang])
    return classes, words


def bound(docs: DataFrame, labels: DataFrame, passing: float = PASSING) -> float | None:
    """The least hundredth within which the common words of such a share of the good documents lie."""
    at = quality_rules.judge(learnable(docs, labels)).where("not base_failed").select(F.percentile("common_js", passing)).first()[0]
    return None if at is None else math.ceil(100 * at) / 100


def main(folder: str) -> None:
    spark = SparkSession.builder.getOrCreate()
    read = lambda t: spark.read.parquet(f"{folder}/{t}.parquet")
    for table in derive(read("documents"), read("labels")):
        for k, v in table.items():
            print(f"    {k!r}: {v!r},".replace("'", '"'))
    print("COMMON_DISTANCE", bound(read("documents"), read("labels")))


if __name__ == "__main__":
    main(sys.argv[1])
