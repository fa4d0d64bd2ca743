"""Quality classifier by nearest-neighbour voting in a latent-semantic space.

A document becomes a vector of hashed byte trigrams (log counts, inverse document frequency, unit length) and of the share of its words
that repeat the word before, scaled. At most `labelled` rows with a
label, the first by a hash of their doc_id, are the sample: over their matrix a randomised truncated SVD gives the latent space. The
space and the sample's vectors have a fixed largest size (buckets x rank and labelled x rank numbers) and are broadcast. Each
document is projected, its cosines with all labelled vectors are computed exactly, in blocks, and the labels of its k nearest vote, weighted by a
power of the similarity; a small prior keeps the score defined.

Labels, language, source and doc_id are no inputs of a score: doc_id only decides which rows may be learnt from (crc32 of its text
modulo 3 is not 1). Defined cases: a null text counts as empty, and a text of under three bytes gets the prior, the share of label 1 in the sample
(0.5 without any labels); very long texts are counted in pieces; repeated labels of one doc_id count once, with the largest label; of several texts with one doc_id the one with the least hash is learnt from; null labels
and null doc_ids are not learnt from; documents with a null doc_id are not held out; ties among neighbours go to the smaller row of the
sample; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

LABELLED = 4096
BUCKETS = 4096
RANK = 64
NEIGHBOURS = 15
POWER = 4.0
PRIOR = 0.05
REPEAT = 2.0
BLOCK = 256
_PIECE = 1 << 22


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def counted(text: str) -> np.ndarray:
    """Counts of the text's byte trigrams in hashed buckets and, last, the repeating words in a thousand."""
    data = text.encode("utf-8", "surrogatepass")
    raw = np.frombuffer(data, np.uint8)
    out = np.zeros(BUCKETS + 1, np.int64)
    for i in range(0, max(len(raw) - 2, 0), _PIECE):
        b = raw[i : i + _PIECE + 2].astype(np.uint32)
        code = (b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(2654435761)
        out[:-1] += np.bincount((code >> np.uint32(16)) % np.uint32(BUCKETS), minlength=BUCKETS)
    words = data.split()
    if len(words) > 1:
        out[-1] = 1000 * sum(map(eq, words, words[1:])) // (len(words) - 1)
    return out


def nearest(cosine: np.ndarray, k: int) -> np.ndarray:
    """The columns of the k largest values of each row, ascending; of equal values the smaller columns."""
    if k == cosine.shape[1]:
        return np.broadcast_to(np.arange(k), cosine.shape)
    least = np.partition(cosine, cosine.shape[1] - k, axis=1)[:, -k, None]
    pick = cosine > least
    room = k - pick.sum(1)
    tied = cosine == least
    row, column = np.nonzero(tied)  # at least one a row
    place = np.arange(len(row)) - np.searchsorted(row, np.arange(len(cosine)))[row]
    own = place < room[row]
    pick[row[own], column[own]] = True
    return np.nonzero(pick)[1].reshape(-1, k)


class Space:
    """The latent space of a sample and the sample's vectors and labels in it."""

    def __init__(self, counts: np.ndarray, labels: np.ndarray, rank: int = RANK, seed: int = 7):
        n = len(counts)
        self.labels = labels.astype(np.float32)
        self.prior = float(labels.mean()) if n else 0.5
        self.idf = np.log((1 + n) / (1 + (counts[:, :-1] > 0).sum(0))).astype(np.float32) + 1
        rows = self._weighted(counts)
        rank = min(rank, *rows.shape) if n else 1
        basis = np.random.default_rng(seed).standard_normal((rows.shape[1], min(rank + 16, rows.shape[1])), np.float32)
        for _ in range(4):  # power iterations
            basis = np.linalg.qr(rows.T @ (rows @ basis))[0] if n else basis
        _, _, vt = np.linalg.svd(rows @ basis, full_matrices=False) if n else (None, None, np.eye(basis.shape[1], dtype=np.float32))
        self.axes = (basis @ vt[:rank].T).astype(np.float32)
        self.vectors = self._unit(rows @ self.axes)

    def _weighted(self, counts: np.ndarray) -> np.ndarray:
        counts = counts.astype(np.float32)
        return self._unit(np.hstack((self._unit(np.log1p(counts[:, :-1]) * self.idf), counts[:, -1:] * np.float32(REPEAT / 1000))))

    @staticmethod
    def _unit(x: np.ndarray) -> np.ndarray:
        return x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-12)

    def scores(self, counts: np.ndarray, k: int = NEIGHBOURS) -> np.ndarray:
        """The vote of the k labelled vectors with the largest cosines, for each row of counts."""
        if not len(self.labels):
            return np.full(len(counts), self.prior)
        cosine = self._unit(self._weighted(counts) @ self.axes) @ self.vectors.T
        k = min(k, len(self.labels))
        near = nearest(cosine, k)
        weight = np.maximum(np.take_along_axis(cosine, near, 1), 0).astype(np.float64) ** POWER
        out = ((weight * self.labels[near]).sum(1) + PRIOR * self.prior) / (weight.sum(1) + PRIOR)
        return np.clip(np.where(counts[:, :-1].any(1), out, self.prior), 0, 1)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", labelled: int = LABELLED) -> Space:
    """The space of at most `labelled` rows that may be learnt from."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max(label).cast("double").alias("_label"))
    picked = known.orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id").limit(labelled)
    text = docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("_hash", F.xxhash64("text"))
    text = text.join(F.broadcast(picked), "doc_id")  # picked has at most `labelled` rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [counted(t or "") for t in batch.column("text").to_pylist()]
            places = [np.flatnonzero(c) for c in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("_hash"), batch.column("_label"), pa.array([p.astype("<u2").tobytes() for p in places], pa.binary()), pa.array([np.minimum(c[p], 2**31).astype("<u4").tobytes() for c, p in zip(found, places, strict=True)], pa.binary())],
                names=["doc_id", "hash", "label", "place", "n"],
            )

    schema = T.StructType([docs.schema["doc_id"], T.StructField("hash", T.LongType()), T.StructField("label", T.DoubleType()), T.StructField("place", T.BinaryType()), T.StructField("n", T.BinaryType())])
    one = F.min(F.struct("hash", "label", "place", "n")).alias("one")
    rows = text.mapInArrow(run, schema).groupBy("doc_id").agg(one).orderBy("doc_id").limit(labelled).select("one.*").collect()
    counts = np.zeros((len(rows), BUCKETS + 1), np.float32)
    for i, r in enumerate(rows):
        counts[i, np.frombuffer(r.place, "<u2")] = np.frombuffer(r.n, "<u4")
    return Space(counts, np.array([r.label for r in rows], np.float64))


def score(docs: DataFrame, space: Space) -> DataFrame:
    """doc_id and score of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(space)
    schema = T.StructType([docs.schema["doc_id"], T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(at, BLOCK)
                counts = np.stack([counted(t or "") for t in batch.column("text").to_pylist()]).astype(np.float32)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(space.scores(counts), pa.float64())], names=schema.names)

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def op9_neighbour_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read_documents(spark, sf_dir)
    out = score(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


QUERIES = {"op9_neighbour_vote": op9_neighbour_vote}
ORACLES: dict[str, str] = {}
