"""Line dedup by a log-template tree.

A line is split into words; a word with a digit is a variable field and becomes <*>. The parse tree has a fixed depth: first the number of
words, then the leading words; its nodes hold templates. Within a node, templates of which at least `similar` of the places agree
are one (the differing places generalise to <*>); they are taken in a fixed order, those that recur by themselves first, then by their words, so the
result depends neither on the order of rows nor on repeated ones. A node with many templates looks its groups up by words at their places, with the same result. A template
that occurs in `least` or more documents recurs, and one of `long` or more words also if it occurs in two different texts (copies of one
document are left to the dedup of documents); its lines are dropped from every document but the first. Documents are counted, not rows or templates:
a group carries the first few different documents that hold it, which is enough to decide exactly and has a fixed size.

Each task folds the equal lines of an Arrow batch before the shuffle, so a line that a third of all documents hold arrives as one row per batch, and
documents carry hashes of their lines only. The decisions are joined to the lines by those hashes (two of 64 bits).

Defined cases: a null text is kept null and has no lines; lines without words are never dropped; the first document is the one with the smallest doc_id,
null doc_ids last, then the least hash of the text; rows with one doc_id and one text are one document, different texts with one doc_id or none are several; very long lines and texts are taken whole; an empty table gives an empty
result; further columns pass through `dedup`.
"""

from __future__ import annotations

import re
from collections.abc import Collection, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

DEPTH = 3
SIMILAR = 0.8
LEAST = 3
#: Templates of at least so many words recur if they occur in two different texts (in `dedup` and the query).
LONG = 50
#: Over so many templates a node is searched by an index instead of comparing with every group; the groups are the same.
NODE = 256
VARIABLE = "<*>"
_DIGIT = re.compile(r"[0-9]")
_LAST = 2**63 - 1


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def template(line: str) -> list[str]:
    """The line's words with variable fields masked."""
    words = line.split()
    return [VARIABLE if _DIGIT.search(w) else w for w in words] if _DIGIT.search(line) else words


def node(words: list[str], depth: int = DEPTH) -> int:
    return _signed(xxhash.xxh64_intdigest(f"{len(words)} {' '.join(words[:depth])}"))


def merged(templates: list[tuple[str, int]], similar: float = SIMILAR) -> list[int]:
    """For each distinct template of a node, with its count of documents (up to the number that makes it recur), the place of its group's first in order.

    A template that agrees with a group in the needed places differs in at most `spare` of its own, so of any spare + 1 of its places one
    agrees: in a large node only the groups found by the rarest such places are compared, and none is lost.
    """
    out = [0] * len(templates)
    order = sorted(range(len(templates)), key=lambda i: (-templates[i][1], templates[i][0]))
    ids: dict[str, int] = {VARIABLE: 0}
    words = np.array([[ids.setdefault(w, len(ids)) for w in templates[i][0].split(" ")] for i in order], np.int32)
    groups = np.empty_like(words)
    heads: list[int] = []
    holders: dict[tuple[int, int], list[int]] = {}  # groups that had the word at the place when they began
    for i, w in zip(order, words, strict=True):
        fixed = np.flatnonzero(w)
        if len(order) <= NODE:
            near = np.arange(len(heads))
        else:
            need = next((m for m in range(len(fixed) + 1) if m / max(len(fixed), 1) >= similar), None)
            places = list(zip(fixed.tolist(), w[fixed].tolist(), strict=True))
            rare = [] if need is None else sorted((holders.get(x, ()) for x in places), key=len)[: len(places) - need + 1]
            near = np.array(sorted(set().union(*rare)), np.int64)
        own = groups[near]
        share = ((own == w) & (own > 0)).sum(1) / max(len(fixed), 1)
        best = int(share.argmax()) if len(near) else -1
        if best >= 0 and share[best] >= similar:
            g = near[best]
            groups[g][groups[g] != w] = 0
            out[i] = heads[g]
        else:
            if len(order) > NODE:
                for x in places:
                    holders.setdefault(x, []).append(len(heads))
            groups[len(heads)] = w
            heads.append(i)
            out[i] = i
    return out


@dataclass(frozen=True, slots=True)
class Holders:
    """The documents (id, hash of the text) that hold a template: the first `least` different ones in order, and the least and greatest hash of all their texts.

    Unions of these are exact: whether there are `least` different documents, which is the first, and whether there are two different texts.
    """

    docs: tuple[tuple[int, int], ...]
    low: int
    high: int

    @staticmethod
    def of(docs: Collection[tuple[int, int]], least: int) -> Holders:
        hashes = [h for _, h in docs]
        return Holders(tuple(sorted(docs)[:least]), min(hashes), max(hashes))

    def with_(self, other: Holders, least: int) -> Holders:
        return Holders(tuple(sorted({*self.docs, *other.docs})[:least]), min(self.low, other.low), max(self.high, other.high))

    def packed(self) -> bytes:
        return np.array(self.docs, "<i8").tobytes()

    @staticmethod
    def unpacked(docs: bytes, low: int, high: int) -> Holders:
        flat = np.frombuffer(docs, "<i8").reshape(-1, 2).tolist()
        return Holders(tuple(map(tuple, flat)), low, high)


def _lines(text: str | None) -> list[list[str]]:
    return [] if text is None else [template(x) for x in text.split("\n")]


def text_hash() -> Column:
    """With the doc_id it tells documents apart."""
    return F.xxhash64(F.col("text").cast("string"))


def hashed_lines(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_lines and, for each line with words, its number, node and template hash."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("text_hash", T.LongType()), T.StructField("n_lines", T.LongType()), T.StructField("lines", T.ArrayType(T.StructType([T.StructField("line", T.IntegerType()), T.StructField("node", T.LongType()), T.StructField("hash", T.LongType())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            n, ends, cols = [], [0], ([], [], [])
            for text in batch.column("text").to_pylist():
                own = _lines(text)
                n.append(len(own))
                for i, words in enumerate(own):
                    if words:
                        cols[0].append(i)
                        cols[1].append(node(words))
                        cols[2].append(_signed(xxhash.xxh64_intdigest(" ".join(words))))
                ends.append(len(cols[0]))
            items = pa.StructArray.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64())], ["line", "node", "hash"])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(n, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), items)], names=schema.names)

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("text_hash", text_hash()).mapInArrow(run, schema)


def recurring(docs: DataFrame, least: int = LEAST, similar: float = SIMILAR, long: int | None = None) -> DataFrame:
    """node, hash and first document (doc_id and text hash) of every template that recurs; long: the words from which two different texts suffice."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            holders: dict[str, tuple[int, int] | set[tuple[int, int]]] = {}  # most lines occur in one document: no set for these
            for part in common.slices(iter((batch,))):
                for doc, text, h in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), part.column("text_hash").to_pylist(), strict=True):
                    me = (_LAST if doc is None else doc, h)
                    for words in {" ".join(w) for w in _lines(text) if w}:
                        known = holders.setdefault(words, me)
                        if isinstance(known, set):
                            known.add(me)
                        elif known != me:
                            holders[words] = {known, me}
            keys = list(holders)
            own = [Holders.of(x if isinstance(x, set) else (x,), least) for x in holders.values()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([node(k.split(" ")) for k in keys], pa.int64()), pa.array(keys, pa.string()), pa.array([x.packed() for x in own], pa.binary()), pa.array([x.low for x in own], pa.int64()), pa.array([x.high for x in own], pa.int64())],
                names=["node", "words", "docs", "low", "high"],
            )

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if kept is None else pa.concat_tables([kept, table])
            ids = table.column("node").to_numpy()
            cut = int(np.searchsorted(ids, ids[-1]))  # the last node may go on in the next batch
            kept = table.slice(cut)
            if cut:
                yield decided(table.slice(0, cut))
        if kept is not None:
            yield decided(kept)

    def decided(table: pa.Table) -> pa.RecordBatch:
        ids = table.column("node").to_numpy()
        start = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
        out: tuple[list, list, list, list] = ([], [], [], [])
        for a, b in zip(start.tolist(), np.r_[start[1:], len(ids)].tolist(), strict=True):
            part = table.slice(a, b - a)
            if b - a == 1 and least > 1 and len(part.column("docs")[0].as_py()) < 16 * min(least, 2):
                continue  # one template of one document
            own: dict[str, Holders] = {}
            for w, docs, low, high in zip(*(part.column(c).to_pylist() for c in ("words", "docs", "low", "high")), strict=True):
                new = Holders.unpacked(docs, low, high)
                own[w] = own[w].with_(new, least) if w in own else new
            names = list(own)
            heads = merged([(w, len(own[w].docs)) for w in names], similar) if len(names) > 1 else [0]
            sums: dict[int, Holders] = {}
            for w, h in zip(names, heads, strict=True):
                sums[h] = sums[h].with_(own[w], least) if h in sums else own[w]
            wide = long is not None and names[0].count(" ") + 1 >= long
            for w, h in zip(names, heads, strict=True):
                if len(sums[h].docs) >= least or wide and sums[h].low < sums[h].high:
                    out[0].append(int(ids[a]))
                    out[1].append(_signed(xxhash.xxh64_intdigest(w)))
                    out[2].append(sums[h].docs[0][0])
                    out[3].append(sums[h].docs[0][1])
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["node", "hash", "first", "first_hash"])

    folded = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("text_hash", text_hash()).mapInArrow(fold, "node long, words string, docs binary, low long, high long")
    return folded.repartition("node").sortWithinPartitions("node").mapInArrow(grow, "node long, hash long, first long, first_hash long")


def _dropped(docs: DataFrame, least: int, similar: float, long: int | None) -> DataFrame:
    """doc_id, text_hash, n_lines and the numbers of the dropped lines of every document, in order."""
    lines = common.stage(hashed_lines(docs), "lines")
    drop = common.stage(recurring(docs, least, similar, long), "templates")
    flat = lines.select("doc_id", "text_hash", F.explode("lines").alias("x")).select("doc_id", "text_hash", "x.*")
    hit = flat.join(drop, ["node", "hash"]).where((F.coalesce(F.col("doc_id"), F.lit(_LAST)) != F.col("first")) | (F.col("text_hash") != F.col("first_hash")))
    each = hit.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set("line")).alias("dropped"))
    out = lines.select("doc_id", "text_hash", "n_lines").alias("l").join(each.alias("e"), F.col("l.doc_id").eqNullSafe(F.col("e.doc_id")) & (F.col("l.text_hash") == F.col("e.text_hash")), "left")
    return out.select("l.doc_id", "l.text_hash", "n_lines", F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"))


def dropped(docs: DataFrame, least: int = LEAST, similar: float = SIMILAR, long: int | None = None) -> DataFrame:
    """doc_id, n_lines and the numbers of the dropped lines of every document, in order."""
    return _dropped(docs, least, similar, long).drop("text_hash")


def dedup(docs: DataFrame, least: int = LEAST, similar: float = SIMILAR, long: int | None = LONG) -> DataFrame:
    """The documents, all columns and rows, without the dropped lines; n_chars, if there, is counted anew."""
    gone = _dropped(docs, least, similar, long).where(F.size("dropped") > 0).groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).agg(F.max("dropped").alias("_gone"))
    out = docs.join(gone, F.col("doc_id").eqNullSafe(F.col("_id")) & (text_hash() == F.col("_hash")), "left")
    kept = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains(F.col("_gone"), i)), "\n")
    out = out.withColumn("text", F.when(F.col("_gone").isNull(), F.col("text")).otherwise(kept))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def op10_template_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dropped(common.read_documents(spark, sf_dir), long=LONG)
    return out.select("doc_id", "n_lines", F.size("dropped").cast("long").alias("n_dropped"), F.array_join(F.col("dropped").cast("array<string>"), ",").alias("dropped_lines"))


QUERIES = {"op10_template_tree": op10_template_tree}
ORACLES: dict[str, str] = {}
