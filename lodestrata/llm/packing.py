"""Packing by minimum bin slack.

Every document is cut into whole windows and one remainder. The lengths of all pieces form a histogram with at most `capacity`
entries, whatever the input; over it, the plan is made on the driver: the longest length left opens a window, and a subset-sum
dynamic programme over bit sets (bit s set: some multiset of the lengths left sums to s) finds the fill closest to the capacity;
backtracking gives the multiset, and the same window is repeated as often as the counts allow. So every step uses up at least one
length. The plan says, for the r-th piece of a length, its sequence and offset. Pieces are ranked within their length by
two levels (a hash bucket's first rank, then the rank in the bucket), so that a length that a third of all rows share is still
ranked by many tasks.

Token ids are those of the `tokenizers` file; the byte-level BPE itself runs in `tiktoken` over the same vocabulary, which the
loader checks for equal form (ids in merge order, the plain byte-level splitter).

Defined cases: a null text counts as empty and is one piece, the end id alone; very long texts, also of one character, give many whole windows; repeated
rows are packed each for itself; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from . import common

CAPACITY = 1024
END_ID = 0
BUCKETS = 512
# Fixed value: the byte-level splitter's pattern.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# The splitter's blanks.
_LONG_BLANKS = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{10000,}")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@cache
def encoder(path: str) -> tiktoken.Encoding:
    """The vocabulary of a byte-level BPE file of `tokenizers` as an encoding with the same ids."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre, model = spec["pre_tokenizer"], spec["model"]
    if spec.get("normalizer") or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre.get("use_regex", True) or model["type"] != "BPE":
        raise ValueError(f"{path} is not a plain byte-level BPE")
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
    merges = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    order = [model["vocab"][m] for m in merges]
    if order != sorted(order):
        raise ValueError(f"{path}: ids are not in merge order")
    return tiktoken.Encoding("byte-level", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)


def token_ids(encoding: tiktoken.Encoding, text: str) -> np.ndarray:
    """The text's ids and the end id.

    The splitter's look-ahead over blanks backtracks with a stack that a very long run overflows, so long runs are cut out first. A run is one
    word of the splitter, without its last blank where another character follows: that blank goes to what follows.
    """
    ids: list[int] = []
    at = 0
    for m in _LONG_BLANKS.finditer(text):
        end = m.end()
        if end < len(text) and not text.startswith(tuple(encoding.special_tokens_set), end):
            end -= 1
        ids += encoding.encode(text[at : m.start()], allowed_special="all")
        ids += encoding._encode_single_piece(text[m.start() : end])
        at = end
    ids += encoding.encode(text[at:], allowed_special="all")
    return np.array([*ids, END_ID], "<u4")


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens and bucket of every piece: whole windows and a remainder."""
    schema = T.StructType([docs.schema["doc_id"], *(T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = encoder(vocabulary)
        for batch in batches:
            row, cols = [], ([], [], [], [])
            for i, text in enumerate(batch.column("text").to_pylist()):
                ids = token_ids(encoding, text or "")
                for start in range(0, len(ids), capacity):
                    part = ids[start : start + capacity]
                    row.append(i)
                    for c, v in zip(cols, (start, len(part), zlib.crc32(part.tobytes()), len(ids)), strict=True):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(row, pa.int64())), *(pa.array(c, pa.int64()) for c in cols)], names=schema.names)

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of the lengths in counts whose sum is nearest to room from below: bit-set subset sums, then backtracking."""
    mask = (1 << (room + 1)) - 1
    sums, steps = 1, []
    for length in sorted((x for x in counts if 0 < x <= room), reverse=True):
        copies, size = min(counts[length], room // length), 1
        while copies > 0:  # 1, 2, 4, ... copies, and what is left, give every count
            n = min(size, copies)
            steps.append((length, n, sums))
            sums |= sums << (length * n) & mask
            copies, size = copies - n, size * 2
        if sums >> room & 1:
            break
    target = sums.bit_length() - 1
    used: dict[int, int] = {}
    for length, n, before in reversed(steps):
        if not before >> target & 1:
            target -= length * n
            used[length] = used.get(length, 0) + n
    return used


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Windows as (length -> copies, times) that use up the histogram."""
    left = {k: v for k, v in histogram.items() if v > 0}
    out = []
    while left:
        longest = max(left)
        rest = dict(left)
        rest[longest] -= 1
        window = fill({k: v for k, v in rest.items() if v}, capacity - longest)
        window[longest] = window.get(longest, 0) + 1
        times = min(left[k] // n for k, n in window.items())
        out.append((window, times))
        for k, n in window.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
    return out


def places(windows: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, copies in a window, first sequence, offset in the window) for each length of each window."""
    rank: dict[int, int] = {}
    sequence, out = 0, []
    for window, times in windows:
        offset = 0
        for length in sorted(window, reverse=True):
            n, first = window[length], rank.get(length, 0)
            out.append((length, first, first + n * times, n, sequence, offset))
            rank[length] = first + n * times
            offset += length * n
        sequence += times
    return out


def pack(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset of every piece."""
    spark = docs.sparkSession
    rows = common.stage(pieces(docs, vocabulary or default_vocabulary(), capacity).withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(BUCKETS)).cast("int")), "pieces")
    cells = rows.groupBy("length", "bucket").agg(F.count("*").alias("n"))  # at most capacity x BUCKETS cells
    histogram = {r.length: r.n for r in cells.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = F.coalesce(F.sum("n").over(W.Window.partitionBy("length").orderBy("bucket").rowsBetween(W.Window.unboundedPreceding, -1)), F.lit(0))
    firsts = cells.select("length", "bucket", before.alias("before"))
    table = ",".join(":".join(map(str, p)) for p in places(plan(histogram, capacity)))
    spots = spark.range(1).select(F.explode(F.split(F.lit(table), ",")).alias("p")).where("p <> ''")
    spots = spots.select(*(F.split("p", ":")[i].cast("bigint").alias(c) for i, c in enumerate(("length", "low", "high", "copies", "sequence", "at"))))
    rank = F.row_number().over(W.Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32")) - 1
    ranked = rows.withColumn("rank", rank).join(firsts, ["length", "bucket"]).withColumn("rank", F.col("rank") + F.col("before")).alias("r")
    found = ranked.join(F.broadcast(spots).alias("s"), (F.col("r.length") == F.col("s.length")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
    step = F.col("rank") - F.col("low")
    return found.select(
        "doc_id", "start", "r.length", "ids_crc32", "doc_tokens", (F.col("sequence") + F.floor(step / F.col("copies"))).cast("long").alias("sequence_id"), (F.col("at") + step % F.col("copies") * F.col("r.length")).alias("offset")
    )


def op3_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(common.read_documents(spark, sf_dir))


QUERIES = {"op3_bin_slack": op3_bin_slack}
ORACLES: dict[str, str] = {}
