"""SimHash near-dedup by anchor-point covering.

Anchors are the words of a covering code: the perfect binary Golay code [23,12] (every 23-bit word lies within 3 of exactly one
code word), once for each of one or two blocks of 23 bits of the fingerprint; with two blocks the covering radius is 6. A
fingerprint is at home at its nearest anchor and is replicated to every anchor within radius + threshold. Two fingerprints
within the threshold therefore meet at the home of either, so no link is lost; what meets is compared over all 64 bits. Each
anchor gives only the edges of a spanning forest (member, smallest member of its local component), never its pairs, and the
components over all anchors come from star contraction. Copies share a fingerprint and are folded before the replication.

A shorter reach is exact as well: some word lies halfway between two linked fingerprints, and both are within half the threshold,
rounded up, of its nearest anchor's ball. With reach = radius + half the threshold all that meets at an anchor is compared, home or not;
so a reach of 2 serves a threshold of 4. The default reach is the whole threshold.

With two blocks there are 2^24 anchors, and a fingerprint has about 77 replicas: the work grows in proportion to the number of
different fingerprints up to some tens of millions; one block has 2^12 anchors and about 22 replicas.

Near copies of a lower similarity differ in more bits than a covering code reaches at a bearable number of replicas. For them
(`near_components`, `dedup`) the fingerprint has 128 bits, and the same covering is laid over three runs of 46 of them; two
fingerprints of which any run meets at an anchor are compared over all 128 bits. The distance is exact there, the meeting is not:
the chance to meet is estimated at 0.98 for texts of similarity 0.8 (Jaccard, five-word shingles), where they differ in 19 bits on average,
and tends to 1 above. NEAR_THRESHOLD leaves room for the spread of that number, so what meets is only a candidate: within the components of these links
every two sets of shingles are compared (by 64-bit hashes of the shingles), those of similarity SIMILAR or more are linked, and their components are
the groups of near copies. Equal sets are folded before; a group of candidates is decided in one task, which holds the hashes of its different sets.

Defined cases: a null text counts as empty; a text without words has fingerprint 0 and is linked like any other; very long
texts are hashed in pieces; repeated rows share a component; for near copies texts without words are only like each other, and different texts that share a doc_id or have none are different documents; a component whose doc_ids are all null has component_id null,
otherwise nulls do not count for the smallest; an empty table gives an empty result; further columns are ignored (`dedup` passes them through).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from . import common

THRESHOLD = 2
SHINGLE = 5
#: For near copies: the most differing bits of 128, and the reach beyond the covering radius in each run.
NEAR_THRESHOLD, NEAR_REACH = 32, 2
#: The least Jaccard similarity of near copies' shingles.
SIMILAR = 0.8
_GENERATOR = 0xC75  # fixed value: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1, the Golay code's generator polynomial
_BITS, _MESSAGES, _RADIUS = 23, 4096, 3
_PIECE = 1 << 18
_PART = 1 << 14
_GROUP, _STEP = 8192, 2048
#: Replicas that one task makes, about.
REPLICAS = 1_000_000


def fingerprint(text: str, words: int) -> int:
    """64 bits as a signed number: bit set if it is set in over half of the shingles' hashes."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(tokens) <= words:
        hashes = [digest(b" ".join(tokens), 42)]
    else:
        whole = b" ".join(tokens)
        ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
        starts = np.concatenate(([0], ends[: -words] + 1)).tolist()
        hashes = [digest(whole[a:b], 42) for a, b in zip(starts, ends[words - 1 :].tolist(), strict=True)]
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _PIECE):
        ones += np.unpackbits(np.array(hashes[i : i + _PIECE], ">u8").view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes)).view(">i8")[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE, keep: list[str] | None = None) -> DataFrame:
    """doc_id (or the columns named in keep) and fp of every document."""
    keep = keep or ["doc_id"]
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField("fp", T.LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = [fingerprint(t or "", words) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(fp, pa.int64())], names=schema.names)

    return docs.select(*keep, F.col("text").cast("string").alias("_text")).mapInArrow(run, schema)


@cache
def _golay() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For every 23-bit word its nearest code word's message and its error's number; for every error the messages by distance, the distances and their cumulative counts."""
    m = np.arange(_MESSAGES, dtype=np.uint32)
    code = np.zeros_like(m)
    for i in range(12):
        code ^= np.where(m >> i & 1, np.uint32(_GENERATOR << i), np.uint32(0)).astype(np.uint32)
    errors = np.arange(1 << _BITS, dtype=np.uint32)
    errors = errors[np.bitwise_count(errors) <= _RADIUS]
    message, error = np.zeros(1 << _BITS, np.uint16), np.zeros(1 << _BITS, np.uint16)
    for k, e in enumerate(errors):
        message[code ^ e] = m
        error[code ^ e] = k
    far = np.stack([np.bitwise_count(e ^ code) for e in errors])
    order = np.stack([np.argsort(x, kind="stable").astype(np.uint16) for x in far])
    distance = np.take_along_axis(far, order, axis=1)
    upto = np.stack([(far <= d).sum(1) for d in range(_BITS + 1)], axis=1).astype(np.int64)
    return message, error, order, distance, upto


def _ragged(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and places within the row for so many entries a row."""
    rows = np.repeat(np.arange(len(counts)), counts)
    return rows, np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)


def replicas(fp: np.ndarray, blocks: int, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, home) of every anchor within the covering radius plus reach of each fingerprint (uint64)."""
    message, error, order, distance, upto = _golay()
    part = [(fp >> np.uint64(_BITS * b) & np.uint64((1 << _BITS) - 1)).astype(np.int64) for b in range(blocks)]
    least = [distance[error[p], 0].astype(np.int64) for p in part]
    rows, anchor = np.arange(len(fp)), np.zeros(len(fp), np.int64)
    left = np.full(len(fp), _RADIUS * blocks + reach, np.int64)
    home = np.ones(len(fp), bool)
    for b in range(blocks):
        later = sum(least[b + 1 :], np.zeros(len(fp), np.int64))
        e = error[part[b]]
        pick, j = _ragged(upto[e[rows], np.clip(left - later[rows], 0, _BITS)])
        rows, anchor, left, home = rows[pick], anchor[pick], left[pick], home[pick]
        anchor = anchor << 12 | (message[part[b]][rows] ^ order[e[rows], j]).astype(np.int64)
        left, home = left - distance[e[rows], j], home & (j == 0)
    return rows, anchor, home


def local_roots(fp: np.ndarray, threshold: int) -> np.ndarray:
    """For each of the different fingerprints of one anchor, the place of the smallest in its component; linear memory, no list of pairs."""
    n = len(fp)
    root = np.full(n, -1)
    order = np.argsort(fp.view(np.int64), kind="stable")
    if n > 8192 and threshold <= 2:  # by looking up every word within the threshold instead of comparing with every other
        flips = np.array([1 << i for i in range(64)], np.uint64)
        if threshold == 2:
            i, j = np.triu_indices(64, 1)
            flips = np.concatenate((flips, flips[i] | flips[j]))
        ordered = np.sort(fp)
        where = np.argsort(fp, kind="stable")
        for seed in order:
            if root[seed] >= 0:
                continue
            root[seed], front = seed, np.array([seed])
            while len(front):
                found = []
                for f in np.array_split(front, -(-len(front) // 512)):
                    near = (fp[f][:, None] ^ flips[None, :]).ravel()
                    at = np.minimum(np.searchsorted(ordered, near), n - 1)
                    found.append(where[at[ordered[at] == near]])
                front = np.unique(np.concatenate(found))
                front = front[root[front] < 0]
                root[front] = seed
        return root
    for seed in order:
        if root[seed] >= 0:
            continue
        root[seed], front = seed, np.array([seed])
        while len(front):
            rest = np.flatnonzero(root < 0)
            hit = np.zeros(len(rest), bool)
            for f in np.array_split(front, -(-len(front) // 256)):
                hit |= (np.bitwise_count(fp[f][:, None] ^ fp[rest][None, :]) <= threshold).any(0)
            front = rest[hit]
            root[front] = seed
    return root


def _links(anchor: np.ndarray, fp: np.ndarray, home: np.ndarray | None, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (a, b) among rows ordered by anchor, of anchors that are complete in these arrays."""
    first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    size = np.diff(np.r_[first, len(anchor)])
    busy = size > 1 if home is None else (size > 1) & np.logical_or.reduceat(home, first)
    a, b = [], []
    small = busy & (size <= 32)
    keep = np.repeat(small, size)
    x, y = anchor[keep], fp[keep]
    for step in range(1, int(size[small].max(initial=1))):  # neighbours at this step, all small anchors at once
        near = (x[step:] == x[:-step]) & (np.bitwise_count(y[step:] ^ y[:-step]) <= threshold)
        a.append(y[step:][near])
        b.append(y[:-step][near])
    for k in np.flatnonzero(busy & (size > 32)):
        own = fp[first[k] : first[k] + size[k]]
        root = local_roots(own, threshold)
        far = root != np.arange(len(own))
        a.append(own[far])
        b.append(own[root[far]])
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def links(distinct: DataFrame, threshold: int = THRESHOLD, blocks: int = 2, reach: int | None = None) -> DataFrame:
    """Edges (a, b) between different fingerprints that connect exactly what the threshold links. distinct: column fp, no repeats."""
    reach = threshold if reach is None else reach
    if 2 * reach < threshold:
        raise ValueError("a reach under half the threshold loses links")
    step = 4096 if blocks == 2 else 16384

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for i in range(0, len(fp), step):
                part = fp[i : i + step]
                rows, anchor, home = replicas(part, blocks, reach)
                yield pa.RecordBatch.from_arrays([pa.array(anchor.astype(np.int32)), pa.array(part[rows].view(np.int64)), pa.array(home)], names=["anchor", "fp", "home"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] | None = None
        for batch in batches:
            new = [batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64), batch.column(2).to_numpy(zero_copy_only=False)]
            if not len(new[0]):
                continue
            now = new if kept is None else [np.concatenate(p) for p in zip(kept, new, strict=True)]
            cut = int(np.searchsorted(now[0], now[0][-1]))  # the last anchor may go on in the next batch
            kept = [x[cut:] for x in now]
            if cut:
                yield out(*[x[:cut] for x in now])
        if kept is not None:
            yield out(*kept)

    def out(anchor, fp, home) -> pa.RecordBatch:
        a, b = _links(anchor, fp, home if reach >= threshold else None, threshold)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    # a fingerprint becomes dozens of replicas: as many tasks as these need, however few splits the fingerprints are read in
    n = 1 + distinct.count() // (REPLICAS // (80 if blocks == 2 else 25))
    spreaded = distinct.select("fp").repartition(n, "fp").mapInArrow(spread, "anchor int, fp long, home boolean")
    return spreaded.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(meet, "a long, b long")


def shingle_hashes(text: str, words: int = SHINGLE) -> np.ndarray:
    """The hashes of the different shingles, two big-endian numbers each, the smallest first."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.zeros((0, 2), ">u8")
    whole = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    del tokens
    starts = np.concatenate(([0], ends[:-words] + 1))
    ends = ends[min(words, len(ends)) - 1 :]
    parts = []
    for i in range(0, len(starts), _PART):
        spans = zip(starts[i : i + _PART].tolist(), ends[i : i + _PART].tolist(), strict=True)
        parts.append(b"".join([xxhash.xxh3_128_digest(whole[a:b], 42) for a, b in spans]))
    hashes = np.frombuffer(b"".join(parts), ">u8").reshape(-1, 2).astype(np.uint64)
    hashes = hashes[np.lexsort((hashes[:, 1], hashes[:, 0]))]
    return hashes[np.r_[True, (hashes[1:] != hashes[:-1]).any(1)]].astype(">u8")


def _wide(hashes: np.ndarray) -> bytes:
    if not len(hashes):
        return bytes(16)
    ones = np.zeros(128, np.int64)
    for i in range(0, len(hashes), _PART):
        ones += np.unpackbits(hashes[i : i + _PART].view(np.uint8), axis=1).sum(0, dtype=np.int64)
    tie = np.unpackbits(hashes[0].view(np.uint8))
    return np.packbits(ones * 2 + tie > len(hashes)).tobytes()


def wide_fingerprint(text: str, words: int = SHINGLE) -> bytes:
    """128 bits: bit set if it is set in over half of the different shingles' hashes; the smallest hash decides ties, which are common in short texts."""
    return _wide(shingle_hashes(text, words))


def _key(hashes: np.ndarray) -> bytes:
    """128 bits that tell sets of shingles apart."""
    return xxhash.xxh3_128_digest(np.ascontiguousarray(hashes).tobytes(), 7)


def text_hash() -> Column:
    """With the doc_id it tells documents apart."""
    return F.unhex(F.md5(common.text_or_empty().cast("binary")))


def wide_fingerprints(docs: DataFrame, words: int = SHINGLE) -> DataFrame:
    """doc_id, text_hash, the 128-bit fp and the key of the set of shingles of every document."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("text_hash", T.BinaryType()), T.StructField("fp", T.BinaryType(), False), T.StructField("key", T.BinaryType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            fp, key = [], []
            for t in batch.column("_text").to_pylist():
                hashes = shingle_hashes(t or "", words)
                fp.append(_wide(hashes))
                key.append(_key(hashes))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(fp, pa.binary()), pa.array(key, pa.binary())], names=schema.names)

    return docs.select("doc_id", text_hash().alias("text_hash"), F.col("text").cast("string").alias("_text")).mapInArrow(run, schema)


def _runs(fp: np.ndarray) -> list[np.ndarray]:
    """Three runs of 46 bits, together all 128 (the second and the third share ten)."""
    mask = np.uint64((1 << 2 * _BITS) - 1)
    low, high = fp[:, 0], fp[:, 1]
    return [low & mask, (low >> np.uint64(46) | high << np.uint64(18)) & mask, high >> np.uint64(18)]


def _binary(rows: np.ndarray) -> pa.Array:
    """The rows of a matrix as binary values."""
    rows = np.ascontiguousarray(rows)
    wide = rows.strides[0] if len(rows) else 0
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer((np.arange(len(rows) + 1) * wide).astype(np.int32)), pa.py_buffer(rows)])


def _least(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For n numbered nodes and edges between them the smallest number of each node's component."""
    own, before = np.arange(n), None
    while before is None or (own != before).any():
        before = own
        least = np.minimum(own[i], own[j])
        own = own.copy()
        np.minimum.at(own, i, least)
        np.minimum.at(own, j, least)
        own = own[own]
    return own


def _contracted(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect the same fingerprints, each with the smallest of its component: fewer edges than fingerprints."""
    fp = np.concatenate((a, b))
    order = np.lexsort((fp[:, 1], fp[:, 0]))
    new = np.r_[True, (fp[order[1:]] != fp[order[:-1]]).any(1)] if len(fp) else np.zeros(0, bool)
    number = np.empty(len(fp), np.int64)
    number[order] = np.cumsum(new) - 1
    node = fp[order[new]]
    root = _least(len(node), number[: len(a)], number[len(a) :])
    member = np.flatnonzero(root != np.arange(len(root)))
    return node[member], node[root[member]]


def _wide_links(anchor: np.ndarray, fp: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (member, smallest member of its local component) of every anchor; rows ordered by anchor, then fp. Never all pairs."""
    first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    size = np.diff(np.r_[first, len(anchor)])
    root = np.arange(len(anchor))
    small = np.flatnonzero(np.repeat((size > 1) & (size <= 32), size))
    x, y = anchor[small], fp[small]
    near = [np.zeros((0, 2), np.int64)]
    for step in range(1, int(size[size <= 32].max(initial=1))):  # neighbours at this step, all small anchors at once
        at = np.flatnonzero(x[step:] == x[:-step])
        at = at[np.bitwise_count(y[at + step] ^ y[at]).sum(1) <= threshold]
        near.append(np.stack((at + step, at), 1))
    i, j = np.concatenate(near).T
    root[small] = small[_least(len(small), i, j)]
    for k in np.flatnonzero(size > 32):
        own = fp[first[k] : first[k] + size[k]]
        rest = np.arange(len(own))
        while len(rest) > 1:  # one component at a time, from its first row outwards
            seed, front, rest = rest[0], [int(rest[0])], rest[1:]
            while front and len(rest):
                hit = np.bitwise_count(own[rest] ^ own[front.pop()]).sum(1) <= threshold
                found, rest = rest[hit], rest[~hit]
                root[first[k] + found] = first[k] + seed
                front += found.tolist()
    member = np.flatnonzero(root != np.arange(len(root)))
    return fp[member], fp[root[member]]


def wide_links(distinct: DataFrame, threshold: int, reach: int) -> DataFrame:
    """Edges (a, b) between different 128-bit fingerprints that meet at an anchor of any run. distinct: column fp, no repeats.

    Replicas travel packed: one row for those of a group of documents that share all but the last byte of the anchor.
    """
    record = np.dtype([("last", np.uint8), ("fp", np.uint64, 2)])

    def pack(fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        for t, run in enumerate(_runs(fp)):
            parts = [(i, replicas(run[i : i + _STEP], 2, reach)) for i in range(0, len(run), _STEP)]
            rows = np.concatenate([(r + i).astype(np.int32) for i, (r, _, _) in parts])
            anchor = np.concatenate([x.astype(np.int32) for _, (_, x, _) in parts])
            order = np.argsort(anchor, kind="stable")
            rows, anchor = rows[order], anchor[order]
            packed = np.empty(len(rows), record)
            packed["last"], packed["fp"] = anchor & 255, fp[rows]
            bucket = anchor >> 8
            first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            ends = (np.r_[first, len(bucket)] * record.itemsize).astype(np.int32)
            data = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(packed)])
            yield pa.RecordBatch.from_arrays([pa.array((t << 16 | bucket[first]).astype(np.int32)), data], names=["bucket", "packed"])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = b""
        for batch in batches:
            waiting += b"".join(batch.column("fp").to_pylist())
            while len(waiting) >= _GROUP * 16:
                yield from pack(np.frombuffer(waiting[: _GROUP * 16], np.uint64).reshape(-1, 2))
                waiting = waiting[_GROUP * 16 :]
        if waiting:
            yield from pack(np.frombuffer(waiting, np.uint64).reshape(-1, 2))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, fp = np.zeros(0, np.int64), np.zeros((0, 2), np.uint64)
        found = (fp, fp)  # all edges of the task, contracted whenever they have grown: groups of copies meet at many anchors
        for batch in common.slices(batches, 1024):
            if not batch.num_rows:
                continue
            packed = batch.column("packed").to_pylist()
            data = np.frombuffer(b"".join(packed), record)
            bucket = np.repeat(batch.column("bucket").to_numpy().astype(np.int64), np.fromiter(map(len, packed), np.int64, len(packed)) // record.itemsize)
            anchor, fp = np.concatenate((anchor, bucket << 8 | data["last"])), np.concatenate((fp, data["fp"]))
            cut = int(np.searchsorted(anchor >> 8, bucket[-1]))  # the last bucket may go on in the next batch
            found = grown(found, anchor[:cut], fp[:cut])
            anchor, fp = anchor[cut:], fp[cut:]
        a, b = grown(found, anchor, fp)
        yield pa.RecordBatch.from_arrays([_binary(a), _binary(b)], names=["a", "b"])

    def grown(found: tuple[np.ndarray, np.ndarray], anchor: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(anchor):
            return found
        order = np.lexsort((fp[:, 1], fp[:, 0], anchor))
        a, b = _wide_links(anchor[order], fp[order], threshold)
        return _contracted(np.concatenate((found[0], a)), np.concatenate((found[1], b))) if len(a) else found

    n = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spreaded = distinct.select("fp").repartition(n, "fp").mapInArrow(spread, "bucket int, packed binary")
    return spreaded.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(meet, "a binary, b binary")


def _components(fps: DataFrame, link) -> DataFrame:
    """fps with component_id, where link gives the edges between different fingerprints."""
    distinct = common.stage(fps.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct")
    roots = common.connected_components(common.stage(link(distinct), "links")).select(F.col("node").alias("fp"), "root")
    known = distinct.join(roots, "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = known.groupBy("root").agg(F.min("low").alias("component_id"))
    return fps.join(known.select("fp", "root").join(lowest, "root").select("fp", "component_id"), "fp")


def components(docs: DataFrame, words: int = SHINGLE, threshold: int = THRESHOLD, blocks: int = 2, reach: int | None = None) -> DataFrame:
    """doc_id, fp and component_id (smallest doc_id reachable over links) of every document; no link within the threshold is lost."""
    return _components(common.stage(fingerprints(docs, words), "fingerprints"), lambda distinct: links(distinct, threshold, blocks, reach))


def similar_roots(sets: list[np.ndarray], similar: float = SIMILAR) -> list[int]:
    """For each of the different sets (hashes, no repeats) the place of the first in its component; linked are sets of Jaccard similarity `similar` or more.

    One component at a time from its first set outwards. An index from hash to the sets not yet taken finds what shares anything with
    a set and how much, so every pair is decided exactly and no list of pairs is made; it shrinks as sets are taken.
    """
    n = len(sets)
    root, size = np.full(n, -1), np.fromiter(map(len, sets), np.int64, n)
    value = np.concatenate([np.zeros(0, np.uint64), *sets])
    owner = np.repeat(np.arange(n, dtype=np.int32), size)
    order = np.argsort(value, kind="stable")
    value, owner = value[order], owner[order]
    free = int(size.sum())
    for seed in range(n):
        if root[seed] >= 0:
            continue
        root[seed], front = seed, [seed]
        free -= int(size[seed])
        while front and free:
            if 2 * free < len(value):
                left = root[owner] < 0
                value, owner = value[left], owner[left]
            own = sets[front.pop()]
            low, high = np.searchsorted(value, own), np.searchsorted(value, own, "right")
            _, at = _ragged(high - low)
            shared = np.bincount(owner[np.repeat(low, high - low) + at])
            near = np.flatnonzero(shared)
            near = near[root[near] < 0]
            near = near[shared[near] >= similar * (size[near] + len(own) - shared[near])]
            root[near] = seed
            free -= int(size[near].sum())
            front += near.tolist()
    return root.tolist()


def verified(docs: DataFrame, rows: DataFrame, words: int, similar: float) -> DataFrame:
    """key and root of every set of shingles that is not alone in its group of candidates; root is one key of each component of verified links.

    rows: doc_id, text_hash, key and the group of every document. Of each set one document's shingles are read.
    """
    one = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("one")
    sets = rows.groupBy("group", "key").agg(one)
    several = sets.groupBy("group").agg(F.count("*").alias("n")).where("n > 1").select("group")
    chosen = sets.join(several, "group").select("group", "key", F.col("one.doc_id").alias("_id"), F.col("one.text_hash").alias("_hash"))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("_text"), text_hash().alias("text_hash"))
    texts = texts.join(chosen, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))).select("group", "key", "_text")

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            own = [np.sort(shingle_hashes(t or "", words)[:, 0].astype(np.uint64)).tobytes() for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("group"), batch.column("key"), pa.array(own, pa.binary())], names=["group", "key", "hashes"])

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, own = None, {}
        for batch in batches:
            for g, k, h in zip(batch.column("group"), batch.column("key"), batch.column("hashes"), strict=True):
                g, k = g.as_py(), k.as_py()
                if g != group:
                    if own:
                        yield decided(own)
                    group, own = g, {}
                if k not in own:  # repeated rows
                    own[k] = np.frombuffer(h.as_py(), np.uint64)
        if own:
            yield decided(own)

    def decided(own: dict[bytes, np.ndarray]) -> pa.RecordBatch:
        keys = list(own)
        roots = similar_roots(list(own.values()), similar)
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array([keys[i] for i in roots], pa.binary())], names=["key", "root"])

    hashed = texts.mapInArrow(shingled, "group binary, key binary, hashes binary")
    return hashed.repartition("group").sortWithinPartitions("group", "key").mapInArrow(decide, "key binary, root binary")


def _near_rows(docs: DataFrame, words: int, threshold: int, reach: int, similar: float) -> DataFrame:
    """doc_id, text_hash, fp and root of every document; root tells the components of verified links apart."""
    fps = common.stage(wide_fingerprints(docs, words), "fingerprints")
    met = common.connected_components(common.stage(wide_links(common.stage(fps.select("fp").distinct(), "distinct"), threshold, reach), "links"))
    rows = fps.join(met.select(F.col("node").alias("fp"), F.col("root").alias("group")), "fp", "left").withColumn("group", F.coalesce("group", "fp"))
    known = common.stage(verified(docs, rows, words, similar).withColumnRenamed("key", "_key"), "verified")
    return fps.join(known, F.col("key") == F.col("_key"), "left").select("doc_id", "text_hash", "fp", F.coalesce("root", "key").alias("root"))


def near_components(docs: DataFrame, words: int = SHINGLE, threshold: int = NEAR_THRESHOLD, reach: int = NEAR_REACH, similar: float = SIMILAR) -> DataFrame:
    """doc_id, the 128-bit fp and component_id of every document, for near copies of similarity 0.8 or more."""
    rows = _near_rows(docs, words, threshold, reach, similar)
    lowest = rows.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rows.join(lowest, "root").select("doc_id", "fp", "component_id")


def dedup(docs: DataFrame, words: int = SHINGLE, threshold: int = NEAR_THRESHOLD, reach: int = NEAR_REACH, similar: float = SIMILAR) -> DataFrame:
    """The documents, all columns, of which one of each group of near copies stays: the one with the smallest doc_id, nulls last, then the least hash of the text (of repeated rows, one)."""
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("one")
    stay = _near_rows(docs, words, threshold, reach, similar).groupBy("root").agg(least).select(F.col("one.doc_id").alias("_stay"), F.col("one.text_hash").alias("_hash"))
    kept = docs.withColumn("_own", text_hash()).join(stay, F.col("doc_id").eqNullSafe(F.col("_stay")) & (F.col("_own") == F.col("_hash")), "left_semi")
    once = F.row_number().over(W.Window.partitionBy("doc_id", "_own").orderBy("text"))
    return kept.withColumn("_once", once).where("_once = 1").drop("_once", "_own")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = components(common.read_documents(spark, sf_dir), words=3)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op2_simhash": op2_simhash}
ORACLES: dict[str, str] = {}
