"""Removal of repeated byte strings with hash-compared suffix sorting.

A string of `length` bytes (200) that starts at two places or more of the corpus is repeated; every byte that such a string covers is
removed. Sorting all suffixes of the corpus in one place is out of the question, so they are dealt out first:

1. Each window of 200 bytes has an anchor, the leftmost of its 64-byte grams with the least hash (prefix polynomial hashes, one
   multiplication a gram). Equal windows have equal anchors at equal offsets, so windows are compared within their anchor only. Neighbouring windows
   share anchors, about one to 69 bytes. Anchors that occur once in the corpus end here: these windows are not repeated.
2. Documents that have an anchor left give, for every run of windows with one anchor, the bytes that the run spans. Equal runs of a chunk are folded
   (bytes compared), so that a passage that a third of all documents hold arrives as one row per chunk, and the chunk already knows it is repeated.
3. The rows of an anchor meet. Their suffixes to the right of the anchor, and the reversed ones to its left, are sorted by
   mergesort; two suffixes are compared by binary search for their longest common extension over prefix polynomial hashes, 8 steps
   for 200 bytes, then by one byte. The common extensions of neighbours are verified byte by byte; a collision makes that anchor's rows
   be sorted by their bytes. Windows at one offset are equal if they share the class of both sides, cut from the sorted orders at the
   lengths that the offset asks for; so all members of a group are compared without a pair of them being formed.
4. The spans go back to their documents, whose remaining bytes are hashed.

Defined cases: a null text counts as empty; texts under 200 bytes lose nothing; very long texts are cut into overlapping slices, no window is lost;
repeated rows are copies of each other; null doc_ids are kept as nulls; matches never cross documents; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

LENGTH = 200
GRAM = 64
CHUNK = 1 << 21
_BASE = 0x9E3779B97F4A7C15  # odd, so that its powers have inverses modulo 2^64
_PLACE = np.uint64((1 << 24) - 1)
_NULL_ID = -(2**63)
_SPAN, _RUN, _TEXT = 0, 1, 2


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    out = []
    for b in (_BASE, pow(_BASE, -1, 1 << 64)):
        x = np.full(n, b, np.uint64)
        x[0] = 1
        out.append(np.multiply.accumulate(x))
    return out[0], out[1]


class Hashes:
    """Prefix polynomial hashes of a buffer."""

    def __init__(self, data: np.ndarray):
        n = 1 << max(16, len(data).bit_length())
        power, self.inverse = _powers(n)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, length) -> np.ndarray:
        return (self.sums[start + length] - self.sums[start]) * self.inverse[start]

    def every(self, length: int) -> np.ndarray:
        return (self.sums[length:] - self.sums[:-length]) * self.inverse[: len(self.sums) - length]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def _window_least(x: np.ndarray, w: int) -> np.ndarray:
    """Least of each w consecutive values: blocks of w, running minima from both ends."""
    n = len(x)
    padded = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = x
    blocks = padded.reshape(-1, w)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - w + 1], left[w - 1 : n])


def slices(texts: list[bytes], length: int, chunk: int = CHUNK) -> Iterator[list[tuple[int, int, bytes]]]:
    """Chunks of slices (text, offset, bytes); the slices of a long text overlap by length - 1 bytes, so each window lies in one."""
    own, size = [], 0
    for i, t in enumerate(texts):
        for at in range(0, max(len(t) - length + 1, 0), chunk):
            part = t[at : at + chunk + length - 1]
            if own and size + len(part) > chunk:
                yield own
                own, size = [], 0
            own.append((i, at, part))
            size += len(part)
    if own:
        yield own


def runs(parts: list[tuple[int, int, bytes]], length: int, gram: int) -> tuple[np.ndarray, Hashes, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The buffer of the slices, its hashes, and of each run of windows with one anchor: slice, first window, windows, anchor's place, anchor's hash."""
    size = np.array([len(p) for _, _, p in parts], np.int64)
    end = np.cumsum(size)
    data = np.frombuffer(b"".join(p for _, _, p in parts), np.uint8)
    hashes = Hashes(data)
    grams = _mixed(hashes.every(gram))
    least = _window_least((grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64), length - gram + 1)
    anchor = (least & _PLACE).astype(np.int64)
    count = size - length + 1  # every slice has a window
    first = np.repeat(end - size - (np.cumsum(count) - count), count)
    place = np.arange(len(first)) + first
    anchor = anchor[place]
    start = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (place[1:] != place[:-1] + 1)])
    n = np.diff(np.r_[start, len(place)])
    which = np.searchsorted(end, place[start], side="right")
    at = anchor[start]
    return data, hashes, which, place[start], n, at, grams[at]


def _ragged(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    row = np.repeat(np.arange(len(count)), count)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)


class Suffixes:
    """Strings in one buffer, sorted within groups by mergesort with comparisons by hash."""

    def __init__(self, data: np.ndarray, start: np.ndarray, size: np.ndarray):
        self.data, self.start, self.size = data, start, size
        self.hashes = Hashes(data)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Lengths of the longest common extensions, by binary search over the hashes."""
        x, y = self.start[a], self.start[b]
        low, high = np.zeros(len(a), np.int64), np.minimum(self.size[a], self.size[b])
        for _ in range(int(high.max(initial=0)).bit_length()):
            mid = (low + high + 1) >> 1
            same = self.hashes.of(x, mid) == self.hashes.of(y, mid)
            low, high = np.where(same, mid, low), np.where(same, high, np.minimum(mid - 1, high))
            high = np.maximum(low, high)
        return low

    def less(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        shared = self.common(a, b)
        over_a, over_b = shared >= self.size[a], shared >= self.size[b]
        top = len(self.data) - 1
        return np.where(over_b, False, np.where(over_a, True, self.data[np.minimum(self.start[a] + shared, top)] < self.data[np.minimum(self.start[b] + shared, top)]))

    def sort(self, first: np.ndarray, count: np.ndarray) -> np.ndarray:
        """The order of the strings within each group of rows (first, count): bottom-up mergesort of all groups at once."""
        order = np.arange(len(self.start))
        base, size = np.repeat(first, count), np.repeat(count, count)
        local = order - base
        width = 1
        while width < count.max(initial=0):
            live = np.flatnonzero(size > width)
            run = local[live] // width
            other = run ^ 1
            low = np.minimum(other * width, size[live])
            high = np.minimum(low + width, size[live])
            begin = low.copy()
            own = order[live]
            later = run & 1 == 1  # equal strings keep their order: those of the right run come after
            while (todo := np.flatnonzero(low < high)).size:
                mid = (low[todo] + high[todo]) >> 1
                there = order[base[live[todo]] + mid]
                left = np.where(later[todo], ~self.less(own[todo], there), self.less(there, own[todo]))
                low[todo] = np.where(left, mid + 1, low[todo])
                high[todo] = np.where(left, high[todo], mid)
            to = base[live] + np.minimum(run, other) * width + (local[live] - run * width) + (low - begin)
            moved = order.copy()
            moved[to] = own
            order = moved
            width *= 2
        return order

    def sorted_with_common(self, first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The order and each string's common extension with the one before it in its group (-1: none), verified by the bytes."""
        order = self.sort(first, count)
        shared = np.full(len(order), -1)
        inner = np.ones(len(order), bool)
        inner[first] = False
        at = np.flatnonzero(inner)
        shared[at] = self.common(order[at], order[at - 1])
        row, j = _ragged(shared[at])
        wrong = self.data[self.start[order[at]][row] + j] != self.data[self.start[order[at - 1]][row] + j]
        if wrong.any():  # a collision: sort these groups by their bytes
            whole = self.data.tobytes()
            text = lambda i: whole[self.start[i] : self.start[i] + self.size[i]]
            for g in np.unique(np.searchsorted(first, at[row[wrong]], side="right") - 1):
                a, n = first[g], count[g]
                order[a : a + n] = sorted(range(a, a + n), key=text)
                for k in range(a + 1, a + n):
                    x, y = text(order[k - 1]), text(order[k])
                    shared[k] = next((i for i, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), min(len(x), len(y)))
        return order, shared


def repeated_windows(segments: list[bytes], group: np.ndarray, offset: np.ndarray, windows: np.ndarray, weight: np.ndarray, length: int) -> np.ndarray:
    """For rows ordered by group: flags[row, j], is the row's j-th window repeated?

    The row's bytes are segments[row]; its anchor lies at offset from its first window. A row of weight 2 counts as two.
    """
    size = np.fromiter(map(len, segments), np.int64, len(segments))
    data = np.frombuffer(b"".join(segments), np.uint8)
    begin = np.cumsum(size) - size
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    count = np.diff(np.r_[first, len(group)])
    right, right_common = Suffixes(data, begin + offset, np.minimum(size - offset, length)).sorted_with_common(first, count)
    left, left_common = Suffixes(data[::-1].copy(), len(data) - begin - offset, offset).sorted_with_common(first, count)
    right_rank, left_rank = np.empty_like(right), np.empty_like(left)
    right_rank[right] = np.arange(len(right))
    left_rank[left] = np.arange(len(left))
    flags = np.zeros((len(segments), int(windows.max(initial=1))), bool)
    for d in range(int(offset.max(initial=0)) + 1):
        has = np.flatnonzero((offset >= d) & (offset - windows < d))
        if not len(has):
            continue
        a = np.cumsum(right_common < length - d)[right_rank[has]]
        b = np.cumsum(left_common < d)[left_rank[has]]
        key = a * (len(segments) + 1) + b
        order = np.argsort(key, kind="stable")
        cut = np.flatnonzero(np.r_[True, key[order][1:] != key[order][:-1]])
        total = np.add.reduceat(weight[has[order]], cut)
        often = np.repeat(total >= 2, np.diff(np.r_[cut, len(order)]))
        hit = has[order[often]]
        flags[hit, offset[hit] - d] = True
    return flags


def _documents(docs: DataFrame) -> DataFrame:
    text = common.text_or_empty()
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("id"), F.xxhash64(text).alias("t"), text.cast("binary").alias("text"))


def anchors(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """id, t, n_bytes, sha256 and the anchors' hashes (each at most twice) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                texts = batch.column("text").to_pylist()
                doc, found = [], []
                for parts in slices(texts, length):
                    _, _, which, _, _, _, h = runs(parts, length, gram)
                    doc.append(np.array([p[0] for p in parts])[which])
                    found.append(h)
                doc = np.concatenate([np.zeros(0, np.int64), *doc])
                h = np.concatenate([np.zeros(0, np.uint64), *found])
                order = np.lexsort((h, doc))
                doc, h = doc[order], h[order]
                third = np.zeros(len(h), bool)
                third[2:] = (h[2:] == h[:-2]) & (doc[2:] == doc[:-2])
                doc, h = doc[~third], h[~third]
                ends = np.searchsorted(doc, np.arange(len(texts) + 1))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(h.view(np.int64)))
                sha = pa.array([hashlib.sha256(t).hexdigest() for t in texts])
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("t"), pa.array([len(t) for t in texts], pa.int64()), sha, lists], names=["id", "t", "n_bytes", "sha256", "hashes"])

    return rows.mapInArrow(run, "id long, t long, n_bytes long, sha256 string, hashes array<long>")


_ROW = "h long, id long, t long, kind int, a long, n int, d int, weight int, body binary"


def _rows(cols: list[list]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=[x.split()[0] for x in _ROW.split(", ")])


def segments(candidates: DataFrame, length: int, gram: int) -> DataFrame:
    """Of documents with their anchors that occur elsewhere (id, t, text, hashes): runs of windows, spans known already, packed texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for whole in batches:
            for begin in range(0, whole.num_rows, 1024):
                batch = whole.slice(begin, 1024)
                texts = batch.column("text").to_pylist()
                ids, ts = batch.column("id").to_pylist(), batch.column("t").to_pylist()
                salt = np.arange(len(texts), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                lists = batch.column("hashes")
                wanted = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64) + np.repeat(salt, lists.value_lengths().to_numpy(zero_copy_only=False))
                out: list[list] = [[] for _ in range(9)]

                def add(h, i, kind, a, n, d, weight, body):
                    for c, v in zip(out, (h, ids[i], ts[i], kind, a, n, d, weight, body), strict=True):
                        c.append(v)

                for i, t in enumerate(texts):
                    add(ts[i], i, _TEXT, 0, 0, 0, 0, packer.compress(t))
                for parts in slices(texts, length):
                    data, hashes, which, first, n, at, h = runs(parts, length, gram)
                    doc = np.array([p[0] for p in parts])
                    shift = np.array([p[1] for p in parts]) - (np.cumsum([len(p[2]) for p in parts]) - [len(p[2]) for p in parts])
                    keep = np.isin(h + salt[doc[which]], wanted)
                    which, first, n, at, h = (x[keep] for x in (which, first, n, at, h))
                    size = n + (length - 1)
                    look = hashes.of(first, size)
                    order = np.lexsort((size, at - first, look, h))
                    new = np.ones(len(order), bool)
                    x, y = order[1:], order[:-1]
                    new[1:] = (h[x] != h[y]) | (look[x] != look[y]) | (size[x] != size[y]) | (at[x] - first[x] != at[y] - first[y])
                    buffer = data.tobytes()
                    start = np.flatnonzero(new)
                    local: list[tuple[int, int, int]] = []
                    for a, b in zip(start.tolist(), np.r_[start[1:], len(order)].tolist(), strict=True):
                        fold: dict[bytes, list[int]] = {}  # by the bytes: usually one entry
                        for k in order[a:b].tolist():
                            fold.setdefault(buffer[first[k] : first[k] + size[k]], []).append(k)
                        for body, own in fold.items():
                            k = own[0]
                            add(int(h.view(np.int64)[k]), int(doc[which[k]]), _RUN, int(first[k] + shift[which[k]]), int(n[k]), int(at[k] - first[k]), min(len(own), 2), body)
                            if len(own) > 1:
                                local += [(int(doc[which[k]]), int(first[k] + shift[which[k]]), int(size[k])) for k in own]
                    at_end: dict[int, tuple[int, int]] = {}
                    for i, a, s in sorted(local):  # neighbouring runs become one span
                        if i in at_end and a <= at_end[i][1]:
                            at_end[i] = (at_end[i][0], max(at_end[i][1], a + s))
                        else:
                            if i in at_end:
                                add(ts[i], i, _SPAN, at_end[i][0], at_end[i][1] - at_end[i][0], 0, 0, None)
                            at_end[i] = (a, a + s)
                    for i, (a, b) in at_end.items():
                        add(ts[i], i, _SPAN, a, b - a, 0, 0, None)
                yield _rows(out)

    return candidates.mapInArrow(run, _ROW)


def _complete(batches: Iterator[pa.RecordBatch], keys: list[str], least: int = 0) -> Iterator[pa.Table]:
    """Tables in which every group of equal keys is whole; the rows come ordered by the keys."""
    kept: list[pa.RecordBatch] = []
    held = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        kept.append(batch)
        held += batch.nbytes
        if held < least:
            continue
        table = pa.Table.from_batches(kept)
        last = np.ones(table.num_rows, bool)
        for k in keys:
            x = table.column(k).to_numpy()
            last &= x == x[-1]
        cut = table.num_rows - int(last.sum())
        if cut:
            yield table.slice(0, cut)
            kept = table.slice(cut).to_batches()
            held = sum(b.nbytes for b in kept) if len(kept) < 64 else least
    if kept:
        yield pa.Table.from_batches(kept)


def spans(dealt: DataFrame, length: int) -> DataFrame:
    """Of rows dealt by anchor and ordered by it: every span to remove; spans and texts pass through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _complete(batches, ["h"], 4 << 20):
            kind = table.column("kind").to_numpy()
            through = table.filter(pa.array(kind != _RUN)).select(["id", "t", "kind", "a", "n", "body"]).combine_chunks()
            yield from through.to_batches()
            rows = table.filter(pa.array(kind == _RUN))
            h = rows.column("h").to_numpy()
            if not len(h):
                continue
            first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
            count = np.diff(np.r_[first, len(h)])
            busy = np.repeat(count > 1, count)  # a single row knows its repeats already
            if not busy.any():
                continue
            rows, h = rows.filter(pa.array(busy)), h[busy]
            a, n, d, weight, ids, ts = (rows.column(c).to_numpy().astype(np.int64) for c in ("a", "n", "d", "weight", "id", "t"))
            body = rows.column("body").to_pylist()
            fold: dict[tuple, int] = {}  # rows with equal bytes are one, with the weights' sum
            to = np.array([fold.setdefault(k, len(fold)) for k in zip(h.tolist(), d.tolist(), body, strict=True)])
            one = np.zeros(len(fold), np.int64)
            one[to[::-1]] = np.arange(len(to))[::-1]
            total = np.bincount(to, weight).astype(np.int64)
            flags = repeated_windows([body[i] for i in one], h[one], d[one], n[one], np.minimum(total, 2), length)
            edge = np.diff(np.pad(flags, ((0, 0), (1, 1))).astype(np.int8), axis=1)
            row, begin = np.nonzero(edge == 1)
            _, end = np.nonzero(edge == -1)
            many = np.bincount(row, minlength=len(fold))
            where = np.cumsum(many) - many
            need = np.flatnonzero((weight < 2) & (many[to] > 0))  # rows of weight 2 were answered in their chunk
            pick, j = _ragged(many[to[need]])
            k = where[to[need[pick]]] + j
            src = need[pick]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[src]), pa.array(ts[src]), pa.array(np.full(len(src), _SPAN, np.int32)), pa.array(a[src] + begin[k]), pa.array((end[k] - begin[k] + length - 1).astype(np.int32)), pa.nulls(len(src), pa.binary())],
                names=["id", "t", "kind", "a", "n", "body"],
            )

    return dealt.mapInArrow(run, "id long, t long, kind int, a long, n int, body binary")


def merged(found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs (start, end) of the union."""
    out: list[list[int]] = []
    for a, b in sorted(found):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def without(text: bytes, gone: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for a, b in gone:
        out.append(text[at:a])
        at = b
    return b"".join([*out, text[at:]])


def dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, texts: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and, if asked for, the remaining text and the spans) of every document."""
    if not 0 < gram < length:
        raise ValueError("a gram must be shorter than the strings")
    rows = _documents(docs)
    known = common.stage(anchors(rows, length, gram), "anchors")
    flat = known.select("id", "t", F.explode("hashes").alias("h"))
    often = flat.groupBy("h").agg(F.count("*").alias("c")).where("c > 1").select("h")
    wanted = common.stage(flat.join(often, "h").groupBy("id", "t").agg(F.collect_set("h").alias("hashes")), "wanted")
    dealt = segments(rows.join(wanted.hint("shuffle_hash"), ["id", "t"]).select("id", "t", "text", "hashes"), length, gram)
    found = spans(dealt.repartition("h").sortWithinPartitions("h"), length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        for table in _complete(batches, ["id", "t"]):
            cols: list[list] = [[] for _ in range(8)]
            gone: list[tuple[int, int]] = []
            last = None
            for i, t, kind, a, n, body in zip(*(table.column(c).to_pylist() for c in ("id", "t", "kind", "a", "n", "body")), strict=True):
                if (i, t) != last:
                    gone, last = [], (i, t)
                if kind == _SPAN:  # spans come before the texts
                    gone.append((a, a + n))
                    continue
                text = unpacker.decompress(body)
                cut = merged(gone)
                kept = without(text, cut)
                for c, v in zip(cols, (i, t, len(text), len(text) - len(kept), len(cut), hashlib.sha256(kept).hexdigest(), kept if texts else None, [list(s) for s in cut] if texts else None), strict=True):
                    c.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.list_(pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["id", "t", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"])

    schema = "id long, t long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, spans array<array<long>>"
    hit = found.repartition("id", "t").sortWithinPartitions("id", "t", "kind").mapInArrow(run, schema)
    free = known.join(wanted.select("id", "t"), ["id", "t"], "left_anti")
    free = free.select("id", "t", "n_bytes", F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.col("sha256").alias("kept_sha256"))
    if texts:
        free = free.join(rows, ["id", "t"]).dropDuplicates(["id", "t"]).select(*free.columns, F.col("text").alias("kept"), F.array().cast("array<array<bigint>>").alias("spans"))
    out = hit.select(*free.columns).unionByName(free)
    return out.select(F.when(F.col("id") != _NULL_ID, F.col("id")).alias("doc_id"), *[c for c in out.columns if c not in ("id", "t")])


def op1_suffix_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(common.read_documents(spark, sf_dir))


QUERIES = {"op1_suffix_sort": op1_suffix_sort}
ORACLES: dict[str, str] = {}
