"""SentencePiece encoding and decoding of BPE models by vectorised merge rounds.

The model file is read here (pieces, scores, kinds, normaliser flags); the sentencepiece library is not used on this path. A text is
escaped and cut into words at places that no piece of the vocabulary crosses, so words are merged independently. The distinct new words of
a batch lie in flat numpy arrays of symbols. In every round each word finds the least rank among its neighbouring pairs
(segmented minimum) and merges that pair at its leftmost place; where no piece made by a later merge can come before it, at all its
places at once, leftmost first. The arrays are then compacted, and words without a mergeable pair leave. That is the order of the
sequential algorithm, word by word. Long runs of blanks allow only one merge a round (their pieces all have one rank): the few words that are left
after a fixed number of rounds are finished by a heap, in n log n. Words are remembered within a task, up to a fixed number of bytes.

Defined cases: a null text counts as empty and has no ids; very long texts and words without a blank take the same path, in
rounds; ties in rank go to the leftmost pair; repeated rows are encoded alike; an empty table gives an empty result;
further columns are ignored. Characters outside the vocabulary become their UTF-8 bytes, as the model's byte fallback says.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from functools import cache, cached_property
from heapq import heappop, heappush
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

SPACE = "▁"  # fixed value: the sign that stands for a blank
# Kinds of pieces in the model file.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: The most bytes of remembered words, and the most characters of a word that is remembered.
MEMO_BYTES, MEMO_WORD = 256 << 20, 64
_ENTRY = 420  # what a word, its entry and its place in the table take, but for the ids
_NONE = np.int64(1 << 40)
#: After so many rounds what is left (long runs whose pairs must be merged from left to right one at a time) is merged from a heap.
ROUNDS = 200


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of each field of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while at < len(data):
        key = varint()
        wire = key & 7
        if wire == 0:
            value: object = varint()
        elif wire == 5:
            value, at = struct.unpack_from("<f", data, at)[0], at + 4
        elif wire == 1:
            value, at = data[at : at + 8], at + 8
        else:
            n = varint()
            value, at = data[at : at + n], at + n
        yield key >> 3, value


def _runs(word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word's symbols."""
    first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
    return first, np.r_[first[1:], len(word)]


class Model:
    """A BPE model and its merge tables."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            data = f.read()
        self.pieces: list[tuple[str, float, int]] = []
        self.dummy_prefix = self.squeeze = self.escape = True
        kind_of_model, charsmap, self.fallback = 1, b"", False
        for number, value in _fields(data):
            if number == 1:
                own = dict(_fields(value))
                self.pieces.append((own.get(1, b"").decode(), own.get(2, 0.0), own.get(3, NORMAL)))
            elif number == 2:
                for k, v in _fields(value):
                    kind_of_model = v if k == 3 else kind_of_model
                    self.fallback = bool(v) if k == 35 else self.fallback
            elif number == 3:
                for k, v in _fields(value):
                    charsmap = v if k == 2 else charsmap
                    self.dummy_prefix = bool(v) if k == 3 else self.dummy_prefix
                    self.squeeze = bool(v) if k == 4 else self.squeeze
                    self.escape = bool(v) if k == 5 else self.escape
        kinds = {k for _, _, k in self.pieces}
        if kind_of_model != 2 or charsmap or self.squeeze or not self.escape or kinds & {USER, UNUSED}:
            raise ValueError(f"{path}: only BPE models without a character map, squeezing, user pieces and unused pieces are read")
        self.unknown = next(i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN)
        self.byte_id = {int(p[0][3:5], 16): i for i, p in enumerate(self.pieces) if p[2] == BYTE}
        self._tables()

    def _tables(self) -> None:
        normal = {p: (i, s) for i, (p, s, k) in enumerate(self.pieces) if k == NORMAL}
        symbol = {p: i for p, (i, _) in normal.items()}
        for p in list(normal):  # single characters that occur within pieces but are none themselves
            for c in p:
                symbol.setdefault(c, len(self.pieces) + len(symbol))
        self.symbol = symbol
        levels = sorted({s for _, s in normal.values()}, reverse=True)
        rank_of = {s: i for i, s in enumerate(levels)}
        rank = {p: rank_of[s] for p, (_, s) in normal.items()}
        self.width = 1 + max(symbol.values())
        keys, ranks, merged, unsafe = [], [], [], set()
        for p, (i, _) in normal.items():
            for cut in range(1, len(p)):
                left, right = p[:cut], p[cut:]
                if left in symbol and right in symbol:
                    keys.append(symbol[left] * self.width + symbol[right])
                    ranks.append(rank[p])
                    merged.append(i)
                    unsafe.update(symbol[x] for x in (left, right) if x in rank and len(x) > 1 and rank[x] >= rank[p])
        order = np.argsort(np.array(keys, np.int64))
        self.keys = np.array(keys, np.int64)[order]
        self.ranks = np.array(ranks, np.int64)[order]
        self.merged = np.array(merged, np.int64)[order]
        self.unsafe = np.zeros(self.width + 1, bool)
        self.unsafe[list(unsafe)] = True
        # words begin at a blank sign after another character, and around characters that no longer piece holds
        self.inside = {c for p in normal if len(p) > 1 for c in p}
        crossing = any(SPACE in p.lstrip(SPACE) for p in normal)
        alone = "".join(sorted(c for c in "\n\t\r" if c not in self.inside))
        self.cut = re.compile(rf"[{alone}]|{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" if alone else rf"{SPACE}*[^{SPACE}]+|{SPACE}+") if not crossing else re.compile(r"(?s).+")

    def words(self, text: str) -> list[str]:
        if not text:
            return []
        return self.cut.findall((SPACE if self.dummy_prefix else "") + text.replace(" ", SPACE))

    def _pairs(self, s: np.ndarray, word: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged id of the symbols at these places with their successors in the word."""
        rank, into = np.full(len(at), _NONE), np.zeros(len(at), np.int64)
        after = np.minimum(at + 1, len(s) - 1)
        left, right = s[at], s[after]
        pair = np.flatnonzero((after > at) & (word[after] == word[at]) & (left >= 0) & (right >= 0))
        key = left[pair] * self.width + right[pair]
        found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[found] == key
        rank[pair[hit]] = self.ranks[found[hit]]
        into[pair[hit]] = self.merged[found[hit]]
        return rank, into

    @cached_property
    def _table(self) -> dict[int, tuple[int, int]]:
        return dict(zip(self.keys.tolist(), zip(self.ranks.tolist(), self.merged.tolist(), strict=True), strict=True))

    def _one_by_one(self, s: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Places and ids of the symbols that are left of one word, merged pair by pair from a heap (rank, place)."""
        after, before = [*range(1, len(s)), -1], [*range(-1, len(s) - 1)]
        alive = [True] * len(s)
        waiting: list[tuple[int, int, int, int]] = []

        def offer(i: int, j: int) -> None:
            if s[i] >= 0 and s[j] >= 0 and (found := self._table.get(s[i] * self.width + s[j])):
                heappush(waiting, (found[0], i, s[i], s[j]))

        for i in range(len(s) - 1):
            offer(i, i + 1)
        while waiting:
            _, i, left, right = heappop(waiting)
            j = after[i]
            if not alive[i] or j < 0 or (s[i], s[j]) != (left, right):
                continue  # one of the two was merged before
            s[i] = self._table[left * self.width + right][1]
            alive[j] = False
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                offer(i, k)
            if before[i] >= 0:
                offer(before[i], i)
        place = np.flatnonzero(alive)
        return place, np.array(s, np.int64)[place]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """The ids of each word, all words merged together in rounds."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        chars = "".join(words)
        points = np.frombuffer(chars.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        known, back = np.unique(points, return_inverse=True)
        s = np.array([self.symbol.get(chr(c), -1) for c in known.tolist()], np.int64)[back] if len(known) else points
        word = np.repeat(np.arange(len(words)), size)
        raw = points  # the character of a symbol that is no piece
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        rank, into = self._pairs(s, word, np.arange(len(s)))
        for turn in count():
            if not len(s):
                break
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            least = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.r_[first, len(s)]))
            over = least == _NONE
            if over.any():
                done.append((word[over], s[over], raw[over]))
                s, word, raw, rank, into, least = (x[~over] for x in (s, word, raw, rank, into, least))
                if not len(s):
                    break
            if turn == ROUNDS:
                for a, b in zip(*(x.tolist() for x in _runs(word)), strict=True):
                    place, own = self._one_by_one(s[a:b].tolist())
                    done.append((word[a:b][place], own, raw[a:b][place]))
                break
            at = np.flatnonzero(rank == least)
            # of a word's places only the leftmost, if a piece made from the merged one may come before it; else all that make the same piece
            lead = np.r_[True, word[at[1:]] != word[at[:-1]]]
            leader = np.maximum.accumulate(np.where(lead, np.arange(len(at)), 0))
            ok = lead | ((into[at] == into[at[leader]]) & ~self.unsafe[into[at]])
            # of overlapping places (each starts where the one before ends) every other one
            chain = np.r_[False, (at[1:] == at[:-1] + 1) & (word[at[1:]] == word[at[:-1]])] & ok
            start = np.maximum.accumulate(np.where(~chain, np.arange(len(at)), 0))
            at = at[ok & ((np.arange(len(at)) - start) % 2 == 0)]
            s[at] = into[at]
            keep = np.ones(len(s), bool)
            keep[at + 1] = False
            at -= np.arange(len(at))  # where they are after the compaction
            s, word, raw, rank, into = s[keep], word[keep], raw[keep], rank[keep], into[keep]
            touched = np.concatenate((at, at[at > 0] - 1))
            rank[touched], into[touched] = self._pairs(s, word, touched)
        out: list[list[int]] = [[] for _ in words]
        if done:
            word, s, raw = (np.concatenate(x) for x in zip(*done, strict=True))
            order = np.argsort(word, kind="stable")
            for w, i, c in zip(word[order].tolist(), s[order].tolist(), raw[order].tolist(), strict=True):
                if 0 <= i < len(self.pieces):
                    out[w].append(i)
                elif self.fallback:
                    out[w] += [self.byte_id[b] for b in chr(c).encode("utf-8", "surrogatepass")]
                else:
                    out[w].append(self.unknown)
        return out

    def decode_word(self, ids: list[int]) -> str:
        """The text of ids within a text: pieces joined, blank signs as blanks, runs of bytes as UTF-8."""
        parts, run = [], bytearray()
        for i in ids:
            piece, _, kind = self.pieces[i]
            if kind == BYTE:
                run.append(int(piece[3:5], 16))
                continue
            if run:
                parts.append(run.decode("utf-8", "replace"))
                run = bytearray()
            if kind != CONTROL:
                parts.append(" \u2047 " if kind == UNKNOWN else piece.replace(SPACE, " "))
        parts.append(run.decode("utf-8", "replace"))
        return "".join(parts)

    def decode(self, ids: list[int]) -> str:
        """The text of ids: as decode_word, without the blank of the dummy prefix."""
        first = next((i for i in ids if self.pieces[i][2] != CONTROL), None)
        dropped = self.dummy_prefix and first is not None and self.pieces[first][2] == NORMAL and self.pieces[first][0].startswith(SPACE)
        return self.decode_word(ids)[dropped:]


@cache
def model(path: str) -> Model:
    return Model(path)


class Memo:
    """Distinct words of a task with the number of their ids, the ids as text, and the ids decoded.

    Bounded in bytes: long words (a text without blanks is one) are not remembered, and what is remembered is dropped when it has grown to MEMO_BYTES.
    """

    def __init__(self, path: str):
        self.model, self.known, self.held = model(path), {}, 0

    def look_up(self, texts: list[list[str]]) -> list[list[tuple[int, str, str]]]:
        if self.held > MEMO_BYTES:
            self.known, self.held = {}, 0
        new = list({w for t in texts for w in t} - self.known.keys())
        back, long = self.model.decode_word, {}
        for w, ids in zip(new, self.model.encode_words(new), strict=True):
            entry = (len(ids), ",".join(map(str, ids)), back(ids))
            if len(w) > MEMO_WORD:
                long[w] = entry
            else:
                self.known[w] = entry
                self.held += _ENTRY + len(entry[1])
        if not long:
            return [[self.known[w] for w in t] for t in texts]
        return [[long[w] if len(w) > MEMO_WORD else self.known[w] for w in t] for t in texts]


@cache
def memo(path: str) -> Memo:
    return Memo(path)


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and ids (array of int) of every document."""
    path = path or default_model()
    schema = T.StructType([docs.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = memo(path)
        for batch in common.slices(batches):
            found = words.look_up([words.model.words(t or "") for t in batch.column("text").to_pylist()])
            ids = pa.array([[int(i) for f in t for i in f[1].split(",")] for t in found], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], names=schema.names)

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def digest(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document, encoded and decoded again in one pass."""
    path = path or default_model()
    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = memo(path)
        sha = lambda x: hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest()
        for batch in common.slices(batches):
            found = words.look_up([words.model.words(t or "") for t in batch.column("text").to_pylist()])
            n = [sum([f[0] for f in t]) for t in found]
            ids = [sha(",".join([f[1] for f in t])) for t in found]
            # a text's first word begins with the dummy prefix, whose blank decoding drops
            back = [sha("".join([f[2] for f in t])[words.model.dummy_prefix and bool(t) :]) for t in found]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())], names=schema.names)

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def op6_merge_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(common.read_documents(spark, sf_dir))


QUERIES = {"op6_merge_rounds": op6_merge_rounds}
ORACLES: dict[str, str] = {}
