"""Sharding by fixed virtual slots (DataFrame functions only).

Every record is hashed into one of a few thousand virtual slots. Bytes and rows are added up per slot, which gives a table
whose size is the number of slots, whatever the input. A versioned map gives each slot a shard: version 0 deals the slots out
in turn, and a rebalancing edits the map before it into the next version by moving few slots from heavy shards to light ones, until they
are within a bound of each other. Rows follow their slot, so a change of the map names exactly the slots that move. Within a shard, a row's place is the slot's first place plus its rank
in the slot: ranks need one sort per slot, never one per shard.

Defined cases: a null text counts as empty (size 16, crc32 of nothing); null doc_ids are placed like any other, by their text;
repeated rows share a slot and get different places; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from . import common

SLOTS = 4096
SHARDS = 40
ROW_BYTES = 16
#: The largest difference between two shards, as a share of their mean, that needs no move.
SPREAD = 0.005


@dataclass(frozen=True)
class SlotMap:
    """Which shard holds each virtual slot; a change makes a new version."""

    version: int
    shards: int
    shard_of: tuple[int, ...]

    @staticmethod
    def first(slots: int = SLOTS, shards: int = SHARDS) -> SlotMap:
        return SlotMap(0, shards, tuple(s % shards for s in range(slots)))

    def rebalanced(self, load: dict[int, int], shards: int | None = None, spread: float = SPREAD) -> SlotMap:
        """The next version for the slots' loads: this one, edited by as few moves as bring the shards within `spread` of their mean, if slots can do that.

        Slots of shards that are given up go to the lightest shard, heaviest first. Then the heaviest shard gives the lightest the slot nearest to
        half their difference, which is the most that one move can do, or where its slots are all as large as the difference, one in exchange for
        another. A shard that cannot do either gives no more.
        """
        shards = shards or self.shards
        shard_of = list(self.shard_of)
        total = [0] * shards
        own: list[list[tuple[int, int]]] = [[] for _ in range(shards)]  # (load, slot), ascending
        homeless = []
        for slot, s in enumerate(shard_of):
            x = load.get(slot, 0)
            if s >= shards:
                homeless.append((x, slot))
            else:
                total[s] += x
                own[s].append((x, slot))
        for each in own:
            each.sort()

        def put(x: int, slot: int, s: int) -> None:
            shard_of[slot] = s
            total[s] += x
            insort(own[s], (x, slot))

        for x, slot in sorted(homeless, key=lambda i: (-i[0], i[1])):
            put(x, slot, min(range(shards), key=lambda s: (total[s], len(own[s]), s)))
        givers = set(range(shards))
        while givers:
            high, low = max(givers, key=lambda s: (total[s], -s)), min(range(shards), key=lambda s: (total[s], s))
            gap = total[high] - total[low]
            if gap * shards <= spread * sum(total):
                break
            best = None  # (distance from half the gap, slots to give, slots to take)
            for y in [(0, -1), *own[low]]:  # a slot for none, or if none fits, for one of the lightest shard's
                if best and y[1] >= 0:
                    break
                i = bisect_left(own[high], (y[0] + gap / 2, 0))
                for x in own[high][max(i - 1, 0) : i + 1]:
                    if 0 < x[0] - y[0] < gap and (best is None or abs(x[0] - y[0] - gap / 2) < best[0]):
                        best = abs(x[0] - y[0] - gap / 2), x, y
            if best is None:
                givers.discard(high)
                continue
            for (load_of, slot), here, there in ((best[1], high, low), (best[2], low, high)):
                if slot >= 0:
                    own[here].remove((load_of, slot))
                    total[here] -= load_of
                    put(load_of, slot, there)
        return SlotMap(self.version + 1, shards, tuple(shard_of))

    def moved(self, other: SlotMap) -> list[int]:
        return [s for s, (a, b) in enumerate(zip(self.shard_of, other.shard_of, strict=True)) if a != b]

    def column(self, slot: Column) -> Column:
        return F.element_at(F.split(F.lit(",".join(map(str, self.shard_of))), ",").cast("array<int>"), slot + 1)

    def frame(self, spark: SparkSession) -> DataFrame:
        """The map as rows (version, slot, shard)."""
        slot = F.col("id").cast("int")
        return spark.range(len(self.shard_of)).select(F.lit(self.version).alias("version"), slot.alias("slot"), self.column(slot).alias("shard"))

    def save(self, spark: SparkSession, path: str) -> None:
        self.frame(spark).coalesce(1).write.mode("append").partitionBy("version").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str, version: int | None = None) -> SlotMap:
        """A stored version, the last one unless it is named."""
        found = spark.read.schema("slot int, shard int, version int").parquet(path)
        version = found.agg(F.max("version")).first()[0] if version is None else version
        rows = sorted((r.slot, r.shard) for r in found.where(F.col("version") == version).select("slot", "shard").collect())
        return SlotMap(version, max(s for _, s in rows) + 1, tuple(s for _, s in rows))


def slot_of(key: Column, text: Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(key, text), F.lit(slots)).cast("int")


def shard(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, map_path: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, virtual_slot, map_version, shard and place (gapless in its shard) of every document.

    The map's versions are stored under map_path, if given: the last one there is edited, and a new version is added if slots move.
    """
    spark = docs.sparkSession
    text = common.text_or_empty()
    rows = common.stage(
        docs.select(
            "doc_id",
            (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            slot_of(F.col("doc_id"), text, slots).alias("virtual_slot"),
        ),
        "slots",
    )
    load = {r.virtual_slot: (r.bytes, r.rows) for r in rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect()}  # at most one row a slot
    stored = map_path is not None and common.exists(spark, map_path)
    old = SlotMap.load(spark, map_path) if stored else SlotMap.first(slots, shards)
    if len(old.shard_of) != slots:
        raise ValueError(f"the stored map has {len(old.shard_of)} slots, not {slots}")
    new = old.rebalanced({s: b for s, (b, _) in load.items()}, shards)
    if new.shard_of == old.shard_of:
        new = old
    if map_path and not stored:
        old.save(spark, map_path)
    if map_path and new is not old:
        new.save(spark, map_path)
    filled, first = [0] * shards, []
    for slot in range(slots):
        first.append(filled[new.shard_of[slot]])
        filled[new.shard_of[slot]] += load.get(slot, (0, 0))[1]
    start = F.element_at(F.split(F.lit(",".join(map(str, first))), ",").cast("array<bigint>"), F.col("virtual_slot") + 1)
    rank = F.row_number().over(W.Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size"))
    return rows.select("doc_id", "size", "text_crc32", "virtual_slot", F.lit(new.version).alias("map_version"), new.column(F.col("virtual_slot")).alias("shard"), (start + rank - 1).alias("place"))


def op4_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard(common.read_documents(spark, sf_dir), map_path=f"{common.shared_dir(spark)}/slot-map-{uuid4().hex}")
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("place").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version")


QUERIES = {"op4_virtual_slots": op4_virtual_slots}
ORACLES: dict[str, str] = {}
