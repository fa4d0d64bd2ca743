"""Sharding, exact dedup and quality rules against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from lodestrata.llm import exact_dedup, quality_rules, references, sharding


def test_sharding(edge, nothing, sample):
    for df in (edge, sample):
        rows = sharding.shard(df, shards=5).collect()
        given = Counter((r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in df.collect())
        assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == given
        places = defaultdict(list)
        for r in rows:
            places[r.shard].append(r.place)
        assert all(sorted(p) == list(range(len(p))) for p in places.values())
    load = Counter()
    for r in rows:
        load[r.shard] += r["size"]
    assert max(load.values()) - min(load.values()) <= max(r["size"] for r in rows)
    assert sharding.shard(nothing).count() == 0


def test_slot_map_versions(spark, tmp_path):
    old = sharding.SlotMap.first(64, 4)
    new = old.rebalanced({s: s for s in range(64)})
    assert new.version == 1
    assert set(new.shard_of) == {0, 1, 2, 3}
    assert len(new.moved(old)) <= 6
    for m in (old, new):
        m.save(spark, str(tmp_path / "map"))
    assert sharding.SlotMap.load(spark, str(tmp_path / "map")) == new
    assert sharding.SlotMap.load(spark, str(tmp_path / "map"), 0) == old
    assert new.moved(old) == [s for s in range(64) if new.shard_of[s] != old.shard_of[s]]


def test_rebalancing_moves_few_slots():
    rng = random.Random(9)
    load = {s: sum(int(800 * rng.paretovariate(1.6)) for _ in range(12)) for s in range(4096)}

    def spread(m):
        total = [0] * m.shards
        for slot, s in enumerate(m.shard_of):
            total[s] += load.get(slot, 0)
        return (max(total) - min(total)) * m.shards / sum(total)

    first = sharding.SlotMap.first()
    second = first.rebalanced(load)
    assert spread(second) <= sharding.SPREAD < spread(first)
    assert len(second.moved(first)) < 200
    assert second.rebalanced(load).shard_of == second.shard_of
    load[17] += 3 * 12 * 800
    third = second.rebalanced(load)
    assert spread(third) <= sharding.SPREAD
    assert len(third.moved(second)) <= 10
    wider, narrower = third.rebalanced(load, 41), third.rebalanced(load, 38)
    assert max(wider.shard_of) == 40
    assert max(narrower.shard_of) == 37
    assert len(wider.moved(third)) <= 150
    assert len(narrower.moved(third)) <= 2 * 4096 // 40 + 150
    assert spread(wider) <= 2 * sharding.SPREAD


def test_the_stored_map_is_edited(spark, sample, tmp_path):
    path = str(tmp_path / "map")
    one = sharding.shard(sample, 5, 256, path)
    assert {r.map_version for r in one.select("map_version").distinct().collect()} == {1}
    again = sharding.shard(sample, 5, 256, path)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, one.collect()))
    more = sharding.shard(sample.unionByName(sample.limit(20)), 5, 256, path)
    before, after = sharding.SlotMap.load(spark, path, 1), sharding.SlotMap.load(spark, path)
    assert more.select("map_version").first()[0] == after.version == 2
    assert 0 < len(after.moved(before)) < 64


def brute_exact(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[re.sub("[\x20\x09-\x0d]", "", r.text or "")].append(r)
    out = []
    for body, own in groups.items():
        best = min(own, key=lambda r: (-len(r.text or ""), r.doc_id is None, r.doc_id or 0))
        for i, r in enumerate(sorted(own, key=lambda r: (r.doc_id != best.doc_id, len(r.text or "") != len(best.text or "")))):
            kept = i == 0  # of rows alike one stays
            out.append((r.doc_id, best.doc_id, len(own), kept, hashlib.sha256(body.encode()).hexdigest()))
    return Counter(out)


def test_exact_dedup(edge, nothing, sample):
    for df in (edge, sample):
        assert Counter(tuple(r) for r in exact_dedup.dedup(df).collect()) == brute_exact(df.collect())
    assert exact_dedup.dedup(nothing).count() == 0


def test_exact_dedup_keeps_one_row(spark):
    rows = [(1, "a b"), (1, "a b"), (1, "ab"), (2, "a b"), (None, "c"), (None, "c"), (None, "c "), (None, "c "), (5, "d")]
    out = exact_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in out if r.kept) == Counter([(1, 1, 4), (None, None, 4), (5, 5, 1)])
    assert len(out) == len(rows)


def test_exact_dedup_survives_collisions(edge):
    weak = lambda c: F.unhex(F.substring(F.md5(c.cast("binary")), 1, 0))  # noqa: E731  every text has the same hash
    assert Counter(tuple(r) for r in exact_dedup.dedup(edge, weak).collect()) == brute_exact(edge.collect())


def brute_rules(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    hit = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 10 or 100 * len(hit) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit), failed


def test_rules_base(edge, nothing, sample):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    for df in (edge, sample):
        assert Counter((r.doc_id, *(r[n] for n in names)) for r in quality_rules.judge(df).collect()) == Counter((r.doc_id, *brute_rules(r.text)) for r in df.collect())
    assert quality_rules.judge(nothing).count() == 0
    assert not quality_rules.judge(edge).where("kept and base_failed").count()
    assert quality_rules.judge(edge).schema["kept"].dataType.typeName() == "boolean"


def test_rules_verdict(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = quality_rules.judge(docs).join(labels, "doc_id").where("not base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    kept = {x.quality: x.kept for x in r}
    assert kept[1] >= 0.99
    assert kept.get(0, 0) <= 0.05
    assert quality_rules.select(docs).columns == docs.columns


def test_rules_common_words_alone(spark):
    """With the other comparison switched off, the common words still keep good documents and reject bad ones."""
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = quality_rules.judge(docs, class_distance=1.0).join(labels, "doc_id").where("common_js is not null and not base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    kept = {x.quality: x.kept for x in r}
    assert kept[1] >= 0.99
    assert kept[0] <= 0.2


def test_rules_reject_another_language(spark):
    docs = quality_rules.select(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("size(split(text, ' ')) >= 100 and lang in ('de', 'en')").select("doc_id", "text", "lang")
    other = docs.withColumn("lang", F.when(F.col("lang") == "de", "en").otherwise("de"))
    assert other.count() >= 100
    assert quality_rules.select(other).count() <= 0.02 * other.count()
    nonsense = spark.createDataFrame([(i, " ".join(f"{c}{d}xou" for c in "abcdefghij" for d in "klmnopqrst"), lang) for i, lang in enumerate([*quality_rules.WORDS, None])], "doc_id long, text string, lang string")
    assert not quality_rules.judge(nonsense, class_distance=1.0).where("kept or base_failed").count()


def test_rules_bound_is_derived(spark, nothing):
    read = lambda t: spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet")
    assert references.bound(read("documents"), read("labels")) == quality_rules.COMMON_DISTANCE
    assert references.bound(nothing, read("labels")) is None
