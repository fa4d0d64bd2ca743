"""Snapshots, merges, dimensions, checks with seeded faults, pages and streams."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from lodestrata import schemas
from lodestrata.operators import quality, tables, warehouse
from lodestrata.sources import listings, pages
from lodestrata.streaming import ingest


def core(spark, *rows):
    out = []
    for u, b, price, city, district, kind in rows:
        out.append(("Titre assez long ici", None, Decimal(price), city, district, "apartment", kind, None, None, u, dt.datetime(2026, 1, 31, 23, 59), b))
    return spark.createDataFrame(out, schemas.CORE_SCHEMA)


def test_replay_is_idempotent_and_steals(spark, tmp_path):
    t = tables.Tables(spark, str(tmp_path), {"c": schemas.CORE_SCHEMA})
    first = core(spark, ("u1", "a", "100", "X", "Y", "sale"), ("u2", "a", "200", "X", None, "sale"))
    assert t.replay("c", first, "a") == 2
    assert t.replay("c", first, "a") == 2
    assert t.read("c").count() == 2
    assert t.replay("c", core(spark, ("u1", "b", "300", "X", "Y", "sale")), "b") == 1
    assert {(r.listing_url, r.batch_id) for r in t.read("c").collect()} == {("u1", "b"), ("u2", "a")}
    missing, lacking, counts = t.audit({"c": list(schemas.CORE), "d": ["x"]})
    assert (missing, lacking, counts) == (["d"], {}, {"c": 2})
    assert t.reset(["c"]) == {"c": 2}
    assert t.read("c").count() == 0


def test_duplicates_of_a_batch_do_not_stay(spark, tmp_path):
    t = tables.Tables(spark, str(tmp_path), {"c": schemas.CORE_SCHEMA})
    rows = core(spark, ("u", "b", "1", "X", "Y", "sale"), ("v", "b", "5", "X", "Y", "sale"), ("u", "b", "2", "X", "Y", "sale")).coalesce(1)
    assert t.replay("c", rows, "b") == 2
    assert {(r.listing_url, r.price) for r in t.read("c").collect()} == {("u", Decimal("2.00")), ("v", Decimal("5.00"))}


def test_ids_survive_and_features_go_with_their_listing(spark, tmp_path):
    t = tables.listing_tables(spark, str(tmp_path))
    t.replay("clean_listings", core(spark, ("u1", "a", "100", "X", "Y", "sale"), ("u2", "a", "200", "X", "Y", "sale")), "a")
    features = spark.createDataFrame([(u, Decimal(50), *[None] * 16, "a") for u in ("u1", "u2")], schemas.FEATURE_SCHEMA)
    t.replay("clean_listing_features", features, "a")
    before = {r.listing_url: r.listing_id for r in t.read("clean_listings").collect()}
    assert sorted(before.values()) == [1, 2]
    t.replay("clean_listings", core(spark, ("u1", "b", "150", "X", "Y", "sale"), ("u3", "b", "1", "X", "Y", "sale")), "b")
    after = {r.listing_url: r.listing_id for r in t.read("clean_listings").collect()}
    assert after == before | {"u3": 3}
    assert t.read("clean_listing_features").count() == 2
    t.replay("clean_listings", core(spark), "a")
    assert {r.listing_url for r in t.read("clean_listings").collect()} == {"u1", "u3"}
    assert {r.listing_url for r in t.read("clean_listing_features").collect()} == {"u1"}


def test_a_slower_writer_starts_again(spark, tmp_path):
    t = tables.Tables(spark, str(tmp_path), {"c": schemas.CORE_SCHEMA})
    t.replay("c", core(spark, ("u1", "a", "100", "X", "Y", "sale")), "a")
    other = tables.Tables(spark, str(tmp_path), {"c": schemas.CORE_SCHEMA})
    commit, lost = t._commit, []

    def late(name, before, *rest):
        if not lost:
            lost.append(other.replay("c", core(spark, ("u2", "b", "200", "X", "Y", "sale")), "b"))
        return commit(name, before, *rest)

    t._commit = late
    t.replay("c", core(spark, ("u3", "c", "300", "X", "Y", "sale")), "c")
    assert lost == [1]
    assert {r.listing_url for r in t.read("c").collect()} == {"u1", "u2", "u3"}
    untouched = t.version("c", 0).parts["a"]
    assert t.version("c").parts["a"] == untouched  # parts of other batches are not rewritten
    assert t.vacuum("c") == 1  # what the slower writer wrote in vain
    assert t.versions("c") == [2]
    assert t.read("c").count() == 3


def test_last_duplicate_wins(spark):
    rows = core(spark, ("u", "b", "1", "X", "Y", "sale"), ("u", "b", "2", "X", "Y", "sale")).withColumn("n", F.col("price").cast("int"))
    assert [r.price for r in tables.replay(core(spark).withColumn("n", F.lit(0)), rows, "b", order="n").collect()] == [Decimal("2.00")]


def test_star_schema_with_nulls(spark):
    c = core(spark, ("u1", "a", "100", "X", None, "sale"), ("u2", "a", "200", "X", None, "rent"), ("u3", "a", "300", None, "Y", "sale"))
    f = spark.createDataFrame([], schemas.FEATURE_SCHEMA)
    times, places = warehouse.add_times(c), warehouse.add_locations(c)
    assert [(r.year, r.month, r.month_name, r.quarter) for r in times.collect()] == [(2026, 1, "January", 1)]
    assert places.count() == 2
    assert warehouse.add_locations(c, places).count() == 2
    fact = warehouse.facts(c, f, times, places)
    assert fact.count() == 3
    assert quality.foreign_keys(warehouse.orphans(fact, times, places, c)).first().bad_rows == 0
    assert quality.foreign_keys(warehouse.orphans(fact, times.limit(0), places, c)).first().bad_rows == 3


def test_checks_find_faults(spark):
    bad = core(spark, ("u", "a", "100", None, "Y", "lease"), ("u", "a", "500", "me@x.org", "Y", "sale"))
    got = {r.check_name: (r.passed, r.bad_rows) for r in quality.core_checks(bad).collect()}
    assert got["clean_no_duplicate_listing_url"] == (False, 1)
    assert got["clean_required_columns_not_null"] == (False, 1)
    assert got["required_columns_not_null"] == (False, 1)
    assert got["no_personal_data_patterns"] == (False, 1)
    assert got["warning_clean_realistic_price"] == (True, 1)
    assert quality.duplicate_keys(bad).first().bad_rows == 1
    f = spark.createDataFrame([("u", Decimal("10.00"), 30, 1, 1, 2000, 26, Decimal("5.00"), 2, None, None, 0, 0, "old", None, None, None, None, "a"), ("w", *[None] * 17, "a")], schemas.FEATURE_SCHEMA)
    joins = {r.check_name: r.bad_rows for r in quality.join_checks(bad.limit(1), f).collect()}
    assert joins == {"features_join_key_matches_core": 1, "warning_features_price_per_m2_quality": 1, "warning_optional_values_out_of_range": 1, "price_per_m2_coherence": 1}
    assert {r.check_name: r.bad_rows for r in quality.feature_checks(f).collect()}["warning_features_optional_values_out_of_range"] == 2
    ml = spark.createDataFrame([("rent", "a"), (None, "b")], "listing_type string, batch_id string")
    assert quality.rental_contamination(ml, "a").first().bad_rows == 1
    assert quality.rental_contamination(ml).first().bad_rows == 2


def test_medians_are_exact(spark):
    import random
    import statistics

    rng = random.Random(2)
    rows = [(rng.choice(["x", "y", None]), Decimal(rng.choice([rng.randint(1, 99), rng.randint(1, 10**7)])) / 100) for _ in range(500)] + [("z", None), ("one", Decimal("7.25"))]
    got = warehouse.medians(spark.createDataFrame(rows, "g string, v decimal(20,2)"), ["g"], "v", "m").collect()
    expected = {g: [v for h, v in rows if h == g and v is not None] for g in ("x", "y", None, "one")}
    assert {r.g: (round(r.m, 6), r.n) for r in got} == {g: (round(float(statistics.median(v)), 6), len(v)) for g, v in expected.items()}


def test_whole_batch(spark, tmp_path):
    import json

    from lodestrata.plans import batch

    row = {c: "" for c in schemas.RAW_COLUMNS} | {"listing_title_raw": "Appartement lumineux", "price_raw": "1 000 000 DH", "city_raw": "casa", "district_raw": "Maarif", "property_type_raw": "apartment", "surface_raw": "80 m2", "bedrooms_raw": "2 chambres", "bathrooms_raw": "1 sdb", "floor_raw": "2 etage", "listing_url": "https://www.listings.example/fr/a/appartements/x_12345678.htm", "scraped_at": "2026-04-28T12:00:00"}
    other = row | {"listing_url": "https://www.listings.example/fr/a/appartements/y_22345678.htm", "price_raw": "3 000 DH / mois"}
    path = tmp_path / "raw_batch_7.csv"
    path.write_text("\n".join([",".join(row), *(",".join(r.values()) for r in (row, other, row | {"price_raw": ""} | {"listing_url": other["listing_url"] + "?a=b"}))]) + "\n", encoding="utf-8")
    for _ in range(2):
        out = batch.run_batch(spark, str(path), str(tmp_path / "run"), 2026, retries=0)
    assert (out["batch_id"], out["total_staged_listings"], out["total_cleaned_listings"], out["total_ml_ready_rows"]) == ("batch_7", 2, 2, 1)
    assert sorted(map(tuple, out["sale_vs_rent_distribution"])) == [("rent", 1), ("sale", 1)]
    checkpoint = json.loads((tmp_path / "run/files/pipeline_checkpoint_batch_7.json").read_text())
    assert [s["step"] for s in checkpoint["steps"]][-2:] == ["data_quality_checks", "final_validation"]
    assert {s["status"] for s in checkpoint["steps"]} == {"succeeded"}
    assert json.loads((tmp_path / "run/files/final_validation_batch_7.json").read_text())["total_cleaned_listings"] == 2


def test_median_of_even_groups(spark):
    sale = spark.createDataFrame([("X", Decimal("10.00")), ("X", Decimal("20.01"))], "city string, price_per_m2 decimal(20,2)")
    assert warehouse.market_index(sale, ["city"], "m").first().m == 15.005


def test_evolution(spark):
    old = spark.createDataFrame([("t", 5)], "listing_title string, gone int")
    new = tables.evolve(old, schemas.RAW, {"listing_title": "listing_title_raw"})
    assert new.columns == list(schemas.RAW_COLUMNS)
    assert new.first().listing_title_raw == "t"


PAGE = """<html><head><script type="application/ld+json">{"@graph":[{"@type":"Product","url":"/fr/rabat/appartements/bel_appartement_1234567.htm","name":"Bel appartement","offers":{"price":900000},"geo":{"latitude":34.01,"longitude":-6.83}}]}</script></head>
<body><ul><li class="listing-card"><a href="/fr/rabat/appartements/bel_appartement_1234567.htm?x=1">voir</a><span class="price">1 000 000 DH</span><span class="location">Rabat, Agdal</span>
<span class="feature">100 m²</span><span class="feature">3 chambres</span><p class="description">Un appartement calme et lumineux au coeur de la ville</p></li></ul></body></html>"""


def test_pages(spark):
    df = spark.createDataFrame([(1, "https://www.listings.example/", PAGE), (2, "https://www.listings.example/", "<p>Access denied: robot</p>"), (3, None, None)], "page_id long, url string, html string")
    r = pages.listings(df, batch_id="b").collect()
    assert len(r) == 1
    assert (r[0].listing_title_raw, r[0].price_raw, r[0].city_raw, r[0].district_raw, r[0].surface_raw, r[0].bedrooms_raw, r[0].latitude_raw) == ("Bel appartement", "1 000 000 DH", "Rabat", "Agdal", "100 m²", "3 chambres", "34.01")
    assert r[0].attributes_raw == '["100 m²", "3 chambres"]'
    search = pages.listings(df, batch_id="b").withColumn("price_raw", F.lit(None).cast("string"))
    filled = pages.enrich(search, pages.listings(df, batch_id="b").withColumn("attributes_raw", F.lit("[]"))).first()
    assert (filled.price_raw, filled.attributes_raw, filled.detail_scraped) == ("1 000 000 DH", "[]", "true")


def test_snippets(spark):
    df = spark.createDataFrame([("Appartement 83 m² au 3eme étage, 4 pièces, 2 sdb, 8 000 DH / mois puis 1 550 000 DH, construit en 2010",)], "t string")
    t = F.col("t")
    r = df.select(pages.price_snippet(t).alias("p"), pages.surface_snippet(t).alias("s"), pages.bedrooms_snippet(t).alias("b"), pages.bathrooms_snippet(t).alias("w"), pages.floor_snippet(t).alias("f"), pages.year_snippet(t).alias("y")).first()
    assert tuple(r) == ("1 550 000 DH", "83 m²", "4 chambres", "2 sdb", "Étage 3", "construit en 2010")


def test_stream(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    row = {c: "" for c in schemas.RAW_COLUMNS} | {"listing_title_raw": "Appartement lumineux", "price_raw": "1 000 000 DH", "city_raw": "casa", "district_raw": "Maarif", "property_type_raw": "apartment", "listing_url": "https://www.listings.example/fr/a/appartements/x_12345678.htm", "scraped_at": "2026-04-28T12:00:00", "batch_id": "b"}
    (src / "a.csv").write_text(",".join(row) + "\n" + ",".join(row.values()) + "\n", encoding="utf-8")
    t = tables.Tables(spark, str(tmp_path / "t"))
    for _ in range(2):
        ingest.start(ingest.raw_stream(spark, str(src)), t, str(tmp_path / "cp"), 2026).awaitTermination(120)
    assert t.read("clean_listings").count() == 1


def test_latest(spark, tmp_path):
    for n in ("a", "b"):
        (tmp_path / f"raw_{n}.csv").write_text("x")
    import os

    os.utime(tmp_path / "raw_a.csv", (2_000_000_000, 2_000_000_000))
    assert listings.latest(spark, str(tmp_path / "raw_*.csv")).endswith("raw_a.csv")


def test_numbers_of_many_rows_are_whole_and_different(spark, tmp_path):
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        rows = spark.range(0, 60_000, 1, 8).select(F.sha2(F.col("id").cast("string"), 256).alias("u"), F.repeat(F.sha2((F.col("id") + 1).cast("string"), 256), 4).alias("text"))
        tables.numbered(rows, "n", 5, ["u"]).write.parquet(str(tmp_path / "out"))  # all columns: a reader of few would have them pruned
        out = spark.read.parquet(str(tmp_path / "out"))
        found = out.agg(F.count("*"), F.count_distinct("n"), F.min("n"), F.max("n")).first()
        assert tuple(found) == (60_000, 60_000, 6, 60_005)
        in_order = out.selectExpr("n", "lag(u) over (order by n) < u as ok").where("not ok").count()
        assert in_order == 0
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
