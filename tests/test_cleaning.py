"""Golden cases of parsing, cleaning, typed reload and profiles."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lodestrata import schemas
from lodestrata.functions import classify, location, numbers, text, titles, url
from lodestrata.functions import patterns as P
from lodestrata.operators import clean as cleaning
from lodestrata.operators import quality, report
from lodestrata.plans import catalog
from lodestrata.sources import listings

YEAR = 2026


def value(spark, f, *args):
    df = spark.createDataFrame([args], ", ".join(f"v{i} string" for i in range(len(args))))
    return df.select(f(*(F.col(c) for c in df.columns)).alias("x")).first().x


def raw(spark, **fields):
    base = {"listing_title_raw": "Appartement lumineux", "price_raw": "1 200 000 DH", "city_raw": "casa", "district_raw": "Maarif", "property_type_raw": "apartment", "listing_url": "/fr/casablanca/appartements/x_12345678.htm", "scraped_at": "2026-04-28T12:00:00", "batch_id": "b"}
    row = base | fields
    return spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} string" for k in row))


def cleaned(spark, **fields):
    return cleaning.clean(raw(spark, **fields), YEAR).first()


@pytest.mark.parametrize(("given", "expected"), [("1 250 000 DH", "1250000.00"), ("1.5 million MAD", "1500000.00"), ("1.500 million", "1500000000.00"), ("-3", "3.00"), ("1234 567 DH", "234567.00"), ("1 250 000 DH", "1250000.00"), ("Prix non spécifié", None), ("", None), (None, None)])
def test_any_decimal(spark, given, expected):
    got = value(spark, lambda c: numbers.any_decimal(text.clean(c)), given)
    assert got == (None if expected is None else Decimal(expected))


@pytest.mark.parametrize(("given", "plain", "focused"), [("Rez de chaussee", 0, 0), ("RDC", 0, 0), ("3eme etage", 3, 3), ("0", None, None), ("Etage 0", None, None), ("7", None, 7), ("Étage 61", None, None), ("niveau 12", 12, 12)])
def test_floor(spark, given, plain, focused):
    assert value(spark, numbers.floor, given) == plain
    assert value(spark, lambda c: numbers.floor(c, True), given) == focused


def test_places(spark):
    assert value(spark, location.city, "casa") == "Casablanca"
    assert value(spark, location.city, "Fes") == "Fès"
    assert value(spark, location.city, "al hoceima") == "al Hoceima"
    assert value(spark, location.district, "Toute la ville") is None
    assert value(spark, location.district, "Rue Example 12") is None
    assert value(spark, location.district, "hay riad 2/5 Premium") == "Hay Riad"
    assert value(spark, location.from_text, "Appartements dans Marrakech, Guéliz Appartement neuf").asDict() == {"city": "Marrakech", "district": "Guéliz"}


def test_text(spark):
    assert value(spark, text.sanitize, "Contact: a.b@x.org / 0612345678") == "Contact: [REDACTED_EMAIL] / [REDACTED_PHONE]"
    assert value(spark, text.clean, " NaN ") is None
    assert value(spark, text.sanitize, "CafÃ© <b>noir</b> &amp; th") == "Café noir & th"
    assert value(spark, text.sanitize, "CafÃ© thé") == "CafÃ© thé"  # not wholly mojibake: left alone
    assert value(spark, lambda c: text.sanitize(c), "a&eacute;b") == "aéb"
    assert value(spark, text.key, "Fès - Médina!") == "fes medina"


def test_urls(spark):
    assert value(spark, url.normalize, "https://other.example/fr/a") is None
    assert value(spark, url.normalize, "/fr/a/b.htm?utm=abc#x") == "https://www.listings.example/fr/a/b.htm"
    assert value(spark, url.normalize, "https://WWW.listings.example/fr/a/") == "https://WWW.listings.example/fr/a"
    assert value(spark, url.title, "https://www.listings.example/fr/x/bel_appartement_12345.htm") == "Bel appartement"
    assert value(spark, url.place, "https://www.listings.example/fr/el_jadida/appartements/x_1.htm").asDict() == {"city": "El Jadida", "district": None}
    assert value(spark, url.place, "https://www.listings.example/fr/maarif/appartements/x_1.htm").asDict() == {"city": None, "district": "Maarif"}
    assert value(spark, url.looks_like_listing, "https://www.listings.example/fr/a/b/c_123456") is True
    assert value(spark, url.looks_like_listing, "https://www.listings.example/fr/profile/c_123456") is False


def test_title(spark):
    given = "Vendeur il y a 5 minutes Appartements dans Rabat, Agdal Appartement meublé calme agdal 4 personnes 1 chambre 700 DH Contacter le vendeur"
    assert value(spark, titles.clean_title, given, None) == "Appartement meublé calme agdal"
    assert value(spark, titles.clean_title, "Villa", "https://www.listings.example/fr/x/grande_villa_99.htm") == "Grande villa"


def test_kinds(spark):
    kind = lambda c: classify.property_type([c])
    assert value(spark, kind, "duplex appartement") == "duplex"
    assert value(spark, lambda c: classify.page_property_type([c]), "duplex appartement") == "apartment"
    assert value(spark, lambda c: classify.listing_type(F.lit("rent"), c, F.lit(500_000)), "texte") == "sale"  # a label beside text has no effect
    assert value(spark, lambda c: classify.listing_type(F.lit("rent"), c, F.lit(500_000), True), "texte") == "rent"
    assert value(spark, lambda c: classify.listing_type(F.lit(None).cast("string"), c, F.lit(500_000)), "il y a 2 mois") == "rent"
    assert value(spark, lambda c: classify.page_listing_type([c]), "à vendre, location") == "rent"


def test_whole_row(spark):
    r = cleaned(spark, surface_raw="120 m2", construction_year_raw="Construit en 2016")
    assert (r.price, r.surface_m2, r.price_per_m2, r.property_age, r.city, r.reject_reason) == (Decimal("1200000.00"), Decimal("120.00"), Decimal("10000.00"), 10, "Casablanca", None)


def test_noisy_row(spark):
    title = "Appartements dans Marrakech, Guéliz Appartement 83 m² 1 550 000 DH et 8 615 DH / mois à vendre"
    r = cleaned(spark, listing_title_raw=title, price_raw=None, city_raw=None, district_raw=None, surface_raw="90 m2")
    assert (r.price, r.surface_m2, r.city, r.district, r.price_per_m2) == (Decimal("1550000.00"), Decimal("83.00"), "Marrakech", "Guéliz", Decimal("18674.70"))


@pytest.mark.parametrize(("fields", "reason"), [({"listing_url": None}, "missing_listing_url"), ({"price_raw": None}, "invalid_price"), ({"property_type_raw": None, "listing_title_raw": "Bien rare", "listing_url": "/fr/casablanca/x/y_1234567.htm"}, "missing_property_type"), ({"district_raw": "Rue Example 12"}, "missing_district"), ({"scraped_at": "never"}, "missing_scraped_at"), ({"batch_id": "nan"}, "missing_batch_id"), ({"surface_raw": "2000 m2"}, "outlier_price_per_m2"), ({"property_type_raw": "villa", "listing_url": "/fr/casablanca/x/y_1234567.htm", "listing_title_raw": "Villa avec jardin", "surface_raw": "300 m2", "bedrooms_raw": "0 chambres"}, "contradictory_rooms")])
def test_reasons(spark, fields, reason):
    assert cleaned(spark, **fields).reject_reason == reason


def test_missing_options_are_fine(spark):
    r = cleaned(spark, bedrooms_raw="99 chambres")
    assert r.reject_reason is None
    assert (r.surface_m2, r.bedrooms, r.bathrooms, r.floor, r.price_per_m2) == (None,) * 5


def test_personal_data_in_coordinates(spark):
    assert cleaned(spark, latitude_raw="33.0512345678").latitude is None
    assert cleaned(spark, latitude_raw="33,57").latitude == Decimal("33.570000")


def test_first_copy_counts_even_if_invalid(spark):
    rows = raw(spark, price_raw="none").withColumn("ordinal", F.lit(1)).unionByName(raw(spark).withColumn("ordinal", F.lit(2)))
    got = cleaning.clean(rows, YEAR).collect()
    assert [r.reject_reason for r in got] == ["invalid_price"]
    assert cleaning.keep_last(cleaning.sanitize(cleaning.conform(rows))).first().ordinal == 2
    assert cleaning.clean(rows.withColumn("listing_url", F.lit(None).cast("string")), YEAR).count() == 2


def test_older_names(spark):
    old = spark.createDataFrame([("Appartement calme", "1 000 000 DH", "Rabat", "Agdal", "100 m2", "/fr/a/appartements/z_7654321.htm", "2026-01-01T00:00:00", "b")], "listing_title string, price string, city string, district string, surface_m2 string, listing_url string, scraped_at string, batch_id string")
    r = cleaning.clean(old, YEAR).first()
    assert (r.reject_reason, r.surface_m2) == (None, Decimal("100.00"))


def test_contract(spark):
    df = spark.createDataFrame([("t", "x")], "listing_title_raw string, email string")
    with pytest.raises(ValueError, match="email"):
        cleaning.assert_contract(df, schemas.RAW_COLUMNS)
    with pytest.raises(ValueError, match="listing_title_raw"):
        cleaning.assert_contract(spark.createDataFrame([("a@b.org",)], "listing_title_raw string"), schemas.RAW_COLUMNS)
    cleaning.assert_contract(spark.createDataFrame([("fine",)], "listing_title_raw string"), schemas.RAW_COLUMNS)


def test_profile_and_report(spark):
    rows = cleaning.clean(raw(spark, surface_raw="120 m2").unionByName(raw(spark, surface_raw="80 m2", listing_url="/fr/a/appartements/q_2345678.htm")).withColumn("ordinal", F.monotonically_increasing_id()), YEAR)
    rep = report.batch_report(rows, 2, "b")
    assert (rep["clean_rows"], rep["ml_candidate_sale_rows"], rep["optional_completeness_percent"]["surface_m2"], rep["removed_duplicates"]) == (2, 2, 100.0, 0)
    assert rep["statistics"]["surface_m2"] == [80.0, 120.0, 100.0]
    assert {r.column_name: r.missing_percent for r in report.column_profile(rows).collect()}["bedrooms"] == 100.0


def test_csv_round_trip(spark, tmp_path):
    src, out = str(tmp_path / "raw_batch_test.csv"), str(tmp_path / "core")
    row = {c: "" for c in schemas.RAW_COLUMNS} | {"listing_title_raw": "Appartement lumineux", "price_raw": "1 000 000 DH", "city_raw": "casa", "district_raw": "Maarif", "property_type_raw": "apartment", "surface_raw": "100 m2", "bedrooms_raw": "2 chambres", "listing_url": "https://www.listings.example/fr/a/appartements/x_12345678.htm", "scraped_at": "2026-04-28T12:00:00"}
    with open(src, "w", encoding="utf-8") as f:
        f.write(",".join(row) + "\n" + ",".join(row.values()) + "\n")
    assert listings.batch_id(src) == "batch_test"
    core, features, _ = cleaning.clean_listings(listings.read_raw(spark, src, "batch_test"), YEAR)
    listings.write_csv(core, out)
    listings.write_csv(features, out + "_f")
    text_rows = spark.read.csv(out + "_f", header=True).first()
    assert (text_rows.surface_m2, text_rows.floor, text_rows.price_per_m2) == ("100.00", None, "10000.00")
    again = listings.reload_core(spark.read.csv(out, header=True), "batch_test")
    fagain = listings.reload_features(spark.read.csv(out + "_f", header=True), "batch_test")
    ok, kept = listings.load(again, fagain)
    assert ok.count() == kept.count() == 1
    assert kept.first().bedrooms == 2


def test_reload_reasons(spark):
    base = {"listing_title_clean": "Appartement calme", "price": "1000000", "city": "Rabat", "district": "Agdal", "property_type": "apartment", "listing_url": "/fr/a/b/c_1234567.htm", "scraped_at": "2026-01-01T00:00:00", "batch_id": "b"}
    def reason(**f):
        r = base | f
        return listings.reload_core(spark.createDataFrame([tuple(r.values())], ", ".join(f"{k} string" for k in r))).first().reject_reason
    assert reason() is None
    assert reason(price="not-a-price") == "invalid_price"
    assert (reason(listing_title_clean=""), reason(city=" "), reason(district="nan")) == ("missing_listing_title_clean", "missing_city", "missing_district")
    empty = spark.createDataFrame([("/fr/a/b/c_1234567.htm", None, None, None, None, None)], "listing_url string, surface_m2 string, bedrooms string, bathrooms string, floor string, price_per_m2 string")
    assert listings.reload_features(empty).first().reject_reason == "all_features_missing"


def test_failed_checks_raise(spark):
    rows = spark.createDataFrame([("positive_price", False, 2, "")], quality.SCHEMA)
    with pytest.raises(AssertionError, match="positive_price=2"):
        quality.assert_passed(rows)
    quality.assert_passed(rows.withColumn("passed", F.lit(True)))


def test_page_classes_read_whole_texts(spark, tmp_path):
    long = "x" * 65
    texts = ["33,5", None, "", "Casablanca, Maarif", f"{long}, {long}y, Rabat", ", ".join(["z" * 71] * 3 + ["Rabat", "Agdal"]), "mot " * 60 + "appartements dans Casablanca, Maarif", "z" * 139 + "abc | Rabat - Agdal"]

    def place(t):
        if "appartements dans " in t:
            return tuple(t.split("appartements dans ")[1].split(", "))
        pieces = [p for p in (x.strip(" ,-") for x in t.replace("|", ",").replace(" - ", ",").split(",")) if p and len(p) <= 70]
        first, second = [*pieces, None, None][:2]
        ok = first is not None and len(first) <= 60
        return (first if ok else None, second if ok and second is not None and len(second) <= 60 else None)

    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in catalog.page_classes_documents(spark, str(tmp_path)).collect()}
    for i, t in enumerate(texts):
        if t and t != "33,5":
            assert tuple(got[i].place) == place(t), t
    assert tuple(got[6].place) == ("Casablanca", "Maarif")
    assert [got[i].x for i in range(len(texts))] == [33.5] + [None] * (len(texts) - 1)


def test_the_number_of_an_address_is_no_price(spark):
    for number in ("00000409", "00100409", "12345678"):
        row = cleaned(spark, price_raw="Prix non spécifié", listing_url=f"/fr/casablanca/immobilier/bien_{number}.htm")
        assert (row.listing_type, row.price, row.reject_reason) == ("rent", None, "invalid_price")


@pytest.mark.parametrize(
    ("pattern", "stems", "phrases"),
    [
        (P.RENT, P.RENT_STEMS, ("location", "louer", "à  louer", "A LOUER", "loyer", "par mois", "mensuel", "mois", "jour", "journée", "journee", "nuit", "nuitée", "vacance", "Vacances", "estival", "DH/mois", "moiſ")),
        (P.SALE, P.SALE_STEMS, ("vente", "vendre", "vend", "à vendre", "titre foncier", "TITRÉ", "titre", "tıtre")),
        (P.LUXURY, P.LUXURY_STEMS, ("luxe", "haut  standing", "prestige", "premium", "piscine", "golf", "vue mer", "front mer", "marina", "neuf", "Résidence fermée", "residence fermee", "piſcine")),
    ],
)
def test_cheap_tests_let_every_match_through(spark, pattern, stems, phrases):
    df = spark.createDataFrame([(f"un {p}",) for p in phrases], "t string")
    out = df.select("t", text.maybe(text.low(F.col("t")), stems).alias("maybe"), F.col("t").rlike(pattern).alias("match")).collect()
    assert [r.t for r in out if not (r.maybe and r.match)] == []


def test_texts_that_need_no_sanitizing_are_left_alone(spark):
    plain = ["Bien ensoleillé", "120 m²", "2 345 670 DH", "1995-06-01T12:00:00", "a\x01b", "33.57"]
    busy = {" a": "a", "a ": "a", "a  b": "a b", "a\tb": "a b", "a b": "a b", "": None, "&amp;": "&", "CafÃ©": "Café", "<b>x": "x", "a@b.co": "[REDACTED_EMAIL]", "0612345678": "[REDACTED_PHONE]", "+212 6 12 34 56 78": "[REDACTED_PHONE]", "06.12.34.56.7": "[REDACTED_PHONE]"}
    df = spark.createDataFrame([(t, t, "x") for t in [*plain, *busy]], "t string, u string, v string")
    out = text.sanitized(df, ["u", "v"]).select("t", "u", "v", text.sanitize(F.col("t")).alias("alone"), text._needs_nothing(F.col("t")).alias("kept")).collect()
    wanted = {t: t for t in plain} | busy
    assert {r.t: (r.u, r.v, r.alone, r.kept) for r in out} == {t: (w, "x", w, t in plain) for t, w in wanted.items()}


def test_counts_without_a_number_raise_no_errors(spark):
    """try_cast of an empty text raises and catches an error for every row."""
    seen = spark.createDataFrame([("3 etage",), ("12 m",)], "t string").select(numbers.floor(F.col("t")).alias("f"), numbers._whole(F.col("t"), P.BEDROOMS).alias("b"))
    assert [tuple(r) for r in seen.collect()] == [(3, None), (None, None)]
    plan = seen._jdf.queryExecution().optimizedPlan().toString()
    assert "try_cast(regexp_extract" not in plan
