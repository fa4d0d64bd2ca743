"""From raw listings to typed listings: sanitize, drop repeated addresses, parse, give the first failing rule as reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from .. import schemas
from ..functions import classify, location, numbers, text, titles, url
from ..functions import patterns as P
from ..session import filter_above


def conform(df: DataFrame) -> DataFrame:
    """The raw columns, all text: a missing column is taken from its older name, or null. A title that is null or empty falls back to its older name; of the others an old name counts only where the new column is absent."""
    have = set(df.columns)

    def column(c: str) -> Column:
        old = schemas.RAW_ALIASES.get(c)
        if c == "listing_title_raw":
            parts = [F.nullif(F.col(x).cast("string"), F.lit("")) for x in (c, "listing_title") if x in have]
            return F.coalesce(*parts) if parts else F.lit(None)
        return F.col(c) if c in have else F.col(old) if old in have else F.lit(None)

    kept = ["ordinal"] if "ordinal" in have else []
    return df.select(*(column(c).cast("string").alias(c) for c in schemas.RAW_COLUMNS), *kept)


def sanitize(df: DataFrame, site: url.Site = url.SITE) -> DataFrame:
    """The raw contract, sanitized: address in normal form, places that look like street addresses null."""
    df = text.sanitized(df, [c for c in schemas.RAW_COLUMNS if c != "listing_url"])
    return df.withColumns({"listing_url": url.normalize(F.col("listing_url"), site)} | {c: location.no_address(F.col(c)) for c in ("city_raw", "district_raw")})


def assert_contract(df: DataFrame, allowed) -> None:
    """Raises for a column outside the contract, and for a row with personal data outside address, source, batch and time."""
    extra = sorted(set(df.columns) - set(allowed))
    if extra:
        raise ValueError(f"Disallowed fields detected: {extra}")
    texts = [c for c in df.columns if c not in ("listing_url", "source", "batch_id", "scraped_at")]
    found = df.agg(*(F.coalesce(F.bool_or(text.has_personal_data(F.col(c).cast("string"))), F.lit(False)).alias(c) for c in texts)).first()
    bad = [c for c in texts if found[c]]
    if bad:
        raise ValueError(f"Personal data detected in field: {bad[0]}")


def keep_first(df: DataFrame, by: str = "listing_url", order: str = "ordinal") -> DataFrame:
    """The first row of each key in order; rows without a key all stay."""
    alone = F.when(F.col(by).isNull(), F.col(order))  # rows without a key are their own groups, so they neither vanish nor meet in one task
    return filter_above(df.withColumn("_n", F.row_number().over(W.Window.partitionBy(by, alone).orderBy(order))), F.col("_n") == 1).drop("_n")


def keep_last(df: DataFrame, by: str = "listing_url", order: str = "ordinal") -> DataFrame:
    """The last row of each key in order, as row-by-row upserts leave it; rows without a key all stay."""
    alone = F.when(F.col(by).isNull(), F.col(order))
    return filter_above(df.withColumn("_n", F.row_number().over(W.Window.partitionBy(by, alone).orderBy(F.col(order).desc()))), F.col("_n") == 1).drop("_n")


def utc_time(c: Column) -> Column:
    """A time with or without an offset; without one it is UTC, whatever the session's time zone."""
    return text.once(F.trim(c), lambda t: F.try_to_timestamp(F.when(t.rlike("(?:Z|[+-][0-9]{2}:?[0-9]{2})$") & t.rlike("[T ][0-9]"), F.regexp_replace(t, "Z$", "+00:00")).otherwise(F.concat(t, F.when(t.rlike("[T ][0-9]"), "+00:00").otherwise("T00:00:00+00:00")))))


def _between(c: str, bounds: tuple) -> Column:
    return F.col(c).between(F.lit(bounds[0]), F.lit(bounds[1]))


def typed(raw: DataFrame, current_year: int, strict_label: bool = False) -> DataFrame:
    """All columns of core and features, and reject_reason (null: accepted), for sanitized raw rows. One row in, one row out, in steps so that each text is parsed once."""
    df = text.all_known(raw, {f"_{c}": F.col(c) for c in schemas.RAW_COLUMNS if c != "listing_url"})
    title, description, attributes = F.col("_listing_title_raw"), F.col("_description_raw"), F.col("_attributes_raw")
    texts = [title, description, attributes]
    combined = F.concat_ws(" ", *(F.coalesce(F.col(c), F.lit("")) for c in ("_listing_title_raw", "_description_raw", "_attributes_raw", "_price_raw", "_city_raw", "_district_raw", "_property_type_raw", "_listing_type_raw", "listing_url")))
    df = df.withColumns(
        {
            "_combined": combined,
            "listing_title_clean": titles.clean_title(title, F.col("listing_url")),
            "property_type": classify.property_type([F.col("_property_type_raw"), F.col("listing_url"), *texts]),
            "_named": location.from_text(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(description, F.lit("")))),
            "_city": location.city(F.col("_city_raw")),
            "_district": location.district(F.col("_district_raw")),
            "_prices": numbers.prices(F.col("_price_raw")),
        }
    )
    lacks = lambda c: F.coalesce(f"_{c}", f"_named.{c}").isNull()
    df = df.withColumn("_path", F.when(lacks("city") | lacks("district"), url.place(F.col("listing_url"))))
    # a number alone in the whole text, such as that of the address, is no price; what has no price lies under the sale range, whatever that number
    df = df.withColumn("_offer", F.coalesce(F.nullif(numbers.any_decimal(F.col("_price_raw"), F.col("_prices")), F.lit(0).cast("decimal(20,2)")), numbers.any_price(F.col("_combined")), F.lit(0).cast("decimal(20,2)")))
    df = df.withColumn("listing_type", classify.listing_type(F.col("_listing_type_raw"), F.col("_combined"), F.col("_offer"), strict_label))
    parsed_time = utc_time(F.col("_scraped_at"))
    land = F.col("property_type") == "land"
    rooms = numbers.bedrooms([F.col("_bedrooms_raw"), *texts])
    df = df.withColumns(
        {
            "price": numbers.price([F.col("_price_raw"), F.col("_combined")], F.col("listing_type"), F.col("_prices")),
            "city": F.coalesce("_city", "_named.city", "_path.city"),
            "district": F.coalesce("_district", "_named.district", "_path.district"),
            "scraped_at": F.date_trunc("second", parsed_time),
            "batch_id": F.col("_batch_id"),
            "surface_m2": numbers.surface([*texts, F.col("_surface_raw")]),
            "bedrooms": F.when(land, F.lit(0)).when(F.col("property_type") == "studio", F.coalesce(rooms, F.lit(0))).otherwise(rooms),
            "bathrooms": F.when(land, F.lit(0)).otherwise(numbers.bathrooms([F.col("_bathrooms_raw"), *texts])),
            "floor": F.when(land, F.lit(0)).otherwise(numbers.first_of([F.col("_floor_raw"), *texts], numbers.floor, "int")),
            "construction_year": numbers.year([F.col("_construction_year_raw"), *texts], current_year),
            "latitude": numbers.coordinate(F.col("_latitude_raw"), 90),
            "longitude": numbers.coordinate(F.col("_longitude_raw"), 180),
            "description_clean": description,
        }
    )
    df = df.withColumn("district", F.when(F.col("city").isNull() | (text.key(F.col("city")) != text.key(F.col("district"))), F.col("district")))
    df = df.withColumns(
        {
            "property_age": F.lit(current_year) - F.col("construction_year"),
            "price_per_m2": numbers.price_per_m2(F.col("price"), F.col("surface_m2"), F.col("property_type")),
            "rooms_total": classify.rooms_total(F.col("property_type"), F.col("bedrooms"), F.col("bathrooms")),
            "luxury_flag": F.when((text.maybe(text.low(F.col("_combined")), P.LUXURY_STEMS) & F.col("_combined").rlike(P.LUXURY)) | (F.col("price") >= P.LUXURY_PRICE), 1).otherwise(0),
            "coastal_city": F.when(F.col("city").isin(*P.COASTAL), 1).otherwise(0),
        }
    )
    money, share = "decimal(20,2)", "decimal(12,4)"
    raw_fields = ("listing_title_raw", "description_raw", "price_raw", "city_raw", "district_raw", "property_type_raw", "surface_raw", "bedrooms_raw", "bathrooms_raw", "floor_raw", "attributes_raw")
    done = ("price", "city", "district", "property_type", "listing_type", "surface_m2", "bedrooms", "bathrooms", "floor", "price_per_m2")
    df = df.withColumns(
        {
            "price_per_room": numbers.ratio(F.col("price"), F.col("rooms_total"), 2, money),
            "room_density": numbers.ratio(F.col("rooms_total"), F.col("surface_m2"), 4, share),
            "property_age_bucket": classify.age_bucket(F.col("property_age")),
            "surface_x_rooms": (F.col("surface_m2") * F.col("rooms_total")).cast(money),
            "bathrooms_per_bedroom": numbers.ratio(F.col("bathrooms"), F.when(F.col("bedrooms") > 0, F.col("bedrooms")), 4, share),
            "extraction_score": classify.share_present([F.col(f"_{c}") for c in raw_fields]),
            "feature_completeness_score": classify.share_present([F.col(c) for c in done]),
        }
    )
    df = df.withColumn("reject_reason", reject_reason())
    # accepted rows pass the sanitizer once more: its wider list of address words empties some places
    df = text.sanitized(df, ["city", "district"]).withColumns({c: location.no_address(F.col(c)) for c in ("city", "district")})
    # filters of later steps stay above these projections, so that a condition on a parsed column does not parse again
    return filter_above(df.select(*schemas.CORE, *schemas.OPTIONAL_FEATURES, "reject_reason", *(["ordinal"] if "ordinal" in raw.columns else [])), F.lit(True))


def reject_reason() -> Column:
    """The first rule that a typed row fails."""
    in_range = F.when(F.col("listing_type") == "rent", _between("price", P.RENT_PRICE)).otherwise(_between("price", P.SALE_PRICE))
    house = F.col("property_type").isin("villa", "house", "riad")
    rules = [
        ("missing_listing_url", F.col("listing_url").isNull()),
        ("missing_listing_title_clean", F.col("listing_title_clean").isNull()),
        ("missing_property_type", F.col("property_type").isNull()),
        ("invalid_price", F.col("price").isNull()),
        ("missing_city", F.col("city").isNull()),
        ("missing_district", F.col("district").isNull()),
        ("missing_scraped_at", F.col("scraped_at").isNull()),
        ("missing_batch_id", F.col("batch_id").isNull()),
        ("invalid_price", ~in_range),
        ("outlier_surface", ~_between("surface_m2", P.SURFACE)),
        ("outlier_bedrooms", ~_between("bedrooms", P.ROOMS)),
        ("outlier_bathrooms", ~_between("bathrooms", P.ROOMS)),
        ("outlier_floor", ~_between("floor", P.FLOOR)),
        ("outlier_price_per_m2", (F.col("listing_type") == "sale") & F.col("surface_m2").isNotNull() & F.col("price_per_m2").isNull()),
        ("contradictory_rooms", house & (F.col("surface_m2") >= 250) & (F.col("bedrooms") == 0)),
        ("contradictory_rooms", house & (F.col("bathrooms") > F.col("bedrooms") + 4)),
    ]
    return F.coalesce(*(F.when(rule, F.lit(name)) for name, rule in rules))


def clean(raw: DataFrame, current_year: int, site: url.Site = url.SITE, strict_label: bool = False) -> DataFrame:
    """Typed rows with reject_reason, after dropping repeated addresses (the first copy counts, valid or not). raw needs an ordinal; without one, the order of reading counts."""
    raw = raw if "ordinal" in raw.columns else raw.withColumn("ordinal", F.monotonically_increasing_id())
    return typed(keep_first(sanitize(conform(raw), site)), current_year, strict_label)


def accepted(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("reject_reason").isNull()).drop("reject_reason", "ordinal")


def rejected(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("reject_reason").isNotNull())


def core(rows: DataFrame) -> DataFrame:
    return rows.select(*schemas.CORE)


def features(rows: DataFrame) -> DataFrame:
    return rows.select(*schemas.FEATURES)


def clean_listings(raw: DataFrame, current_year: int, **options) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(core, features, all typed rows with reasons) of a frame of raw listings."""
    rows = clean(raw, current_year, **options)
    ok = accepted(rows)
    return core(ok), features(ok), rows
