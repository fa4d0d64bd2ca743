"""Columns and types of the raw, clean and warehouse tables."""

from __future__ import annotations

from pyspark.sql import types as T

# The raw contract, all text.
RAW_COLUMNS = (
    "listing_title_raw", "description_raw", "price_raw", "city_raw", "district_raw", "property_type_raw", "listing_type_raw", "surface_raw", "bedrooms_raw", "bathrooms_raw",
    "floor_raw", "latitude_raw", "longitude_raw", "construction_year_raw", "attributes_raw", "listing_url", "scraped_at", "batch_id", "source", "detail_scraped",
)
RAW_ALIASES = {
    "description_raw": "description", "price_raw": "price", "city_raw": "city", "district_raw": "district", "property_type_raw": "property_type", "listing_type_raw": "listing_type",
    "surface_raw": "surface_m2", "bedrooms_raw": "bedrooms", "bathrooms_raw": "bathrooms", "floor_raw": "floor", "latitude_raw": "latitude", "longitude_raw": "longitude",
    "construction_year_raw": "construction_year", "attributes_raw": "attributes",
}
MONEY, RATIO, DEGREES = T.DecimalType(20, 2), T.DecimalType(12, 4), T.DecimalType(9, 6)
# The clean core and its features.
CORE = {
    "listing_title_clean": T.StringType(), "description_clean": T.StringType(), "price": MONEY, "city": T.StringType(), "district": T.StringType(), "property_type": T.StringType(),
    "listing_type": T.StringType(), "latitude": DEGREES, "longitude": DEGREES, "listing_url": T.StringType(), "scraped_at": T.TimestampType(), "batch_id": T.StringType(),
}
FEATURES = {
    "listing_url": T.StringType(), "surface_m2": MONEY, "bedrooms": T.IntegerType(), "bathrooms": T.IntegerType(), "floor": T.IntegerType(), "construction_year": T.IntegerType(),
    "property_age": T.IntegerType(), "price_per_m2": MONEY, "rooms_total": T.IntegerType(), "price_per_room": MONEY, "room_density": RATIO, "luxury_flag": T.IntegerType(),
    "coastal_city": T.IntegerType(), "property_age_bucket": T.StringType(), "surface_x_rooms": MONEY, "bathrooms_per_bedroom": RATIO, "extraction_score": RATIO,
    "feature_completeness_score": RATIO, "batch_id": T.StringType(),
}
REQUIRED = ("listing_title_clean", "price", "city", "district", "property_type", "listing_type", "listing_url", "scraped_at", "batch_id")
OPTIONAL_FEATURES = tuple(c for c in FEATURES if c not in ("listing_url", "batch_id"))
OPTIONAL = ("description_clean", "latitude", "longitude", *OPTIONAL_FEATURES)
# The feature table for models, 30 columns.
ML_COLUMNS = (
    "listing_url", "price", "log_price", "city", "district", "property_type", "listing_type", "surface_m2", "bedrooms", "bathrooms", "floor", "construction_year", "property_age", "price_per_m2",
    "rooms_total", "price_per_room", "room_density", "luxury_flag", "coastal_city", "district_market_index", "city_market_index", "property_age_bucket", "surface_x_rooms", "bathrooms_per_bedroom",
    "latitude", "longitude", "feature_completeness_score", "scraped_year", "scraped_month", "batch_id",
)
FACT_COLUMNS = ("time_id", "location_id", "price", "property_type", "listing_type", "surface_m2", "price_per_m2", "listing_url", "batch_id")

RAW = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])
CORE_SCHEMA = T.StructType([T.StructField(c, t) for c, t in CORE.items()])
FEATURE_SCHEMA = T.StructType([T.StructField(c, t) for c, t in FEATURES.items()])
