"""Reading and writing listing files: header contracts, batch ids, CSV and Parquet, typed reload with reject reasons."""

from __future__ import annotations

import logging
import re
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import classify, location, numbers, text, url
from ..functions import patterns as P
from ..operators import clean as cleaning
from ..session import filter_above

log = logging.getLogger(__name__)
_BATCH = r"(batch_\d{8}T\d{6}Z|batch_[A-Za-z0-9_-]+)"
# Columns that files of an older form must have.
OLD_CORE = ("listing_title_clean", "price", "city", "district", "listing_url", "scraped_at", "batch_id")
OLD_FEATURES = ("listing_url", "surface_m2", "bedrooms", "bathrooms", "floor", "price_per_m2")
TRUE = ("1", "true", "yes", "y", "on")


def batch_id(path: str | None = None, given: str | None = None) -> str:
    """The given id, the one in the file's name, or one made of the clock."""
    found = re.search(_BATCH, (path or "").rsplit("/", 1)[-1].rsplit(".", 1)[0])
    return given or (found[1] if found else datetime.now(UTC).strftime("batch_%Y%m%dT%H%M%SZ"))


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text; an empty cell is null. multiLine files are not split: keep CSV files small and many, or use Parquet."""
    return spark.read.csv(path, header=True, inferSchema=False, multiLine=True, escape='"', encoding="UTF-8")


def latest(spark: SparkSession, pattern: str) -> str:
    """The newest file of a glob, in any file system that Spark reads."""
    found = spark.read.format("binaryFile").load(pattern).select("path", "modificationTime").orderBy(F.col("modificationTime").desc(), F.col("path").desc()).first()
    if not found:
        raise FileNotFoundError(pattern)
    return found.path


def check_header(df: DataFrame, required, allowed=None) -> None:
    missing = sorted(set(required) - set(df.columns))
    extra = sorted(set(df.columns) - set(allowed)) if allowed is not None else []
    if missing or extra:
        raise ValueError(f"CSV columns missing: {missing}, not allowed: {extra}")


def read_raw(spark: SparkSession, path: str, batch: str | None = None) -> DataFrame:
    """A raw CSV file under its contract (a title under its older name is accepted); the batch id is stamped on every row; the order of reading is kept as ordinal."""
    df = read_csv(spark, path)
    required = set(schemas.RAW_COLUMNS) - {"source", "detail_scraped"}
    if "listing_title" in df.columns:
        required -= {"listing_title_raw"}
    check_header(df, required)
    if batch:
        df = df.withColumn("batch_id", F.lit(batch))
    return df.withColumn("ordinal", F.monotonically_increasing_id())


def read_staging(spark: SparkSession, path: str, batch: str, source: str = "listings", site: url.Site = url.SITE) -> DataFrame:
    """Raw rows for the staging table: sanitized, empty cells null, a default source, detail_scraped as boolean. Raises for personal data; rows without an address are counted in a warning."""
    rows = cleaning.sanitize(cleaning.conform(read_raw(spark, path, batch)), site)
    cleaning.assert_contract(rows.drop("ordinal"), schemas.RAW_COLUMNS)
    lost = rows.where(F.col("listing_url").isNull()).count()
    if lost:
        log.warning("raw_csv_missing_listing_url file=%s batch_id=%s rows=%d", path, batch, lost)
    return rows.withColumns({"source": F.coalesce("source", F.lit(source)), "detail_scraped": F.coalesce(F.lower(F.trim("detail_scraped")).isin(*TRUE), F.lit(False))})


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header; decimals in plain notation, null as an empty cell."""
    kinds = dict(df.dtypes)
    plain = [F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss").alias(c) if k.startswith("timestamp") else F.col(c).cast("string").alias(c) for c, k in kinds.items()]
    df.select(*plain).write.mode("overwrite").csv(path, header=True, nullValue="", emptyValue="", escape='"')


def write_batch(df: DataFrame, path: str) -> None:
    """Parquet by batch; a batch that is written again replaces its folder only."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)


def reload_core(df: DataFrame, batch: str | None = None, site: url.Site = url.SITE) -> DataFrame:
    """A clean core file typed anew, with reject_reason.

    Property type and listing type are inferred again from the texts and the price, so a stored label does not decide; a price outside the inferred type's range is rejected.
    """
    check_header(df, OLD_CORE)
    rows = text.each(df, {f"_{c}": F.col(c) if c in df.columns else F.lit(None) for c in schemas.CORE}, text.clean)
    texts = [F.col("_listing_title_clean"), F.col("_description_clean"), F.col("_listing_url")]
    rows = rows.withColumn("_kind", classify.property_type([F.col("_property_type"), *texts]))
    rows = rows.withColumn("_type", classify.listing_type(F.col("_listing_type"), F.concat_ws(" ", *texts), numbers.any_decimal(F.col("_price"))))
    given = {"property_type": F.coalesce("_property_type", "_kind"), "listing_type": F.coalesce("_listing_type", "_type")}
    missing = F.coalesce(*(F.when(given.get(c, F.col(f"_{c}")).isNull(), F.lit(f"missing_{c}")) for c in schemas.REQUIRED))
    out = {
        "listing_title_clean": F.col("_listing_title_clean"), "description_clean": F.col("_description_clean"), "price": numbers.price([F.col("_price")], F.col("_type")),
        "city": location.city(F.col("_city")), "district": location.district(F.col("_district")), "property_type": F.col("_kind"), "listing_type": F.col("_type"),
        "latitude": numbers.coordinate(F.col("_latitude"), 90), "longitude": numbers.coordinate(F.col("_longitude"), 180), "listing_url": url.normalize(F.col("_listing_url"), site),
        "scraped_at": F.date_trunc("second", cleaning.utc_time(F.col("_scraped_at"))), "batch_id": F.coalesce(F.col("_batch_id"), F.lit(batch)),
    }
    rows = filter_above(rows.select(*(v.alias(c) for c, v in out.items()), missing.alias("_missing")), F.lit(True))
    late = F.coalesce(*(F.when(F.col(c).isNull(), F.lit(f"missing_{c}")) for c in schemas.REQUIRED))
    reason = F.coalesce("_missing", F.when(F.col("price").isNull(), "invalid_price"), F.when(F.col("listing_url").isNull(), "invalid_listing_url"), late)
    return filter_above(rows.withColumn("reject_reason", reason).drop("_missing"), F.lit(True))


def reload_features(df: DataFrame, batch: str | None = None, site: url.Site = url.SITE) -> DataFrame:
    """A features file typed anew, with reject_reason; values out of range become null, a row with nothing left is rejected."""
    check_header(df, OLD_FEATURES)
    df = text.each(df, {f"_{c}": F.col(c) if c in df.columns else F.lit(None) for c in schemas.FEATURES}, text.clean)
    have = lambda c: F.col(f"_{c}")
    within = lambda c, b: numbers.once(numbers.any_decimal(have(c)), lambda x: F.when(x.between(F.lit(b[0]), F.lit(b[1])), x))
    whole = {"bedrooms": P.ROOMS, "bathrooms": P.ROOMS, "floor": P.FLOOR, "construction_year": (1800, 2100), "property_age": (0, 200), "rooms_total": (0, 40), "luxury_flag": (0, 1), "coastal_city": (0, 1)}
    plain = {"room_density": None, "surface_x_rooms": None, "bathrooms_per_bedroom": None, "extraction_score": 1, "feature_completeness_score": 1}
    value = {c: numbers.integer(have(c), b) for c, b in whole.items()} | {c: numbers.plain_decimal(have(c), 0, high) for c, high in plain.items()}
    value |= {"listing_url": url.normalize(have("listing_url"), site), "surface_m2": within("surface_m2", P.SURFACE), "price_per_m2": within("price_per_m2", P.ANY_PPM2), "price_per_room": numbers.any_decimal(have("price_per_room")), "property_age_bucket": have("property_age_bucket"), "batch_id": F.coalesce(have("batch_id"), F.lit(batch))}
    rows = filter_above(df.select(*(value[c].try_cast(t).alias(c) for c, t in schemas.FEATURES.items())), F.lit(True))
    analytic = [c for c in schemas.OPTIONAL_FEATURES if c not in ("extraction_score", "feature_completeness_score")]
    empty = F.coalesce(*(F.col(c).cast("string") for c in analytic)).isNull()
    return filter_above(rows.withColumn("reject_reason", F.when(F.col("listing_url").isNull(), "invalid_listing_url").when(empty, "all_features_missing")), F.lit(True))


def load(core: DataFrame, features: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What goes into the clean tables: accepted core rows, and the accepted features whose address is among them."""
    ok = core.where(F.col("reject_reason").isNull()).select(*schemas.CORE)
    kept = features.where(F.col("reject_reason").isNull()).join(ok.select("listing_url"), "listing_url", "left_semi").select(*schemas.FEATURES)
    return ok, kept


def empty_raw(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], T.StructType(schemas.RAW.fields))
