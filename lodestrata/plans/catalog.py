"""Named queries over the test tables, each with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import classify, location, numbers, text, url
from ..functions import patterns as P
from ..operators import clean as cleaning
from ..operators import quality, report, tables, warehouse
from ..session import filter_above, folder, stage
from ..sources import listings, pages
from .adapter import CURRENT_YEAR, FAULTS, ORIGINS, faulty_core, faulty_features, number_of, raw_listings
from .batch import TABLES, run_batch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, base: str = ORIGINS):
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLES[name] = (base + sql) if base else sql
        return f

    return add


def typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean(raw_listings(spark, sf_dir), CURRENT_YEAR)


def whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The accepted rows, core and features together, for a query that reads them once."""
    return cleaning.accepted(typed(spark, sf_dir))


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The accepted rows, parsed once and written down, for a query that reads them several times."""
    return stage(whole(spark, sf_dir), "accepted")


def batch(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Core and features of the clean rows as two tables."""
    rows = staged(spark, sf_dir)
    return cleaning.core(rows), cleaning.features(rows)


def _doubles(df: DataFrame) -> DataFrame:
    """Decimals as doubles, timestamps as text: equal in any engine."""
    kinds = dict(df.dtypes)
    return df.select(*(F.col(c).cast("double").alias(c) if k.startswith("decimal") else F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) if k.startswith("timestamp") else F.col(c) for c, k in kinds.items()))


CORE_SQL = """listing_url, title as listing_title_clean, description as description_clean, cast(price as double) as price, city, district, property_type, listing_type,
 case when k % 10 <> 0 then 33 + (k % 100) / 100.0::double end as latitude, case when k % 10 <> 0 then -(7 + (k % 100) / 100.0::double) end as longitude, strftime(d, '%Y-%m-%d %H:%M:%S') as scraped_at, batch_id"""


@query("clean_core", f"select {CORE_SQL} from clean")
def clean_core(spark, sf_dir):
    out = _doubles(cleaning.core(whole(spark, sf_dir)))
    return out.withColumns({c: F.round(c, 6) for c in ("latitude", "longitude")})


ORACLES["clean_core"] = ORACLES["clean_core"].replace("case when k % 10 <> 0 then 33 + (k % 100) / 100.0::double end as latitude", "round(case when k % 10 <> 0 then 33 + (k % 100) / 100.0::double end, 6) as latitude").replace("case when k % 10 <> 0 then -(7 + (k % 100) / 100.0::double) end as longitude", "round(case when k % 10 <> 0 then -(7 + (k % 100) / 100.0::double) end, 6) as longitude")

FEATURES_SQL = """listing_url, cast(s as double) as surface_m2, cast(bedrooms as int) as bedrooms, cast(bathrooms as int) as bathrooms, cast(floor as int) as floor, cast(built as int) as construction_year,
 cast(age as int) as property_age, ppm2c / 100.0::double as price_per_m2, cast(rooms as int) as rooms_total, case when rooms > 0 then ((200 * price + rooms) // (2 * rooms)) / 100.0::double end as price_per_room,
 ((20000 * rooms + s) // (2 * s)) / 10000.0::double as room_density, cast(luxury_flag as int) as luxury_flag, cast(coastal_city as int) as coastal_city,
 case when age <= 2 then 'new' when age <= 10 then 'recent' when age <= 30 then 'established' else 'old' end as property_age_bucket, cast(s * rooms as double) as surface_x_rooms,
 case when bedrooms > 0 then ((20000 * bathrooms + bedrooms) // (2 * bedrooms)) / 10000.0::double end as bathrooms_per_bedroom, extraction / 10000.0::double as extraction_score,
 complete / 10000.0::double as feature_completeness_score, batch_id"""


@query("clean_features", f"select {FEATURES_SQL} from clean")
def clean_features(spark, sf_dir):
    return _doubles(cleaning.features(whole(spark, sf_dir)))


@query("reject_reasons", "select reject_reason, count(*) as n from t where reject_reason is not null group by 1")
def reject_reasons(spark, sf_dir):
    return report.reasons(typed(spark, sf_dir))


_PRICE_TEXT = "case when k % 31 = 0 then 'Prix non spécifié' when k % 7 = 0 then replace(format('{:,}', rent), ',', ' ') || ' DH / mois' else replace(format('{:,}', amount), ',', ' ') || ' DH' end"


@query("dedup_first_by_url", f"select t.listing_url, t.k as ordinal, {_PRICE_TEXT.replace('k %', 't.k %')} as price_raw from t join o on o.k = t.k")
def dedup_first_by_url(spark, sf_dir):
    return cleaning.keep_first(cleaning.sanitize(raw_listings(spark, sf_dir))).select("listing_url", "ordinal", "price_raw")


_LAST = f"select t.listing_url, t.k + case when t.k % 97 = 0 then 1000000000 else 0 end as ordinal, case when t.k % 97 = 0 then '999 999 DH' else {_PRICE_TEXT.replace('k %', 't.k %')} end as price_raw from t join o on o.k = t.k"


@query("upsert_last_wins", _LAST)
def upsert_last_wins(spark, sf_dir):
    return cleaning.keep_last(cleaning.sanitize(raw_listings(spark, sf_dir))).select("listing_url", "ordinal", "price_raw")


def _tables(spark: SparkSession, name: str) -> tables.Tables:
    return tables.listing_tables(spark, f"{folder(spark)}/{name}-{uuid4().hex}")


@query("staging_last_wins", f"{_LAST} where t.k % 5 <> 0 union all {_LAST} where t.k % 5 = 0")
def staging_last_wins(spark, sf_dir):
    """The staging table after two batches, of which the second takes over rows of the first."""
    rows = stage(cleaning.sanitize(raw_listings(spark, sf_dir)), "raw")
    t = _tables(spark, "staging")
    t.replay("raw_listings", rows.withColumn("batch_id", F.lit("one")), "one")
    t.replay("raw_listings", rows.where(number_of(F.col("listing_url")) % 5 == 0).withColumn("batch_id", F.lit("two")), "two")
    return t.read("raw_listings").select("listing_url", "ordinal", "price_raw")


@query(
    "replay_cascade",
    "select 'clean_listings' as table_name, batch_id, count(*) as n, count(distinct k) as ids from clean where batch_id <> 'batch_1995' or k % 2 = 0 group by batch_id union all select 'clean_listing_features', batch_id, count(*), count(distinct k) from clean where batch_id <> 'batch_1995' or k % 4 = 0 group by batch_id",
)
def replay_cascade(spark, sf_dir):
    """A batch is loaded again with half of its listings and features for half of these: the features of all its old listings go with them."""
    core, features = batch(spark, sf_dir)
    k, old = number_of(F.col("listing_url")), F.col("batch_id") == "batch_1995"
    t = _tables(spark, "cascade")
    t.upsert("clean_listings", core)
    t.upsert("clean_listing_features", features)
    t.replay("clean_listings", core.where(old & (k % 2 == 0)), "batch_1995")
    t.replay("clean_listing_features", features.where(old & (k % 4 == 0)), "batch_1995")
    counts = [t.read(n).groupBy("batch_id").agg(F.count("*").alias("n"), F.count_distinct(i).alias("ids")).select(F.lit(n).alias("table_name"), "batch_id", "n", "ids") for n, i in (("clean_listings", "listing_id"), ("clean_listing_features", "listing_url"))]
    return counts[0].unionByName(counts[1])


@query(
    "batch_run_counts",
    "select v.table_name, v.n from (values ('raw_listings', (select count(*) from t)), ('clean_listings', (select count(*) from clean)), ('clean_listing_features', (select count(*) from clean)), ('fact_listing', (select count(*) from clean)), ('ml_property_features', (select count(*) from sale)), ('dim_time', (select count(distinct cast(d as date)) from clean)), ('dim_location', (select count(*) from (select distinct city, district from clean)))) v(table_name, n)",
)
def batch_run_counts(spark, sf_dir):
    """Rows of every table after a whole run from a raw file, in which some listings are repeated under an equivalent address."""
    root = f"{folder(spark)}/run-{uuid4().hex}"
    rows = raw_listings(spark, sf_dir).where("ordinal < 1000000000")
    again = rows.where("ordinal % 97 = 0").withColumn("listing_url", F.concat("listing_url", F.lit("/")))
    listings.write_csv(rows.unionByName(again).drop("ordinal"), f"{root}/raw")
    run_batch(spark, f"{root}/raw", root, CURRENT_YEAR, "batch_all", retries=0)
    t = tables.listing_tables(spark, f"{root}/tables")
    return spark.createDataFrame([(n, t.read(n).count()) for n in TABLES], "table_name string, n long")


@query("delete_batch", "select batch_id, count(*) as n from clean where batch_id <> 'batch_1995' group by 1")
def delete_batch(spark, sf_dir):
    return tables.without_batch(whole(spark, sf_dir), "batch_1995").groupBy("batch_id").agg(F.count("*").alias("n"))


@query("two_batch_merge", "select case when k % 10 = 0 then 'stolen' else batch_id end as batch_id, count(*) as n, cast(sum(case when k % 10 = 0 then price + 1 else price end) as double) as total from clean group by 1")
def two_batch_merge(spark, sf_dir):
    core = batch(spark, sf_dir)[0]
    k = number_of(F.col("listing_url"))
    later = core.where(k % 10 == 0).withColumns({"batch_id": F.lit("stolen"), "price": (F.col("price") + 1).cast("decimal(20,2)")})
    return tables.replay(core, later, "stolen").groupBy("batch_id").agg(F.count("*").alias("n"), F.sum("price").cast("double").alias("total"))


# --- warehouse


@query("dim_time", "select distinct cast(d as date) as date, cast(year(d) as int) as year, cast(month(d) as int) as month, monthname(d) as month_name, cast(quarter(d) as int) as quarter from clean")
def dim_time(spark, sf_dir):
    return warehouse.time_rows(whole(spark, sf_dir))


@query("dim_location", "select distinct city, district from clean")
def dim_location(spark, sf_dir):
    return warehouse.location_rows(whole(spark, sf_dir))


@query("dim_location_incremental", "select city, district, row_number() over (order by city, district) as location_id from (select distinct city, district from clean where batch_id = 'batch_1995') union all select city, district, row_number() over (order by city, district) + (select count(*) from (select distinct city, district from clean where batch_id = 'batch_1995')) from (select distinct city, district from clean except select distinct city, district from clean where batch_id = 'batch_1995')")
def dim_location_incremental(spark, sf_dir):
    core = batch(spark, sf_dir)[0]
    first = warehouse.add_locations(core.where("batch_id = 'batch_1995'"))
    return warehouse.add_locations(core, first).select("city", "district", "location_id")


@query("fact_listing", "select cast(d as date) as date, city, district, cast(price as double) as price, property_type, listing_type, cast(s as double) as surface_m2, ppm2c / 100.0::double as price_per_m2, listing_url, batch_id from clean")
def fact_listing(spark, sf_dir):
    rows = staged(spark, sf_dir)
    times, places = warehouse.add_times(rows), warehouse.add_locations(rows)
    fact = warehouse.facts(rows, None, times, places)
    out = fact.join(times.select("time_id", "date"), "time_id").join(places, "location_id")
    return _doubles(out.select("date", "city", "district", "price", "property_type", "listing_type", "surface_m2", "price_per_m2", "listing_url", "batch_id"))


@query("fk_integrity", "select 'foreign_keys_integrity' as check_name, count(*) = 0 as passed, count(*) as bad_rows from clean where month(d) = 1 or city = 'Rabat' or k % 73 = 0")
def fk_integrity(spark, sf_dir):
    """Facts whose days, places and clean rows are partly gone."""
    rows = staged(spark, sf_dir)
    times, places = warehouse.add_times(rows), warehouse.add_locations(rows)
    fact = warehouse.facts(rows, None, times, places)
    left = cleaning.core(rows).where(number_of(F.col("listing_url")) % 73 != 0)
    return quality.foreign_keys(warehouse.orphans(fact, times.where("month <> 1"), places.where("city <> 'Rabat'"), left)).drop("details")


ML_SQL = f"""
 , ci as (select city as c, quantile_cont(ppm2, 0.5) as v from sale group by 1), di as (select city as c, district as dd, quantile_cont(ppm2, 0.5) as v from sale group by 1, 2)
 select {FEATURES_SQL.replace("feature_completeness_score, batch_id", "feature_completeness_score, batch_id").replace("extraction / 10000.0::double as extraction_score,", "")}, cast(price as double) as price, round(ln(price), 9) as log_price, city, district, property_type, listing_type,
 round(di.v, 6) as district_market_index, round(ci.v, 6) as city_market_index, round(case when k % 10 <> 0 then 33 + (k % 100) / 100.0::double end, 6) as latitude, round(case when k % 10 <> 0 then -(7 + (k % 100) / 100.0::double) end, 6) as longitude,
 cast(year(d) as int) as scraped_year, cast(month(d) as int) as scraped_month
 from sale left join ci on ci.c = city left join di on di.c = city and di.dd = district"""


@query("ml_features", ML_SQL)
def ml_features(spark, sf_dir):
    out = _doubles(warehouse.ml_features(staged(spark, sf_dir)))
    return out.withColumns({"log_price": F.round("log_price", 9)} | {c: F.round(c, 6) for c in ("latitude", "longitude", "district_market_index", "city_market_index")})


@query("city_market_index", "select city, round(quantile_cont(ppm2, 0.5), 6) as city_market_index from sale group by 1")
def city_market_index(spark, sf_dir):
    return warehouse.market_index(warehouse.sales(staged(spark, sf_dir)), ["city"], "city_market_index").withColumn("city_market_index", F.round("city_market_index", 6))


@query("district_market_index", "select city, district, round(quantile_cont(ppm2, 0.5), 6) as district_market_index from sale group by 1, 2")
def district_market_index(spark, sf_dir):
    return warehouse.market_index(warehouse.sales(staged(spark, sf_dir)), ["city", "district"], "district_market_index").withColumn("district_market_index", F.round("district_market_index", 6))


# --- analytics


@query("layer_counts", "select (select count(*) from t) + (select count(*) from t where k % 97 = 0) as raw_rows, (select count(*) from clean) as clean_rows, (select count(*) from clean) as feature_rows, (select count(*) from sale) as ml_rows")
def layer_counts(spark, sf_dir):
    core, features = batch(spark, sf_dir)
    one = lambda df, n: df.agg(F.count("*").alias(n))
    return one(raw_listings(spark, sf_dir), "raw_rows").crossJoin(one(core, "clean_rows")).crossJoin(one(features, "feature_rows")).crossJoin(one(warehouse.sales(core, features), "ml_rows"))


@query("market_stats", "select count(*) as n, cast(min(price) as double) as lowest, cast(max(price) as double) as highest, round(sum(price) / count(*), 2) as mean from clean")
def market_stats(spark, sf_dir):
    core = whole(spark, sf_dir)
    return core.agg(F.count("*").alias("n"), F.min("price").cast("double").alias("lowest"), F.max("price").cast("double").alias("highest"), F.round(F.sum("price").cast("double") / F.count("*"), 2).alias("mean"))


@query("geo_benchmark", "select city, district, count(*) as n, round(quantile_cont(ppm2c / 100.0::double, 0.5), 6) as median_price_per_m2 from clean where ppm2c is not null group by 1, 2 having count(*) >= 10")
def geo_benchmark(spark, sf_dir):
    out = warehouse.medians(staged(spark, sf_dir), ["city", "district"], "price_per_m2", "median_price_per_m2")
    return out.where("n >= 10").select("city", "district", "n", F.round("median_price_per_m2", 6).alias("median_price_per_m2"))


@query("batch_trend", "select batch_id, count(*) as n, round(sum(price) / count(*), 2) as mean_price, strftime(min(d), '%Y-%m-%d %H:%M:%S') as first_seen from clean group by 1")
def batch_trend(spark, sf_dir):
    core = whole(spark, sf_dir)
    return core.groupBy("batch_id").agg(F.count("*").alias("n"), F.round(F.sum("price").cast("double") / F.count("*"), 2).alias("mean_price"), F.date_format(F.min("scraped_at"), "yyyy-MM-dd HH:mm:ss").alias("first_seen"))


def _top(column: str, limit: int):
    def run(spark, sf_dir):
        return report.top_values(whole(spark, sf_dir), column, limit)

    return run


for _name, _column, _limit in (("listing_type_distribution", "listing_type", 1000), ("top_property_types", "property_type", 10), ("top_cities", "city", 10), ("top_districts", "district", 10)):
    query(_name, f"select {_column}, count(*) as n from clean where {_column} is not null group by 1 order by n desc, 1 limit {_limit}")(_top(_column, _limit))

_ML_OPTIONAL = {"bedrooms": "bedrooms", "bathrooms": "bathrooms", "floor": "floor", "latitude": "case when k % 10 <> 0 then 1 end", "price_per_room": "case when rooms > 0 then 1 end"}


@query("ml_missing_pct", "select " + ", ".join(f"round(100.0::double * count(*) filter (where {v} is null) / count(*), 2) as {c}" for c, v in _ML_OPTIONAL.items()) + " from sale")
def ml_missing_pct(spark, sf_dir):
    return report.missing_percent(warehouse.sales(whole(spark, sf_dir)), list(_ML_OPTIONAL))


_PROFILE = {"price": "price", "district": "district", "description_clean": "description", "latitude": "case when k % 10 <> 0 then 1 end", "surface_m2": "s", "price_per_m2": "ppm2c", "price_per_room": "case when rooms > 0 then 1 end", "room_density": "s", "bathrooms_per_bedroom": "case when bedrooms > 0 then 1 end"}


@query("column_profile", " union all ".join(f"select '{c}' as column_name, count(*) filter (where {v} is null) as missing, round(100.0::double * count(*) filter (where {v} is null) / count(*), 2) as missing_percent from clean" for c, v in _PROFILE.items()))
def column_profile(spark, sf_dir):
    return report.column_profile(cleaning.accepted(typed(spark, sf_dir))).where(F.col("column_name").isin(*_PROFILE)).select("column_name", "missing", "missing_percent")


@query("decimal_stats", " union all ".join(f"select '{c}' as column_name, cast(min({v}) as double) as min_value, cast(max({v}) as double) as max_value, round(sum({v}) / count({v})::double, 2) as avg_value from clean" for c, v in (("price", "price"), ("surface_m2", "s"), ("price_per_m2", "ppm2c / 100.0::double"))))
def decimal_stats(spark, sf_dir):
    return report.decimal_stats(cleaning.accepted(typed(spark, sf_dir)))


@query("success_rates", "select round(100 - 100.0::double * count(*) filter (where reject_reason = 'invalid_price') / n, 2) as price, 100.0::double as property_type, round(100 - 100.0::double * count(*) filter (where reject_reason = 'missing_district') / n, 2) as location from t, (select count(*) + count(*) filter (where k % 97 = 0) as n from t) group by n")
def success_rates(spark, sf_dir):
    raw = raw_listings(spark, sf_dir).agg(F.count("*").alias("raw_n"))
    rows = typed(spark, sf_dir).crossJoin(F.broadcast(raw))
    return report.success_rates(rows, F.max("raw_n"))


@query("quality_warnings", "select w.warning from (select count(*) as n, count(*) filter (where s is not null and k % 3 = 0) as s, count(*) filter (where bedrooms is not null and k % 2 = 0) as b, count(*) filter (where listing_type = 'sale' and s is not null and k % 3 = 0 and ppm2c is not null and complete >= 7000) as m from clean) c, (values ('surface completeness below 70 percent', 1), ('bedrooms completeness below 60 percent', 2), ('fewer than half of the clean rows are model candidates', 3)) w(warning, i) where n > 0 and ((i = 1 and 100 * s < 70 * n) or (i = 2 and 100 * b < 60 * n) or (i = 3 and 2 * m < n))")
def quality_warnings(spark, sf_dir):
    """Rows of which two in three have lost their surface and every other one its bedrooms."""
    k = number_of(F.col("listing_url"))
    rows = whole(spark, sf_dir)
    return report.warnings(filter_above(rows, F.lit(True)).withColumns({"surface_m2": F.when(k % 3 == 0, F.col("surface_m2")), "bedrooms": F.when(k % 2 == 0, F.col("bedrooms"))}))


# --- parts of cleaning, over all typed rows


def _typed_columns(name: str, columns: dict[str, str], sql: str):
    def run(spark, sf_dir):
        return _doubles(filter_above(typed(spark, sf_dir), F.lit(True)).selectExpr("listing_url", *(f"{v} as {c}" for c, v in columns.items())))

    query(name, f"select listing_url, {sql} from t")(run)


_typed_columns("parse_price", {"price": "price", "listing_type": "listing_type"}, "cast(price as double) as price, listing_type")
_typed_columns("parse_surface", {"surface_m2": "surface_m2"}, "cast(s as double) as surface_m2")
_typed_columns("parse_rooms", {"bedrooms": "bedrooms", "bathrooms": "bathrooms", "rooms_total": "rooms_total"}, "cast(bedrooms as int) as bedrooms, cast(bathrooms as int) as bathrooms, cast(rooms as int) as rooms_total")
_typed_columns("parse_floor", {"floor": "floor"}, "cast(floor as int) as floor")
_typed_columns("parse_year", {"construction_year": "construction_year", "property_age_bucket": "property_age_bucket"}, "cast(built as int) as construction_year, case when age <= 2 then 'new' when age <= 10 then 'recent' when age <= 30 then 'established' else 'old' end as property_age_bucket")
_typed_columns("classify_property_type", {"property_type": "property_type"}, "property_type")
_typed_columns("city_alias", {"city": "city", "district": "district"}, "city, district")
_typed_columns("title_clean", {"listing_title_clean": "listing_title_clean"}, "title as listing_title_clean")
_typed_columns("ppm2_by_type_range", {"property_type": "property_type", "price_per_m2": "price_per_m2"}, "property_type, ppm2c / 100.0::double as price_per_m2")
_typed_columns("extraction_score", {"extraction_score": "extraction_score"}, "extraction / 10000.0::double as extraction_score")


@query("property_age_bucket", "select case when age <= 2 then 'new' when age <= 10 then 'recent' when age <= 30 then 'established' else 'old' end as property_age_bucket, count(*) as n from clean group by 1")
def property_age_bucket(spark, sf_dir):
    return whole(spark, sf_dir).groupBy("property_age_bucket").agg(F.count("*").alias("n"))


@query("rooms_features", "select property_type, count(*) as n, cast(sum(rooms) as bigint) as rooms, round(avg(((20000 * rooms + s) // (2 * s)) / 10000.0::double), 6) as mean_density from clean group by 1")
def rooms_features(spark, sf_dir):
    return whole(spark, sf_dir).groupBy("property_type").agg(F.count("*").alias("n"), F.sum("rooms_total").alias("rooms"), F.round(F.avg(F.col("room_density").cast("double")), 6).alias("mean_density"))


# --- checks


# The checks run over clean rows with faults (`adapter.faulty_core`, `faulty_features`), which SQL counts from the numbers.


def _checks_sql(rows: list[tuple[str, bool, str]]) -> str:
    """check_name, passed and bad_rows of (name, does it fail, SQL of the count)."""
    return FAULTS + " union all ".join(f"select '{n}' as check_name, {'bad_rows = 0' if hard else 'true'} as passed, bad_rows from (select cast(({v}) as bigint) as bad_rows)" for n, hard, v in rows)


_OUT = "price not between 300 and 100000000"
_PHONE_LEFT = "title = 'Appel 0612345678 svp'"


@query(
    "dq_core",
    _checks_sql(
        [
            ("clean_no_duplicate_listing_url", True, "select count(*) - count(distinct k) from bad"),
            ("clean_required_columns_not_null", True, "select count(*) from bad where district is null"),
            ("warning_clean_realistic_price", False, f"select count(*) from bad where {_OUT}"),
            ("warning_clean_title_length", False, "select count(*) from bad where length(title) < 15"),
            ("no_personal_data_patterns", True, f"select count(*) from bad where {_PHONE_LEFT}"),
            ("required_columns_not_null", True, "select count(*) from bad where district is null or listing_type = 'lease'"),
            ("warning_required_value_quality", False, f"select count(*) from bad where length(title) < 15 or {_OUT}"),
        ]
    ),
)
def dq_core(spark, sf_dir):
    return quality.core_checks(faulty_core(cleaning.core(staged(spark, sf_dir)))).drop("details")


_THERE = "k % 73 <> 0"
_WRONG = "shown is not null and (s is null or abs(shown - ppm2c) > 1)"
_RANGE = "coalesce(s not between 10 and 20000, false) or coalesce(bedrooms not between 0 and 20, false) or coalesce(bathrooms not between 0 and 20, false) or coalesce(floor not between 0 and 60, false) or coalesce(shown not between 10000 and 10000000, false)"


@query(
    "dq_joins",
    _checks_sql(
        [
            ("features_join_key_matches_core", True, "select count(*) from badf where k % 73 = 0"),
            ("warning_features_price_per_m2_quality", False, f"select count(*) from badf where (k % 73 = 0 and shown is not null) or ({_WRONG})"),
            ("warning_optional_values_out_of_range", False, f"select count(*) from badf where {_THERE} and ({_RANGE})"),
            ("price_per_m2_coherence", True, f"select count(*) from badf where {_THERE} and {_WRONG}"),
        ]
    ),
)
def dq_joins(spark, sf_dir):
    core, features = batch(spark, sf_dir)
    return quality.join_checks(core.where(number_of(F.col("listing_url")) % 73 != 0), faulty_features(features)).drop("details")


_PRESENT = {
    "surface_m2": "s", "bedrooms": "bedrooms", "bathrooms": "bathrooms", "floor": "floor", "construction_year": "built", "property_age": "age", "price_per_m2": "ppm2c", "rooms_total": "rooms",
    "price_per_room": "case when rooms > 0 then 1 end", "room_density": "s", "luxury_flag": "1", "coastal_city": "1", "property_age_bucket": "age", "surface_x_rooms": "s",
    "bathrooms_per_bedroom": "case when bedrooms > 0 then 1 end", "extraction_score": "1", "feature_completeness_score": "1",
}


@query(
    "dq_completeness",
    _checks_sql(
        [(f"warning_optional_{c}_completeness", False, f"select count(*) filter (where ({v}) is null) from clean") for c, v in _PRESENT.items()]
        + [
            ("features_no_duplicate_listing_url", True, "select count(*) from clean where k % 71 = 0"),
            ("warning_features_optional_values_out_of_range", False, "select sum(bad) from (select (coalesce(s not between 10 and 20000, false)::int + coalesce(bedrooms not between 0 and 20, false)::int + coalesce(shown not between 10000 and 10000000, false)::int) as bad from badf union all select (coalesce(s not between 10 and 20000, false)::int + coalesce(bedrooms not between 0 and 20, false)::int + coalesce(shown not between 10000 and 10000000, false)::int) from badf where k % 71 = 0)"),
        ]
    ),
)
def dq_completeness(spark, sf_dir):
    """Completeness of all optional columns; repeated rows and values out of range in spoiled ones."""
    features = cleaning.features(staged(spark, sf_dir))
    spoiled = faulty_features(features)
    spoiled = spoiled.unionByName(spoiled.where(number_of(F.col("listing_url")) % 71 == 0))
    complete, rest = F.col("check_name").endswith("_completeness"), quality.feature_checks(spoiled)
    return quality.feature_checks(features).where(complete).unionByName(rest.where(~complete)).drop("details")


@query("dq_duplicates", "select 'no_duplicate_listing_url' as check_name, count(*) = 0 as passed, count(*) as bad_rows from t where k % 97 = 0")
def dq_duplicates(spark, sf_dir):
    return quality.duplicate_keys(cleaning.sanitize(raw_listings(spark, sf_dir))).drop("details")


@query("dq_rental_contamination", "select 'ml_no_rental_contamination' as check_name, count(*) = 0 as passed, count(*) as bad_rows from sale where k % 89 = 0")
def dq_rental_contamination(spark, sf_dir):
    ml = warehouse.ml_features(staged(spark, sf_dir))
    return quality.rental_contamination(ml.withColumn("listing_type", F.when(number_of(F.col("listing_url")) % 89 == 0, "rent").otherwise(F.col("listing_type")))).drop("details")


@query("dq_counts", "select v.check_name, v.bad_rows = 0 as passed, v.bad_rows from (values ('fact_count_equals_clean_count', (select count(*) from clean where k % 73 = 0)), ('ml_count_not_greater_than_sale_clean_count', (select count(*) - count(*) filter (where listing_type = 'sale') from clean)), ('clean_table_count_equals_clean_rows', cast(7 as bigint))) v(check_name, bad_rows)")
def dq_counts(spark, sf_dir):
    """A fact that lacks rows, a model table with rents, a clean table that lacks seven rows of its file."""
    rows = staged(spark, sf_dir)
    fact = warehouse.facts(rows.where(number_of(F.col("listing_url")) % 73 != 0), None, warehouse.add_times(rows), warehouse.add_locations(rows))
    return quality.count_checks(rows, fact, rows, rows.count() + 7).drop("details")


@query("dq_personal_data_raw", f"{FAULTS} select 'no_personal_data_in_files' as check_name, false as passed, (select count(*) from bad where {_PHONE_LEFT}) + (select count(*) + count(*) filter (where k % 97 = 0) from t where k % 61 = 0) as bad_rows")
def dq_personal_data_raw(spark, sf_dir):
    """Raw rows that were not sanitized, and clean ones with faults."""
    core, features = batch(spark, sf_dir)
    raw = raw_listings(spark, sf_dir).drop("ordinal")
    raw = raw.withColumn("listing_title_raw", F.when(number_of(F.col("listing_url")) % 61 == 0, "Appel 0612345678 svp").otherwise(F.col("listing_title_raw")))
    return quality.personal_data(raw, faulty_core(core), features).drop("details")


@query("orphan_features", "select listing_url from clean where batch_id = 'batch_1996'")
def orphan_features(spark, sf_dir):
    core, features = batch(spark, sf_dir)
    return features.join(core.where("batch_id <> 'batch_1996'").select("listing_url"), "listing_url", "left_anti").select("listing_url")


# --- text operators over documents, pages and events


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


_EMAIL_RE2 = r"(?i)(^|[^\pL\pN_])[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}([^\pL\pN_]|$)"
_PHONE_RE2 = r"(^|[^0-9])(\+?212|0)[\s.\-]?[567][\s.\-]?([0-9][\s.\-]?){7,8}([^0-9]|$)"


@query("pii_flag_documents", f"select doc_id, regexp_matches(text, '{_EMAIL_RE2}') or regexp_matches(text, '{_PHONE_RE2}') as has_personal_data from documents", base="")
def pii_flag_documents(spark, sf_dir):
    return _read(spark, sf_dir, "documents").select("doc_id", text.has_personal_data(F.col("text")).alias("has_personal_data"))


def _redacted(c: str) -> str:
    """The replacements in SQL: RE2 has no look-around, so neighbours are captured, and a second pass finds matches that share one."""
    for pattern, label, groups in ((_EMAIL_RE2, "[REDACTED_EMAIL]", (1, 2)), (_PHONE_RE2, "[REDACTED_PHONE]", (1, 4))):
        for _ in range(2):
            c = f"regexp_replace({c}, '{pattern}', '\\{groups[0]}{label}\\{groups[1]}', 'g')"
    return c


@query("pii_redact_documents", f"select doc_id, {_redacted('text')} as text from documents", base="")
def pii_redact_documents(spark, sf_dir):
    return _read(spark, sf_dir, "documents").select("doc_id", text.redact(F.col("text")).alias("text"))


@query("null_spelling", "select turn, role, count(*) as n, count(case when lower(trim(text)) in ('nan','none','null','na','n/a','-','') then null else text end) as kept from conversations group by 1, 2", base="")
def null_spelling(spark, sf_dir):
    return _read(spark, sf_dir, "conversations").select("turn", "role", text.known(F.col("text")).alias("t")).groupBy("turn", "role").agg(F.count("*").alias("n"), F.count("t").alias("kept"))


@query("text_keys_documents", "select doc_id, trim(regexp_replace(lower(strip_accents(coalesce(text, ''))), '[^a-z0-9]+', ' ', 'g')) as key from documents", base="")
def text_keys_documents(spark, sf_dir):
    return _read(spark, sf_dir, "documents").select("doc_id", text.key(F.col("text")).alias("key"))


@query("text_sanitize_pages")
def text_sanitize_pages(spark, sf_dir):
    return _read(spark, sf_dir, "pages").select("page_id", text.sanitize(F.col("html")).alias("text"))


@query("url_normalize_pages", r"select page_id, regexp_replace(regexp_replace(regexp_replace(url, '[?#].*$', ''), ';[^/]*$', ''), '/+$', '') as url from pages", base="")
def url_normalize_pages(spark, sf_dir):
    return _read(spark, sf_dir, "pages").select("page_id", url.normalize(F.col("url"), None).alias("url"))


@query("url_dedup_pages", r"select u as url, min(page_id) as page_id from (select page_id, regexp_replace(regexp_replace(regexp_replace(url, '[?#].*$', ''), ';[^/]*$', ''), '/+$', '') as u from pages) group by 1", base="")
def url_dedup_pages(spark, sf_dir):
    rows = _read(spark, sf_dir, "pages").select("page_id", url.normalize(F.col("url"), None).alias("url"))
    return cleaning.keep_first(rows, "url", "page_id").select("url", "page_id")


@query(
    "url_title_pages",
    r"""select page_id, case when lower(t) not in ('', 'listing', 'annonce') then upper(left(t, 1)) || substr(t, 2) end as title from (
      select page_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_extract(regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', ''), '^[^:]+://[^/]*(?:.*/)?([^/]*)$', 1), '(.)\.[^.]*$', '\1'), '_[0-9]+$', ''), '[_-]+', ' ', 'g')) as t from pages)""".replace("\\\\", "\\"),
    base="",
)
def url_title_pages(spark, sf_dir):
    return _read(spark, sf_dir, "pages").select("page_id", url.title(url.normalize(F.col("url"), None)).alias("title"))


@query("html_meta_pages", r"select page_id, nullif(trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '\s+', ' ', 'g')), '') as title, regexp_extract(html, '(?i)<meta[^>]*charset=[''\x22]?([A-Za-z0-9_-]+)', 1) as charset from pages", base="")
def html_meta_pages(spark, sf_dir):
    html = F.col("html")
    title = F.nullif(F.trim(F.regexp_replace(F.regexp_extract(html, "(?is)<title[^>]*>(.*?)</title>", 1), r"\s+", " ")), F.lit(""))
    return _read(spark, sf_dir, "pages").select("page_id", title.alias("title"), F.regexp_extract(html, "(?i)<meta[^>]*charset=['\"]?([A-Za-z0-9_-]+)", 1).alias("charset"))


@query("html_links_pages", r"select page_id, len(regexp_extract_all(html, '(?i)<a\s[^>]*href=[''\x22]([^''\x22]*)[''\x22]', 1)) as n_links, array_to_string(regexp_extract_all(html, '(?i)<a\s[^>]*href=[''\x22]([^''\x22]*)[''\x22]', 1), ' ') as links from pages", base="")
def html_links_pages(spark, sf_dir):
    links = F.regexp_extract_all("html", F.lit(r"(?i)<a\s[^>]*href=['\"]([^'\"]*)['\"]"), 1)
    return _read(spark, sf_dir, "pages").select("page_id", F.size(links).cast("bigint").alias("n_links"), F.array_join(links, " ").alias("links"))


@query("html_blocked_pages", r"select page_id, regexp_matches(left(html, 4000), '(?i)\b(captcha|robot|access denied|too many requests|cloudflare|unusual traffic)\b') as blocked from pages", base="")
def html_blocked_pages(spark, sf_dir):
    return _read(spark, sf_dir, "pages").select("page_id", pages.is_blocked(F.col("html")).alias("blocked"))


@query("html_cards_pages")
def html_cards_pages(spark, sf_dir):
    return pages.listings(_read(spark, sf_dir, "pages"), None)


@query("json_props_events", "select event_type, count(*) as n, cast(sum(cast(json_extract(props, '$.k') as bigint)) as bigint) as total from events group by 1", base="")
def json_props_events(spark, sf_dir):
    k = F.from_json("props", "k bigint")["k"]
    return _read(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.sum(k).alias("total"))


@query("page_classes_documents")
def page_classes_documents(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents").select("doc_id", F.col("text"))
    return docs.select("doc_id", classify.page_property_type([F.col("text")]).alias("property_type"), classify.page_listing_type([F.col("text")]).alias("listing_type"), location.candidate(F.col("text")).alias("place"), numbers.coordinate(F.col("text"), 90).cast("double").alias("x"))


@query("tokens_with_luxury_words", f"select doc_id, regexp_matches(text, '(?i)(^|[^\\pL\\pN_])(luxe|haut +standing|prestige|premium|piscine|golf|vue +mer|front +mer|marina|neuf|résidence +fermée|residence +fermee)([^\\pL\\pN_]|$)') as luxury from documents", base="")
def tokens_with_luxury_words(spark, sf_dir):
    return _read(spark, sf_dir, "documents").select("doc_id", F.col("text").rlike(P.LUXURY).alias("luxury"))
