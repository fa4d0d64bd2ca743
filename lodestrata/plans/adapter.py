"""Synthetic raw listings made from orders, customers and line items, so that every parser and rule meets known values.

`raw_listings` prints numbers into text as a listing would; `ORIGINS` is DuckDB SQL that computes what cleaning must give from the
numbers themselves, never by parsing text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CURRENT_YEAR = 2026
CITIES = ("casa", "Fes", "marrakesh", "Rabat - Agdal", "tanger", "SALE", "el jadida", "Ville Nouvelle")
SLUGS = ("casablanca", "fes", "marrakech", "rabat", "tanger", "sale", "el_jadida", "ville_nouvelle")
DISTRICTS = ("Maarif", "hay riad", "Gueliz", "Rue Atlas 12", "Toute la ville", "les hopitaux", "centre")
NOUNS = ("appartement", "studio", "villa", "riad", "duplex", "maison", "terrain", "bureau", "local")


def _pick(values, index: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (index + 1).cast("int"))


def _grouped(n: Column) -> Column:
    return F.replace(F.format_number(n, 0), F.lit(","), F.lit(" "))


def origins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k, cust, nation, price and rent in whole units, date and quantity of every order; line items are added up first, so orders do not multiply."""
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    lines = read("lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.sum("l_quantity").cast("bigint").alias("q"))
    orders = read("orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c_custkey"), F.floor(F.col("o_totalprice") * 10).alias("amount"), F.floor(F.col("o_totalprice") / 50).alias("rent"), F.col("o_orderdate").alias("d"))
    # the numbers are dealt out before they are printed: parsing is the work, and a small file is one split
    return orders.join(read("customer").select("c_custkey", "c_nationkey"), "c_custkey").join(lines, "k", "left").repartition("k")


def raw_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw contract and an ordinal; one in 97 listings has a second copy, with another price and an equivalent address."""
    k, o = F.col("k"), origins(spark, sf_dir)
    noun = _pick(NOUNS, k % 9)
    surface = F.lit(20) + 2 * F.col("q")
    at = F.concat(F.lit("https://www.listings.example/fr/"), _pick(SLUGS, F.col("c_nationkey") % 8), F.lit("/immobilier/bien_"), F.lpad(k.cast("string"), 8, "0"), F.lit(".htm"))
    rows = o.select(
        F.concat(F.initcap(noun), F.lit(" lumineux calme")).alias("listing_title_raw"),
        F.concat(F.lit("Bien ensoleille"), F.when(k % 11 == 0, " avec piscine").otherwise(""), F.when(k % 13 == 0, " contact a.b@x.org ou 0612345678").otherwise("")).alias("description_raw"),
        F.when(k % 31 == 0, "Prix non spécifié").when(k % 7 == 0, F.concat(_grouped(F.col("rent")), F.lit(" DH / mois"))).otherwise(F.concat(_grouped(F.col("amount")), F.lit(" DH"))).alias("price_raw"),
        _pick(CITIES, F.col("c_nationkey") % 8).alias("city_raw"),
        _pick(DISTRICTS, F.col("c_custkey") % 7).alias("district_raw"),
        noun.alias("property_type_raw"),
        F.lit(None).cast("string").alias("listing_type_raw"),
        F.when(k % 2 == 0, F.concat(surface.cast("string"), F.lit(" m²"))).otherwise(F.concat(F.lit("surface : "), surface.cast("string"))).alias("surface_raw"),
        F.concat((k % 6).cast("string"), F.lit(" chambres")).alias("bedrooms_raw"),
        F.concat((k % 4).cast("string"), F.lit(" sdb")).alias("bathrooms_raw"),
        F.when(k % 10 == 0, "RDC").otherwise(F.concat((k % 10).cast("string"), F.lit(" etage"))).alias("floor_raw"),
        F.when(k % 10 != 0, F.concat(F.lit("33."), F.lpad((k % 100).cast("string"), 2, "0"))).alias("latitude_raw"),
        F.when(k % 10 != 0, F.concat(F.lit("-7,"), F.lpad((k % 100).cast("string"), 2, "0"))).alias("longitude_raw"),
        F.concat(F.lit("Construit en "), F.year("d").cast("string")).alias("construction_year_raw"),
        F.when(k % 5 != 0, '["calme"]').alias("attributes_raw"),
        at.alias("listing_url"),
        F.date_format("d", "yyyy-MM-dd'T'HH:mm:ss").alias("scraped_at"),
        F.concat(F.lit("batch_"), F.year("d").cast("string")).alias("batch_id"),
        F.lit("listings").alias("source"),
        F.lit("true").alias("detail_scraped"),
        k.alias("ordinal"),
    )
    again = rows.where("ordinal % 97 = 0").withColumns({"price_raw": F.lit("999 999 DH"), "listing_url": F.concat("listing_url", F.when(F.col("ordinal") % 2 == 0, "?utm=abc").otherwise("/")), "ordinal": F.col("ordinal") + 1_000_000_000})
    return rows.unionByName(again)


def number_of(address: Column) -> Column:
    """k of a listing's address."""
    return F.regexp_extract(address, "bien_0*([0-9]+)", 1).cast("bigint")


def _spoiled(df: DataFrame, changes: dict[str, tuple[int, object]]) -> DataFrame:
    """df with a value put into the rows whose k is a multiple of a number."""
    k = number_of(F.col("listing_url"))
    kinds = dict(df.dtypes)
    return df.withColumns({c: F.when(k % n == 0, F.lit(v).cast(kinds[c])).otherwise(F.col(c)) for c, (n, v) in changes.items()})


def faulty_core(core: DataFrame) -> DataFrame:
    """A clean core with faults for the checks to find: prices, places, kinds, titles with a phone number, short titles, repeated rows."""
    df = _spoiled(core, {"price": (53, 200), "district": (59, None), "listing_type": (67, "lease"), "listing_title_clean": (61, "Appel 0612345678 svp")})
    df = _spoiled(df, {"listing_title_clean": (43, "Court")})
    return df.unionByName(df.where(number_of(F.col("listing_url")) % 71 == 0))


def faulty_features(features: DataFrame) -> DataFrame:
    """Clean features with counts out of range and prices per square metre that do not follow from price and surface."""
    k = number_of(F.col("listing_url"))
    return _spoiled(features, {"bedrooms": (83, 25)}).withColumn("price_per_m2", F.when(k % 79 == 0, F.col("price_per_m2") + 1).otherwise(F.col("price_per_m2")).cast("decimal(20,2)"))


#: DuckDB, after ORIGINS: `bad` is `faulty_core`, `badf` is `faulty_features` beside the row's price.
FAULTS = """
, once as (
  select * replace (case when k % 53 = 0 then 200 else price end as price, case when k % 59 <> 0 then district end as district, case when k % 67 = 0 then 'lease' else listing_type end as listing_type,
                    case when k % 43 = 0 then 'Court' when k % 61 = 0 then 'Appel 0612345678 svp' else title end as title) from clean),
bad as (select * from once union all select * from once where k % 71 = 0),
badf as (select k, price, s, ppm2c, case when k % 83 = 0 then 25 else bedrooms end as bedrooms, bathrooms, floor, case when k % 79 = 0 then ppm2c + 100 else ppm2c end as shown from clean)
"""

#: DuckDB: `typed` has a row per address with reject_reason, `clean` the accepted rows.
ORIGINS = """
with q as (select l_orderkey as k, cast(sum(l_quantity) as bigint) as q from lineitem group by 1),
o as (
  select o_orderkey as k, o_custkey as cust, c_nationkey as nk, cast(floor(o_totalprice * 10) as bigint) as amount, cast(floor(o_totalprice / 50) as bigint) as rent, o_orderdate as d, q.q,
         20 + 2 * q.q as s, ['apartment','studio','villa','riad','duplex','house','land','office','commercial'][o_orderkey % 9 + 1] as kind
  from orders join customer on c_custkey = o_custkey left join q on q.k = o_orderkey),
p as (
  select *, case when k % 31 = 0 then null when k % 7 = 0 then rent else amount end as asked,
         case when k % 7 = 0 or k % 31 = 0 or amount < 100000 then 'rent' else 'sale' end as lt,
         ['Casablanca','Fès','Marrakech','Rabat','Tanger','Salé','El Jadida','Ville Nouvelle'][nk % 8 + 1] as city,
         ['Maarif','Hay Riad','Gueliz',null,null,'les Hopitaux','Centre'][cust % 7 + 1] as district,
         case when kind in ('land','studio') then 0 else k % 6 end as bedrooms, case when kind = 'land' then 0 else k % 4 end as bathrooms, case when kind = 'land' then 0 else k % 10 end as floor,
         year(d) as built
  from o),
r as (
  select *, case when lt = 'rent' and asked between 300 and 250000 then asked when lt = 'sale' and asked between 100000 and 100000000 then asked end as price,
         case when kind = 'land' then 0 when kind = 'studio' then 1 + bathrooms else bedrooms + bathrooms end as rooms
  from p),
m as (select *, (200 * price + s) // (2 * s) as ppm from r),
typed as (
  select *, case when kind = 'land' then case when ppm between 5000 and 6000000 then ppm end
                 when kind in ('office','commercial') then case when ppm between 50000 and 9000000 then ppm end
                 when ppm between 100000 and 10000000 then ppm end as ppm2c
  from m),
t as (
  select k, cust, nk, d, kind as property_type, lt as listing_type, price, city, district, s, bedrooms, bathrooms, floor, built, rooms, ppm2c, q,
    'https://www.listings.example/fr/' || ['casablanca','fes','marrakech','rabat','tanger','sale','el_jadida','ville_nouvelle'][nk % 8 + 1] || '/immobilier/bien_' || lpad(cast(k as varchar), 8, '0') || '.htm' as listing_url,
    ['Appartement','Studio','Villa','Riad','Duplex','Maison','Terrain','Bureau','Local'][k % 9 + 1] || ' lumineux calme' as title,
    'Bien ensoleille' || case when k % 11 = 0 then ' avec piscine' else '' end || case when k % 13 = 0 then ' contact [REDACTED_EMAIL] ou [REDACTED_PHONE]' else '' end as description,
    case when price is null then 'invalid_price' when district is null then 'missing_district'
         when lt = 'sale' and s is not null and ppm2c is null then 'outlier_price_per_m2'
         when kind in ('villa','house','riad') and s >= 250 and bedrooms = 0 then 'contradictory_rooms' end as reject_reason,
    case when k % 11 = 0 or price >= 5000000 then 1 else 0 end as luxury_flag,
    case when city in ('Casablanca','Rabat','Salé','Tanger','El Jadida') then 1 else 0 end as coastal_city,
    2026 - built as age, 'batch_' || built as batch_id,
    (20000 * (9 + case when cust % 7 = 3 then 0 else 1 end - case when q is null then 1 else 0 end + case when k % 5 = 0 then 0 else 1 end) + 11) // 22 as extraction,
    (8 + case when s is null then 0 else 1 end + case when ppm2c is null then 0 else 1 end) * 1000 as complete
  from typed),
clean as (select * from t where reject_reason is null),
sale as (select *, ppm2c / 100.0::double as ppm2 from clean where listing_type = 'sale' and s is not null and ppm2c is not null and complete >= 7000)
"""
