"""Star schema and model features of a batch of clean listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from .. import schemas
from ..functions import patterns as P
from .tables import numbered

#: Width of the bins in which a median is looked for.
BIN = 100


def _highest(dim: DataFrame | None, name: str) -> int:
    return int(dim.agg(F.coalesce(F.max(name), F.lit(0))).first()[0]) if dim is not None else 0


def time_rows(core: DataFrame) -> DataFrame:
    """The different days of the listings with year, month, month name and quarter."""
    d = F.to_date("scraped_at")
    days = core.where(F.col("scraped_at").isNotNull()).select(d.alias("date")).distinct()
    return days.select("date", F.year("date").alias("year"), F.month("date").alias("month"), F.date_format("date", "MMMM").alias("month_name"), F.quarter("date").alias("quarter"))


def location_rows(core: DataFrame) -> DataFrame:
    return core.select("city", "district").distinct()


def add_times(core: DataFrame, dim: DataFrame | None = None) -> DataFrame:
    """The time dimension with the days that were not there yet."""
    new = time_rows(core)
    if dim is not None:
        new = new.join(dim.select("date"), "date", "left_anti")
    added = numbered(new, "time_id", _highest(dim, "time_id"), ["date"])
    return added if dim is None else dim.unionByName(added)


def add_locations(core: DataFrame, dim: DataFrame | None = None) -> DataFrame:
    """The location dimension with the places that were not there yet; nulls compare as equal."""
    new = location_rows(core)
    if dim is not None:
        old = dim.select(F.col("city").alias("_c"), F.col("district").alias("_d"))
        new = new.join(old, F.col("city").eqNullSafe(F.col("_c")) & F.col("district").eqNullSafe(F.col("_d")), "left_anti")
    added = numbered(new, "location_id", _highest(dim, "location_id"), ["city", "district"])
    return added if dim is None else dim.unionByName(added)


def facts(core: DataFrame, features: DataFrame | None, times: DataFrame, locations: DataFrame) -> DataFrame:
    """One row per listing with its keys; features are looked up by address alone, whatever their batch. features None: core is whole rows, which have them."""
    t = times.select("time_id", F.col("date").alias("_date"))
    p = locations.select("location_id", F.col("city").alias("_c"), F.col("district").alias("_d"))
    joined = core if features is None else core.join(features.select("listing_url", "surface_m2", "price_per_m2"), "listing_url", "left")
    joined = joined.join(t, F.to_date("scraped_at") == F.col("_date"))
    joined = joined.join(p, F.col("city").eqNullSafe(F.col("_c")) & F.col("district").eqNullSafe(F.col("_d")))
    return joined.select(*schemas.FACT_COLUMNS)


def is_candidate() -> Column:
    """Rows that models may learn from."""
    there = [F.col(c).isNotNull() for c in ("property_type", "city", "district", "surface_m2", "price_per_m2")]
    out = (F.col("listing_type") == "sale") & (F.col("price") > 0) & (F.coalesce(F.col("feature_completeness_score"), F.lit(0)) >= F.lit(str(P.ML_LEAST_SCORE)).cast("decimal(12,4)"))
    for c in there:
        out = out & c
    return out


def sales(core: DataFrame, features: DataFrame | None = None) -> DataFrame:
    """Sale listings with their features, those that models may learn from. features None: core is whole rows, which have them."""
    return (core if features is None else core.join(features.drop("batch_id"), "listing_url")).where(is_candidate())


def medians(rows: DataFrame, by: list[str], value: str, name: str) -> DataFrame:
    """The exact median of a decimal column for each group, and n, its number of values.

    Equal values are counted where they lie. The counts are added up by coarse bins, of which a group has a bounded number; the bins that hold the middle
    ranks are opened, and the middle values read from running sums within a bin. No task holds a group's values.
    """
    counts = rows.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("_v")).agg(F.count("*").alias("_c")).withColumn("_bin", F.floor(F.col("_v") / BIN))
    group = W.Window.partitionBy(*by)
    bins = counts.groupBy(*by, "_bin").agg(F.sum("_c").alias("_m"))
    bins = bins.withColumns({"_before": F.sum("_m").over(group.orderBy("_bin")) - F.col("_m"), "n": F.sum("_m").over(group)})
    low, high = F.floor((F.col("n") + 1) / 2), F.floor((F.col("n") + 2) / 2)  # the middle ranks, from one
    holds = lambda rank, before, many: (rank > before) & (rank <= before + many)
    bins = bins.where(holds(low, F.col("_before"), F.col("_m")) | holds(high, F.col("_before"), F.col("_m"))).drop("_m")
    same = [F.col(f"c.{c}").eqNullSafe(F.col(f"b.{c}")) for c in (*by, "_bin")]
    opened = counts.alias("c").join(bins.alias("b"), same).select("c.*", "_before", "n")
    upto = F.sum("_c").over(W.Window.partitionBy(*by, "_bin").orderBy("_v"))
    opened = opened.withColumn("_at", F.col("_before") + upto - F.col("_c"))
    middle = lambda rank: F.max(F.when(holds(rank, F.col("_at"), F.col("_c")), F.col("_v").cast("double")))
    return opened.groupBy(*by).agg(((middle(low) + middle(high)) / 2).alias(name), F.max("n").alias("n"))


def market_index(sale: DataFrame, by: list[str], name: str) -> DataFrame:
    """The exact median price per square metre of each group."""
    return medians(sale, by, "price_per_m2", name).drop("n")


def ml_features(core: DataFrame, features: DataFrame | None = None) -> DataFrame:
    """The flat table for models with the medians of city and district.

    The medians are aggregates joined back, not windows: a large city's rows are partly aggregated where they lie, while a window would bring them to one task.
    """
    sale = sales(core, features)
    out = sale.join(market_index(sale, ["city"], "city_market_index"), "city", "left").join(market_index(sale, ["city", "district"], "district_market_index"), ["city", "district"], "left")
    out = out.withColumns({"log_price": F.ln(F.col("price").cast("double")), "scraped_year": F.year("scraped_at"), "scraped_month": F.month("scraped_at")})
    return out.select(*schemas.ML_COLUMNS)


def orphans(fact: DataFrame, times: DataFrame, locations: DataFrame, core: DataFrame) -> DataFrame:
    """Fact rows without one of their dimensions or their clean row."""
    t = times.select("time_id", F.lit(True).alias("_t"))
    p = locations.select("location_id", F.lit(True).alias("_p"))
    c = core.select("listing_url", F.lit(True).alias("_c")).distinct()
    joined = fact.join(t, "time_id", "left").join(p, "location_id", "left").join(c, "listing_url", "left")
    return joined.where(F.col("_t").isNull() | F.col("_p").isNull() | F.col("_c").isNull()).select(*fact.columns)
