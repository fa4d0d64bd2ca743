"""Profiles and reports of a batch."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import patterns as P


def _percent(part: Column, whole: Column) -> Column:
    return F.coalesce(F.round(100 * part / F.nullif(whole, F.lit(0)), 2), F.lit(0.0))


def column_profile(rows: DataFrame) -> DataFrame:
    """column_name, required, missing, missing_percent, completeness_percent, in one scan."""
    names = [*schemas.REQUIRED, *schemas.OPTIONAL]
    row = rows.agg(F.count("*").alias("_n"), *(F.count_if(F.col(c).isNull()).alias(c) for c in names))
    each = [F.struct(F.lit(c).alias("column_name"), F.lit(c in schemas.REQUIRED).alias("required"), F.col(c).alias("missing"), _percent(F.col(c), F.col("_n")).alias("missing_percent")) for c in names]
    out = row.select(F.explode(F.array(*each)).alias("x")).select("x.*")
    return out.withColumn("completeness_percent", F.round(100 - F.col("missing_percent"), 2))


def reasons(rows: DataFrame) -> DataFrame:
    """reject_reason and its number of rows."""
    return rows.where(F.col("reject_reason").isNotNull()).groupBy("reject_reason").agg(F.count("*").alias("n"))


def decimal_stats(rows: DataFrame, columns=("price", "surface_m2", "price_per_m2")) -> DataFrame:
    """Least, largest and mean (2 places, half even) of each column."""
    row = rows.agg(*(f.alias(f"{c}_{k}") for c in columns for k, f in (("min", F.min(c)), ("max", F.max(c)), ("avg", F.bround(F.avg(c), 2).cast("decimal(20,2)")))))
    each = [F.struct(F.lit(c).alias("column_name"), *(F.col(f"{c}_{k}").cast("double").alias(f"{k}_value") for k in ("min", "max", "avg"))) for c in columns]
    return row.select(F.explode(F.array(*each)).alias("x")).select("x.*")


def top_values(rows: DataFrame, column: str, limit: int = 10, order: str | None = None) -> DataFrame:
    """The most frequent values; ties by first appearance in order, else by value."""
    first = F.min(order if order else column).alias("_first")
    out = rows.where(F.col(column).isNotNull() & (F.col(column) != "")).groupBy(column).agg(F.count("*").alias("n"), first)
    return out.orderBy(F.col("n").desc(), "_first").limit(limit).drop("_first")


def success_rates(rows: DataFrame, raw_rows: int | Column) -> DataFrame:
    """Share of the raw rows whose price, property type and place could be read, in percent."""
    n = F.greatest(raw_rows if isinstance(raw_rows, Column) else F.lit(raw_rows), F.lit(1))
    lost = {"price": ["invalid_price"], "property_type": ["missing_property_type"], "location": ["missing_city", "missing_district"]}
    return rows.agg(*(F.round(100 - 100 * F.count_if(F.col("reject_reason").isin(*v)) / n, 2).alias(k) for k, v in lost.items()))


def warnings(rows: DataFrame) -> DataFrame:
    """Warnings about thin columns, at most three rows."""
    ml = (F.col("listing_type") == "sale") & F.col("surface_m2").isNotNull() & F.col("price_per_m2").isNotNull() & (F.col("feature_completeness_score") >= P.ML_LEAST_SCORE)
    row = rows.agg(F.count("*").alias("n"), F.count("surface_m2").alias("s"), F.count("bedrooms").alias("b"), F.count_if(ml).alias("m")).where("n > 0")
    told = F.array_compact(
        F.array(
            F.when(100 * F.col("s") / F.col("n") < 70, F.lit("surface completeness below 70 percent")),
            F.when(100 * F.col("b") / F.col("n") < 60, F.lit("bedrooms completeness below 60 percent")),
            F.when(F.col("m") / F.col("n") < 0.5, F.lit("fewer than half of the clean rows are model candidates")),
        )
    )
    return row.select(F.explode(told).alias("warning"))


def missing_percent(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: the share of nulls of each column in percent."""
    return df.agg(*(F.round(100 * F.count_if(F.col(c).isNull()) / F.nullif(F.count("*"), F.lit(0)), 2).alias(c) for c in columns))


def batch_report(rows: DataFrame, raw_rows: int, batch_id: str) -> dict:
    """The report of a cleaned batch; what comes to the driver is one row or ten per part."""
    ok = rows.where(F.col("reject_reason").isNull())
    ml = (F.col("listing_type") == "sale") & F.col("surface_m2").isNotNull() & F.col("price_per_m2").isNotNull() & (F.col("feature_completeness_score") >= P.ML_LEAST_SCORE)
    counts = rows.agg(F.count("*").alias("deduped"), F.count_if(F.col("reject_reason").isNull()).alias("clean"), F.count_if(F.col("reject_reason").isNull() & ml).alias("ml"), F.count_if(F.col("reject_reason").isNull() & (F.col("listing_type") == "rent")).alias("rent")).first()
    why = {r.reject_reason: r.n for r in reasons(rows).orderBy("reject_reason").collect()}
    profile = {r.column_name: r for r in column_profile(ok).collect()}
    mean = ok.agg(F.bround(F.avg("feature_completeness_score"), 4)).first()[0]
    return {
        "batch_id": batch_id,
        "raw_rows": raw_rows,
        "after_dedup_rows": counts.deduped,
        "removed_duplicates": raw_rows - counts.deduped,
        "clean_rows": counts.clean,
        "ml_candidate_sale_rows": counts.ml,
        "rent_rows_excluded_from_ml": counts.rent,
        "invalid_reasons_count": why,
        "removed_missing_required": sum(n for k, n in why.items() if k.startswith("missing_")),
        "outliers_removed": sum(n for k, n in why.items() if k.startswith(("outlier_", "contradictory_"))),
        "required_null_counts": {c: profile[c].missing for c in schemas.REQUIRED},
        "optional_completeness_percent": {c: profile[c].completeness_percent for c in schemas.OPTIONAL},
        "extraction_success_rate": success_rates(rows, raw_rows).first().asDict(),
        "feature_completeness": None if mean is None else float(mean),
        "statistics": {r.column_name: [r.min_value, r.max_value, r.avg_value] for r in decimal_stats(ok).collect()},
        "top": {c: [[r[c], r.n] for r in top_values(ok, c).collect()] for c in ("property_type", "city", "district", "listing_type")},
        "quality_warnings": [r.warning for r in warnings(ok).collect()],
    }


def report_json(report: dict) -> str:
    return json.dumps(report, ensure_ascii=False, indent=2, default=str)
