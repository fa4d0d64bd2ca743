"""One batch from its raw file to checked tables: clean files, staging, clean tables, star schema, model table, checks, summary.

Every step is tried again when it fails (but for audit, reset and checks) and leaves a checkpoint; steps replace what an earlier run of the
batch left, so a batch can be run again as a whole. Files and tables lie under one folder that driver and executors share.
"""

from __future__ import annotations

import json
import logging
import time
from collections.abc import Callable
from datetime import UTC, datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import clean as cleaning
from ..operators import quality, report, warehouse
from ..operators.tables import EXPECTED, Tables, listing_tables
from ..session import stage
from ..sources import listings

TABLES = ("raw_listings", "clean_listings", "clean_listing_features", "dim_time", "dim_location", "fact_listing", "ml_property_features")
log = logging.getLogger(__name__)


class Run:
    """A run of one batch: where its files are, its checkpoints, its retries."""

    def __init__(self, spark: SparkSession, folder: str, batch_id: str, current_year: int, retries: int = 2, delay: float = 3.0):
        self.spark, self.folder, self.batch_id, self.current_year = spark, folder.rstrip("/"), batch_id, current_year
        self.retries, self.delay = retries, delay
        self.tables: Tables = listing_tables(spark, f"{self.folder}/tables")
        self.steps: list[dict[str, Any]] = []

    def file(self, kind: str) -> str:
        return f"{self.folder}/files/{kind}_{self.batch_id}"

    def put_json(self, kind: str, value: Any) -> str:
        """Writes a small JSON file through the file system that Spark uses; its path."""
        path = f"{self.file(kind)}.json"
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        out = where.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(where, True)
        out.write(bytearray(report.report_json(value).encode()))
        out.close()
        return path

    def step(self, name: str, body: Callable[[], Any], retries: int | None = None) -> Any:
        """Runs a step, again after a pause if it fails, and writes the checkpoint."""
        tries = 1 + (self.retries if retries is None else retries)
        for attempt in range(1, tries + 1):
            log.info("step_started %s attempt=%d", name, attempt)
            try:
                out = body()
            except Exception as error:
                log.error("step_failed %s attempt=%d error=%s", name, attempt, type(error).__name__)
                if attempt == tries:
                    self._checkpoint(name, "failed", {"error": type(error).__name__})
                    raise
                time.sleep(self.delay * attempt)
            else:
                self._checkpoint(name, "succeeded", out if isinstance(out, dict) else {"rows": out} if isinstance(out, int) else {})
                return out
        raise AssertionError("unreachable")

    def _checkpoint(self, name: str, status: str, metadata: dict[str, Any]) -> None:
        now = datetime.now(UTC).isoformat()
        self.steps.append({"step": name, "status": status, "metadata": metadata, "at": now})
        self.put_json("pipeline_checkpoint", {"batch_id": self.batch_id, "updated_at": now, "steps": self.steps})

    # --- steps

    def clean(self, raw: DataFrame) -> dict[str, Any]:
        """Clean core and features as files, and the report of the batch."""
        rows = stage(cleaning.clean(raw, self.current_year), "typed")
        ok = cleaning.accepted(rows)
        listings.write_csv(cleaning.core(ok), self.file("listings_clean"))
        listings.write_csv(cleaning.features(ok), self.file("listings_features"))
        done = report.batch_report(rows, raw.count(), self.batch_id)
        done["report_file"] = self.put_json("quality_report", done)
        return done

    def load_clean(self) -> int:
        """The clean files read again, typed, into the clean tables; features only where their listing is."""
        core = listings.reload_core(listings.read_csv(self.spark, self.file("listings_clean")), self.batch_id)
        features = listings.reload_features(listings.read_csv(self.spark, self.file("listings_features")), self.batch_id)
        core, features = listings.load(stage(core, "core"), features)
        n = self.tables.replay("clean_listings", core, self.batch_id)
        self.tables.replay("clean_listing_features", features, self.batch_id)
        return n

    def _of_batch(self, name: str) -> DataFrame:
        return self.tables.read(name).where(F.col("batch_id") == self.batch_id)

    def load_star(self) -> int:
        """Dimensions get what is new; the batch's facts are replayed."""
        core, features = self._of_batch("clean_listings").select(*schemas.CORE), self.tables.read("clean_listing_features")
        dims = []
        for name, add in (("dim_time", warehouse.add_times), ("dim_location", warehouse.add_locations)):
            old = self.tables.read(name) if self.tables.exists(name) else None
            dims.append(self.tables.write(name, add(core, old)))
        return self.tables.replay("fact_listing", warehouse.facts(core, features, *dims), self.batch_id)

    def load_models(self) -> int:
        """The batch's model rows, with medians over the batch."""
        core, features = self._of_batch("clean_listings").select(*schemas.CORE), self.tables.read("clean_listing_features")
        return self.tables.replay("ml_property_features", stage(warehouse.ml_features(core, features), "models"), self.batch_id)

    def checks(self, raw_file: str) -> DataFrame:
        """All checks of the batch: files, tables, layers against each other."""
        core, features = self._of_batch("clean_listings"), self._of_batch("clean_listing_features")
        fact, ml = self._of_batch("fact_listing"), self._of_batch("ml_property_features")
        files = {"raw_csv_exists": raw_file, "clean_csv_exists": self.file("listings_clean"), "features_csv_exists": self.file("listings_features")}
        clean_file = listings.read_csv(self.spark, files["clean_csv_exists"])
        raw = cleaning.sanitize(cleaning.conform(listings.read_raw(self.spark, raw_file, self.batch_id))).drop("ordinal")
        orphans = warehouse.orphans(fact, self.tables.read("dim_time"), self.tables.read("dim_location"), core)
        parts = [
            quality.files_exist(self.spark, files), quality.core_checks(core), quality.feature_checks(features, core.count()), quality.duplicate_keys(core), quality.join_checks(core, features),
            quality.rental_contamination(ml, self.batch_id), quality.count_checks(core, fact, ml, clean_file.count()), quality.foreign_keys(orphans),
            quality.personal_data(raw, core.drop("listing_id"), features),
        ]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return stage(out, "checks")

    def summary(self, report_of_batch: dict[str, Any]) -> dict[str, Any]:
        core, ml = self._of_batch("clean_listings"), self._of_batch("ml_property_features")
        top = lambda c, n: [[r[c], r.n] for r in report.top_values(core, c, n).collect()]
        return {
            "batch_id": self.batch_id, "total_staged_listings": self._of_batch("raw_listings").count(), "total_cleaned_listings": core.count(), "total_ml_ready_rows": ml.count(),
            "sale_vs_rent_distribution": top("listing_type", 2), "top_property_types": top("property_type", 10), "city_distribution": top("city", 10),
            "ml_missing_value_statistics": report.missing_percent(ml, ["surface_m2", "bedrooms", "bathrooms", "floor", "price_per_m2"]).first().asDict(),
            "quality_report": report_of_batch["report_file"], "extraction_success_rate": report_of_batch["extraction_success_rate"], "feature_completeness": report_of_batch["feature_completeness"],
        }


def run_batch(spark: SparkSession, raw_file: str, folder: str, current_year: int, batch_id: str | None = None, reset: bool = False, retries: int = 2, delay: float = 3.0) -> dict[str, Any]:
    """Takes a raw CSV file through all layers; the summary, which is also written as final_validation_<batch>.json. Raises if a hard check fails."""
    run = Run(spark, folder, listings.batch_id(raw_file, batch_id), current_year, retries, delay)
    there = {n: c for n, c in EXPECTED.items() if run.tables.exists(n)}
    lacking = run.step("audit_pipeline_schemas", lambda: {"columns_missing": run.tables.audit(there)[1]}, 0)["columns_missing"]
    if lacking:
        raise ValueError(f"tables lack columns: {lacking}")
    if reset:
        run.step("reset_pipeline_data", lambda: run.tables.reset(list(TABLES)), 0)
    raw = listings.read_raw(spark, raw_file, run.batch_id)
    done = run.step("clean_raw_csv_to_clean_csv", lambda: run.clean(raw))
    run.step("load_raw_csv_to_staging", lambda: run.tables.replay("raw_listings", listings.read_staging(spark, raw_file, run.batch_id), run.batch_id))
    run.step("load_clean_csv_to_clean_table", run.load_clean)
    run.step("load_bi_schema", run.load_star)
    run.step("load_ml_schema", run.load_models)

    def checked() -> dict[str, Any]:
        results = run.checks(raw_file)
        quality.assert_passed(results)
        return {"checks": results.count(), "failed_checks": 0}

    run.step("data_quality_checks", checked, 0)
    summary = run.summary(done)
    path = run.put_json("final_validation", summary)
    run.step("final_validation", lambda: {"summary_file": path}, 0)
    return summary


def main(argv: list[str] | None = None) -> None:
    import argparse

    from ..session import session

    parser = argparse.ArgumentParser(description="Runs a raw CSV file of listings through cleaning, warehouse and checks.")
    parser.add_argument("--input-file", required=True)
    parser.add_argument("--folder", required=True, help="where files and tables are kept")
    parser.add_argument("--batch-id")
    parser.add_argument("--reset-data", action="store_true")
    given = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    out = run_batch(session(), given.input_file, given.folder, datetime.now(UTC).year, given.batch_id, given.reset_data)
    print(json.dumps(out, ensure_ascii=False, default=str))


if __name__ == "__main__":
    main()
