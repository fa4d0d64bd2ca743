"""Raw listing files as a stream: cleaned batch by batch into the clean tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..operators import clean as cleaning
from ..operators.tables import Tables


def raw_stream(spark: SparkSession, folder: str, files_per_trigger: int = 64) -> DataFrame:
    """Raw CSV files that arrive in a folder."""
    return spark.readStream.schema(schemas.RAW).option("header", True).option("multiLine", True).option("escape", '"').option("maxFilesPerTrigger", files_per_trigger).csv(folder)


def distinct_within(stream: DataFrame, delay: str = "1 day") -> DataFrame:
    """The first row of each address within the watermark; state of older addresses is dropped."""
    return stream.withColumn("seen_at", F.to_timestamp("scraped_at")).withWatermark("seen_at", delay).dropDuplicatesWithinWatermark(["listing_url"])


def start(stream: DataFrame, tables: Tables, checkpoint: str, current_year: int, **trigger) -> StreamingQuery:
    """Each micro-batch is cleaned and merged by address into the parts that it touches, so a batch that is run again changes nothing."""

    def put(rows: DataFrame, epoch: int) -> None:
        core, features, _ = cleaning.clean_listings(rows, current_year)
        for name, df in (("clean_listings", core), ("clean_listing_features", features)):
            tables.upsert(name, df)

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
