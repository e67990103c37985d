"""Structured Streaming: landed records into the catalog, and the daily quota counter."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tierweave import schemas
from tierweave.fixed.scoring import DAILY_PAGE_QUOTA
from tierweave.plans.ingest import ingest
from tierweave.sources.buckets import BUCKETS, update_buckets, write_buckets
from tierweave.sources.catalog_io import read_current
from tierweave.sources.pointers import latest, pointers

LANDED_RECORD = T.StructType([*schemas.RECORD.fields, T.StructField("landed_at", T.TimestampType())])


def read_records(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Stream of record files with their arrival time ``landed_at``."""
    return spark.readStream.schema(LANDED_RECORD).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def first_arrivals(records: DataFrame, delay: str = "7 days") -> DataFrame:
    """The first record of every (source, name) within the delay; state stays bounded.

    Later records of the same name, and records later than the delay, are left out: a view of what
    is new, not an input for ``ingest_stream``, which keeps them.
    """
    keyed = records.withColumn("_key", F.lower("name")).withWatermark("landed_at", delay)
    return keyed.dropDuplicatesWithinWatermark(["source", "_key"]).drop("_key")


def late_records(batch: DataFrame, watermark: str | None, delay: str) -> tuple[DataFrame, DataFrame]:
    """(on time, late): records that landed more than ``delay`` before the watermark are late.

    The watermark is the latest arrival of all earlier batches; without one nothing is late.
    """
    if watermark is None:
        return batch, batch.limit(0)
    late = F.coalesce(F.col("landed_at") < F.lit(watermark).cast("timestamp") - F.expr(f"INTERVAL {delay}"), F.lit(False))
    return batch.filter(~late), batch.filter(late)


def read_late(spark: SparkSession, catalog_path: str) -> DataFrame:
    """Records that came too late to be merged, with the batch they came in."""
    return spark.read.schema(T.StructType([*LANDED_RECORD.fields, T.StructField("batch", T.IntegerType())])).parquet(f"{catalog_path}/_late")


def ingest_stream(
    records: DataFrame, catalog_path: str, checkpoint: str, as_of: Callable, fuzzy: bool = True, similar: bool = True,
    delay: str = "7 days", buckets: int = BUCKETS,
) -> StreamingQuery:
    """Run the ingest plan on every micro-batch and publish a catalog version per batch.

    A version is named by its batch, so a batch that is repeated after its version was published is
    skipped. Only the buckets of products that a batch creates or changes are written; a catalog
    that is not in buckets yet is written whole, once. All records are merged in the order they
    arrive, several of one product too, but for those over ``delay`` late: they are kept in a
    table beside the catalog (``read_late``).
    """

    def publish(batch: DataFrame, batch_id: int) -> None:
        spark, version = batch.sparkSession, f"batch-{batch_id:09d}"
        base = latest(spark, catalog_path)
        if not pointers(spark, catalog_path).filter(F.col("version") == version).isEmpty():
            return
        current = read_current(spark, catalog_path)
        on_time, late = late_records(batch, base.watermark, delay)
        # the folder is named by the batch: a repeated batch replaces its own rows only
        late.write.mode("overwrite").parquet(f"{catalog_path}/_late/batch={batch_id}")
        newest = batch.agg(F.max("landed_at").cast("string")).first()[0]
        watermark = max(filter(None, (base.watermark, newest)), default=None)
        if base.folders is None:
            base = write_buckets(current, catalog_path, f"{base.version}-buckets", buckets, base.number)
        run = ingest(current, on_time.drop("landed_at"), as_of(), fuzzy, similar)
        update_buckets(run.changed, catalog_path, version, base, watermark)

    return (
        records.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def quota_stream(requests: DataFrame, limit: int = DAILY_PAGE_QUOTA, ts: str = "ts", delay: str = "1 day") -> DataFrame:
    """(day, used, remaining), emitted when a day is complete."""
    counted = requests.withWatermark(ts, delay).groupBy(F.window(ts, "1 day").alias("w")).agg(F.count("*").alias("asked"))
    return counted.select(
        F.to_date("w.start").alias("day"), F.least("asked", F.lit(limit)).cast("bigint").alias("used"),
        F.greatest(F.lit(limit) - F.col("asked"), F.lit(0)).cast("bigint").alias("remaining"),
    )
