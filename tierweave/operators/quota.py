"""Daily quota, first-seen and per-source limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierweave.fixed.scoring import DAILY_PAGE_QUOTA

#: Shares that a key is cut into before its first rows are picked.
SHARES = 64


def first_seen(records: DataFrame, *keys: str, order: str = "seq") -> DataFrame:
    """The first record of every key, by order. Reduced before the shuffle."""
    others = [c for c in records.columns if c not in keys]
    return records.groupBy(*keys).agg(F.min_by(F.struct(*others), order).alias("r")).select(*keys, "r.*").select(*records.columns)


def _first_rows(rows: DataFrame, limit: int, key: Column, *order: str) -> DataFrame:
    """The first ``limit`` rows of every key.

    A key may hold most of the rows: each of its shares is cut first, so that the last step
    sees at most ``SHARES * limit`` rows of it.
    """
    keyed = rows.withColumn("_key", key).withColumn("_share", F.pmod(F.xxhash64(*order), F.lit(SHARES)))
    for keys in (("_key", "_share"), ("_key",)):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        keyed = keyed.withColumn("_rn", place).filter(F.col("_rn") <= limit).drop("_rn")
    return keyed.drop("_key", "_share")


def limit_per_source(records: DataFrame, limit: int, source: str = "source", order: str = "seq") -> DataFrame:
    """The first ``limit`` records of every source."""
    return _first_rows(records, limit, F.col(source), order)


def admit_daily(requests: DataFrame, limit: int = DAILY_PAGE_QUOTA, ts: str = "ts", tie: str = "event_id") -> DataFrame:
    """The first ``limit`` requests of every day."""
    return _first_rows(requests, limit, F.to_date(ts), ts, tie)


def daily_usage(requests: DataFrame, limit: int = DAILY_PAGE_QUOTA, ts: str = "ts") -> DataFrame:
    """(day, used, remaining) of every day."""
    return requests.groupBy(F.to_date(ts).alias("day")).agg(F.count("*").alias("asked")).select(
        "day", F.least("asked", F.lit(limit)).cast("bigint").alias("used"),
        F.greatest(F.lit(limit) - F.col("asked"), F.lit(0)).cast("bigint").alias("remaining"),
    )
