"""A catalog in buckets: a new version rewrites only the buckets it touches.

A product lies in the bucket of its slug's hash. A version is a manifest that names the folder of
every bucket; a write puts the touched buckets into a folder of its own and publishes a manifest
that keeps the old folders of all others. Published folders are never changed, so readers of an
older version are not disturbed, and a writer that fails leaves nothing that is read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierweave import schemas
from tierweave.session import stored
from tierweave.sources.pointers import Pointer, latest, publish

BUCKETS = 64


def bucket_of(slug: Column | str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(slug), F.lit(buckets)).cast("int")


def _write(catalog: DataFrame, path: str, buckets: int) -> dict[str, str]:
    """Write the rows into a new folder: bucket -> folder. A bucket without rows has none."""
    spark = catalog.sparkSession
    folder = f"data/{uuid.uuid4().hex}"
    placed = catalog.withColumn("bucket", bucket_of("slug", buckets))
    placed.repartition(buckets, "bucket").write.partitionBy("bucket").parquet(f"{path}/{folder}")
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{folder}")
    names = [s.getPath().getName() for s in place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)]
    return {n.removeprefix("bucket="): f"{folder}/{n}" for n in names if n.startswith("bucket=")}


def read_folders(spark: SparkSession, path: str, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schemas.PRODUCT)
    return spark.read.schema(schemas.PRODUCT).parquet(*[f"{path}/{f}" for f in folders])


def read_buckets(spark: SparkSession, path: str, pointer: Pointer | None = None) -> DataFrame:
    """The catalog of a version, the latest one by default."""
    pointer = pointer or latest(spark, path)
    return read_folders(spark, path, sorted((pointer.folders or {}).values()))


def write_buckets(catalog: DataFrame, path: str, version: str, buckets: int = BUCKETS, after: int | None = None) -> Pointer:
    """Publish a whole catalog as a version in buckets."""
    spark = catalog.sparkSession
    after = latest(spark, path).number if after is None else after
    return publish(spark, path, Pointer(after + 1, version, buckets, _write(catalog, path, buckets)))


def update_buckets(
    changed: DataFrame, path: str, version: str, base: Pointer | None = None, watermark: str | None = None,
) -> Pointer:
    """Publish a version in which the changed products replace those of the same slug.

    Only buckets that hold a changed slug are read and written. ``base`` is the version the change
    was made from; if another writer has published since, nothing is published and
    ``VersionTaken`` is raised.
    """
    spark = changed.sparkSession
    base = base or latest(spark, path)
    changed = stored(changed.select(*schemas.PRODUCT.names))
    touched = {r[0] for r in changed.select(bucket_of("slug", base.buckets)).distinct().collect()}  # at most one row a bucket
    held = [folder for bucket, folder in (base.folders or {}).items() if int(bucket) in touched]
    kept = read_folders(spark, path, held).join(changed.select("slug"), "slug", "left_anti").select(*schemas.PRODUCT.names)
    folders = {**(base.folders or {}), **_write(kept.unionByName(changed), path, base.buckets)} if touched else base.folders
    return publish(spark, path, Pointer(base.number + 1, version, base.buckets, folders, watermark))
