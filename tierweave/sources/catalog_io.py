"""Catalog, dimension and landing-table readers, and versioned writers."""

from __future__ import annotations

import json
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierweave import schemas
from tierweave.fixed import taxonomy, terms
from tierweave.session import global_row_number
from tierweave.sources.buckets import read_buckets
from tierweave.sources.pointers import Pointer, latest, publish

CORRUPT = "_corrupt_record"


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Every JSON document with its file name; unparsable ones keep their text."""
    schema = T.StructType([*schemas.PRODUCT.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT).json(path)
        .withColumn("file_name", F.col("_metadata.file_name"))
    )


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Product documents of a folder; unparsable files are left out, a missing slug is the file stem."""
    docs = read_documents(spark, path)
    stem = F.regexp_replace("file_name", r"\.json$", "")
    return docs.filter(F.col(CORRUPT).isNull()).withColumn("slug", F.coalesce("slug", stem)).drop(CORRUPT)


def corrupt_records(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, body) of the documents that do not parse."""
    # an unparsable document has no slug; naming the slug keeps the scan a parsed one
    docs = read_documents(spark, path).filter(F.col(CORRUPT).isNotNull() & F.col("slug").isNull())
    return docs.select("file_name", F.col(CORRUPT).alias("body"))


def corrupt_bodies(df: DataFrame, schema: str, body: str = "body") -> DataFrame:
    """Rows whose JSON text does not parse under ``schema``."""
    parsed = F.from_json(F.col(body), f"{schema}, {CORRUPT} string", {"columnNameOfCorruptRecord": CORRUPT})
    return df.filter(parsed[CORRUPT].isNotNull())


def write_catalog(catalog: DataFrame, path: str, version: str, after: int | None = None) -> str:
    """Write a new version folder, then publish a pointer to it; the highest pointer counts.

    Nothing is replaced: a reader sees the old version until the new pointer is complete. ``after``
    is the number of the version the catalog was made from; if another writer has published since,
    ``VersionTaken`` is raised and the old version stays.
    """
    spark = catalog.sparkSession
    after = latest(spark, path).number if after is None else after
    target = f"{path}/version={version}"
    catalog.write.mode("overwrite").parquet(target)
    publish(spark, path, Pointer(after + 1, version))
    return target


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The catalog version of the highest pointer."""
    pointer = latest(spark, path)
    if pointer.folders is not None:
        return read_buckets(spark, path, pointer)
    return spark.read.schema(schemas.PRODUCT).parquet(f"{path}/version={pointer.version}")


def write_index(index: DataFrame, path: str) -> None:
    """Index rows, and their number beside them."""
    index.write.mode("overwrite").json(f"{path}/products")
    index.agg(F.count("*").alias("total")).coalesce(1).write.mode("overwrite").json(f"{path}/total")


def write_stats(frames: Mapping[str, DataFrame], path: str) -> None:
    """One JSON object: a value for each one-column frame of one row named in it, else a list of rows.

    Metrics have one row per label, so each is small.
    """
    parts = []
    for name, df in frames.items():
        rows = F.collect_list(F.struct(*df.columns))
        scalar = F.get_json_object(F.to_json(rows), f"$[0].{df.columns[0]}") if len(df.columns) == 1 else F.lit(None)
        value = F.when((F.count("*") == 1) & scalar.isNotNull(), scalar).otherwise(F.to_json(rows))
        parts.append(df.agg(F.concat(F.lit(f"{json.dumps(name)}: "), value).alias("part")))
    every = reduce(DataFrame.unionByName, parts)
    every.agg(F.concat(F.lit("{"), F.array_join(F.array_sort(F.collect_list("part")), ", "), F.lit("}"))).coalesce(1).write.mode(
        "overwrite",
    ).text(path)


def write_routed(df: DataFrame, path: str) -> None:
    """Rows split into one folder per ``target`` in a single pass."""
    df.write.mode("overwrite").partitionBy("target").parquet(path)


def load_categories(spark: SparkSession, path: str | None = None) -> DataFrame:
    """(id, name, name_zh, icon): from a file, or the built-in eleven rows."""
    if path is None:
        return spark.createDataFrame(list(taxonomy.CATEGORIES), "id string, name string, name_zh string, icon string")
    doc = spark.read.option("multiLine", True).schema(
        "categories array<struct<id:string,name:string,name_zh:string,icon:string>>"
    ).json(path)
    return doc.select(F.explode("categories").alias("c")).select("c.*")


def load_tags(spark: SparkSession, path: str | None = None) -> DataFrame:
    """(dimension, tag_id, name, name_zh): from a file, or the built-in vocabulary."""
    if path is None:
        return spark.createDataFrame(list(taxonomy.TAGS), "dimension string, tag_id string, name string, name_zh string")
    doc = spark.read.option("multiLine", True).schema(
        "dimensions map<string,struct<tags:array<struct<id:string,name:string,name_zh:string>>>>"
    ).json(path)
    dims = doc.select(F.explode("dimensions").alias("dimension", "d"))
    return dims.select("dimension", F.explode("d.tags").alias("t")).select(
        "dimension", F.col("t.id").alias("tag_id"), "t.name", "t.name_zh"
    )


def load_keywords(spark: SparkSession, path: str | None = None, lang: str | None = None) -> DataFrame:
    """(lang, kind, category, ord, keyword), in configuration order."""
    if path is None:
        text = json.dumps(terms.DEFAULT_JOB_KEYWORDS, ensure_ascii=False)
        doc = spark.createDataFrame([(text,)], "body string")
    else:
        doc = spark.read.text(path, wholetext=True).withColumnRenamed("value", "body")
    parsed = F.from_json("body", "map<string,struct<search:array<string>,match:array<string>,categories:map<string,array<string>>>>")
    langs = doc.select(F.explode(parsed).alias("lang", "c"))

    def plain(kind: str) -> DataFrame:
        return langs.select("lang", F.lit(kind).alias("kind"), F.lit(None).cast("string").alias("category"), F.posexplode(f"c.{kind}").alias("ord", "keyword"))

    cats = langs.select("lang", F.explode("c.categories").alias("category", "words")).select(
        "lang", F.lit("categories").alias("kind"), "category", F.posexplode("words").alias("ord", "keyword")
    )
    out = plain("search").unionByName(plain("match")).unionByName(cats)
    return out.filter(F.col("lang") == lang) if lang else out


def read_landed(spark: SparkSession, path: str, source: str, fmt: str = "html") -> DataFrame:
    """Whole files of a landing folder as payload rows; Parquet landing tables pass through."""
    if fmt == "parquet":
        return schemas.conform(spark.read.parquet(path).filter(F.col("source") == source), schemas.LANDED)
    raw = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("url"), F.lit(source).alias("source"),
        F.lit(fmt).alias("format"), F.col("value").alias("body"), F.col("_metadata.file_modification_time").alias("fetched_at"),
    )
    # arrival order is that of the files; only their names and times are sorted
    files = global_row_number(raw.select("url", "fetched_at"), ["fetched_at", "url"], "seq").select("url", "seq")
    return schemas.conform(raw.join(files, "url"), schemas.LANDED)
