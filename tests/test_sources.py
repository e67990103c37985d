import json

import pytest
from pyspark.sql import functions as F

from tierweave.bindings import Tables
from tierweave.operators.index import build_index
from tierweave.operators.quota import daily_usage, limit_per_source
from tierweave.operators.stats import count_by
from tierweave.sources import catalog_io as io
from tierweave.sources.registry import pick, sources
from tierweave.streaming.feeds import first_arrivals, ingest_stream, quota_stream, read_records

SF = "/root/testdata/sf0.001"


def test_catalog_files(spark, tmp_path):
    docs = tmp_path / "docs"
    docs.mkdir()
    (docs / "a-b.json").write_text(json.dumps({"slug": "a-b", "name": "B", "category": "x", "company": {"funding": {"total_raised_usd": 5}}}))
    (docs / "a.json").write_text(json.dumps({"name": "A", "category": "y"}))
    (docs / "bad.json").write_text("{not json")
    cat = io.read_catalog(spark, str(docs)).cache()
    assert {r.slug for r in cat.select("slug").collect()} == {"a-b", "a"}
    assert [r.file_name for r in io.corrupt_records(spark, str(docs)).collect()] == ["bad.json"]
    assert [r.label for r in count_by(cat, F.col("category")).collect()] == ["x", "y"]  # ties by file name
    assert [r.slug for r in build_index(cat).collect()] == ["a-b", "a"]
    io.write_catalog(cat.drop("file_name"), str(tmp_path / "out"), "v1")
    assert io.read_current(spark, str(tmp_path / "out")).count() == 2
    io.write_index(build_index(cat), str(tmp_path / "idx"))
    assert spark.read.json(str(tmp_path / "idx" / "total")).first().total == 2


def test_dimensions(spark):
    assert io.load_tags(spark).count() == 114 and io.load_categories(spark).count() == 11
    zh = io.load_keywords(spark, lang="zh").filter("kind = 'match'").orderBy("ord").first()
    assert zh.keyword == "机器学习"


def test_registry():
    assert len(sources()) == 20
    assert [s.name for s in pick("npm, pypi")] == ["npm", "pypi"]
    with pytest.raises(ValueError, match="nope"):
        pick("nope")


def test_limits_are_applied_before_the_shuffle(spark):
    plan = limit_per_source(Tables(spark, SF).events, 5, "event_type", "event_id")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_quota_stream_equals_batch(spark, tmp_path):
    events = Tables(spark, SF).events.withColumn("ts", F.col("ts").cast("timestamp"))
    last = events.agg(F.max("ts")).first()[0]
    tail = spark.createDataFrame([(last,)], "ts timestamp").select(F.expr("ts + interval 5 days").alias("ts"))
    events.select("ts").repartition(1).write.parquet(str(tmp_path / "in" / "a"))
    tail.write.parquet(str(tmp_path / "in" / "b"))
    stream = spark.readStream.schema("ts timestamp").option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    q = quota_stream(stream, 10).writeStream.format("memory").queryName("usage").outputMode("append").option(
        "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {tuple(r) for r in spark.table("usage").collect()}
    assert got == {tuple(r) for r in daily_usage(events, 10).collect()}


def test_ingest_stream_publishes_versions(spark, records, tmp_path):
    t = Tables(spark, SF)
    io.write_catalog(t.catalog.limit(20), str(tmp_path / "cat"), "v0")
    rows = [
        {"seq": 1, "name": "Brand New Thing", "source": "s", "source_tier": 2, "source_url": "https://s/1", "product_url": "https://brand.new/"},
        {"seq": 2, "name": "brand new thing", "source": "s", "source_tier": 2, "source_url": "https://s/2"},
        {"seq": 3, "name": "X", "source": "s", "source_tier": 2, "source_url": "https://s/3"},
    ]
    records(rows).withColumn("landed_at", F.lit("2026-01-01").cast("timestamp")).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = first_arrivals(read_records(spark, str(tmp_path / "in")))
    q = ingest_stream(stream, str(tmp_path / "cat"), str(tmp_path / "cp"), lambda: F.lit("2026-01-15").cast("date"), fuzzy=False, similar=False)
    q.awaitTermination(180)
    assert q.exception() is None
    out = io.read_current(spark, str(tmp_path / "cat"))
    assert out.count() == 21 and out.filter("slug = 'brand-new-thing'").count() == 1
