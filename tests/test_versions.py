"""Published versions: two writers, buckets, and a stream that equals one batch."""

import os

import pytest

from pyspark.sql import functions as F
from tierweave import schemas
from tierweave.bindings import Tables
from tierweave.plans.ingest import ingest
from tierweave.sources import buckets
from tierweave.sources.catalog_io import read_current, write_catalog
from tierweave.sources.pointers import VersionTaken, latest, pointers
from tierweave.streaming.feeds import LANDED_RECORD, ingest_stream, read_late, read_records

SF = "/root/testdata/sf0.001"


def as_of():
    return F.lit("2026-01-15").cast("date")


@pytest.fixture(scope="module")
def catalog(spark):
    """One file of 40 customers as products."""
    from tierweave.session import stored

    return stored(Tables(spark, SF).catalog.orderBy("slug").limit(40).coalesce(1))


def test_one_of_two_writers_is_refused(spark, catalog, tmp_path):
    path = str(tmp_path)
    write_catalog(catalog, path, "v1")
    seen = latest(spark, path).number  # both writers start from here
    write_catalog(catalog.limit(2), path, "mine", after=seen)
    with pytest.raises(VersionTaken):
        write_catalog(catalog.limit(3), path, "theirs", after=seen)
    assert read_current(spark, path).count() == 2
    assert [(r.number, r.version) for r in pointers(spark, path).orderBy("number").collect()] == [(1, "v1"), (2, "mine")]


def sizes(path):
    return {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(path) for f in files if f.endswith(".parquet")}


def test_an_update_writes_touched_buckets_only(spark, catalog, tmp_path):
    path = str(tmp_path)
    base = buckets.write_buckets(catalog, path, "v1", 16)
    before = sizes(tmp_path)
    slug = catalog.first().slug
    changed = catalog.filter(F.col("slug") == slug).withColumn("description", F.lit("changed")).select(*schemas.PRODUCT.names)
    done = buckets.update_buckets(changed, path, "v2", base)
    added = {f: n for f, n in sizes(tmp_path).items() if f not in before}
    assert len({os.path.dirname(f) for f in added}) == 1 and sum(added.values()) < sum(before.values()) / 4
    assert sum(done.folders[b] != base.folders[b] for b in base.folders) == 1
    now = {r.slug: r.description for r in read_current(spark, path).collect()}
    was = {r.slug: r.description for r in buckets.read_buckets(spark, path, base).collect()}
    assert now == {**was, slug: "changed"} and was[slug] != "changed"
    with pytest.raises(VersionTaken):
        buckets.update_buckets(changed, path, "v2b", base)
    assert buckets.update_buckets(changed.limit(0), path, "v3").folders == done.folders
    empty = buckets.write_buckets(catalog.limit(0), f"{path}/none", "v1", 4)
    assert empty.folders == {} and read_current(spark, f"{path}/none").count() == 0


def document(r):
    """A product without the moment of its changes."""
    return (r.slug, r.name, r.description, r.name_zh, tuple(r.tags or ()), tuple(s.url for s in r.sources or ()), r.company.website if r.company else None)


def test_stream_equals_batch_and_keeps_late_records(spark, records, catalog, tmp_path):
    known = [r.name for r in catalog.orderBy("slug").limit(3).collect()]
    base = {"source": "s", "category": "ai-app"}
    days = [
        [{"name": "Brand New Thing", "source_tier": 2, "tags": ["a"], "product_url": "https://brand.new/"},
         {"name": "brand new thing", "source_tier": 1, "tags": ["b"]}, {"name": known[0], "source_tier": 2, "tags": ["x"]}],
        [{"name": known[0], "source_tier": 1, "tags": ["y"], "name_zh": "一号"}, {"name": "Brand New Thing", "source_tier": 1, "tags": ["c"]},
         {"name": "Second Thing", "source_tier": 2, "product_url": "https://second.thing/"}],
        [{"name": known[1], "source_tier": 2, "tags": ["z"]}, {"name": "Late One", "source_tier": 1, "late": True}],
    ]
    seq, rows, places = 0, [], []
    for day, batch in enumerate(days):
        for r in batch:
            seq += 1
            rows.append(base | {k: v for k, v in r.items() if k != "late"} | {"seq": seq, "source_url": f"https://s/{seq}"})
            places.append((seq, day, "2025-11-01" if r.get("late") else f"2026-01-0{day + 1}"))
    whole = records(rows).join(spark.createDataFrame(places, "seq long, day int, at string"), "seq")
    landed = whole.withColumn("landed_at", F.col("at").cast("timestamp"))
    for day in range(len(days)):
        out = str(tmp_path / f"in/{day}")
        landed.filter(F.col("day") == day).select(*LANDED_RECORD.names).coalesce(1).write.parquet(out)
        for f in os.listdir(out):
            if f.endswith(".parquet"):
                os.rename(f"{out}/{f}", str(tmp_path / f"in/day-{day}.parquet"))
                os.utime(str(tmp_path / f"in/day-{day}.parquet"), (1_700_000_000 + day,) * 2)
    cat = str(tmp_path / "cat")
    write_catalog(catalog, cat, "v0")
    stream = read_records(spark, str(tmp_path / "in/*.parquet"), 1)
    q = ingest_stream(stream, cat, str(tmp_path / "cp"), as_of, fuzzy=False, similar=False, buckets=8)
    q.awaitTermination(300)
    assert q.exception() is None
    got = sorted(map(document, read_current(spark, cat).collect()), key=str)
    batch = ingest(catalog, landed.filter("at >= '2026'").select(*schemas.RECORD.names), as_of(), fuzzy=False, similar=False)
    assert got == sorted(map(document, batch.catalog.collect()), key=str)
    assert [(r.name, r.batch) for r in read_late(spark, cat).select("name", "batch").collect()] == [("Late One", 2)]
    versions = [r.version for r in pointers(spark, cat).orderBy("number").collect()]
    assert versions == ["v0", "v0-buckets", "batch-000000000", "batch-000000001", "batch-000000002"]
