"""Landing files to catalog: one arrival order over all sources, create rule, names of any script."""

import json
import os

from pyspark.sql import functions as F

from tierweave import schemas
from tierweave.bindings import Tables
from tierweave.plans.ingest import ingest
from tierweave.sources.catalog_io import read_current, read_landed, write_catalog, write_stats
from tierweave.sources.registry import map_sources

SF = "/root/testdata/sf0.001"


def as_of():
    return F.lit("2026-01-15").cast("date")


def catalog(spark):
    return Tables(spark, SF).catalog.limit(20)


def landed(spark, rows):
    return schemas.conform(spark.createDataFrame(rows, "seq long, url string, source string, format string, body string"), schemas.LANDED)


def test_records_of_all_sources_have_their_own_number(spark):
    info = json.dumps({"info": {"summary": "Tensors"}})
    rows = [
        (1, "https://pypi.org/pypi/torch/json", "pypi", "info", info),
        (1, "https://registry.npmjs.org/openai", "npm", "info", json.dumps({"description": "client"})),
        (1, "https://hub.docker.com/v2/repositories/ollama/ollama/", "dockerhub", "json", json.dumps({"description": "models", "pull_count": 5})),
        (1, "x", "app_store", "json", json.dumps({"results": [{"trackId": 7, "trackName": "Seven"}, {"trackId": 8, "trackName": "Eight"}]})),
    ]
    got = map_sources(landed(spark, rows)).cache()
    seqs = [r.seq for r in got.select("seq").collect()]
    assert len(seqs) == len(set(seqs)) == got.count() >= 4
    order = [r.source for r in got.orderBy("seq").collect()]
    assert order == sorted(order, key=order.index)  # sources stay together
    run = ingest(catalog(spark), got, as_of(), fuzzy=False, similar=False)
    new = run.catalog.filter(~F.col("slug").startswith("customer-")).select("slug", F.size("sources").alias("n")).collect()
    assert len(new) == len(seqs) and {r.n for r in new} == {1}


def test_landed_files_keep_their_order(spark, tmp_path):
    for i, name in enumerate(("b", "a", "c")):
        f = tmp_path / f"{name}.json"
        f.write_text(json.dumps({"results": [{"trackId": 10 * i + k, "trackName": f"App {i}-{k}"} for k in range(2)]}))
        os.utime(f, (1_700_000_000 + 100 * i,) * 2)
    pages = read_landed(spark, str(tmp_path), "app_store", "json")
    got = [r.name for r in map_sources(pages, "app_store").orderBy("seq").collect()]
    assert got == [f"App {i}-{k}" for i in range(3) for k in range(2)]


def test_a_new_product_keeps_its_description(spark, records):
    known = catalog(spark)
    text = "Search engine for long scientific documents with citations, graphs and alerts"
    known = known.withColumn("description", F.when(F.col("slug") == known.orderBy("slug").first().slug, F.lit(text)).otherwise(F.col("description")))
    rows = [
        {"seq": 1, "name": "Fresh Thing", "source": "s", "source_tier": 2, "source_url": "https://s/1", "product_url": "https://fresh.example/", "description": text},
        {"seq": 2, "name": "智能搜索", "source": "s", "source_tier": 2, "source_url": "https://s/2", "product_url": "https://zh.example/"},
        {"seq": 3, "name": "智能助手", "source": "s", "source_tier": 2, "source_url": "https://s/3", "product_url": "https://zh2.example/"},
    ]
    run = ingest(known, records(rows), as_of(), fuzzy=False)
    out = {r.name: r for r in run.catalog.select("slug", "name", "description").collect()}
    assert out["Fresh Thing"].description == text
    assert out["智能搜索"].slug != out["智能助手"].slug and out["智能搜索"].slug.startswith("n-")
    assert run.rejected.count() == 0


def test_long_job_pages_are_read_to_the_end(spark):
    from tierweave.sources.extract import job_listings

    advert = "| Data Engineer | Acme Corp | Berlin |\n"
    body = "| Title | Company | Location |\n|---|---|---|\n" + "filler text without any advert\n" * 20_000 + "| Title | Company | Location |\n|---|---|---|\n" + advert
    got = job_listings(landed(spark, [(1, "u", "jobs", "html", body)])).collect()
    assert len(body) > 600_000 and [r.company_name for r in got][-1] == "Acme Corp"


def test_publishing_adds_a_pointer(spark, tmp_path):
    known = catalog(spark)
    for i, version in enumerate(("v1", "v2", "v2")):
        write_catalog(known.limit(i + 1), str(tmp_path), version)
        assert read_current(spark, str(tmp_path)).count() == i + 1
    assert len(list((tmp_path / "_current").glob("part-*"))) == 3


def test_stats_are_one_document(spark, tmp_path):
    frames = {
        "total": spark.sql("SELECT 7L AS n"), "by_kind": spark.sql("SELECT 'a' AS kind, 2L AS n UNION ALL SELECT 'b', 1L"),
        "none": spark.sql("SELECT 1 AS x WHERE false"),
    }
    write_stats(frames, str(tmp_path / "s"))
    text = "".join(p.read_text() for p in (tmp_path / "s").glob("part-*"))
    assert json.loads(text) == {"total": 7, "by_kind": [{"kind": "a", "n": 2}, {"kind": "b", "n": 1}], "none": []}
