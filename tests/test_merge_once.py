from pyspark.sql import functions as F

from tierweave import schemas
from tierweave.fixed.scoring import ARRAY_PATHS
from tierweave.operators.merge import create_products, tiered_merge


def test_unseen_items_and_owners_are_computed_once(spark, records):
    as_of = F.lit("2026-01-01").cast("date")
    catalog = create_products(records([{"seq": 0, "slug": "p", "name": "P", "source": "s", "source_tier": 2, "tags": ["a"]}], slug=True), as_of)
    catalog = spark.createDataFrame(catalog.collect(), schemas.PRODUCT)
    rows = records([
        {"seq": 1, "slug": "p", "name": "P", "source": "t", "source_tier": 1, "tags": ["a", "b"], "description": "better"},
        {"seq": 2, "slug": "p", "name": "P", "source": "u", "source_tier": 1, "tags": ["c"], "description": "late"},
    ], slug=True)
    out = tiered_merge(catalog, rows, as_of)
    plan = out._jdf.queryExecution().optimizedPlan().toJSON()
    assert plan.count("expressions.ArrayContains\"") < 2 * len(ARRAY_PATHS)
    assert plan.count("expressions.MapFromEntries\"") <= 4
    got = out.first()
    owners = {k: v["source"] for k, v in got.meta.provenance.items()}
    assert got.tags == ["a", "b", "c"] and got.description == "better"
    assert owners["description"] == "t" and owners["tags"] == "u"
