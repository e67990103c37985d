"""Stored rankings: what they write and what a page reads."""

import os

from pyspark.sql import functions as F
from tierweave.operators.ranking import positions, stored_ranking


def size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(path) for f in files if f.endswith(".parquet"))


def frame(spark, width):
    return spark.range(500).select(F.concat(F.lit("s"), "id").alias("slug"), (F.col("id") * 37 % 100).alias("score"), F.repeat(F.sha2(F.col("id").cast("string"), 512), width).alias("wide"))


def test_what_is_written_does_not_depend_on_the_rows(spark, tmp_path):
    order = [F.desc("score"), F.col("slug")]
    for width in (1, 50):
        stored_ranking(frame(spark, width), order, part_rows=50, path=str(tmp_path / str(width)))
    assert size(tmp_path / "1") == size(tmp_path / "50")
    assert positions(frame(spark, 1), order).columns == ["slug", "rn"]


def test_pages_are_those_of_the_whole_order(spark, tmp_path):
    df = frame(spark, 1)
    order = [F.desc("score"), F.col("slug")]
    ranking = stored_ranking(df, order, part_rows=50, path=str(tmp_path / "r"))
    want = [r.slug for r in df.orderBy(*order).collect()]
    for page in (1, 5, 42):
        assert [r.slug for r in ranking.page(df, page, 12).collect()] == want[12 * page - 12:12 * page]
    assert ranking.page(df, 43, 12).count() == 0
    plan = spark.read.parquet(ranking.path).filter(F.col("part").isin(0)).select("slug")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "part" in plan.split("PartitionFilters: [")[1].split("]")[0]
