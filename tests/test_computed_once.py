import re

from pyspark.sql import functions as F

from tierweave.operators import gaps, search, tags


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_tag_rules_fold_the_text_once(spark):
    df = spark.createDataFrame([("An AI chatbot, open source SDK",), ("plain",), (None,)], "text string")
    out = df.select(tags.text_tags(F.concat("text", F.lit(" of today"))).alias("tags"))
    assert plan_of(out).count("translate(") == 1
    assert "chatbot" in out.first().tags


def test_answers_are_parsed_once(spark):
    df = spark.createDataFrame([('```json\n{"category": "ai-hardware"}\n```',), ("[1]",), (None,)], "response string")
    asked = F.array(F.lit("category"), F.lit("tags"))
    out = df.withColumn("a", gaps.answer(F.col("response"), asked)).select("a.*")
    assert len(re.findall("(?i)parse_?json", plan_of(out))) == 1
    assert [r.category for r in out.collect()] == ["ai-hardware", None, None]


def test_search_folds_a_value_once(spark):
    df = spark.createDataFrame([("Some Machinery",), ("machinary",), ("other",)], "name string")
    out = df.select(search.key_distance(F.concat("name", F.lit("")), "machinery").alias("d"))
    assert plan_of(out).count("lower(") == 1
    assert [r.d for r in out.collect()] == [0.1, 1 / 9, None]
