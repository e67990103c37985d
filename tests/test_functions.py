import pytest
from pyspark.sql import functions as F

from tierweave.functions import geo, money, text, url


@pytest.mark.parametrize("fn,given,want", [
    (text.slugify, "Hugging Face", "hugging-face"), (text.slugify, "1X Technologies", "1x-technologies"),
    (text.slugify, " Café Zoë – Ltd ", "cafe-zoe-ltd"), (text.slugify, "人工智能", None),
    (text.normalize_name, "Acme, Inc.", "Acme"), (text.normalize_name, "Costco", "Cost"), (text.normalize_name, "Cisco", "Cis"),
    (text.humanize_label, "ai-main-ai", "AI main AI"), (text.has_chinese, "x 中", True), (text.valid_slug, "../etc", False), (text.valid_slug, "a", True),
    (url.normalize_url, " https://a.b/c/#x ", "https://a.b/c"), (url.extract_domain, "https://www.Openai.com/x", "openai.com"),
    (url.extract_domain, "WWW.a.com", "www.a.com"), (url.host_for_policy, "https://u@WWW.A.com:80/x", "a.com"), (url.icon_candidates, "", []),
    (money.money_value, "1,200.5M", 1.2005e9), (money.money_value, "5m", None), (money.employee_range, "101-250", "201-500"),
    (money.format_param_count, 1_500_000_000_000, "1.5T"), (money.format_param_count, 7_000_000_000, "7B"), (money.format_currency, 2_500_000_000, "$2.5B"),
    (money.price_per_million, "0", None), (geo.normalize_country, " usa ", "United States"), (geo.country_code, "Atlantis", None),
    (geo.normalize_category, "AI App", "ai-application"), (geo.parse_modalities, "text+image->text", ["image", "text"]), (geo.headquarters_country, "Oslo", None),
])
def test_values(spark, fn, given, want):
    df = spark.createDataFrame([(given,)], "v long" if isinstance(given, int) else "v string")
    assert df.select(fn("v") if fn is not money.money_value else fn(F.col("v"))).first()[0] == want


def test_job_keywords(spark):
    df = spark.createDataFrame([("大模型算法工程师",), ("Plumber",), ("LLM Engineer",)], "t string")
    got = df.select(text.matches_ai_job("t", F.lit("")).alias("m"), text.job_category("t", F.lit("")).alias("c")).collect()
    assert [(r.m, r.c) for r in got] == [(True, "llm-foundation-model"), (False, None), (True, "llm-foundation-model")]


def test_amounts_are_rounded_as_in_sql(spark, tmp_path):
    import duckdb

    from tierweave.checks import ORACLES, QUERIES

    # 128605 * 0.001 is 128.605, and 100 times that is below 12860.5
    rows = [(3, 128605.0), (7, 1005.0), (2, 115000.0), (6, 235000.0), (1, 1500.5)]
    spark.createDataFrame(rows, "o_orderkey long, o_totalprice double").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW orders AS SELECT * FROM '{tmp_path}/orders.parquet/*.parquet'")
    want = con.execute(ORACLES["f26_format_currency"]).fetchall()
    assert sorted(map(tuple, QUERIES["f26_format_currency"](spark, str(tmp_path)).collect())) == sorted(want)
    assert dict(want)[3] == "$128.6"
