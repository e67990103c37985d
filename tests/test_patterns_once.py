from pyspark.sql import functions as F

from tierweave.checks import QUERIES
from tierweave.functions import money
from tierweave.sources import extract
from tierweave.sources.mappers import crunchbase_records

LANDED = "seq long, url string, source string, format string, body string, fetched_at timestamp"


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_page_of_an_organisation_is_read_once_per_pattern(spark):
    bodies = ["Total Funding: $1,200M\nEmployees: 101-200\nHeadquarters: Oslo, Viken, Norway", "Founded: 1999", "Investors: A", None]
    pages = spark.createDataFrame([(i, f"https://cb.example/organization/org-{i}", "crunchbase", "text", b, None) for i, b in enumerate(bodies)], LANDED)
    out = crunchbase_records(pages)
    assert plan_of(out).count("regexp_extract(") == 7
    got = {r.seq: r for r in out.collect()}
    assert sorted(got) == [0, 1]
    assert (got[0].company_total_raised_usd, got[0].company_employee_count_range, got[0].company_headquarters_country) == (1.2e9, "51-200", "Norway")
    assert (got[1].company_founded_year, got[1].company_total_raised_usd) == (1999, None)


def test_job_pages_run_each_pattern_once_per_group(spark):
    pages = spark.createDataFrame([(1, "u", "jobs", "text", "**Card job**\nCard firm · 深圳\n", None), (2, "u", "jobs", "text", None, None)], LANDED)
    out = extract.job_listings(pages)
    assert plan_of(out).count("regexp_extract_all(") == 10
    assert [(r.company_name, r.job_title, r.location) for r in out.collect()] == [("Card firm", "Card job", "深圳")]


def test_a_first_list_is_built_once_before_its_fallback(spark):
    df = spark.createDataFrame([("a b",), ("a b c",), (None,)], "t string")
    out = df.select(extract.with_fallback(F.split("t", " "), F.array(F.lit("z")), 3).alias("v"))
    assert plan_of(out).count("split(") == 1
    assert [r.v for r in out.collect()] == [["a", "b", "z"], ["a", "b", "c"], None]


def test_an_amount_is_cut_out_once(spark):
    df = spark.createDataFrame([("worth 1,5K",), ("worth x",), (None,)], "t string")
    out = df.select(money.parse_money(F.col("t"), "worth (.*)").alias("v"))
    assert plan_of(out).count("regexp_extract(") == 1
    assert [r.v for r in out.collect()] == [15000.0, None, None]


def test_payloads_are_built_in_more_than_one_task(spark):
    for name in ("m2_crunchbase", "m5_toolify", "m19_google_play", "m21_job_listings"):
        plan = plan_of(QUERIES[name](spark, "/root/testdata/sf0.001"))
        assert "Repartition" in plan, name
