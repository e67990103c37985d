"""A cross-section of the bound queries against the SQL engine; ``check.py`` runs them all."""

from types import SimpleNamespace

import duckdb
import pytest

from check import rows
from pyspark.sql import functions as F
from tierweave.bindings import TABLES, Tables
from tierweave.checks import ORACLES, QUERIES
from tierweave.checks.aggregates import _judged
from tierweave.checks.matching import _candidates, near_description
from tierweave.operators.similarity import lcs_length

SF = "/root/testdata/sf0.001"
PICKED = ("f12_normalize", "p1_plausibility", "a6_stats", "w3_tier_winner", "j8_resolve_exact", "x5_infer_tags", "c4_cross_validate", "m13_theresanaiforthat")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", PICKED)
def test_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    cur = con.execute(ORACLES[name])
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows([d[0] for d in cur.description], cur.fetchall())


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def alike(text, held, own):
    """Slugs of other products with a description of a ratio of at least 0.90."""
    return {s for s, d in held.items() if s != own and min(len(text), len(d)) >= 20 and 2 * lcs_length(text, d) >= 0.9 * (len(text) + len(d))}


@pytest.fixture(scope="module")
def held(spark):
    return {r.slug: r.description for r in Tables(spark, SF).catalog.select("slug", "description").collect() if r.description}


def test_near_descriptions_equal_brute_force(spark, held):
    asked = _candidates(Tables(spark, SF)).select("slug", near_description(F.col("seq")).alias("text")).collect()
    found = {r.slug: r.reason for r in QUERIES["c4_cross_validate_similar"](spark, SF).filter("field = 'description'").collect()}
    want = {r.slug: alike(r.text, held, r.slug) for r in asked}
    assert set(found) == {s for s, others in want.items() if others} and 100 < len(found) < len(asked)
    assert all(reason.split("'")[1] in want[s] for s, reason in found.items())


def test_ingest_takes_no_near_description(spark, held):
    got = QUERIES["c7_ingest"](spark, SF).collect()
    known = {r.slug for r in Tables(spark, SF).catalog.select("slug").collect()}
    filled = {r.slug: r.description for r in got if r.slug in known and r.slug not in held and r.description}
    assert filled and not {s for s, d in filled.items() if alike(d, held, s)}
    assert {"category", "tags"} <= set(got[0].asDict())


def test_run_summary_counts_similar_names(spark):
    t = Tables(spark, SF)
    name = t.catalog.filter("slug = 'customer-12'").first().name
    records = t.incoming.filter("seq % 6 = 3").limit(1).withColumns({"name": F.lit(name + "s"), "name_zh": F.lit(None).cast("string")})
    assert _judged(SimpleNamespace(incoming=records, catalog=t.catalog)).first().match_slug is not None
