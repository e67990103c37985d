from tierweave.bindings import Tables
from tierweave.checks.functions import as_of
from tierweave.plans.ingest import ingest


def test_records_are_normalised_once_for_all_steps(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    run = ingest(t.catalog, t.incoming, as_of(), fuzzy=False, similar=False)
    plan = run.rejected._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace(" not in plan and "parquet" not in plan
    assert run.rejected.count() + run.accepted.count() == t.incoming.count()
