"""The driver contract: entry() runs; every query has an oracle (or is
documented as rows-only); plan shape holds for the headline reports."""

import __spark_entry__ as entry
from claimsflow.catalog import QUERIES
from claimsflow.catalog import tables
from claimsflow.plans import combined, monthly_matrix, original_values
from claimsflow.sources import testbed

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["Provider office account number", "Submission month", "Area of law",
                          "Original submission value", "Date submission was uploaded"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_report_plans_are_scalable(spark):
    t = tables(spark, SF)
    for df in (combined.combined_extract(t, testbed.AS_OF), original_values.original_values(t),
               monthly_matrix.monthly_matrix(t)):
        plan = _plan(df)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
        assert "SinglePartition" not in plan


def test_top1_windows_limit_before_the_shuffle(spark):
    t = tables(spark, SF)
    assert "WindowGroupLimit" in _plan(original_values.original_values(t))
    assert "WindowGroupLimit" in _plan(combined.combined_extract(t, testbed.AS_OF))


def test_filters_reach_the_scan(spark):
    t = tables(spark, SF)
    plan = _plan(combined.combined_extract(t, testbed.AS_OF))
    assert "PushedFilters: [IsNotNull(status), EqualTo(status,VALIDATION_SUCCEEDED)" in plan
    assert "EqualTo(status,VALID)" in plan
