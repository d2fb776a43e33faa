"""Plan shape: column pruning reaches the scans and no query plans a cartesian or nested-loop join."""
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL

CORE = ["scoring_sample", "period_report", "gini_by_pool", "four_pools", "undersample", "stratified_folds",
        "bin_stats_woe", "woe_encode", "roc_points", "category_stats", "apply_codes", "backtest_gini", "vif",
        "uplift_steps", "oversample", "train_medians"]


def plan_text(df):
    qe = df._jdf.queryExecution()
    return qe.executedPlan().toString() + qe.optimizedPlan().toString()


@pytest.mark.parametrize("name", CORE)
def test_no_cartesian_or_nested_loop(spark, name):
    text = plan_text(entry.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_fixture_scans_are_pruned(spark):
    from giniflow.sources.fixture import scoring_sample
    text = scoring_sample(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "l_returnflag" not in text and "l_shipdate" not in text and "o_totalprice" not in text
    assert "c_name" not in text and "p_name" not in text


def test_lazy_sample_is_pruned(spark):
    import __spark_entry__ as entry
    plan = lambda name: entry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    dates = plan("distinct_dates")
    assert "InMemoryRelation" not in dates and "md5" not in dates and "l_extendedprice" not in dates.split("Relation")[0]
    report = plan("period_report")
    assert "InMemoryRelation" not in report and report.count("md5") == 1     # the planted target's only
