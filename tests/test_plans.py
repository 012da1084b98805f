"""Plan checks over every registered query: no nested-loop or Cartesian joins."""

import os
import re

import pytest

import __spark_entry__ as entry
from clinical_cohort.plans import reg_models, registry
from plan_text import plan_text

registry.load_all()

SF = "/root/testdata/sf0.001"
MODEL_KEYS = {"fs_l1", "fs_rfe", "fs_forest", "fs_gbt", "ml_tree_cv", "ml_calibrate", "ml_tree_rules", "ml_baseline_logistic",
              "fs_vote", "ml_predictions", "study_report", "study_rules", "study_explained", "study_calibrated"}
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.mark.parametrize("key", sorted(set(registry.QUERIES) - MODEL_KEYS))
def test_no_pairwise_join(spark, key):
    df = entry.queries()[key](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan
    assert "CartesianProduct" not in plan


def test_profile_reads_person_once(spark):
    df = entry.queries()["qc_profile"](spark, SF)
    df.collect()
    plan = plan_text(df)  # the final plan: every other use of the value counts reads the same exchange
    assert plan.count("FileScan parquet") == 1 and plan.count("ReusedExchange") >= 2


def test_no_join_on_feature_names_of_events(spark):
    """Features come from a dictionary of codes: the only joins are on the code and on rare names."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = entry.queries()["features_icd_levels"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    top = plan[:plan.index("Join ")]
    assert "Aggregate [visit_occurrence_id" in top  # joined by code first, summed by feature after
    assert "condition_source_value" in plan[plan.index("Join "):].splitlines()[0]


def test_votes_read_the_features_once(spark, monkeypatch):
    """Chi-square and support of the vote keys come from one feature table, with the same columns of it."""
    made = []
    was = reg_models.FE.feature_matrix
    monkeypatch.setattr(reg_models.FE, "feature_matrix", lambda *a, **b: made.append(was(*a, **b)) or made[-1])
    df = entry.queries()["rank_features"](spark, SF)
    assert len(made) == 1
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"FileScan parquet \[(l_orderkey#[^]]*)\]", re.sub(r"#\d+L?", "#", plan))
    assert len(scans) % 2 == 0 and len(set(scans)) == 3  # both read the same three sets of columns, so the shuffles are alike
