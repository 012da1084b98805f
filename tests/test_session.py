"""Tables that a job writes once for several readers."""

from clinical_cohort.plans import reg_models
from clinical_cohort.session import written


def test_written_rows_are_read_back(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "a", None), (None, None, 2.5)], "k long, s string, v double")
    back = written(df)
    assert back.schema == df.schema and sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    assert written(df.where("false")).count() == 0


def test_model_inputs_read_written_features(spark, monkeypatch):
    """Names and vectors come from one pass over the events: both read the files of the feature table."""
    seen = []
    names = reg_models.ML.feature_names
    monkeypatch.setattr(reg_models.ML, "feature_names", lambda f: seen.append(f) or names(f))
    reg_models._make_inputs(spark, "/root/testdata/sf0.001")
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "Exchange" not in plan
