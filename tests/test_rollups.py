from clinical_cohort.operators import rollups as R

EVENT = "visit_occurrence_id long, person_id long, code string, name string"


def test_rollup_keeps_alignment_nulls_and_repeats(spark):
    df = spark.createDataFrame([(1, 7, "a", None), (1, 7, "b", "x"), (1, 7, "b", "x"), (2, 8, None, "y"), (None, 9, "z", "z")], EVENT)
    out = {tuple(r) for r in R.rollup(df, R.KEYS, ["code", "name"]).collect()}
    assert out == {(1, 7, "a", None, 1), (1, 7, "b", "x", 2), (2, 8, None, "y", 1), (None, 9, "z", "z", 1)}


def test_large_visit_is_grouped_by_event(spark):
    df = spark.range(300_000).selectExpr("id - id + 1 AS visit_occurrence_id", "id - id + 7 AS person_id",
                                         "CAST(id % 1000 AS STRING) AS code", "'n' AS name")
    rolled = R.rollup(df, R.KEYS, ["code", "name"])
    assert rolled.count() == 1000 and {r.n for r in rolled.collect()} == {300}
    plan = R.rollup(df, R.KEYS, ["code", "name"])._jdf.queryExecution().executedPlan().toString()
    keys = plan.split("hashpartitioning(", 1)[1].split(")")[0]
    assert keys.startswith("visit_occurrence_id") and "code" in keys
    counts = R.rollup_counts(rolled, R.KEYS)
    both = counts.join(R.rollup_counts(rolled, R.KEYS, "again"), list(R.KEYS))
    assert [tuple(r) for r in both.collect()] == [(1, 7, 300_000, 300_000)]


def test_events_without_a_visit_are_kept(spark):
    drugs = spark.createDataFrame([(None, 7, 1), (5, 8, 1)], "visit_occurrence_id long, person_id long, drug_concept_id long")
    concept = spark.createDataFrame([(1, "c", "RxNorm")], "concept_id long, concept_name string, vocabulary_id string")
    out = R.rollup_drugs(drugs, concept, cols=["drug_concept_id", "concept_name", "vocabulary_id"])
    assert {tuple(r) for r in out.collect()} == {(None, 7, 1, "c", "RxNorm", 1), (5, 8, 1, "c", "RxNorm", 1)}


def test_items_text(spark):
    df = spark.createDataFrame([(1, 1, "a", None)], EVENT)
    r = R.collect_items(R.rollup(df, R.KEYS, ["code", "name"]), R.KEYS, ["code", "name"])
    assert r.select(R.items_text("items", ["code", "name", "n"]).alias("t")).collect()[0].t == "a||1"
