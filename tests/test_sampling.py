from pyspark.sql import functions as F

from clinical_cohort.operators import sampling as S


def test_bottom_k_deterministic_and_whole_for_zero(spark):
    df = spark.range(500).withColumnRenamed("id", "k")
    a = [r.k for r in S.comparison_sample(df, 20, ["k"]).collect()]
    b = [r.k for r in S.comparison_sample(df.repartition(7), 20, ["k"]).collect()]
    assert sorted(a) == sorted(b) and len(a) == 20
    assert S.comparison_sample(df, 0, ["k"]).count() == 500
    assert "TakeOrderedAndProject" in S.comparison_sample(df, 20, ["k"])._jdf.queryExecution().executedPlan().toString()


def test_split_disjoint_cover_and_shares(spark):
    df = spark.range(20000).withColumn("y", (F.col("id") % 4 == 0).cast("int"))
    s = S.stratified_split(df, "y", ["id"])
    counts = {(r.y, r.split): r["count"] for r in s.groupBy("y", "split").count().collect()}
    assert sum(counts.values()) == 20000
    for y in (0, 1):
        tot = sum(v for (yy, _), v in counts.items() if yy == y)
        assert [abs(counts[(y, n)] - tot * f) < 1 for n, f in (("train", 0.8), ("validation", 0.1), ("test", 0.1))] == [True] * 3


def test_stratified_split_of_a_rare_class(spark):
    df = spark.range(200).selectExpr("id", "CAST(id < 10 AS INT) AS y")
    for ranges in (1, 4, 4096):
        got = {(r.y, r.split): r["count"] for r in S.stratified_split(df, "y", ["id"], ranges=ranges).groupBy("y", "split").count().collect()}
        assert got == {(0, "train"): 152, (0, "validation"): 19, (0, "test"): 19,
                       (1, "train"): 8, (1, "validation"): 1, (1, "test"): 1}


def test_rank_and_best_features(spark):
    votes = spark.createDataFrame([("a", 2), ("b", 2), ("c", 1)], "Feature string, Total int")
    assert [r.Feature for r in S.rank_features(votes, 2).orderBy("Rank").collect()] == ["b", "a"]
    sc = spark.createDataFrame([("t", "x_person_id", 9.0), ("t", "f1", 1.0), ("t", "f2", 2.0), ("u", "f1", 5.0)],
                               "target string, feature string, score double")
    got = {(r.target, r.feature) for r in S.best_features(sc, 1).collect()}
    assert got == {("t", "f2"), ("u", "f1")}


def test_union_all_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "k long, v string")
    b = spark.createDataFrame([("y", 2)], "v string, k long")
    assert sorted(r.k for r in S.union_all([a, b]).collect()) == [1, 2]
