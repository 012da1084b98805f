import itertools
import re

import pytest
from pyspark.sql import functions as F

from clinical_cohort.operators import features as FE

KEY = "visit_occurrence_id"
PATTERN = FE.ICD_PATTERN
LEVELS = FE.ICD_LEVELS


def test_code_prefix_level3(spark):
    df = spark.createDataFrame([(c,) for c in ["F11.20", "f11.20", "U07.1", "XF11.2", "250.00"]], "c string")
    got = [r.p for r in df.select(FE.code_prefix("c", 3).alias("p")).collect()]
    assert got == ["F11", "F11.20", "U07.1", "XF1", "250.00"]


def _reference_semantics(events):
    """Brute force of the pivot chain: per level a count table; a column name
    keeps the counts of the first level (in level order) where it appears."""
    def clean(s):
        return "DETBL_" + re.sub(r"[ ,;{}()\n\t=]+", "", ("null" if s is None else s).replace(".", "_"))

    tables = []
    for lv in LEVELS:
        t = {}
        for key, code in events:
            if code is not None and re.search(PATTERN, code):
                name = code.upper()[:lv]
            else:
                name = None if code is None else code.upper()
            t[(key, clean(name))] = t.get((key, clean(name)), 0) + 1
        tables.append(t)
    seen, out = set(), {}
    for t in tables:
        names = {n for (_, n) in t}
        new = names - seen
        for (k, n), v in t.items():
            if n in new:
                out[(k, n)] = v
        seen |= names
    return out


def test_code_level_counts_matches_pivot_chain(spark):
    codes = ["F11.20", "f11.20", "U07.1", "XF11.2", "250.00", "A01", "A0", "a01.9", "Z99.123456", None, "E11.9"]
    events = [(k, c) for k, c in itertools.product([1, 2, 3], codes) if (k + len(c or "")) % 4 != 0]
    df = spark.createDataFrame(events, "visit_occurrence_id long, condition_source_value string")
    got = {(r.visit_occurrence_id, r.feature): r.value for r in FE.code_level_counts(df).collect()}
    assert got == _reference_semantics(events)


def test_class_levels_lower_level_wins(spark):
    df = spark.createDataFrame([(1, "A", "A"), (1, "A", "B"), (2, "C", "A")], "visit_occurrence_id long, l1 string, l2 string")
    got = {(r.visit_occurrence_id, r.feature): r.value for r in FE.class_level_counts(df, ["l1", "l2"]).collect()}
    # 'A' exists at level 1, so its level-2 counts are not used
    assert got == {(1, "MEDTBL_A"): 2, (2, "MEDTBL_C"): 1, (1, "MEDTBL_B"): 1}


def test_binarize_drop_rare_and_wide(spark):
    long_df = spark.createDataFrame([(1, "DETBL_A", 3), (2, "DETBL_A", 1), (1, "DETBL_B", 2), (1, "CCTBL_X", 1)],
                                    "visit_occurrence_id long, feature string, value long")
    b = FE.binarize(long_df)
    assert {r.value for r in b.collect()} == {1}
    kept = FE.drop_rare(b, min_support=2, prefix="DETBL_")
    assert sorted({r.feature for r in kept.collect()}) == ["CCTBL_X", "DETBL_A"]
    wide = FE.to_wide(b, ["DETBL_A", "DETBL_B", "DETBL_Z"]).orderBy("visit_occurrence_id").collect()
    assert [(r.DETBL_A, r.DETBL_B, r.DETBL_Z) for r in wide] == [(1, 1, 0), (1, 0, 0)]
    # pivot sum equals the long count
    assert sum(r.DETBL_A + r.DETBL_B for r in wide) == b.where(F.col("feature").startswith("DETBL_")).count()


def _class_rows(spark):
    events = spark.createDataFrame([(1, 10), (1, 10), (1, 11), (2, 12), (3, 10), (None, 11), (2, None), (2, 99)], f"{KEY} long, drug long")
    classes = spark.createDataFrame([(10, "A", "A1"), (11, "B", "A"), (11, "B", "A"), (12, None, "B.x"), (13, "B.x", "Q")],
                                    "drug long, l1 string, l2 string")
    return events, classes


def test_classes_by_code_are_the_joined_classes(spark):
    """Codes that repeat among the classes, null codes and classes without an event count as after the join."""
    events, classes = _class_rows(spark)
    want = sorted(map(str, FE.class_level_counts(events.join(classes, "drug"), ["l1", "l2"]).collect()))
    got = sorted(map(str, FE.class_level_counts(events, ["l1", "l2"], classes=classes, on="drug").collect()))
    assert got == want and len(got) > 5


def test_base_cuts_events_before_their_names_and_not_the_levels(spark):
    events, classes = _class_rows(spark)
    base = spark.createDataFrame([(1,), (1,), (3,), (7,)], f"{KEY} long")
    codes = spark.createDataFrame([(1, "F11.20"), (1, "F11.20"), (2, "F11"), (3, "XX"), (None, "F11")], f"{KEY} long, condition_source_value string")
    for made in (lambda b: FE.class_level_counts(events, ["l1", "l2"], classes=classes, on="drug", base=b),
                 lambda b: FE.code_level_counts(codes, base=b)):
        want = sorted(map(str, FE.restrict_keys(made(None), base).collect()))
        assert sorted(map(str, made(base).collect())) == want and want


def test_long_tables_are_dealt_before_they_are_multiplied(spark):
    """No exchange above the explode: a visit's rows are dealt once, while there is one of each code."""
    events, classes = _class_rows(spark)
    codes = spark.createDataFrame([(1, "F11.20"), (2, "F11")], f"{KEY} long, condition_source_value string")
    for df in (FE.code_level_counts(codes), FE.class_level_counts(events, ["l1", "l2"], classes=classes, on="drug")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan[:plan.index("Generate explode")] and "Generate explode" in plan


def test_names_are_not_shuffled_beside_codes(spark):
    """The dictionary of codes meets the dealt rows; classes of a code are shuffled as numbers."""
    events, classes = _class_rows(spark)
    codes = spark.createDataFrame([(1, "F11.20"), (2, "F11")], f"{KEY} long, condition_source_value string")
    plan = FE.code_level_counts(codes)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join Inner") < plan.index("RepartitionByExpression")
    by_class = FE.class_level_counts(events, ["l1", "l2"], classes=classes, on="drug")
    dealt = by_class._jdf.queryExecution().analyzed().toString()
    assert "explode(_features" in dealt and "_number" in dealt[dealt.index("Generate explode"):].splitlines()[0]


def test_base_is_dealt_like_the_rows(spark):
    """Cutting to the base visits shuffles the rows once."""
    rows = spark.range(50).selectExpr(f"id % 7 AS {KEY}", "'f' AS feature", "1L AS value")
    base = spark.range(5).selectExpr(f"id AS {KEY}")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = FE.restrict_keys(rows, base)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2  # the rows, and the base
        assert sorted(r[KEY] for r in df.collect()) == sorted(i % 7 for i in range(50) if i % 7 < 5)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
