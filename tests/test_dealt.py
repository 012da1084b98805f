"""Joins of large role tables keep their number of partitions, however well their rows compress."""

import datetime

import pytest

from clinical_cohort.operators.joins import active_at_visit, dealt
from clinical_cohort.plans.roles import DEALS_A_SPLIT, Roles

from plan_text import plan_text


@pytest.fixture
def unbroadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture
def folder(spark, tmp_path):
    day = datetime.datetime(2020, 1, 1)
    lines = [(k, 7, n, float(n), "R", "O", day) for k in (1, 2, 2, 3, None) for n in (1, 2)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_returnflag string, "
                                 "l_linestatus string, l_shipdate timestamp_ntz").write.parquet(str(tmp_path / "lineitem.parquet"))
    orders = [(1, 10), (2, 20), (2, 21), (4, 40), (None, 50)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(str(tmp_path / "orders.parquet"))
    return str(tmp_path)


@pytest.mark.parametrize("name", ["procedure_occurrence", "drug_exposure"])
def test_role_join_is_not_packed_and_keeps_every_row(unbroadcast, folder, name):
    out = getattr(Roles(unbroadcast, folder), name)
    splits = unbroadcast.read.parquet(f"{folder}/lineitem.parquet").rdd.getNumPartitions()
    assert out.rdd.getNumPartitions() == max(4, DEALS_A_SPLIT * splits)
    got = sorted(map(tuple, out.select("visit_occurrence_id", "person_id").collect()))
    assert got == sorted([(1, 10)] * 2 + [(2, 20)] * 4 + [(2, 21)] * 4)


def test_dealt_takes_the_sessions_number(spark):
    df = spark.range(10).selectExpr("id AS k")
    assert dealt(df, "k").rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert dealt(df, "k", partitions=7).rdd.getNumPartitions() == 7


def test_person_scope_join_is_not_packed(unbroadcast):
    conditions = unbroadcast.sql("SELECT id % 5 AS person_id, id AS visit_occurrence_id, timestamp_ntz'2020-01-01' AS condition_start_datetime, "
                                 "CASE WHEN id % 2 = 0 THEN timestamp_ntz'2020-03-01' END AS condition_end_datetime FROM range(20)")
    visits = unbroadcast.sql("SELECT id AS person_id, id AS visit_occurrence_id, timestamp_ntz'2020-02-01' AS visit_start_datetime FROM range(5)")
    out = active_at_visit(conditions, visits, scope="person", open_ended=True)
    assert plan_text(out).count("REPARTITION_BY_NUM") == 2
    assert out.count() == 20
    assert active_at_visit(conditions, visits, scope="person").count() == 10
