"""Role views: OMOP-shaped tables over the driver's generic test tables.

The operators take column and table names as parameters, so the same code
runs on an OMOP warehouse and on the TPC-H-like test tables. This module
maps the test tables onto the OMOP roles the operators expect. Each role is
one spec (source table, SQL expressions, optional filter and grouping); the
spec is rendered two ways from the same text:

* ``role(spark, sf_dir, name)`` -> a Spark DataFrame (``selectExpr`` over the
  parquet scan, so column pruning and filter pushdown still reach the scan);
* ``cte(*names)`` -> a ``WITH`` clause for the DuckDB oracle.

The expressions are plain ANSI SQL that both engines evaluate the same way.
The views add nulls, empty strings and open intervals on purpose so that the
operators' null rules are exercised.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import dealt

#: Partitions of a dealt role for each split that its source is scanned in.
DEALS_A_SPLIT = 4


@dataclass(frozen=True)
class RoleSpec:
    source: str
    exprs: tuple[str, ...]
    where: str | None = None
    group_by: int = 0  # number of leading expressions that form the key
    joins: tuple[tuple[str, str, str], ...] = field(default_factory=tuple)
    deal: bool = False  # both sides of the joins are large: dealt by the key, see ``joins.dealt``


# The role definitions shared by the Spark side and the oracle.
ROLES: dict[str, RoleSpec] = {
    "person": RoleSpec(
        "customer",
        (
            "c_custkey AS person_id",
            "DATE '1930-01-01' + CAST(c_custkey * 7919 % 25000 AS INT) AS birth_datetime",
            "CASE WHEN c_custkey % 11 = 0 THEN DATE '2003-01-01' + CAST(c_custkey % 300 AS INT) END AS death_datetime",
            "CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender_source_value",
            "c_mktsegment AS race_source_value",
            "CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN '' ELSE 'Non-Hispanic' END AS ethnicity_source_value",
            "CASE WHEN c_custkey % 13 <> 0 AND c_nationkey < 20 THEN CAST(c_nationkey AS BIGINT) END AS care_site_id",
            "CASE WHEN c_nationkey % 5 <> 4 THEN CAST(c_nationkey % 5 AS BIGINT) END AS location_id",
        ),
    ),
    "visit_occurrence": RoleSpec(
        "orders",
        (
            "o_orderkey AS visit_occurrence_id",
            "o_custkey AS person_id",
            "o_orderdate AS visit_start_datetime",
            "CASE WHEN o_orderkey % 50 <> 0 THEN o_orderdate + INTERVAL '1' HOUR * CAST(o_orderkey % 100 AS INT) END AS visit_end_datetime",
            "o_orderstatus AS discharge_to_source_value",
        ),
        where="o_custkey % 9 <> 0",  # these people have events and insurance but no visit
    ),
    "visit_with_site": RoleSpec(
        "orders",
        (
            "o_orderkey AS visit_occurrence_id",
            "o_custkey AS person_id",
            "o_orderdate AS visit_start_datetime",
            "CASE WHEN o_orderkey % 50 <> 0 THEN o_orderdate + INTERVAL '1' HOUR * CAST(o_orderkey % 100 AS INT) END AS visit_end_datetime",
            "CASE WHEN o_orderkey % 17 <> 0 THEN CAST(o_orderkey % 22 AS BIGINT) END AS care_site_id",
        ),
        where="o_custkey % 9 <> 0",
    ),
    "payer_plan_period": RoleSpec(
        "orders",
        (
            "o_custkey AS person_id",
            "CAST(date_trunc('year', o_orderdate) AS DATE) AS payer_plan_period_start_date",
            "CAST(date_trunc('year', o_orderdate) AS DATE) + 364 AS payer_plan_period_end_date",
            "min(o_orderpriority) AS payer_source_value",
            "max(o_orderpriority) AS plan_source_value",
        ),
        where="o_orderstatus <> 'P'",  # pending orders carry no insurance period
        group_by=3,
    ),
    "care_site": RoleSpec(
        "nation",
        (
            "CAST(n_nationkey AS BIGINT) AS care_site_id",
            "n_name AS care_site_name",
            "CAST(n_regionkey AS STRING) AS place_of_service_source_value",
            "CAST(n_regionkey AS BIGINT) AS location_id",
        ),
    ),
    "location": RoleSpec(
        "region",
        (
            "CAST(r_regionkey AS BIGINT) AS location_id",
            "r_name AS state",
        ),
    ),
    "measurement": RoleSpec(
        "lineitem",
        (
            "l_orderkey AS visit_occurrence_id",
            "l_partkey AS measurement_concept_id",
            "l_returnflag AS measurement_source_value",
            "l_shipdate AS measurement_datetime",
            "l_extendedprice AS value_as_number",
            "l_linenumber",
            "l_suppkey",
        ),
    ),
    "condition_occurrence": RoleSpec(
        "lineitem",
        (
            "l.l_orderkey AS visit_occurrence_id",
            "l_partkey AS condition_concept_id",
            "l_shipdate AS condition_start_datetime",
            "CASE WHEN l_linenumber <> 7 THEN l_shipdate + INTERVAL '1' DAY * CAST(l_quantity AS INT) END AS condition_end_datetime",
            "CASE WHEN l_linenumber = 6 THEN concat(CAST(100 + l_suppkey % 10 AS STRING), '.0') "
            "ELSE concat(substr('ABCDEFGHIJ', CAST(l_partkey % 10 AS INT) + 1, 1), lpad(CAST(l_suppkey % 4 AS STRING), 2, '0'), '.', CAST(l_linenumber AS STRING)) END AS condition_source_value",
            "concat(l_returnflag, l_linestatus) AS condition_type_source_value",
            "l_linenumber AS condition_occurrence_seq",
            "o.o_custkey AS person_id",
        ),
        joins=(("orders", "o", "l.l_orderkey = o.o_orderkey"),),
        deal=True,
    ),
    "procedure_occurrence": RoleSpec(
        "lineitem",
        (
            "l.l_orderkey AS visit_occurrence_id",
            "l_partkey AS procedure_concept_id",
            "l_shipdate AS procedure_datetime",
            "l_linestatus AS procedure_source_value",
            "l_linenumber AS procedure_seq",
            "o.o_custkey AS person_id",
        ),
        joins=(("orders", "o", "l.l_orderkey = o.o_orderkey"),),
        deal=True,
    ),
    "drug_exposure": RoleSpec(
        "lineitem",
        (
            "l.l_orderkey AS visit_occurrence_id",
            "l_partkey AS drug_concept_id",
            "l_shipdate AS drug_exposure_start_datetime",
            "l_shipdate + INTERVAL '1' DAY * l_linenumber AS drug_exposure_end_datetime",
            "l_quantity AS quantity",
            "l_returnflag AS route_source_value",
            "CASE WHEN l_linenumber <> 3 THEN concat('generic ', CAST(l_partkey % 50 AS STRING)) END AS drug_generic_source_value_name",
            "l_linenumber AS drug_seq",
            "o.o_custkey AS person_id",
        ),
        joins=(("orders", "o", "l.l_orderkey = o.o_orderkey"),),
        deal=True,
    ),
    "observation": RoleSpec(
        "events",
        (
            "event_id AS observation_id",
            "user_id AS visit_occurrence_id",
            "event_type AS observation_source_value",
            "event_id % 150 + 1 AS observation_concept_id",
            "ts AS observation_datetime",
            "value AS value_as_number",
            "props AS value_as_string",
        ),
    ),
    "concept": RoleSpec(
        "part",
        (
            "p_partkey AS concept_id",
            "p_name AS concept_name",
            "p_type AS vocabulary_id",
            "p_brand AS concept_class_id",
            "CAST(p_size AS STRING) AS concept_code",
            "CASE WHEN p_size % 3 = 0 THEN 'Drug' WHEN p_size % 3 = 1 THEN 'Condition' ELSE 'Procedure' END AS domain_id",
        ),
    ),
    "diagnosis_extract": RoleSpec(
        "lineitem",
        (
            "l_orderkey AS visit_occurrence_id",
            "concat(l_returnflag, l_linestatus) AS chief_complaint",
            "CASE WHEN l_linenumber = 6 THEN concat(CAST(100 + l_suppkey % 10 AS STRING), '.0') "
            "ELSE concat(substr('ABCDEFGHIJ', CAST(l_partkey % 10 AS INT) + 1, 1), lpad(CAST(l_suppkey % 4 AS STRING), 2, '0'), '.', CAST(l_linenumber AS STRING)) END AS condition_source_value",
            "l_linenumber AS diagnosis_seq",
        ),
    ),
    "medications": RoleSpec(
        "lineitem",
        (
            "l_orderkey AS visit_occurrence_id",
            "l_partkey AS drug_concept_id",
            "l_linenumber AS medication_seq",
        ),
    ),
    "medication_classification": RoleSpec(
        "part",
        (
            "p_partkey AS drug_concept_id",
            "p_type AS ATC_1",
            "p_brand AS ATC_2",
            "CAST(p_size AS STRING) AS ATC_3",
            "p_name AS ATC_4",
        ),
    ),
    "lab_flag": RoleSpec(
        "events",
        (
            "event_id",
            "user_id AS visit_occurrence_id",
            "event_type AS substance",
            "CASE WHEN value > 20 THEN 'True' ELSE 'False' END AS is_positive",
        ),
    ),
    "targets": RoleSpec(
        "orders",
        (
            "o_orderkey AS visit_occurrence_id",
            "CASE WHEN o_orderstatus = 'F' THEN 'yes' ELSE 'no' END AS fulfilled",
            "CASE WHEN o_orderpriority = '1-URGENT' THEN 'yes' WHEN o_orderpriority = '5-LOW' THEN NULL ELSE 'no' END AS urgent",
            "o_orderdate AS recorded_at",
        ),
    ),
    "scores": RoleSpec(
        "labels",
        (
            "l.doc_id AS doc_id",
            "l.quality AS label",
            "CAST(d.n_chars % 1000 AS DOUBLE) / 1000 AS score",
        ),
        joins=(("documents", "d", "l.doc_id = d.doc_id"),),
    ),
}


def table_path(sf_dir: str, table: str) -> str:
    return os.path.join(sf_dir, f"{table}.parquet")


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, table))


def role(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Spark DataFrame for one role view."""
    spec = ROLES[name]
    if spec.joins:
        # Aliased base table joined to its partners on the given condition.
        alias = spec.exprs[0].split(".")[0]
        df = read_table(spark, sf_dir, spec.source).alias(alias)
        # The files are many for a large table, whatever the session's number of partitions.
        n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), DEALS_A_SPLIT * df.rdd.getNumPartitions()) if spec.deal else 0
        for table, other, cond in spec.joins:
            partner = read_table(spark, sf_dir, table).alias(other)
            if spec.deal:
                ours, theirs = cond.split(" = ")
                df, partner = dealt(df, ours, partitions=n), dealt(partner, theirs, partitions=n)
            df = df.join(partner, F.expr(cond), "inner")
        return df.selectExpr(*spec.exprs)
    df = read_table(spark, sf_dir, spec.source)
    if spec.where:
        df = df.where(spec.where)
    if spec.group_by:
        keys = [F.expr(e) for e in spec.exprs[: spec.group_by]]
        aggs = [F.expr(e) for e in spec.exprs[spec.group_by:]]
        return df.groupBy(*keys).agg(*aggs)
    return df.selectExpr(*spec.exprs)


def role_sql(name: str) -> str:
    """SELECT text of one role view (DuckDB dialect = ANSI here)."""
    spec = ROLES[name]
    if spec.joins:
        alias = spec.exprs[0].split(".")[0]
        text = f"SELECT {', '.join(spec.exprs)} FROM {spec.source} {alias}"
        for table, other, cond in spec.joins:
            text += f" JOIN {table} {other} ON {cond}"
        return text
    text = f"SELECT {', '.join(spec.exprs)} FROM {spec.source}"
    if spec.where:
        text += f" WHERE {spec.where}"
    if spec.group_by:
        text += " GROUP BY " + ", ".join(str(i + 1) for i in range(spec.group_by))
    return text


def cte(*names: str) -> str:
    """``WITH`` clause defining the named role views for the oracle."""
    return "WITH " + ",\n".join(f"{n} AS ({role_sql(n)})" for n in names) + "\n"


class Roles:
    """Lazy accessor: ``Roles(spark, sf_dir).person`` etc."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in ROLES:
            return role(self.spark, self.sf_dir, name)
        raise AttributeError(name)

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)
