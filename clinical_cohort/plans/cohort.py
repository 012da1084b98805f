"""End-to-end cohort jobs.

``demographic_pull`` joins people, visits, insurance periods, care sites
and locations into one cohort frame at visit or person grain, computes age
and length of stay and applies the cohort filters. ``measurement_pull``
lives in ``operators.measures``; ``cohort_combined`` left-joins the two on
the visit id (the reference's demographics + vitals workflow).

Each function returns ``(main, sample)``: the sample is the deterministic
bottom-k of the *unfiltered* frame (X2), or the whole frame for n = 0.
Nothing is counted or collected; the frames stay lazy until written.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import age_at, age_current, visit_length
from ..operators.filters import CohortFilter, apply_cohort_filters
from ..operators.joins import full_outer_join, interval_join, latest_per_key
from ..operators.measures import measurement_pull
from ..operators.sampling import comparison_sample
from ..sources.catalog import OMOP_USED_COLUMNS, schema_for
from ..sources.files import read_parquet_table, write_table

GRAINS = ("visit_occurrence_id", "person_id")

PERSON_COLUMNS = OMOP_USED_COLUMNS["person"]
VISIT_COLUMNS = OMOP_USED_COLUMNS["visit_occurrence"]
PAYER_COLUMNS = OMOP_USED_COLUMNS["payer_plan_period"]
SITE_COLUMNS = OMOP_USED_COLUMNS["care_site"]
LOCATION_COLUMNS = OMOP_USED_COLUMNS["location"]


def _present(df: DataFrame, wanted: Sequence[str], key: str) -> DataFrame:
    """The wanted columns that a dimension table has; its key must be there."""
    return df.select(key, *[c for c in wanted if c != key and c in df.columns])


@dataclass
class CohortTables:
    """The five inputs of a demographic pull, under their OMOP column names; extra columns are not read."""

    person: DataFrame
    visit_occurrence: DataFrame
    payer_plan_period: DataFrame
    care_site: DataFrame
    location: DataFrame

    @classmethod
    def from_folder(cls, spark, base: str, optional: Sequence[str] = ()) -> CohortTables:
        """IO1 for each OMOP table folder under ``base``; an ``optional`` one that is not there is an empty table."""
        def read(name: str) -> DataFrame:
            try:
                return read_parquet_table(spark, f"{base}/{name}")
            except AnalysisException as e:
                if name not in optional or e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                    raise
                return spark.createDataFrame([], schema_for(name))
        return cls(*(read(name) for name in ("person", "visit_occurrence", "payer_plan_period", "care_site", "location")))


def _visits(t: CohortTables, more: Sequence[str] = ()) -> DataFrame:
    v = t.visit_occurrence.select(*VISIT_COLUMNS, *more)
    return v.withColumn("visit_length", visit_length("visit_start_datetime", "visit_end_datetime"))


def _with_dimension(main: DataFrame, dimension: DataFrame, key: str, how: str, key_source: DataFrame) -> DataFrame:
    """A look-up of ``key``; ``how='full'`` also keeps the dimension's rows that no row of ``main`` names."""
    if how == "left":
        return main.join(dimension, key, "left")
    return full_outer_join(main, dimension, key, key_source=key_source)


def _sites_and_locations(main: DataFrame, tables: CohortTables, site_from: str, how: str, visits: DataFrame, person: DataFrame,
                         site_columns: Sequence[str], location_columns: Sequence[str]) -> DataFrame:
    """Care site, then location: the person's own, or those of the visit's site.

    Later steps only add rows with null site and location, so the non-null
    ids of ``main`` are those of the table that they come from: orphan sites
    and locations are found against that table instead of computing ``main``
    again for its key set. A care site has a location of its own, which is not
    the person's.
    """
    location = _present(tables.location, location_columns, "location_id")
    if site_from == "person":
        site = _present(tables.care_site, site_columns, "care_site_id")
        main = _with_dimension(main, site, "care_site_id", how, person)
        return _with_dimension(main, location, "location_id", how, person)
    site = _present(tables.care_site, [*site_columns, "location_id"], "care_site_id")
    main = _with_dimension(main, site, "care_site_id", how, visits)
    return _with_dimension(main, location, "location_id", how, site)


def demographic_pull(
    tables: CohortTables,
    group_value: str = "visit_occurrence_id",
    filters: CohortFilter | None = None,
    rand_sample_size: int = 0,
    as_of: dt.date | str = "2024-01-01",
    seed: int = 42,
    strict_end: bool = False,
    site_columns: Sequence[str] = SITE_COLUMNS,
    location_columns: Sequence[str] = LOCATION_COLUMNS,
    how: str = "full",
    site_from: str = "person",
    one_row_per_person: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """The demographic cohort at visit or person grain.

    Visit grain: one row per visit x payer (payer periods that contain the
    visit, J2), age at the visit (D1). Person grain: the person's latest
    payer period(s) (J3, ties kept, D2), current age or age at death as of
    ``as_of`` (D15), repeated for each visit; with ``one_row_per_person``
    (D14) the visits are reduced to their number, first and last start and
    total length, and of tied payer periods the smallest payer and plan stay.

    Care site and location are looked up from the person, or with
    ``site_from='visit'`` from the visit's care site and that site's location
    (D17). ``how='full'`` keeps sites and locations that nobody names (D16),
    ``how='left'`` does not.
    """
    if group_value not in GRAINS:
        raise ValueError(f"group_value must be one of {GRAINS}, got {group_value!r}")
    if how not in ("full", "left") or site_from not in ("person", "visit"):
        raise ValueError(f"how must be 'full' or 'left' and site_from 'person' or 'visit', got {how!r} and {site_from!r}")
    if one_row_per_person and (group_value != "person_id" or site_from != "person"):
        raise ValueError("one row per person needs the person grain and the person's own site")
    of_visit = site_from == "visit"
    visits = _visits(tables, ["care_site_id"] if of_visit else [])
    person = tables.person.select(*[c for c in PERSON_COLUMNS if not (of_visit and c in ("care_site_id", "location_id"))])
    payer = tables.payer_plan_period.select(*PAYER_COLUMNS)

    if one_row_per_person:
        # One partially aggregated shuffle of the visits; no row of a visit goes on.
        summed = visits.groupBy("person_id").agg(
            F.count(F.lit(1)).alias("n_visits"), F.min("visit_start_datetime").alias("first_visit_start"),
            F.max("visit_start_datetime").alias("last_visit_start"), F.sum("visit_length").alias("total_visit_length"))
        main = full_outer_join(person, summed, "person_id").withColumn("n_visits", F.coalesce("n_visits", F.lit(0).cast("bigint")))
        main = main.withColumn("age", age_current("birth_datetime", "death_datetime", as_of))
        latest = latest_per_key(payer, "person_id", "payer_plan_period_start_date").groupBy("person_id").agg(
            F.min(F.struct("payer_source_value", "plan_source_value")).alias("p"))
        insurance = latest.select("person_id", "p.payer_source_value", "p.plan_source_value")
        people = person.select("person_id").unionByName(visits.select("person_id"))
        main = full_outer_join(main, insurance, "person_id", key_source=people)
        main = main.withColumn("n_visits", F.coalesce("n_visits", F.lit(0).cast("bigint")))
        ordered = ["person_id", "birth_datetime", "death_datetime", "gender_source_value", "race_source_value",
                   "ethnicity_source_value", "age", "n_visits", "first_visit_start", "last_visit_start", "total_visit_length",
                   "payer_source_value", "plan_source_value"]
    else:
        # People with their visits (J1). Orphan people (no visit) are kept.
        main = full_outer_join(visits, person, "person_id")
        ordered = ["visit_occurrence_id", "person_id", "birth_datetime", "death_datetime", "gender_source_value",
                   "race_source_value", "ethnicity_source_value", "age", "visit_start_datetime",
                   "visit_end_datetime", "visit_length", "payer_source_value", "plan_source_value"]
    if group_value == "visit_occurrence_id":
        main = main.withColumn("age", age_at("visit_start_datetime", "birth_datetime"))
        insurance = (interval_join(visits.select("person_id", "visit_occurrence_id", "visit_start_datetime",
                                                 "visit_end_datetime"), payer, strict=strict_end)
                     .select("visit_occurrence_id", "payer_source_value", "plan_source_value")
                     .distinct())
        # Insurance rows come from visits, so every non-null visit id already
        # has its partner in ``main``; only null-id rows would be unmatched
        # under a full outer join. This keeps full-outer semantics without a
        # second shuffle of all visit ids.
        main = _left_by_visit(main, insurance).unionByName(
            insurance.where(F.col("visit_occurrence_id").isNull()), allowMissingColumns=True)
    elif not one_row_per_person:
        main = main.withColumn("age", age_current("birth_datetime", "death_datetime", as_of))
        insurance = (latest_per_key(payer, "person_id", "payer_plan_period_start_date")
                     .select("person_id", "payer_source_value", "plan_source_value"))
        # The people of ``main`` are those of the two tables; reading their
        # ids is cheaper than joining the tables again.
        people = person.select("person_id").unionByName(visits.select("person_id"))
        main = full_outer_join(main, insurance, "person_id", key_source=people)

    main = _sites_and_locations(main, tables, site_from, how, visits, person, site_columns, location_columns)
    rest = [c for c in main.columns if c not in ordered]
    main = main.select(*ordered, *rest)

    sample = comparison_sample(main, rand_sample_size, [group_value], seed, tiebreak=main.columns)
    return apply_cohort_filters(main, filters), sample


def _left_by_visit(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join on the visit id. People without a visit all carry a null id; they stay out of the join, where
    they would meet in one partition."""
    with_visit = left.where(F.col("visit_occurrence_id").isNotNull())
    no_visit = left.where(F.col("visit_occurrence_id").isNull())
    return with_visit.join(right, on="visit_occurrence_id", how="left").unionByName(no_visit, allowMissingColumns=True)


def cohort_combined(
    tables: CohortTables,
    measurement: DataFrame,
    concept: DataFrame | None,
    codes=None,
    concept_filter=None,
    filters: CohortFilter | None = None,
    rand_sample_size: int = 100,
    seed: int = 42,
) -> tuple[DataFrame, DataFrame]:
    """C4: demographics (visit grain) left-joined with the measurement pull.

    Grain: visit x payer x measurement; visits without measurements keep
    nulls. The comparison frame joins the two comparison samples the same
    way (as the reference's workflow does).
    """
    demo, demo_sample = demographic_pull(tables, "visit_occurrence_id", filters, rand_sample_size, seed=seed)
    vitals = measurement_pull(measurement, concept, codes, concept_filter)
    vitals_sample = comparison_sample(vitals, rand_sample_size,
                                      ["visit_occurrence_id", "measurement_source_value"], seed)
    return _left_by_visit(demo, vitals), _left_by_visit(demo_sample, vitals_sample)


def run_stage(frames: tuple[DataFrame, DataFrame], out_dir: str, name: str, comp_name: str) -> tuple[str, str]:
    """IO12/C3: persist a pull's main and comparison frames under fixed names."""
    main_path, comp_path = f"{out_dir}/{name}", f"{out_dir}/{comp_name}"
    write_table(frames[0], main_path)
    write_table(frames[1], comp_path)
    return main_path, comp_path
