"""Table catalog (IO3): which tables hold a column, which columns a table has.

The catalog is read from the tables themselves (parquet footers: no data is
scanned) into a small DataFrame ``(table_name, ordinal, column_name, type)``,
so lookups are ordinary filters and joins. ``OMOP_USED_COLUMNS`` lists the
warehouse columns the operators read, typed by the naming rule below.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DataType, DateType, DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType, TimestampNTZType)

# Warehouse columns read by the cohort and measurement jobs.
OMOP_USED_COLUMNS: dict[str, tuple[str, ...]] = {
    "person": ("person_id", "birth_datetime", "death_datetime", "gender_source_value", "race_source_value",
               "ethnicity_source_value", "care_site_id", "location_id"),
    "visit_occurrence": ("person_id", "visit_occurrence_id", "visit_start_datetime", "visit_end_datetime"),
    "payer_plan_period": ("person_id", "payer_plan_period_start_date", "payer_plan_period_end_date",
                          "payer_source_value", "plan_source_value"),
    "care_site": ("care_site_id", "care_site_name", "care_site_source_value", "place_of_service_source_value"),
    "location": ("location_id", "address_1", "city", "state", "zip", "county", "country"),
    "measurement": ("visit_occurrence_id", "measurement_concept_id", "measurement_source_value",
                    "measurement_datetime", "value_as_number"),
    "concept": ("concept_id", "concept_name", "domain_id", "vocabulary_id", "concept_class_id", "concept_code"),
}

# Name rules for column types.
_DOUBLE_NAMES = {"value_as_number", "range_low", "range_high", "quantity", "amount_value", "numerator_value",
                 "denominator_value", "latitude", "longitude"}
_INT_NAMES = {"refills", "days_supply", "box_size", "year_of_birth", "month_of_birth", "day_of_birth",
              "min_levels_of_separation", "max_levels_of_separation"}
_STRING_IDS = {"domain_id", "vocabulary_id", "concept_class_id", "relationship_id", "specimen_source_id",
               "condition_occurrence_source_id", "procedure_source_id", "order_id", "mrn", "csn"}


def column_type(name: str) -> DataType:
    """Type of a warehouse column from its name."""
    if name.endswith("_datetime"):
        return TimestampNTZType()
    if name.endswith("_date"):
        return DateType()
    if name in _DOUBLE_NAMES:
        return DoubleType()
    if name in _INT_NAMES:
        return IntegerType()
    if name in _STRING_IDS:
        return StringType()
    if name.endswith(("_id", "_id_1", "_id_2")):
        return LongType()
    return StringType()


def schema_for(table: str, columns: Mapping[str, tuple[str, ...]] = OMOP_USED_COLUMNS) -> StructType:
    """StructType of a catalogued table (columns in catalog order)."""
    return StructType([StructField(c, column_type(c), True) for c in columns[table]])


def read_catalog(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """IO3: (table_name, ordinal, column_name, type) of live frames (schemas only)."""
    rows = [(t, i + 1, f.name, f.dataType.simpleString())
            for t, df in tables.items() for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "table_name string, ordinal int, column_name string, type string")


def tables_with_column(catalog: DataFrame, column: str) -> DataFrame:
    """Tables that have ``column`` -> (table_name)."""
    return catalog.where(F.col("column_name") == column).select("table_name").distinct()
