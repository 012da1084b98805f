"""Scans and sinks (IO1, IO2, IO4-IO12).

Scans are lazy ``spark.read`` calls: no count or preview runs at load time.
Sinks overwrite. Paths may be local, HDFS or object-store URIs; nothing walks
a folder on the driver's own file system.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType


def read_parquet_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """IO1: every parquet file of a folder as one table (columns by name).

    Only names ending in ``parquet`` are read, as in the reference; files with
    different column orders line up by name (D11). Without a ``schema`` the
    files' schemas are merged, so a column that only some files have is kept.
    """
    reader = spark.read.option("pathGlobFilter", "*parquet").option("mergeSchema", str(schema is None).lower())
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def describe_table(df: DataFrame) -> DataFrame:
    """IO2: one row with the row count and the column count (lazy)."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).withColumn(
        "column_count", F.lit(len(df.columns)).cast("bigint"))


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             header: bool = False, sep: str = ",", null_value: str = "") -> DataFrame:
    """IO4/IO11: CSV scan with a fixed schema (no inference pass over the data).

    ``null_value`` is the text that stands for null; with a marker such as
    ``\\N`` an empty string and a null stay distinct through a round trip.
    """
    reader = (spark.read.option("header", header).option("sep", sep).option("mode", "PERMISSIVE")
              .option("nullValue", null_value).option("emptyValue", ""))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def load_targets(df: DataFrame, key: str, order_by: str, positive: str = "yes",
                 columns: Sequence[str] | None = None) -> DataFrame:
    """IO5: per key and column the first non-null value in ``order_by`` order; yes -> 1 else 0.

    One ``groupBy`` with ``min_by`` over the non-null values (a FILTER
    clause), so duplicates per key collapse in a single partially aggregated
    shuffle. Of rows with equal ``order_by`` the smallest value counts, so the
    result never depends on row order.
    """
    columns = list(columns) if columns is not None else [c for c in df.columns if c not in (key, order_by)]
    aggs = []
    for c in columns:
        first = F.expr(f"min_by(`{c}`, struct(`{order_by}`, `{c}`)) FILTER (WHERE `{c}` IS NOT NULL)")
        aggs.append(F.when(first == F.lit(positive), 1).otherwise(0).cast("int").alias(c))
    return df.groupBy(key).agg(*aggs)


def parse_fixed_width_codes(lines: DataFrame, text_col: str = "value") -> DataFrame:
    """IO6/M12: code = characters 7-14 with a dot after the third (always), text = 17-77."""
    raw = F.trim(F.substring(F.col(text_col), 7, 8))
    code = F.concat(F.substring(raw, 1, 3), F.lit("."), F.substring(raw, 4, 8))
    return lines.select(code.alias("code"), F.trim(F.substring(F.col(text_col), 17, 61)).alias("description"))


def load_fixed_width_codes(spark: SparkSession, path: str) -> DataFrame:
    """IO6: fixed-width code file scan."""
    return parse_fixed_width_codes(spark.read.text(path))


def uri_tail(column: str) -> F.Column:
    """IO7/M12: last '/'-separated segment of a URI."""
    return F.substring_index(F.col(column), "/", -1)


def load_class_codes(df: DataFrame, uri_col: str = "Class ID", label_col: str = "Preferred Label") -> DataFrame:
    """IO7: class dictionary -> (code, label)."""
    return df.select(uri_tail(uri_col).alias("code"), F.col(label_col).alias("label"))


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> None:
    """IO8/IO10: parquet sink, overwrite."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def arrays_as_text(df: DataFrame) -> DataFrame:
    """M9: every array/map/struct column as its text form (CSV rejects them)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (ArrayType, MapType, StructType)):
            cols.append(F.col(f.name).cast("string").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def write_csv(df: DataFrame, path: str, header: bool = True, null_value: str = "") -> None:
    """IO9: CSV sink with header; nested columns written as text; nulls as ``null_value``."""
    (arrays_as_text(df).write.mode("overwrite").option("header", header).option("nullValue", null_value)
     .option("emptyValue", '""').csv(path))


def write_json(df: DataFrame, path: str) -> None:
    """IO11: JSON-lines report sink."""
    df.write.mode("overwrite").json(path)


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)
