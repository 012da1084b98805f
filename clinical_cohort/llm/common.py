"""Helpers shared by the text operators: column access, let-bindings, scratch tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinical_cohort.session import scratch_path

#: Fixed value: the white space that separates words, as code points.
SPACE = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]+"

#: Columns of the `documents` table.
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    A plain Column used twice inside a higher-order function is evaluated for
    every element; a lambda variable is not.
    """
    return F.transform(F.array(value), body).getItem(0)


def words(text: Column) -> Column:
    """Words between white space; null and blank texts give an empty array."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return let(trimmed, lambda t: F.when(t == "", F.array().cast("array<string>"))
               .otherwise(F.split(t, SPACE_CLASS)))


#: Bytes that a writer of `saved` holds before it flushes them.
ROW_GROUP = 32 << 20


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    The rows then survive the loss of an executor and the lineage is cut.
    """
    path = f"{scratch_path(df.sparkSession, name)}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").option("parquet.block.size", ROW_GROUP).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._saved_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove tables of `saved` that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table._saved_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def utf8(column) -> list[bytes | None]:
    """The UTF-8 bytes of an Arrow string column, row by row."""
    import pyarrow as pa
    return column.cast(pa.binary()).to_pylist()


def release() -> None:
    """Give memory that a worker no longer uses back to the system: workers wait idle beside the next stage's tasks."""
    import ctypes
    import gc

    import pyarrow as pa
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library alone
    if trim is not None:
        trim(0)


#: Rows that a worker is sent and works on at a time.
MAP_ROWS = 1_000
_BATCH_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def slices(batch, rows: int = MAP_ROWS) -> list:
    return [batch.slice(a, rows) for a in range(0, batch.num_rows, rows)]


def map_rows(df: DataFrame, fn: Callable[[object], list], names_and_types: str, keep: list[str] | None = None) -> DataFrame:
    """Append columns that ``fn(batch)`` computes from each Arrow batch of ``df``.

    ``fn`` returns one Arrow array or list per appended column. ``keep`` names
    the input columns that stay (default: all). Only narrow work: no shuffle. It
    is given ``MAP_ROWS`` rows at a time at most, which bounds a worker's memory;
    the session's Arrow batches are made as small, for the executor's.
    """
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    conf = df.sparkSession.conf
    if not 0 < int(conf.get(_BATCH_KEY)) <= MAP_ROWS:
        conf.set(_BATCH_KEY, str(MAP_ROWS))
    keep = df.columns if keep is None else keep
    added = StructType.fromDDL(names_and_types)
    schema = StructType([df.schema[c] for c in keep] + added.fields)
    target = to_arrow_schema(added)

    def run(batches):
        for batch in (part for whole in batches for part in slices(whole)):
            new = [a if isinstance(a, (pa.Array, pa.ChunkedArray)) else pa.array(a, f.type)
                   for a, f in zip(fn(batch), target, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + new, names=schema.names)
            del batch, new
            release()

    return df.mapInArrow(run, schema)
