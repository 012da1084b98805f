"""Registry of runnable queries and their DuckDB oracle SQL.

Each registered query takes ``(spark, sf_dir)``, reads the driver's tables
through the role views and returns a lazy DataFrame. The oracle is SQL over
the same tables (role views inlined as a WITH clause) that DuckDB runs to
check the result. Queries without an oracle (model fitting) get a rows-only
check. Computed columns carry the same alias on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(key: str, sql: str | None = None, digits: int | None = None):
    """Register a query and its SQL. With ``digits`` its DOUBLE columns are rounded, as the SQL rounds them:
    operators return full precision, only registered results are cut for comparison."""
    def deco(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key!r}")
        QUERIES[key] = fn if digits is None else lambda spark, sf_dir: _rounded(fn(spark, sf_dir), digits)
        if sql is not None:
            ORACLES[key] = sql
        return fn
    return deco


def _rounded(df: DataFrame, digits: int) -> DataFrame:
    return df.select(*[F.round(F.col(f"`{f.name}`"), digits).alias(f.name) if isinstance(f.dataType, DoubleType)
                       else F.col(f"`{f.name}`") for f in df.schema.fields])


def load_all() -> None:
    """Import every module that registers queries."""
    from . import reg_cohort, reg_features, reg_io, reg_models, reg_quality  # noqa: F401
