"""Spark session factory and session-level helpers.

Every operator in the package is a DataFrame -> DataFrame function and never
creates a session itself; this module only gives scripts, tests and the bench
one place to build a session with the settings the operators assume:

* ANSI mode on (Spark 4 default) and UTC session time zone;
* timestamps without time zone (the warehouse stores wall-clock times);
* adaptive execution with partition coalescing and skew-join splitting;
* the proleptic-calendar rebase settings for old parquet files;
* a checkpoint directory of its own only on a local master that has none set.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings applied to every session built here (a cluster's own
# spark-defaults win for anything not listed).
DEFAULT_CONF: dict[str, str] = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.datetimeRebaseModeInRead": "CORRECTED",
    "spark.sql.parquet.datetimeRebaseModeInWrite": "CORRECTED",
    "spark.sql.parquet.int96RebaseModeInRead": "CORRECTED",
    "spark.sql.parquet.int96RebaseModeInWrite": "CORRECTED",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(
    app_name: str = "clinical_cohort",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    ``master`` is only set when given, so on a cluster the submit command
    decides. ``conf`` overrides the defaults key by key.
    """
    builder = SparkSession.builder.appName(app_name)
    settings = dict(DEFAULT_CONF)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # Local mode runs every task inside the driver JVM.
            settings["spark.driver.memory"] = "8g"
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint directory.

    A cluster names a shared folder in ``spark.checkpoint.dir``, which is used
    as is. Where nothing is set, a local master gets a folder of its own; on a
    cluster a folder of the driver's machine would be invisible to executors,
    so that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="cc-checkpoint-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name)


def materialize(df):
    """Reliable checkpoint of ``df`` into the session's checkpoint folder.

    Used where one intermediate feeds several consumers (so it is computed
    once) and to cut long lineage; never a machine-local checkpoint.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df):
    """``df`` written once as parquet under the checkpoint folder, and read back.

    As ``materialize``, for long rows of few distinct values: their columns
    compress, where a checkpoint keeps whole rows. The layout is that of the files.
    """
    path = scratch_path(df.sparkSession, f"written-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
