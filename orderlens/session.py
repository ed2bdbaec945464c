"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Runtime SQL settings every plan in this package is written for.  A skewed join is
# split even when that costs one more exchange: a hot order or product would
# otherwise keep a third of the rows in one task.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

_cleaned: set[str] = set()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "orderlens", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or reuse) a session with the package settings; extra conf keys use '__' for '.'."""
    builder = SparkSession.builder.appName(app_name)
    # Python call sites of every column expression are only useful for debugging.
    builder = builder.config("spark.python.sql.dataFrameDebugging.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_SETTINGS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach.

    In this order: the setting ``spark.checkpoint.dir``, the folder given to
    ``SparkContext.setCheckpointDir``; on a local master, where all executors share its disk, a
    part of the session's table storage.  A cluster without either setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} reach")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` and the tree learners' own checkpoints usable."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def scratch_root(spark: SparkSession) -> str:
    """This application's part of the shared folder; it is dropped when the driver ends."""
    root = f"{shared_folder(spark)}/orderlens/{spark.sparkContext.applicationId}"
    if root not in _cleaned:
        _cleaned.add(root)
        atexit.register(drop_scratch, spark)
    return root


def drop_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote to the shared folder; a stopped session is left alone."""
    jvm, context = spark._jvm, spark.sparkContext._jsc
    if jvm is None or context is None or context.sc().isStopped():
        return
    path = jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(context.hadoopConfiguration()).delete(path, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below this application's part of the shared folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Drop a folder that nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a parquet table in the shared folder and read it back.

    Cuts the lineage, survives the loss of executors, and keeps column pruning
    and filter pushdown for whatever reads it next.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_table(spark: SparkSession, rows: Sequence, schema: str | T.StructType) -> DataFrame:
    """A few driver-held rows (scores, settings, a checked small lookup) as a DataFrame.

    The rows travel as one literal, so no Python worker has to start for them.
    """
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    text = json.dumps([dict(zip(fields.names, row)) for row in rows])
    parsed = F.from_json(F.lit(text), T.ArrayType(fields), {"mode": "FAILFAST"})
    return spark.range(1).select(F.inline(parsed))
