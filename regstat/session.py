"""Session helpers: a local session for tests/bench and a shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


#: Settings of the flows, the same on the command line, in tests and in the bench.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.hugeMethodLimit": "8000",                     # what the JVM still compiles: wide projections stay fast
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cpus: str | int = "*", shuffle_partitions: int = 8, app: str = "regstat") -> SparkSession:
    """Session for tests and the bench; on a cluster use the session the job is given."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config(map=SETTINGS)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("REGSTAT_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Run a block with other SQL settings; the caller's come back afterwards."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: A job's shuffle files go when the job ends; else they stay until the driver happens to collect its garbage.
FREED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def wide(df: DataFrame) -> DataFrame:
    """``df``, in a session whose wide projections are cut into methods that the JVM compiles.

    By Spark's default, a register's projection becomes one method that the JVM only
    interprets, several times slower.  A frame is planned again when it runs, so
    the setting stays with the session; a lower limit of the caller's stays too.
    """
    conf, name = df.sparkSession.conf, "spark.sql.codegen.hugeMethodLimit"
    if int(conf.get(name)) > int(SETTINGS[name]):
        conf.set(name, SETTINGS[name])
    return df


#: Tasks a core that :func:`spread` deals rows to: cores that are done early take another.
TASKS_A_CORE = 3


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt over tasks for all cores, by its values, so a retried task has the same rows.

    A Parquet scan has at most one busy task a row group, and the work done row by row on
    top of it runs there: few row groups leave most cores idle.  Meant for rows that are still narrow.
    """
    return df.repartition(TASKS_A_CORE * df.sparkSession.sparkContext.defaultParallelism, *df.columns)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only in local mode may the session name none: a private one is then made
    and registered.  On a cluster a folder of the driver's machine is out of
    the executors' sight, so a missing setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root and not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not root:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="regstat-ckpt-"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/scratch/{name}-{uuid.uuid4().hex}"
