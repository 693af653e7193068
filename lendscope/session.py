"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "lendscope") -> SparkSession:
    """Return (or create) a session with the settings the operators assume.

    On a cluster the session normally already exists and this only fills in
    settings that are unset; locally it builds a ``local[*]`` session.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    elif not os.environ.get("SPARK_MASTER") and not SparkSession.getActiveSession():
        builder = builder.master("local[*]")
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("LENDSCOPE_DRIVER_MEMORY", "16g"),
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Uses ``spark.checkpoint.dir`` when the cluster names one.  Only a local
    session, whose tasks share one machine, gets a private scratch folder
    where it is unset; elsewhere a missing setting is an error, because other
    machines would not see the files.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="lendscope-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, its partitions
    fixed, and safe from the loss of an executor."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


ROWS_PER_TASK = 25_000
TASKS_PER_SLOT = 2


def right_size(df: DataFrame, n_rows: int | None = None) -> DataFrame:
    """Coalesce (no shuffle) to tasks of about ``ROWS_PER_TASK`` rows for
    iterative fits, where every iteration schedules a task per partition and
    sends each task's result to the driver.  Beyond ``TASKS_PER_SLOT`` tasks a
    slot the tasks grow with the rows and not their number, so neither does
    what reaches the driver.  It never raises the partition count."""
    n = df.count() if n_rows is None else n_rows
    most = TASKS_PER_SLOT * df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(min(max(1, -(-n // ROWS_PER_TASK)), most))
