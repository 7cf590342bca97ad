"""Session helpers shared by every workload."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: str | int = "*", app: str = "tastegrid", **conf) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own session."""
    # one BLAS thread per Python worker: the tasks already fill the cores
    for name in ("OPENBLAS_NUM_THREADS", "OMP_NUM_THREADS", "MKL_NUM_THREADS"):
        os.environ.setdefault(name, "1")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TASTEGRID_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the folder the cluster names; fall back to a scratch folder only where none is named."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="tastegrid-ckpt-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to reliable storage and cut its lineage.

    Needed where a later step must see the very same rows in the very same partitions, or where an
    iteration would otherwise replay every earlier round after an executor loss.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str, *folders: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: like ``settle``, for columns that compress well, or by ``folders``."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    (df.write.partitionBy(*folders) if folders else df.write).parquet(path)
    return df.sparkSession.read.parquet(path)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give CPU-heavy work on a small table a task per core.

    A table of a few files arrives in a few tasks; only then is it repartitioned (by a unique key, so a
    replay gives the same layout). A table with at least as many splits as cores is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def gathered(df: DataFrame, rows: int) -> DataFrame:
    """A settled table in tasks of at least about ``rows`` rows, for work that costs much to begin; a task per core at least."""
    cores, parts = df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions()
    return df.coalesce(max(cores, -(-df.count() // rows))) if parts > cores else df
