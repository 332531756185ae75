"""Session helpers: a tuned local session for tests/bench, and checkpoint-dir lookup."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "quarry") -> SparkSession:
    """Session for tests and the bench. On a cluster, use the cluster's own session."""
    master = master or os.environ.get("QUARRY_MASTER", "local[8]")
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("QUARRY_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory.

    The cluster names a shared folder in ``spark.checkpoint.dir``; we only pick our
    own when none is set and the master is local (tests). A cluster without one is
    a configuration error: a machine-local folder would not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="quarry-ckpt-", dir="/tmp"))
        return sc.getCheckpointDir()
    raise RuntimeError("set spark.checkpoint.dir to a shared (HDFS/S3/ABFS) folder")


_removed_at_exit: set[str] = set()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table or a stream's state, in the application's folder under the checkpoint
    directory. The folder is removed when the driver's Python ends; results that must outlive it are written elsewhere."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/quarry-{spark.sparkContext.applicationId}"
    if base not in _removed_at_exit:
        _removed_at_exit.add(base)
        target = spark._jvm.org.apache.hadoop.fs.Path(base)
        files = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        atexit.register(_remove, files, target)
    return f"{base}/{name}-{uuid.uuid4().hex}"


def _remove(files, target) -> None:
    try:
        files.delete(target, True)
    except Py4JError:  # the JVM has gone before us
        pass


def materialize(df, name: str):
    """Cut lineage by writing ``df`` as parquet under the checkpoint folder and reading it back.

    Same guarantee as a reliable checkpoint (survives executor loss, never recomputed or
    re-sampled), but columnar and compressed; AQE sees the exact size of what is read back.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"table-{name}")
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)
