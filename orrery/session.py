"""Spark session helpers.

Cluster settings (shuffle partitions, checkpoint directory, AQE) belong to the
deployment; these helpers only fill in what is unset so local tests run the same
code as a cluster job.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on.  AQE re-plans joins and coalesces shuffle
# partitions at runtime; skew-join splits hot partitions.  UTC keeps epoch
# conversions identical to the SQL oracle.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8, app: str = "orrery") -> SparkSession:
    """Session for tests and the local bench (never used on a cluster)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if not SparkSession.getActiveSession():
        builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="orrery-ckpt-"))
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the deployment sets it to shared storage and it is used as is.
    Only where the driver is the whole cluster (a local master) and it is unset
    is a private folder made; elsewhere executors couldn't read one, so it is an
    error.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir is unset: name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="orrery-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediate tables."""
    return os.path.join(ensure_checkpoint_dir(spark), name)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and read
    it back: later consumers start from the written table (lineage cut), and a
    lost executor re-reads files instead of recomputing the whole plan."""
    spark = df.sparkSession
    path = scratch_path(spark, f"tables/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    remove_at_end(spark, path)
    return spark.read.parquet(path)


def remove_at_end(spark: SparkSession, path: str) -> None:
    """Have the folder deleted when the application ends: results are built
    lazily, so what they read can't go earlier."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
