"""Session construction and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "panelcast",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session with AQE (coalescing, skew join, runtime broadcast) switched on.

    On a cluster, leave ``master`` None and pass the cluster's own settings;
    ``shuffle_partitions`` should then be sized so one partition of the
    largest shuffle fits an executor core (~128-256 MB).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if master and master.startswith("local"):
        # One JVM holds driver and executors; the 1g default is too small.
        conf["spark.driver.memory"] = "8g"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Uses the cluster's ``spark.checkpoint.dir`` (or a checkpoint dir already
    set on the context). When neither is set, a local session (one process,
    as in tests) gets a fresh local folder; a cluster session raises, because
    its executors would each write to their own disk.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        cur = sc.getCheckpointDir()
        if cur:
            d = os.path.dirname(cur.rstrip("/"))
    one_process = sc.master.startswith("local") and not sc.master.startswith("local-cluster")
    if not d and not one_process:
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not d:
        d = tempfile.mkdtemp(prefix="panelcast-")
        sc.setCheckpointDir(d)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below the scratch folder."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder below the scratch folder that nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def materialize(df, name: str):
    """Write ``df`` once as parquet under the scratch folder and read it back.

    Used where several branches of a plan reuse one intermediate: the
    upstream plan runs once, lineage is cut (a lost executor does not
    recompute it), and the planner sizes the result from its files.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
