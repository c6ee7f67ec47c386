"""Session helpers: a configured builder and the shared folder for pinned data.

Intermediate results that must be stable across re-evaluation (a sampled
range sort, a fact table read twice) are written under the folder the
cluster names in ``spark.checkpoint.dir``. That folder is read from the
session and is never made up here: tests, the bench and the driver's entry
point name one of their own where the session has none.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

_SCALE_CONF = {
    # Runtime re-planning: coalesce small shuffle partitions, split skewed
    # join partitions, and switch joins to broadcast only once the runtime
    # size of a side is known to be small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(
    master: str = "local[*]",
    shuffle_partitions: int = 8,
    app_name: str = "stockrisk",
    extra: dict | None = None,
) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(_SCALE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; an error where the session names none."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder wherever Spark's own file systems keep it."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh location for a table written under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/tables/{name}-{uuid.uuid4().hex}"
