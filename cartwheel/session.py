"""Session construction and the shared scratch area.

All intermediate tables the library writes (landed batches, snapshots,
materialised fixtures, checkpoints) live under the cluster's
``spark.checkpoint.dir``. A default is set only when the session has none,
which is the local/test case.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "cartwheel",
    driver_memory: str | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """The session with the library's defaults (UTC, ANSI, AQE, UI off).

    Inside a cluster application (a session exists already, or the driver
    was started by ``spark-submit``) only those defaults are applied: the
    shuffle width and executor sizing stay the cluster's, and AQE coalesces
    small shuffle partitions at run time. ``master``, ``shuffle_partitions``
    and ``driver_memory`` are for local runs and tests; without a master a
    local session over all cores is started.
    """
    builder = SparkSession.builder.appName(app_name)
    running = SparkSession.getActiveSession() is not None
    if master:
        builder = builder.master(master)
    elif not running and "PYSPARK_GATEWAY_PORT" not in os.environ:
        # no session and no JVM launched by spark-submit: a plain local run
        builder = builder.master("local[*]")
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if driver_memory:
        conf["spark.driver.memory"] = driver_memory
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and written intermediate tables.

    Uses the session's checkpoint directory (``spark.checkpoint.dir`` or one
    set with ``setCheckpointDir``). Without one a local folder is created if
    the master is local (tests, single-machine runs); on a cluster that is an
    error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder that all executors share: "
                "a folder of this machine would be lost with it"
            )
        configured = tempfile.mkdtemp(prefix="cartwheel-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path below the checkpoint root; ``unique`` appends a fresh id."""
    root = checkpoint_root(spark).rstrip("/")
    tail = list(parts) + ([uuid.uuid4().hex[:12]] if unique else [])
    return "/".join([root, "cartwheel", *tail])


def hadoop_fs(spark: SparkSession, path: str):
    """The Hadoop FileSystem for ``path`` (works for file:, hdfs:, s3a: ...)."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = hadoop_fs(spark, path)
    return bool(fs.exists(jpath))


def list_dir(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries directly below ``path`` (driver-side metadata only)."""
    fs, jpath = hadoop_fs(spark, path)
    if not fs.exists(jpath):
        return []
    return [st.getPath().getName() for st in fs.listStatus(jpath)]
