"""Session helpers: one place for the configuration the jobs rely on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app: str = "callcorpus", shuffle_partitions: int | None = None) -> SparkSession:
    """Return the active session, or build a local one for tests and benchmarks.

    On a cluster the session already exists (spark-submit); we only read it.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", os.environ.get("CALLCORPUS_TZ", "UTC"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("CALLCORPUS_DRIVER_MEMORY", "16g"))
    )
    if os.environ.get("CALLCORPUS_ANSI") is not None:  # test knob: run under either SQL mode
        builder = builder.config("spark.sql.ansi.enabled", os.environ["CALLCORPUS_ANSI"])
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory named by the cluster.

    The cluster's ``spark.checkpoint.dir`` (a shared folder) wins. Only when it is
    unset -- local tests and benchmarks -- do we set a fresh private one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # no SparkContext handle (e.g. Spark Connect): the server's setting applies
        return configured or ""
    current = sc.getCheckpointDir() or configured
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not (sc.master or "").startswith("local"):
        # a machine-local folder is not reachable from other executors: refuse
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/ABFS...) for positional operators")
    local = tempfile.mkdtemp(prefix="callcorpus-ckpt-")  # local mode (tests, benchmarks) only
    sc.setCheckpointDir(local)
    return local
