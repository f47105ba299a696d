"""Session helpers: tuned local/cluster configuration and checkpoint folder."""

from __future__ import annotations

import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins/aggregates from runtime
# statistics (coalesces small shuffle partitions, splits skewed ones, turns a
# sort-merge join into a broadcast join only when the measured side is small).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "revlens", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    On a cluster pass the master of the cluster manager and size
    ``shuffle_partitions`` to input bytes / ~128 MB; AQE coalesces from there.
    """
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster names the folder; only when it is unset (local tests) a fresh
    scratch folder is created; on a cluster an unset folder is an error, since
    a folder of one machine is lost with it.  The value is also registered with
    the SparkContext so ``DataFrame.checkpoint()`` writes there.
    """
    sc = spark.sparkContext
    d = (spark.conf.get("spark.checkpoint.dir", None)
         or sc.getConf().get("spark.checkpoint.dir", None)
         or sc.getCheckpointDir())
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Shuffle files of a query go with its end; else those of all steps stay until the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
