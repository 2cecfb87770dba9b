"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile
from functools import cache

from pyspark.sql import SparkSession

# Every value may be overridden by spark-submit; on a cluster the partition
# counts come from the deployment and AQE coalesces from there.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # call sites are captured for every column operation otherwise, which takes
    # half of all calls to the JVM while the longer expressions are built
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "newsloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for checkpoints and staged tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session
    without that setting gets a folder made for it, one per application.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    return _local_dir(spark.sparkContext.applicationId)


@cache
def _local_dir(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"newsloom-{application}-")
