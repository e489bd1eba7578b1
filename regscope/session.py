"""Spark session settings shared by tests, the bench and the driver entry.

Everything here is plain configuration: UTC session time zone (dates are ISO
text and elapsed-day arithmetic must not depend on the host zone), AQE with
partition coalescing and skew-join splitting, no UI.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the reports rely on; applied to a session we build and, where they
# are runtime-settable, to a session handed to us.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # the only broadcasts are those Spark proves smaller than this: from file
    # statistics at plan time, from actual shuffle sizes under AQE at run time
    "spark.sql.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    # strict date/time parsing: an impossible date is invalid, never rolled over
    "spark.sql.legacy.timeParserPolicy": "CORRECTED",
}


# Of these, what results depend on.
RESULT_CONF = ("spark.sql.session.timeZone", "spark.sql.legacy.timeParserPolicy")


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "regscope", extra_conf: dict | None = None) -> SparkSession:
    """Build (or join) the session. ``master`` and the shuffle partition count
    are set only when given — under ``spark-submit`` the cluster's settings
    stay in force; a plain ``python`` run defaults to ``local[*]``."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # local mode: the driver is the whole cluster
            builder = builder.config("spark.driver.memory", os.environ.get("REGSCOPE_DRIVER_MEMORY", "16g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**RUNTIME_CONF, **(extra_conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Set on a session handed to us what results depend on, and nothing else:
    its join and partition settings stay its owner's."""
    for k in RESULT_CONF:
        spark.conf.set(k, RUNTIME_CONF[k])
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder is configured by the cluster (a shared file
    system); only when nothing is configured (local tests) do we pick a
    scratch folder of our own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="regscope-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
