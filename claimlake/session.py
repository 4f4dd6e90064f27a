"""SparkSession construction and shared-folder helpers."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every job wants: adaptive execution (runtime re-plan, partition
# coalescing, skew-join splitting), Arrow transfer, UTC clock.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "claimlake",
                  shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Temporary checkpoint folders of local sessions that name none, by application id.
_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession, sub: str = "") -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    On a cluster this setting names shared storage and is used as given; unset, it is an
    error. Only a local master (one process, as in tests) gets a temporary folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^,]*(,\s*\d+)?\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        # The setting can't be changed in a running session, so the folder is remembered here.
        app = spark.conf.get("spark.app.id", "")
        if app not in _LOCAL_DIRS:
            _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="claimlake-ckpt-")
        base = _LOCAL_DIRS[app]
    try:
        spark.sparkContext.setCheckpointDir(base)
    except Exception:  # noqa: BLE001 - no SparkContext on a Spark Connect session
        pass
    return os.path.join(base, sub) if sub else base
