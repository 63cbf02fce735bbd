"""Session helpers.

The library never overrides cluster settings.  ``build_session`` is for tests,
the bench and local runs; ``checkpoint_root`` reads ``spark.checkpoint.dir``
from the session; a local session without one gets a scratch folder.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app: str = "newsfeat", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and intermediate tables: the session's
    ``spark.checkpoint.dir``.  Only a local session (tests, the bench) without
    one gets a scratch folder; on a cluster that would be some machine's own
    disk, so there the setting is required.
    """
    conf = spark.conf.get(CHECKPOINT_CONF, None)
    if not conf:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
        conf = tempfile.mkdtemp(prefix="newsfeat-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, conf)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(conf)
    return conf


#: Paths handed out by ``scratch_path`` in this process.
_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = checkpoint_root(spark)
    path = os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")
    _SCRATCH.append(path)
    return path


def drop_scratch(spark: SparkSession) -> int:
    """Deletes the intermediate tables that this process has written so far and
    returns how many there were.  For the end of a job: frames made of these
    tables cannot be read afterwards."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    gone = 0
    while _SCRATCH:
        path = jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        gone += bool(path.getFileSystem(conf).delete(path, True))
    return gone
