"""Session settings and the shared scratch folder.

Library operators never build a session; callers pass one in. ``build_session``
is for tests, bench and scripts. On a cluster the session comes configured,
and ``shared_dir`` uses the folder the cluster names in
``spark.checkpoint.dir`` so every executor sees the same files.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session needs for stable results: UTC days and hours, and
# adaptive execution (coalescing, skew-join splitting, runtime broadcast).
# Streaming state (dedup keys, open windows) lives in RocksDB: off the JVM
# heap, with incremental changelog checkpoints to the shared folder.
BASE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # delete reliable checkpoints once nothing references them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app: str = "basketry",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder from ``spark.checkpoint.dir``. Local sessions that
    name none get a private temp folder, removed at exit; a cluster must name
    one that all its executors see."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d.rstrip("/")
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="basketry-ckpt-")
        atexit.register(shutil.rmtree, d, ignore_errors=True)
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir().rstrip("/")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/basketry/{name}-{uuid.uuid4().hex[:12]}"
