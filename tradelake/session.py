"""Session construction and shared scratch locations.

Scratch data (sink round trips, lineage cuts) always lives under the
cluster's ``spark.checkpoint.dir`` so that every executor can see it.  A
private directory is only created when that setting is absent (local runs
and tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app_name: str = "tradelake",
                shuffle_partitions: int | None = None,
                extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def parallelism(spark: SparkSession) -> int:
    """Task slots of the session (shuffle partitions where the context is
    not reachable, e.g. a remote session)."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001
        return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only when the session names none and runs in local mode (local runs,
    tests) is a private directory created and registered, so later
    ``checkpoint()`` calls and scratch writes agree on one location.  On a
    cluster an unset folder is an error: a machine-local one would not be
    visible to other executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # noqa: BLE001 - no context in a remote session
            root = None
    if not root:
        master = spark.conf.get("spark.master", "") or ""
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a folder every executor can reach "
                "(e.g. on the cluster's shared file system) before running tradelake jobs")
        root = tempfile.mkdtemp(prefix="tradelake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
        try:
            spark.sparkContext.setCheckpointDir(root)
        except Exception:  # noqa: BLE001
            pass
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path below the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/tradelake-scratch/{name}-{uuid.uuid4().hex[:12]}"
