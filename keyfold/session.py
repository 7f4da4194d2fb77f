"""Session construction and the shared folder used for lineage cuts and state."""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import SparkSession

# Settings every session of the library wants.  Shuffle partitions are sized by
# the caller: ~2-3x the executor cores, so a 1000-executor cluster sets it high
# and AQE coalesces small ones away.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # transformWithState needs the RocksDB state store.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "keyfold", extra: dict | None = None) -> SparkSession:
    """Return a session with the library defaults.

    On a cluster ``master`` stays ``None`` so the submit settings win; tests and
    the bench pass ``local[N]``.  Size ``shuffle_partitions`` to ~2-3x the
    executor cores (AQE coalesces small partitions and splits skewed joins)
    and keep ``spark.sql.files.maxPartitionBytes`` at its 128 MB default or
    lower, so every task's input fits in executor memory.
    """
    conf = dict(_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    # an already running session keeps its static settings; runtime ones apply
    for k, v in conf.items():
        if spark.conf.get(k, None) != v:
            try:
                spark.conf.set(k, v)
            except Exception:  # noqa: BLE001 - static conf of a running session
                pass
    return spark


def ensure_stream_conf(spark: SparkSession) -> None:
    """Settings streaming operators rely on, applied to an existing session."""
    for k in ("spark.sql.session.timeZone",
              "spark.sql.streaming.stateStore.providerClass"):
        if spark.conf.get(k, None) != _DEFAULTS[k]:
            spark.conf.set(k, _DEFAULTS[k])


def shared_dir(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A folder under the cluster's shared checkpoint dir.

    The cluster names it in ``spark.checkpoint.dir`` (a static setting, read
    here, never written); else the SparkContext's checkpoint dir is used.  When
    neither is set a local master gets a folder under the working directory,
    registered with ``setCheckpointDir``; a cluster gets an error, as its
    executors would each write to a disk of their own.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root and not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not root:
        sc.setCheckpointDir(os.path.abspath(os.path.join(os.getcwd(), "spark-checkpoints")))
        root = sc.getCheckpointDir()
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    tail = list(parts)
    if unique:
        tail.append(uuid.uuid4().hex[:12])
    return "/".join([root.rstrip("/")] + tail)


def pickle_by_value(module_name: str) -> None:
    """Ship a module's task code inside the pickled functions.

    ``mapInPandas`` / ``transformWithStateInPandas`` functions and processor
    classes are otherwise pickled by reference, and every Python worker --
    including the driver-side runner that sets up transformWithState -- would
    have to import this package.  By value they only need pyspark, pandas
    and numpy.
    """
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[module_name])
