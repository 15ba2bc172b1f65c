"""Session construction and the few session settings the operators rely on."""

from __future__ import annotations

import atexit
import gc
import os
import shutil
import tempfile
import time
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job wants.  Time zone matters for semantics: event times on the
# wire are UTC and `to_date` uses the session zone.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Only settable before the JVM starts.
_STATIC_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "lakecart", master: str | None = None, shuffle_partitions: int | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**_STATIC_DEFAULTS, **SESSION_DEFAULTS}
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators need (idempotent)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


# A write's shuffle files go when it has ended, not when the driver happens to collect its garbage.
FREE_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def session_settings(spark: SparkSession, settings: dict[str, str]):
    """Runtime settings for the writes that run, and the streams that start, inside; streams keep them for the writes of
    their batches."""
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def free_unreferenced(spark: SparkSession) -> None:
    """Have Spark remove the shuffle files and state of ended streams.  It does so when the driver collects its garbage,
    and a driver that holds no rows seldom has any."""
    for _ in range(2):                                # what the first pass lets go of, the second finds
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


_LOCAL_SHARED: dict[tuple, str] = {}


def session_key(spark: SparkSession) -> tuple:
    """Identity of a running session for per-session caches (object ids alone can be reused)."""
    return (spark.conf.get("spark.app.id", ""), id(spark))


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``) for checkpoints and work tables.

    On a cluster this is always taken from the session.  Only when the setting is
    absent, a local master gets a private temporary folder, made once per session,
    registered as the checkpoint directory and removed when Python ends; any other
    master raises, because executors would not see the driver's folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if d:
        return d.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    key = session_key(spark)
    if key not in _LOCAL_SHARED:
        local = tempfile.mkdtemp(prefix="lakecart-shared-")
        spark.sparkContext.setCheckpointDir(os.path.join(local, "rdd-checkpoints"))
        _LOCAL_SHARED[key] = local
        atexit.register(shutil.rmtree, local, ignore_errors=True)
    return _LOCAL_SHARED[key]


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared folder for one run of a job (never reused)."""
    return f"{shared_dir(spark)}/lakecart-runs/{name}-{uuid.uuid4().hex[:12]}"
