"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

# Settings that results (the time zone) or speed depend on in any session. A
# JVM does not compile methods above 8000 bytes of code; wide projections such
# as the flat document exceed that as one method, and run several times faster
# operator by operator.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# State of streaming queries, set wherever one starts.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Settings of sessions the engine opens itself. Sizes are left to the cluster;
# AQE merges or splits shuffle partitions at run time.
SESSION_CONF = {
    **RUNTIME_CONF,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    **STATE_CONF,
}


def build_session(
    app_name: str = "wattspan",
    master: str | None = None,
    conf: Mapping[str, str] | None = None,
) -> SparkSession:
    """Open a session with the engine's settings; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Bring a session that was opened elsewhere to :data:`RUNTIME_CONF`."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``.

    A temporary folder stands in for it only in local mode, where driver and
    executors are one process; on a cluster a missing setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    configured = configured or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="wattspan-"))
    return spark.sparkContext.getCheckpointDir()


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path below :func:`shared_root`."""
    return f"{shared_root(spark)}/wattspan/{label}-{uuid.uuid4().hex}"


@contextmanager
def session_conf(spark: SparkSession, conf: Mapping[str, str]) -> Iterator[None]:
    """Apply settings for the duration of a block, then restore the old ones.

    A streaming query copies the session settings when it starts, so wrapping
    ``start()`` is enough to give one query its own values.
    """
    before = {key: spark.conf.get(key, None) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
