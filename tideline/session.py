"""Session settings every operator relies on, and the shared folder for written tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# UTC: a wall clock is turned into an instant by an explicit zone, so the session
# zone must not shift it again.  Partition values such as '2025-01' stay strings.
PINNED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

_own_dirs: dict[str, str] = {}


def build_session(app_name: str = "tideline", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**PINNED, **conf}.items():
        builder = builder.config(key, value)
    return pin(builder.getOrCreate())


def pin(spark: SparkSession) -> SparkSession:
    """Apply the pinned settings to a session that somebody else made."""
    for key, value in PINNED.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach: `spark.checkpoint.dir`.

    Where the setting is absent a local session gets its own temporary folder; on a
    cluster that would not survive a lost machine, so there it is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = context.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = tempfile.mkdtemp(prefix="tideline-")
        context.setCheckpointDir(_own_dirs[app])
    return _own_dirs[app]


def workspace(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared folder; every call gives another one."""
    return f"{shared_dir(spark)}/tideline/{name}-{uuid.uuid4().hex[:12]}"
