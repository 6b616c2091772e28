"""Session helpers: recommended settings, the shared folder, scoped settings."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Temporary folders of local sessions, by application.
_LOCAL_SHARED: dict[str, str] = {}
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot account is split even when that costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(
    app: str = "spendmill", master: str | None = None, metastore: bool = False, **settings: str
) -> SparkSession:
    """Session with the recommended settings; keyword names use `__` for dots.

    `metastore` uses the cluster's Hive metastore as catalog, so that the next application finds the tables.
    """
    builder = SparkSession.builder.appName(app)
    if metastore:
        builder = builder.enableHiveSupport()
    if master:
        builder = builder.master(master)
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by the cluster in `spark.checkpoint.dir`.

    Only a local session may fall back to a temporary folder: on a cluster that folder would exist on one machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.conf.get("spark.master", "").startswith("local"):
        application = spark.sparkContext.applicationId
        if application not in _LOCAL_SHARED:
            _LOCAL_SHARED[application] = tempfile.mkdtemp(prefix="spendmill-")
        return _LOCAL_SHARED[application]
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


@contextmanager
def scoped_conf(spark: SparkSession, **settings: str) -> Iterator[None]:
    """Apply session settings (`__` for dots) and put the earlier values back afterwards."""
    names = {key.replace("__", "."): value for key, value in settings.items()}
    earlier = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in earlier.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
