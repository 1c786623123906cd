"""Session settings the jobs are made for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Skewed joins are split and partitions sized at run time; state lives off-heap.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app_name: str, **settings: str) -> SparkSession:
    """A session with ``SETTINGS``; master and sizes come from spark-submit or ``settings``.

    Keyword names are written with ``__`` for a dot: ``spark__sql__shuffle__partitions``.
    """
    builder = SparkSession.builder.appName(app_name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
