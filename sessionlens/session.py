"""A Spark session with the settings the engine expects: UTC, ANSI, AQE with skew joins, RocksDB state."""

from __future__ import annotations

from pyspark.sql import SparkSession

CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # State expires in batches with data; without this, a stream with a clock would make empty batches for ever.
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def session(master: str | None = None, **conf: str) -> SparkSession:
    """Settings given here win over the engine's; on a cluster, master and sizes come from spark-submit."""
    builder = SparkSession.builder.appName("sessionlens")
    if master:
        builder = builder.master(master)
    for k, v in (CONF | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
