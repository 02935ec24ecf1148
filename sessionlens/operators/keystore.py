"""JOIN-4's long-term state: all keys ever stored, as a table in hash buckets that a run joins without moving it.

A run's records are dealt to the store's buckets; the store is read bucket by bucket, where it lies. So a run shuffles
what it brings, not the billions of keys before it. New keys are added in the same buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sessionlens.operators.dedup import KEY

COLUMNS = "acct_session_id STRING, acct_status_type STRING, first_seen_at TIMESTAMP"


class KeyStore:
    """Keys at a path, under a table name of the session's catalog (any that is free; the files are the store)."""

    def __init__(self, spark: SparkSession, name: str, path: str, buckets: int) -> None:
        """buckets: fixed when a store is made; give it about what a task reads with ease, and no fewer than shuffle partitions."""
        self.spark, self.name, self.path, self.buckets = spark, name, path, buckets
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({COLUMNS}) USING parquet CLUSTERED BY ({', '.join(KEY)}) INTO {buckets} BUCKETS LOCATION '{path}'")

    def keys(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, keys: DataFrame) -> None:
        """Appends keys (acct_session_id, acct_status_type, first_seen_at); a task writes whole buckets, a file each."""
        own = keys.select(*[c.split()[0] for c in COLUMNS.split(", ")]).repartition(self.buckets, *KEY)
        own.write.format("parquet").mode("append").bucketBy(self.buckets, *KEY).option("path", self.path).saveAsTable(self.name)
        self.spark.catalog.refreshTable(self.name)
