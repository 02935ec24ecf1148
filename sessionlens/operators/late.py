"""STR-2: late arrivals, a stateless predicate. More than `threshold` seconds late is late; unreadable times are on time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 3600


def delay() -> Column:
    return F.unix_seconds("ingest_ts") - F.unix_seconds("event_ts")


def is_late(threshold: int = THRESHOLD) -> Column:
    return F.coalesce(delay() > threshold, F.lit(False))


def mark_late(records: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Records whose error_code and error_details name a late arrival, where nothing else was wrong."""
    late = is_late(threshold) & F.col("error_code").isNull()
    text = F.format_string(f"Delayed %ds (threshold={threshold}s), event_timestamp=%d, ingest_timestamp=%d", delay(), F.unix_seconds("event_ts"), F.unix_seconds("ingest_ts"))
    return records.withColumn("error_details", F.when(late, text).otherwise(F.col("error_details"))).withColumn("error_code", F.when(late, "ERR_LATE_ARRIVAL").otherwise(F.col("error_code")))


def delay_buckets(records: DataFrame) -> DataFrame:
    """How late the late ones are: up to 5, 5 to 15, over 15 minutes past the threshold."""
    over = delay() - THRESHOLD
    name = F.when(over <= 300, "0-5m").when(over <= 900, "5-15m").otherwise(">15m")
    return records.where(F.col("error_code") == "ERR_LATE_ARRIVAL").groupBy(name.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
