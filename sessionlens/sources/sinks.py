"""Writers: clean records by month, logs, keyed JSON messages, CSV (SNK-1 to SNK-8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlens.functions.columns import nullif_blank
from sessionlens.schemas import CLEAN, RAW_COLUMNS


def clean_projection(records: DataFrame, *others: str) -> DataFrame:
    """PRJ-3 to PRJ-6: the clean schema's columns from normalised records, after others as they are."""
    late = F.coalesce(F.col("late_arrival"), F.lit(False)) if "late_arrival" in records.columns else F.lit(False)
    special = {
        "acct_session_time": F.col("acct_session_time").try_cast("int"),
        "event_timestamp": F.col("event_ts"),
        "ingest_timestamp": F.col("ingest_ts"),
        "framed_ip": nullif_blank(F.col("framed_ip")),
        "nas_ip": nullif_blank(F.col("nas_ip")),
        "late_arrival": late,
    }
    return records.select(*others, *[special.get(f.name, F.col(f.name)).alias(f.name) for f in CLEAN])


def to_messages(records: DataFrame, key: str | None = None) -> DataFrame:
    """SNK-1, SNK-2: value is the record as JSON, key the named column if any."""
    value = F.to_json(F.struct(*records.columns)).alias("value")
    return records.select(*([F.col(key).alias("key")] if key else []), value)


def write_topic(records: DataFrame, servers: str, topic: str, key: str | None = "msisdn") -> None:
    """Needs Spark's Kafka connector on the class path."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic, "kafka.batch.size": "262144", "kafka.linger.ms": "50", "kafka.acks": "1"}
    to_messages(records, key).write.format("kafka").options(**options).save()


def write_messages(records: DataFrame, path: str, key: str = "msisdn") -> None:
    """The same messages as JSON files, a key's in one file in the order of its partition."""
    to_messages(records.repartition(key), key).write.mode("append").json(path)


def write_clean(records: DataFrame, path: str, mode: str = "append") -> None:
    """SNK-3: adds clean records by month. Rows of a month meet in one task a few files' size each, as AQE rebalances."""
    month = F.date_format("event_timestamp", "yyyy-MM")
    records.withColumn("event_month", month).hint("rebalance", "event_month").write.mode(mode).partitionBy("event_month").parquet(path)


def append_log(rows: DataFrame, path: str) -> None:
    """SNK-4 to SNK-7."""
    rows.write.mode("append").parquet(path)


def write_csv(records: DataFrame, path: str) -> None:
    """SNK-8: the raw columns with a header; other columns are left out."""
    records.select(*RAW_COLUMNS).write.mode("overwrite").option("header", True).csv(path)
