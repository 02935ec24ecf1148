"""Schemas of raw and clean records; identity columns are text, as leading zeros count."""

from __future__ import annotations

from pyspark.sql import types as T

#: The record's columns, in the order of files and messages.
RAW_COLUMNS = ["acct_status_type", "acct_session_id", "acct_session_time", "event_timestamp", "ingest_timestamp", "msisdn", "imsi", "imei", "rat_type", "framed_ip", "nas_ip", "mcc_mnc"]
RAW = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])
CLEAN = T.StructType(
    [
        T.StructField("acct_status_type", T.StringType()),
        T.StructField("acct_session_id", T.StringType()),
        T.StructField("acct_session_time", T.IntegerType()),
        T.StructField("event_timestamp", T.TimestampType()),
        T.StructField("ingest_timestamp", T.TimestampType()),
        T.StructField("msisdn", T.StringType()),
        T.StructField("imsi", T.StringType()),
        T.StructField("imei", T.StringType()),
        T.StructField("rat_type", T.StringType()),
        T.StructField("framed_ip", T.StringType()),
        T.StructField("nas_ip", T.StringType()),
        T.StructField("mcc_mnc", T.StringType()),
        T.StructField("late_arrival", T.BooleanType()),
    ]
)
