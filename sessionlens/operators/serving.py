"""Serving tables for the network API: what queries ask for, kept up by batches instead of rerunning the chain (API-1 to API-5).

Both tables are mergeable: a batch adds a small delta, a reader (or a compaction) takes the largest times a key. So a batch
costs what it brings, in any order and however often its delta is read.

* latest swaps: msisdn, swap_type, confirmed_at, the latest of a number and kind. A swap check asks whether the latest one is
  recent enough, so no older one matters.
* sessions: msisdn, acct_session_id, started, stopped, the latest Start and Stop. A session is active if its latest Start is
  recent and no Stop is as late: an earlier Start without a later Stop would have none after the latest one either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlens.operators.serve import checked_requests


def latest_swaps(swaps: DataFrame) -> DataFrame:
    """A batch's delta from swap_event rows, and the merge of deltas."""
    return swaps.where(F.col("confirmed_at").isNotNull()).groupBy("msisdn", "swap_type").agg(F.max("confirmed_at").alias("confirmed_at"))


def session_delta(records: DataFrame) -> DataFrame:
    """A batch's delta from records (acct_status_type, event_ts)."""
    at = lambda status: F.max(F.when(F.col("acct_status_type") == status, F.col("event_ts")))
    return records.where(F.col("acct_status_type").isin("Start", "Stop")).groupBy("msisdn", "acct_session_id").agg(at("Start").alias("started"), at("Stop").alias("stopped"))


def merged_sessions(deltas: DataFrame) -> DataFrame:
    return deltas.groupBy("msisdn", "acct_session_id").agg(F.max("started").alias("started"), F.max("stopped").alias("stopped"))


def still_needed(sessions: DataFrame, as_of: Column, hours: int = 24) -> DataFrame:
    """What a compaction at as_of keeps: a session whose latest record is older can't matter to a question of as_of or later."""
    return sessions.where(F.greatest("started", "stopped") >= as_of - F.make_dt_interval(hours=F.lit(hours)))


def verified_numbers(requests: DataFrame, sessions: DataFrame, as_of: Column, hours: int = 24) -> DataFrame:
    """API-5 from merged sessions: requests plus verified, as serve.number_verify gives it from all records."""
    recent = F.col("started") >= as_of - F.make_dt_interval(hours=F.lit(hours))
    active = sessions.where(recent & (F.col("stopped").isNull() | (F.col("stopped") < F.col("started"))))
    numbers = active.select(F.col("msisdn").alias("phone"), F.lit(True).alias("active")).distinct()
    out = checked_requests(requests).join(numbers, "phone", "left")
    return out.withColumn("verified", F.when(F.col("request_error").isNull(), F.coalesce("active", F.lit(False)))).drop("active")
