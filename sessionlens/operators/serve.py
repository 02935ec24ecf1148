"""Queries of the network API, each for a whole table of requests at once (API-1 to API-5); `as_of` stands for now."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlens.functions.columns import E164_REQUEST

#: Days that a swap check looks back where requests don't say.
MAX_AGE = 30


def checked_requests(requests: DataFrame, default_age: bool = False) -> DataFrame:
    """FLT-8: requests with phone (trimmed), max_age (MAX_AGE where there is no such column) and request_error
    (INVALID_ARGUMENT for a malformed number or a negative max_age)."""
    phone = F.trim("phone_number")
    if default_age and "max_age" not in requests.columns:
        requests = requests.withColumn("max_age", F.lit(MAX_AGE))
    bad = ~F.coalesce(phone.rlike(E164_REQUEST), F.lit(False))
    if "max_age" in requests.columns:
        bad = bad | F.coalesce(F.col("max_age") < 0, F.lit(False))
    return requests.withColumn("phone", phone).withColumn("request_error", F.when(bad, "INVALID_ARGUMENT"))


def swap_check(requests: DataFrame, swaps: DataFrame, swap_type: str, as_of: Column) -> DataFrame:
    """requests (phone_number, max_age in days) plus latest_change and swapped. SRT-2, FLT-4.

    A swap counts if it is confirmed at or after as_of less max_age days; later than as_of counts too. No max_age, no match.
    """
    asked = checked_requests(requests, default_age=True)
    numbers = asked.where(F.col("request_error").isNull()).select("phone", "max_age").distinct()
    own = swaps.where((F.col("swap_type") == swap_type) & F.col("confirmed_at").isNotNull()).select(F.col("msisdn").alias("phone"), "confirmed_at")
    since = as_of - F.make_dt_interval(F.col("max_age"))
    latest = numbers.join(own, "phone").where(F.col("confirmed_at") >= since).groupBy("phone", "max_age").agg(F.max("confirmed_at").alias("latest_change"))
    found = (F.col("a.phone") == F.col("b.phone")) & F.col("a.max_age").eqNullSafe(F.col("b.max_age"))
    out = asked.alias("a").join(latest.alias("b"), found, "left").select("a.*", "b.latest_change")
    return out.withColumn("swapped", F.when(F.col("request_error").isNull(), F.col("latest_change").isNotNull()))


def active_sessions(sessions: DataFrame, as_of: Column, hours: int = 24) -> DataFrame:
    """JOIN-2: Starts of the last hours (inclusive) without a Stop of the same number and session at the same time or later.

    The latest Stop a session decides, so the Stops are aggregated first and each Start meets one row.
    """
    starts = sessions.where((F.col("acct_status_type") == "Start") & (F.col("event_ts") >= as_of - F.make_dt_interval(hours=F.lit(hours))))
    stops = sessions.where(F.col("acct_status_type") == "Stop").groupBy("msisdn", "acct_session_id").agg(F.max("event_ts").alias("stopped"))
    return starts.join(stops, ["msisdn", "acct_session_id"], "left").where(F.col("stopped").isNull() | (F.col("stopped") < F.col("event_ts"))).drop("stopped")


def number_verify(requests: DataFrame, sessions: DataFrame, as_of: Column) -> DataFrame:
    """API-5, JOIN-3: requests plus verified: the number has an active session. Unknown numbers are false, malformed ones null."""
    asked = checked_requests(requests)
    active = active_sessions(sessions, as_of).select(F.col("msisdn").alias("phone"), F.lit(True).alias("active")).distinct()
    return asked.join(active, "phone", "left").withColumn("verified", F.when(F.col("request_error").isNull(), F.coalesce("active", F.lit(False)))).drop("active")
